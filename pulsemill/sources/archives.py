"""Compressed archives: listing them, and a source that reads the reports inside.

``report_archives`` is a batch and a streaming source. A task opens its archives by path, whatever
their size, and reads each of them once from front to back. It gives the report's lines and, at the
end of an archive, one closing record: member, number of lines, header, error. Of several reports
in an archive the one with the smallest path counts, and of a damaged archive nothing does; both are
known only at its end, so lines are given as they come and the few that do not count are named by
the closing records (see ``quarantine``).

Archives are listed and opened through Arrow's file systems (local, s3, gs, hdfs), not Spark's.
"""

from __future__ import annotations

import fnmatch
import json
import lzma
import tarfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from pulsemill.functions.scalars import BLANKS, drop_suffix, file_name, kilobytes, megabytes
from pulsemill.operators.joins import side_join

# kind: "line"; "report", one for each archive; "passed over", a report that a smaller path took the place of.
EXPANDED = (
    "archive string, member string, kind string, block_start long, row_id long, line string, n_lines long, header string, error string"
)
REPORT_SUFFIXES = (".csv", ".txt", ".report")
# A block of lines ends at either.
LINES_PER_BLOCK, BLOCK_BYTES = 1024, 8 << 20
# Small archives share a task up to this many compressed bytes.
TASK_BYTES = 32 << 20


def archive_inventory(spark: SparkSession, path: str | list[str], pattern: str = "*.tar.xz") -> DataFrame:
    """Files with size and age; ``state`` is the folder they lie in. File contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    files = reader.option("recursiveFileLookup", "true").load(path)
    return files.select(
        file_name(F.col("path")).alias("name"),
        drop_suffix(file_name(F.col("path")), ".tar.xz").alias("archive"),
        F.substring_index(F.substring_index("path", "/", -2), "/", 1).alias("state"),
        F.col("length").alias("size"),
        megabytes(F.col("length")).alias("size_mb"),
        kilobytes(F.col("length")).alias("size_kb"),
        F.col("modificationTime").alias("modified"),
        "path",
    )


def expand_archives(spark: SparkSession, path: str | list[str], pattern: str = "*.tar.xz") -> DataFrame:
    """Lines and closing records of all archives below ``path``."""
    return _source(spark.read, spark, path, pattern).load()


def stream_archives(spark: SparkSession, path: str | list[str], log: str, pattern: str = "*.tar.xz") -> DataFrame:
    """The same as a stream: archives that come, or change, are read in the next batch. ``log`` is a
    folder of the stream's own, kept as long as its checkpoint."""
    return _source(spark.readStream, spark, path, pattern).option("log", log).load()


def _source(reader, spark: SparkSession, path: str | list[str], pattern: str):
    spark.dataSource.register(ArchiveSource)
    paths = json.dumps([path] if isinstance(path, str) else list(path))
    return reader.format(ArchiveSource.name()).option("paths", paths).option("pattern", pattern)


def quarantine(expanded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Report lines that count, and failed archives (archive, error). Stage ``expanded`` first: it is read twice."""
    closing = expanded.filter("kind <> 'line'")
    void = closing.filter("member IS NOT NULL AND (kind = 'passed over' OR error IS NOT NULL)").select("archive", "member")
    lines = expanded.filter("kind = 'line'").select("archive", "member", "block_start", "row_id", "line")
    failed = closing.filter("kind = 'report' AND error IS NOT NULL").select("archive", "error")
    return side_join(lines, void, ["archive", "member"], "left_anti"), failed


def report_headers(expanded: DataFrame) -> DataFrame:
    """(archive, header) of every archive: the first non-blank line of its report, null if it has none."""
    closing = expanded.filter("kind = 'report'")
    return closing.select("archive", F.when(F.col("error").isNull(), F.col("header")).alias("header"))


# --- the source ---------------------------------------------------------------------------


@dataclass
class _Archives(InputPartition):
    """Paths one task reads."""

    paths: list[str]


class ArchiveSource(DataSource):
    """Options: ``paths`` (a JSON list of folders or files), ``pattern`` of file names, and for streams ``log``."""

    @classmethod
    def name(cls) -> str:
        return "report_archives"

    def schema(self) -> str:
        return EXPANDED

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)


class _BatchReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.paths, self.pattern = json.loads(options["paths"]), options["pattern"]

    def partitions(self) -> list[InputPartition]:
        return _tasks([(path, size) for path, size, _ in _list(self.paths, self.pattern)])

    def read(self, partition: _Archives) -> Iterator[pa.RecordBatch]:
        return _read_all(partition.paths)


class _StreamReader(DataSourceStreamReader):
    """An offset is a number of entries of the log. An entry lists the archives that were new when it was
    written; it is written before any batch has it, so a batch that is repeated reads the same archives."""

    def __init__(self, options) -> None:
        self.paths, self.pattern, self.log = json.loads(options["paths"]), options["pattern"], options["log"]
        self.seen: set[tuple[str, int, int]] = set()
        self.entries = 0

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        while (held := _read_text(f"{self.log}/{self.entries}")) is not None:
            self.seen.update(tuple(x) for x in json.loads(held))
            self.entries += 1
        fresh = [x for x in _list(self.paths, self.pattern) if x not in self.seen]
        if fresh:
            _write_text(f"{self.log}/{self.entries}", json.dumps(fresh))
            self.seen.update(fresh)
            self.entries += 1
        return {"entries": self.entries}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        chosen = {}
        for entry in range(start["entries"], end["entries"]):
            chosen.update({path: size for path, size, _ in json.loads(_read_text(f"{self.log}/{entry}"))})
        return _tasks(list(chosen.items()))

    def read(self, partition: _Archives) -> Iterator[pa.RecordBatch]:
        return _read_all(partition.paths)


def _filesystem(path: str):
    """The file system of a path, and the path inside it."""
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if path.startswith("/") or scheme == "file":
        return fs.LocalFileSystem(), path if path.startswith("/") else "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(("s3" if scheme == "s3a" else scheme) + ":" + rest)


def _list(paths: list[str], pattern: str) -> list[tuple[str, int, int]]:
    """(path, size, time) of the files below some folders. Names are compared with the pattern; paths are no patterns."""
    from pyarrow import fs

    found = set()
    for root in paths:
        filesystem, inner = _filesystem(root)
        inner = inner.rstrip("/")
        top = filesystem.get_file_info(inner)
        if top.type == fs.FileType.NotFound:
            raise FileNotFoundError(root)
        infos = [top] if top.type == fs.FileType.File else filesystem.get_file_info(fs.FileSelector(inner, recursive=True))
        for info in infos:
            if info.type == fs.FileType.File and fnmatch.fnmatchcase(info.base_name, pattern):
                found.add((root.rstrip("/") + info.path[len(inner) :], info.size, info.mtime_ns or 0))
    return sorted(found)


def _tasks(files: list[tuple[str, int]]) -> list[InputPartition]:
    tasks, held = [], 0
    for path, size in sorted(files, key=lambda x: (-x[1], x[0])):
        if not tasks or held + size > TASK_BYTES:
            tasks.append(_Archives([]))
            held = 0
        tasks[-1].paths.append(path)
        held += size
    return tasks


def _read_text(path: str) -> str | None:
    from pyarrow import fs

    filesystem, inner = _filesystem(path)
    if filesystem.get_file_info(inner).type == fs.FileType.NotFound:
        return None
    with filesystem.open_input_stream(inner) as stream:
        return stream.read().decode()


def _write_text(path: str, text: str) -> None:
    """Write a file that is there as a whole or not at all."""
    filesystem, inner = _filesystem(path)
    filesystem.create_dir(inner.rpartition("/")[0], recursive=True)
    with filesystem.open_output_stream(inner + ".new") as out:
        out.write(text.encode())
    filesystem.move(inner + ".new", inner)


_COLUMNS = {
    "archive": pa.string(), "member": pa.string(), "kind": pa.string(), "block_start": pa.int64(), "row_id": pa.int64(),
    "line": pa.string(), "n_lines": pa.int64(), "header": pa.string(), "error": pa.string(),
}


def _rows(n: int, **values) -> pa.RecordBatch:
    """A batch in which a list gives a column's values and anything else is repeated."""
    columns = [pa.array(x if isinstance(x := values.get(name), (list, range)) else [x] * n, kind) for name, kind in _COLUMNS.items()]
    return pa.RecordBatch.from_arrays(columns, list(_COLUMNS))


def _read_all(paths: list[str]) -> Iterator[pa.RecordBatch]:
    for path in paths:
        yield from _read_archive(path)


def _read_archive(path: str) -> Iterator[pa.RecordBatch]:
    """Lines of the reports of one archive, and its closing record. The archive is read to its end, which
    also proves that it is whole."""
    member, n_lines, header, error = None, 0, None, None
    try:
        filesystem, inner = _filesystem(path)
        with filesystem.open_input_stream(inner) as stream, tarfile.open(fileobj=stream, mode="r|xz") as archive:
            for entry in archive:
                name = entry.name
                if not entry.isfile() or not name.lower().endswith(REPORT_SUFFIXES) or (member is not None and name >= member):
                    continue
                if member is not None:
                    yield _rows(1, archive=path, member=member, kind="passed over")
                member, n_lines, header = name, 0, None
                for lines in _blocks(archive.extractfile(entry)):
                    if header is None:
                        header = next((x for x in lines if x.strip(BLANKS)), None)
                    numbers = range(n_lines, n_lines + len(lines))
                    yield _rows(len(lines), archive=path, member=member, kind="line", block_start=n_lines, row_id=numbers, line=lines)
                    n_lines += len(lines)
        error = "no report in archive" if member is None else "no lines in report" if header is None else None
    except (tarfile.TarError, EOFError, OSError, ValueError, lzma.LZMAError) as problem:
        error = f"{type(problem).__name__}: {problem}"
    yield _rows(1, archive=path, member=member, kind="report", n_lines=n_lines, header=header, error=error)


def _blocks(member) -> Iterator[list[str]]:
    """The lines of a file, some at a time."""
    parts: list[bytes] = []
    lines: list[str] = []
    held = 0
    while chunk := member.read(1 << 20):
        first, *others = chunk.split(b"\n")
        parts.append(first)
        for other in others:
            lines.append(b"".join(parts).decode("utf-8", "replace").rstrip("\r"))
            parts, held = [other], held + len(lines[-1])
            if len(lines) == LINES_PER_BLOCK or held >= BLOCK_BYTES:
                yield lines
                lines, held = [], 0
    if last := b"".join(parts):
        lines.append(last.decode("utf-8", "replace").rstrip("\r"))
    if lines:
        yield lines
