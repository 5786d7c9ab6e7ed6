import io
import tarfile

import pytest
from pyspark.sql import functions as F

from pulsemill.operators.inventory import newest_first, state_counts
from pulsemill.plans.ingest import IngestOptions, StorePaths, ingest_archives
from pulsemill.sinks.samples import read_samples
from pulsemill.sinks.tables import export_reports, read_catalog
from pulsemill.sources import archives as source
from pulsemill.sources.archives import archive_inventory, expand_archives, quarantine, report_headers
from pulsemill.sources.reports import read_parser_log
from pulsemill.streaming.streams import ingest_available

REPORT = "Time,mem.util.free,proc.x\n" + "".join(f"2025-10-09 12:{i // 60:02d}:{i % 60:02d},{i},1\n" for i in range(2500))


def pack(path, members):
    with tarfile.open(path, "w:xz") as archive:
        for name, text in members.items():
            info, data = tarfile.TarInfo(name), text.encode()
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))


@pytest.fixture
def folder(tmp_path):
    for state in ("input", "processed"):
        (tmp_path / state).mkdir()
    pack(tmp_path / "input" / "good.tar.xz", {"a/b/z.csv": "Time,other\n", "a/a/report.csv": REPORT, "a/a/run.meta": "x"})
    pack(tmp_path / "input" / "none.tar.xz", {"readme.md": "nothing"})
    whole = (tmp_path / "input" / "good.tar.xz").read_bytes()
    (tmp_path / "input" / "cut.tar.xz").write_bytes(whole[: len(whole) // 2])
    (tmp_path / "input" / "junk.tar.xz").write_bytes(b"not an archive at all")
    (tmp_path / "input" / "other.zip").write_bytes(b"x")
    pack(tmp_path / "processed" / "old.tar.xz", {"r.csv": REPORT})
    return tmp_path


@pytest.mark.parametrize("task_bytes", [1, 1 << 30])
def test_expand(spark, folder, task_bytes, monkeypatch):
    monkeypatch.setattr(source, "TASK_BYTES", task_bytes)
    expanded = expand_archives(spark, str(folder / "input"))
    assert expanded.rdd.getNumPartitions() == (4 if task_bytes == 1 else 1)
    good, failed = quarantine(expanded)
    rows = good.orderBy("row_id").collect()
    assert [x["line"] for x in rows] == REPORT.splitlines()
    assert {x["member"] for x in rows} == {"a/a/report.csv"}
    assert [x["row_id"] for x in rows] == list(range(2501))
    assert sorted({x["block_start"] for x in rows}) == [0, 1024, 2048]
    errors = {x["archive"].rsplit("/", 1)[1]: x["error"] for x in failed.collect()}
    assert set(errors) == {"none.tar.xz", "cut.tar.xz", "junk.tar.xz"}
    assert errors["none.tar.xz"] == "no report in archive"


def test_a_header_behind_blank_blocks_is_found(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for blank in (0, 1023, 1024, 3000):
        pack(tmp_path / "in" / f"b{blank}.tar.xz", {"r.csv": "\n" * blank + "Time,mem.util.free\n2025-10-09 12:00:00,1\n2025-10-09 12:00:01,2\n"})
    store = StorePaths(str(tmp_path / "store"))
    ingest_archives(spark, expand_archives(spark, str(tmp_path / "in")), store, 1, IngestOptions())
    ledger = spark.read.parquet(store.ledger).groupBy("status").count().collect()
    assert [(x["status"], x["count"]) for x in ledger] == [("processed", 4)]


def test_ingest_archives(spark, folder, tmp_path):
    store = StorePaths(str(tmp_path / "store"))
    files = expand_archives(spark, str(folder / "input"))
    for seq in (1, 2):
        ingest_archives(spark, files, store, seq, IngestOptions(policy=("skip_zero",)), keep_bronze=True)
    samples = read_samples(spark, store.samples)
    assert samples.count() == 2499 and {x["metric"] for x in samples.select("metric").distinct().collect()} == {"mem.util.free"}
    assert [x["metric"] for x in read_catalog(spark, store.catalog).collect()] == ["mem.util.free"]
    ledger = spark.read.parquet(store.ledger).groupBy("ingest_seq", "status").count().collect()
    assert {(x["ingest_seq"], x["status"]): x["count"] for x in ledger} == {
        (1, "processed"): 1, (1, "failed"): 3, (2, "processed"): 1, (2, "failed"): 3,
    }
    assert spark.read.parquet(store.bronze).filter("kind = 'line' AND member = 'a/a/report.csv' AND archive LIKE '%good%'").count() == 2 * 2501


def test_inventory(spark, folder, plan_of):
    files = archive_inventory(spark, str(folder))
    assert {x["state"]: x["n"] for x in state_counts(files).collect()} == {"input": 4, "processed": 1}
    rows = newest_first(files).collect()
    assert [x["modified"] for x in rows] == sorted((x["modified"] for x in rows), reverse=True)
    good = next(x for x in rows if x["name"] == "good.tar.xz")
    size = (folder / "input" / "good.tar.xz").stat().st_size
    assert (good["archive"], good["size"], good["size_kb"]) == ("good", size, round(size / 1024, 2))
    assert "content" not in plan_of(files)


def test_parser_log(spark, tmp_path):
    (tmp_path / "svc").mkdir()
    (tmp_path / "svc" / "run.log").write_text("[2025-10-09 12:00:00] started [1]\nplain text\n[2025-13-09 12:00:00] odd\n")
    (tmp_path / "svc" / "web.log").write_text("other log\n")
    logs = read_parser_log(spark, str(tmp_path))
    names = {(x["log"].removeprefix("file:").replace("//", ""), x["path"]) for x in logs.select("log", "path").distinct().collect()}
    assert names == {(str(tmp_path / "svc" / n), n) for n in ("run.log", "web.log")}
    whole = read_parser_log(spark, str(tmp_path), log=F.regexp_extract("path", "([^/]*)/[^/]*$", 1))
    rows = whole.where("path = 'run.log'").orderBy("row_id").collect()
    assert [(x["log"], x["path"]) for x in rows] == [("svc", "run.log")] * 3
    assert [x["message"] for x in rows] == ["started [1]", None, "odd"]
    assert [x["ts"] is None for x in rows] == [False, True, True]


def test_exported_reports_keep_their_lines(spark, folder, tmp_path):
    good, _ = quarantine(expand_archives(spark, str(folder / "input")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export_reports(good, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "out" / "report=good.tar.xz").glob("part-*"))
    assert len(parts) > 1
    assert "".join(part.read_text() for part in parts) == REPORT


def test_directory_of_archives(spark, folder, tmp_path):
    store = StorePaths(str(tmp_path / "store"))
    for _ in range(2):
        ingest_available(spark, str(folder / "input"), store, str(tmp_path / "c"), archives=True, files_per_batch=3)
    assert read_samples(spark, store.samples).count() == 2500
    ledger = spark.read.parquet(store.ledger)
    assert {x["status"]: x["count"] for x in ledger.groupBy("status").count().collect()} == {"processed": 1, "failed": 3}


def test_an_empty_report_is_a_failed_archive(spark, tmp_path):
    pack(tmp_path / "empty.tar.xz", {"a/report.csv": ""})
    good, failed = quarantine(expand_archives(spark, str(tmp_path)))
    assert good.count() == 0 and [x["error"] for x in failed.collect()] == ["no lines in report"]


def names(rows):
    return {x["archive"].rsplit("/", 1)[1]: x for x in rows}


def test_closing_records(spark, folder):
    pack(folder / "input" / "two.tar.xz", {"z.csv": REPORT, "b.csv": "Time,x\n", "a.csv": "\n \n2025-10-09 12:00:00,1\n", "y.csv": "never\n"})
    expanded = expand_archives(spark, str(folder / "input"))
    closing = names(expanded.filter("kind = 'report'").collect())
    assert [closing["two.tar.xz"][c] for c in ("member", "n_lines", "header", "error")] == ["a.csv", 3, "2025-10-09 12:00:00,1", None]
    assert closing["cut.tar.xz"]["error"] and closing["none.tar.xz"]["member"] is None and len(closing) == 5
    passed = expanded.filter("kind = 'passed over'").select("member").collect()
    assert sorted(x["member"] for x in passed) == ["a/b/z.csv", "a/b/z.csv", "b.csv", "z.csv"]
    good, _ = quarantine(expanded)
    assert good.filter("archive LIKE '%two.tar.xz'").count() == 3
    headers = names(report_headers(expanded).collect())
    assert headers["good.tar.xz"]["header"] == "Time,mem.util.free,proc.x" and headers["cut.tar.xz"]["header"] is None


def test_each_archive_is_unpacked_once(folder, monkeypatch):
    opened = []
    real = source.tarfile.open
    monkeypatch.setattr(source.tarfile, "open", lambda **more: (opened.append(1), real(**more))[1])
    rows = sum(b.num_rows for b in source._read_archive(str(folder / "input" / "good.tar.xz")))
    assert len(opened) == 1 and rows == 2501 + 1 + 1 + 1


def test_names_are_no_patterns(spark, tmp_path):
    """Names with glob characters, blanks, percent signs and other letters, as a folder and as single files."""
    wanted = ["run[1].tar.xz", "a*b?.tar.xz", "{x,y} %41.tar.xz", "ü.tar.xz"]
    (tmp_path / "in[1]").mkdir()
    for name in wanted:
        pack(tmp_path / "in[1]" / name, {"r.csv": REPORT})
    folder = expand_archives(spark, str(tmp_path / "in[1]"))
    assert set(names(folder.filter("kind = 'report' AND error IS NULL").collect())) == set(wanted)
    single = expand_archives(spark, [f"file:{tmp_path}/in[1]/{n}" for n in wanted[:2]])
    assert single.filter("kind = 'line'").count() == 2 * 2501
    with pytest.raises(Exception, match="nowhere"):
        expand_archives(spark, str(tmp_path / "nowhere")).count()


def test_ledger_has_every_archive(spark, tmp_path):
    (tmp_path / "in").mkdir()
    kinds = {"good": {"r.csv": REPORT}, "run[1]": {"r.csv": "\n" * 3000 + REPORT}, "blank": {"r.csv": "\n" * 1500}, "empty": {"r.csv": ""},
             "none": {"x.bin": "x"}, "only": {"r.csv": "Time,a\n"}, "text": {"r.csv": "Time,a\n2025-10-09 12:00:00,x\n"}}
    for name, members in kinds.items():
        pack(tmp_path / "in" / f"{name}.tar.xz", members)
    (tmp_path / "in" / "junk.tar.xz").write_bytes(b"junk")
    store = StorePaths(str(tmp_path / "store"))
    ingest_available(spark, str(tmp_path / "in"), store, str(tmp_path / "c"), archives=True)
    rows = {k.removesuffix(".tar.xz"): v for k, v in names(spark.read.parquet(store.ledger).collect()).items()}
    assert {k: (v["status"], v["error"]) for k, v in rows.items() if k != "junk"} == {
        "good": ("processed", None), "run[1]": ("processed", None), "blank": ("failed", "no lines in report"),
        "empty": ("failed", "no lines in report"), "none": ("failed", "no report in archive"),
        "only": ("failed", "no usable points"), "text": ("failed", "no usable points"),
    }
    assert rows["junk"]["status"] == "failed" and "ReadError" in rows["junk"]["error"]
    assert rows["good"]["lines"] == rows["run[1]"]["lines"] == 2500 and rows["blank"]["lines"] == rows["junk"]["values"] == 0


def test_stream_takes_what_is_new_or_changed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store, run = StorePaths(str(tmp_path / "store")), lambda: ingest_available(spark, str(tmp_path / "in"), store, str(tmp_path / "c"), archives=True)
    first = tmp_path / "in" / "run[1].tar.xz"
    first.write_bytes(b"half an upload")
    run()
    pack(first, {"r.csv": REPORT})
    run()
    run()
    pack(tmp_path / "in" / "old.tar.xz", {"r.csv": "Time,x\n2025-10-10 12:00:00,5\n"})
    import os

    os.utime(tmp_path / "in" / "old.tar.xz", (1, 1))  # older than all that was read
    run()
    assert read_samples(spark, store.samples).count() == 2501
    ledger = spark.read.parquet(store.ledger).orderBy("ingest_seq").collect()
    assert [(x["ingest_seq"], x["status"]) for x in ledger] == [(1, "failed"), (2, "processed"), (3, "processed")]


def test_long_lines_and_wide_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(source, "BLOCK_BYTES", 1000)
    lines = ["x" * 3_000_000, "", "y\r", *[str(i) * 400 for i in range(9)], "last"]
    pack(tmp_path / "w.tar.xz", {"r.txt": "\n".join(lines)})
    batches = list(source._read_archive(str(tmp_path / "w.tar.xz")))
    assert [x for b in batches[:-1] for x in b["line"].to_pylist()] == [x.rstrip("\r") for x in lines]
    assert [x for b in batches[:-1] for x in b["row_id"].to_pylist()] == list(range(len(lines)))
