"""Repeated spans of words, by compacting the repeated part of a De Bruijn graph.

Runs of ``WINDOW`` words are the edges of a graph whose nodes are runs of one word less. Only
edges that more than one document has matter, so most never leave their task: each window is
stood for by the least of its short seeds (a minimiser), seeds are counted first, and only
windows whose seed occurs in two documents are sent on as edges. Equal windows have equal
seeds, so no repeated edge is lost.

A repeated edge keeps the coordinates of its first document. Edges next to each other there
with the same number of occurrences form a nonbranching path: at a node where paths meet or
part the numbers differ. Documents that repeat a path, or a part of it, get one span with its
source coordinates instead of single edges; paths that follow each other in the text and in its
source are joined. The words at the source are then digested and compared with the words of
the span, so that a clash of hashes removes nothing.

Defined results: null and empty texts have no words and lose none; texts shorter than a window
lose none; rows with a null doc_id have no place in the order: they neither lose words nor are
they a source; rows that share a doc_id are compared with smaller doc_ids only; empty tables
give empty results; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsemill.llm.frames import map_texts, staged
from pulsemill.llm.text import split_words, windows

WINDOW = 13
SEED = 5


def _window_seeds(hashes: np.ndarray, words, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where whole windows begin, where the seed of each is, and the seeds' hashes by place."""
    grams, at = windows(hashes, words, seed)
    by_place = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    by_place[at] = grams
    counts = words.counts
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), by_place
    last = np.repeat(words.first[1:], counts)
    starts = np.flatnonzero(np.arange(n) + window <= last[:n])
    within = np.lib.stride_tricks.sliding_window_view(by_place, window - seed + 1)
    return starts, starts + within[starts].argmin(1), by_place


def _seed_places(documents: DataFrame, window: int, seed: int) -> DataFrame:
    """(gram, doc_id, at): the places of all seeds."""

    def find(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        words = split_words(batch["text"])
        _, places, grams = _window_seeds(words.hashes(), words, window, seed)
        places = np.unique(places)
        rows = words.owner[places]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(grams[places].view(np.int64)),
                batch["doc_id"].take(pa.array(rows)),
                pa.array((places - words.first[rows]).astype(np.int32)),
            ],
            ["gram", "doc_id", "at"],
        )

    return map_texts(documents, find, "gram bigint, doc_id bigint, at int")


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """The row of each element of a list column, and all elements in one array."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), 0), np.int64)
    return np.repeat(np.arange(len(column)), lengths), column.flatten()


def edge_runs(spark: SparkSession, documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, start, edges): runs of neighbouring windows that other documents may have as well."""
    places = _seed_places(documents, window, seed)
    shared = (
        places.groupBy("gram").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("gram")
    )
    flagged = places.join(shared, "gram").groupBy("doc_id").agg(F.collect_set("at").alias("places"))

    def cut(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        words = split_words(batch["text"])
        hashes = words.hashes()
        starts, seeds, _ = _window_seeds(hashes, words, window, seed)
        rows, at = _lists(batch["places"])
        marked = np.zeros(len(hashes) + 1, bool)
        marks = words.first[rows] + np.asarray(at, np.int64)
        # Rows that share a doc_id share its places; those beyond a text's end are not its own.
        marked[marks[marks < words.first[rows + 1]]] = True
        starts = starts[marked[seeds]]
        edges, at = windows(hashes, words, window)
        edges = edges[np.searchsorted(at, starts)]
        owner = words.owner[starts]
        fresh = np.ones(len(starts), bool)
        fresh[1:] = (starts[1:] != starts[:-1] + 1) | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(fresh)
        row = owner[begin]
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(pa.array(row)),
                pa.array((starts[begin] - words.first[row]).astype(np.int32)),
                pa.ListArray.from_arrays(np.append(begin, len(starts)).astype(np.int32), edges.view(np.int64)),
            ],
            ["doc_id", "start", "edges"],
        )

    runs = map_texts(documents.join(flagged, "doc_id"), cut, "doc_id bigint, start int, edges array<bigint>")
    return staged(spark, runs, "runs")


def _edges(runs: DataFrame) -> DataFrame:
    exploded = runs.select("doc_id", "start", F.posexplode("edges").alias("step", "edge"))
    return exploded.select("edge", "doc_id", (F.col("start") + F.col("step")).alias("at"))


def repeated_paths(spark: SparkSession, runs: DataFrame) -> DataFrame:
    """(edge, source, source_at, path_at): repeated edges at their first document, and where their path begins there."""
    # Plain numbers keep the aggregate in its hash table. Any place of an edge in its first document will do.
    counted = (
        _edges(runs)
        .groupBy("edge")
        .agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"), F.min_by("at", "doc_id").alias("source_at"), F.count("*").alias("n"))
        .where("source < last")
        .drop("last")
    )
    along = Window.partitionBy("source").orderBy("source_at")
    fresh = (F.lag("source_at").over(along) + 1 != F.col("source_at")) | (F.lag("n").over(along) != F.col("n"))
    begun = counted.withColumn("begins", F.when(F.coalesce(fresh, F.lit(True)), F.col("source_at")))
    path_at = F.last("begins", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, 0))
    return staged(spark, begun.select("edge", "source", "source_at", path_at.alias("path_at")), "paths")


def repeated_spans(spark: SparkSession, documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """(doc_id, at, source, source_at, length): stretches of windows that a smaller doc_id has too, path by path."""
    runs = edge_runs(spark, documents, window, seed)
    paths = repeated_paths(spark, runs)
    later = _edges(runs).join(paths, "edge").where("doc_id > source")
    steps = F.struct("at", "source", "source_at", "path_at")
    by_document = later.groupBy("doc_id").agg(F.collect_list(steps).alias("steps"))

    def compact(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        rows, steps = _lists(batch["steps"])
        at, source, source_at, path_at = (np.asarray(c) for c in steps.flatten())
        order = np.lexsort((source_at, path_at, source, at, rows))
        # Neighbours are sought along each path: same text, source, path and shift between the two.
        order = order[np.lexsort((at[order], (source_at - at)[order], path_at[order], source[order], rows[order]))]
        rows, at, source, source_at, path_at = rows[order], at[order], source[order], source_at[order], path_at[order]
        same = np.zeros(len(rows), bool)
        if len(rows):
            same[1:] = (
                (rows[1:] == rows[:-1])
                & (source[1:] == source[:-1])
                & (path_at[1:] == path_at[:-1])
                & (at[1:] == at[:-1] + 1)
                & (source_at[1:] == source_at[:-1] + 1)
            )
        begin = np.flatnonzero(~same)
        length = np.diff(np.append(begin, len(rows)))
        # Paths that follow each other in the text and in their source alike are one span.
        rows, at, source, source_at = rows[begin], at[begin], source[begin], source_at[begin]
        order = np.lexsort((at, source_at - at, source, rows))
        rows, at, source, source_at, length = rows[order], at[order], source[order], source_at[order], length[order]
        follows = np.zeros(len(rows), bool)
        if len(rows):
            follows[1:] = (
                (rows[1:] == rows[:-1])
                & (source[1:] == source[:-1])
                & (at[1:] == at[:-1] + length[:-1])
                & (source_at[1:] == source_at[:-1] + length[:-1])
            )
        begin = np.flatnonzero(~follows)
        length = np.add.reduceat(length, begin) if len(begin) else length
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(pa.array(rows[begin])),
                pa.array(at[begin].astype(np.int32)),
                pa.array(source[begin].astype(np.int64)),
                pa.array(source_at[begin].astype(np.int32)),
                pa.array(length.astype(np.int32)),
            ],
            ["doc_id", "at", "source", "source_at", "length"],
        )

    schema = "doc_id bigint, at int, source bigint, source_at int, length int"

    def compact_all(batches):
        for batch in batches:
            for start in range(0, len(batch), 256):
                yield compact(batch.slice(start, 256), None)

    return staged(spark, by_document.mapInArrow(compact_all, schema), "spans")


def _digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def source_digests(documents: DataFrame, spans: DataFrame, window: int = WINDOW) -> DataFrame:
    """(source, source_at, length, digest) of the words at the source of each different span."""
    wanted = (
        spans.select("source", "source_at", "length")
        .distinct()
        .groupBy(F.col("source").alias("doc_id"))
        .agg(F.collect_list(F.struct("source_at", "length")).alias("wanted"))
    )

    def digest(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        rows, wanted = _lists(batch["wanted"])
        at, length = (np.asarray(c) for c in wanted.flatten())
        texts, digests, held = batch["text"], [], (-1, [])
        for row, a, n in zip(rows.tolist(), at.tolist(), length.tolist(), strict=True):
            if row != held[0]:
                held = (row, (texts[row].as_py() or "").encode().split())
            digests.append(_digest(held[1][a : a + n + window - 1]))
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(pa.array(rows)),
                pa.array(at.astype(np.int32)),
                pa.array(length.astype(np.int32)),
                pa.array(digests, pa.binary()),
            ],
            ["source", "source_at", "length", "digest"],
        )

    return map_texts(documents.join(wanted, "doc_id"), digest, "source bigint, source_at int, length int, digest binary")


def covered(words: list[bytes], spans: list[tuple[int, int, bytes]], window: int = WINDOW) -> np.ndarray:
    """Marks the words inside spans whose words are those of their source."""
    out = np.zeros(len(words), bool)
    for at, length, digest in spans:
        stop = at + length + window - 1
        if stop <= len(words) and _digest(words[at:stop]) == digest:
            out[at:stop] = True
    return out


def remove_repeats(spark: SparkSession, documents: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, kept (the words that stay, joined by spaces)."""
    rows = documents.select("doc_id", "text")
    known = rows.where("doc_id is not null and text is not null")
    spans = repeated_spans(spark, known, window, seed)
    digests = source_digests(known, spans, window)
    by_document = (
        spans.join(digests, ["source", "source_at", "length"])
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("at", "length", "digest")).alias("spans"))
    )

    def remove(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        n_words, n_removed, digests, kept = [], [], [], []
        for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True):
            words = text.encode().split() if text else []
            removed = 0
            n_words.append(len(words))
            if spans:
                gone = covered(words, [(s["at"], s["length"], s["digest"]) for s in spans], window)
                removed = int(gone.sum())
                words = [words[i] for i in np.flatnonzero(~gone).tolist()]
            rest = b" ".join(words)
            n_removed.append(removed)
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest.decode())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
        )

    joined = rows.join(by_document, "doc_id", "left")
    return map_texts(joined, remove, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


# Every window against the first document that holds it.
REPEATS_SQL = """
with words as (
  select doc_id, row_number() over () as number, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from {table}),
windows as (
  select doc_id, number, i, array_to_string(w[i:i + 12], ' ') as gram
  from (select doc_id, number, w, unnest(range(1, greatest(len(w) - 11, 1))) as i from words)),
firsts as (select gram, min(doc_id) as first from windows group by gram),
covered as (
  select distinct number, i + k as place
  from windows join firsts using (gram), (select unnest(range(13)) as k) where first < doc_id),
placed as (select number, unnest(w) as word, unnest(range(1, len(w) + 1)) as place from words),
kept as (
  select p.number, count(c.place) as n_removed, string_agg(p.word, ' ' order by p.place) filter (c.place is null) as kept
  from placed p left join covered c using (number, place) group by p.number)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from words left join kept using (number)
"""
