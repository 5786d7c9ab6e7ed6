"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased (ASCII) and freed of punctuation. An n-gram is rare or common by the number
of different items that hold it, so what is found for a document does not depend on the others.
An item's word weighs one over the items that hold the commonest n-gram around it: a stem that
many items begin with weighs next to nothing, the words that make an item its own weigh most. A
leak keeps the share ``SCORE`` of that weight, so the lightest words that stay below it need no
seed: an item's seeds are its n-grams that are as rare as those around the words it cannot do
without, and all of them where none is commoner than others. Seeds are looked up in all documents
and give (document, item, place) candidates.

The item is aligned with the stretch of the document around each group of places, unless that
stretch has too few of the item's words to reach the score. The score is the alignment's share of
the item's score against itself, so edited copies are found too. Not found are copies without a
single run of ``N`` unchanged words around a word that counts. An item of fewer than ``WHOLE``
words is found as a whole only; one of fewer than ``N`` words is one n-gram.

The seeds travel to the tasks as a table of hashes; it is cut in parts of at most ``PART_HASHES``,
and the documents are read once for each part. Hits of one seed are salted before they meet the
items that hold it, and a document's text is joined with at most ``CHUNK`` items at a time.

Defined results: null and empty texts match nothing; items of fewer than ``EVIDENCE`` words are
reported but are no reason for ``drop_leaks`` to drop a document; repeated items are aligned once
and give their rows again, as do repeated documents; empty tables give empty results; extra
columns pass through ``drop_leaks`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsemill.llm.frames import free_name, map_texts, staged
from pulsemill.llm.text import Words, mix, split_words

N = 3
# Items of fewer words are found as a whole only, and of fewer than this many are no reason to drop a document.
WHOLE = 8
EVIDENCE = 4
PART_HASHES = 4_000_000
# Hits of one seed meet its items in this many places; a document's text meets this many items at a time.
SALTS = 16
CHUNK = 64
MATCH, MISMATCH, GAP = 2, -1, -1
SCORE = 0.5

PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[np.frombuffer(b".,;:!?\"'()[]{}<>*_#|", np.uint8)] = True


def plain_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words without case and punctuation, and their texts; words of nothing else are left out."""
    if not len(words.data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    skip = PUNCTUATION[words.data]
    hashes = words.hashes(lower=True, skip=skip)
    total = np.concatenate([[0], np.cumsum(~skip)])
    some = total[words.ends] > total[words.starts]
    return hashes[some], words.owner[some]


def _grams(hashes: np.ndarray, owner: np.ndarray, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every n-gram and the index of its first word. A text of fewer words has none."""
    out, at = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(hashes) >= n:
        count = len(hashes) - n + 1
        out = np.zeros(count, np.uint64)
        for k in range(n):
            out = out * np.uint64(0xD1342543DE82EF95) + hashes[k : k + count]
        whole = owner[:count] == owner[n - 1 :]
        out, at = mix(out[whole]), np.flatnonzero(whole)
    return out, at


def item_grams(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, gram, place): every n-gram of every item, or a shorter item as a whole, with the item's word hashes."""

    def cut(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        hashes, owner = plain_words(split_words(batch["text"]))
        first = np.searchsorted(owner, np.arange(len(batch) + 1))
        found = [_grams(hashes, owner)]
        for n in range(1, N):
            short, begin = _grams(hashes, owner, n)
            whole = np.diff(first)[owner[begin]] == n
            found.append((short[whole], begin[whole]))
        grams, at = (np.concatenate(x) for x in zip(*found, strict=True))
        rows = owner[at]
        words = pa.ListArray.from_arrays(first.astype(np.int32), hashes.view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch["item_id"].take(pa.array(rows)), words.take(pa.array(rows)), pa.array(grams.view(np.int64)), pa.array(at - first[rows])],
            ["item_id", "words", "gram", "place"],
        )

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return map_texts(benchmark.select("item_id", "text"), cut, f"item_id {kind}, words array<bigint>, gram bigint, place bigint")


def weigh(length: int, places: np.ndarray, items: np.ndarray, score: float) -> tuple[np.ndarray, np.ndarray]:
    """The weight of each of an item's words, and which of its n-grams are seeds.

    ``items`` tells for the n-gram at each of ``places`` how many items hold it.
    """
    size = min(N, length)
    most = np.ones(length, np.int64)
    for k in range(size):
        np.maximum.at(most, places + k, items)
    weights = 1.0 / most
    # The lightest words that stay below the score together; the next one is the lightest that counts.
    light = np.sort(weights)
    needed = light[min(int(np.searchsorted(np.cumsum(light), score * light.sum() - 1e-9)), length - 1)]
    return weights, 1.0 / items >= needed - 1e-12


def weighed_items(grams: DataFrame, score: float = SCORE) -> DataFrame:
    """(item_mark, words, weights, seeds) of every different item; a seed is an n-gram and its place in the item."""
    places = grams.select("item_mark", "gram", "place").distinct()
    held = places.select("item_mark", "gram").distinct().groupBy("gram").agg(F.count("*").alias("items"))
    words = grams.groupBy("item_mark").agg(F.first("words").alias("words"))
    profile = places.join(held, "gram").groupBy("item_mark").agg(F.collect_list(F.struct("place", "gram", "items")).alias("grams"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, seeds = [], []
            for words, found in zip(batch["words"].to_pylist(), batch["grams"].to_pylist(), strict=True):
                own, rare = weigh(len(words), np.array([x["place"] for x in found]), np.array([x["items"] for x in found]), score)
                weights.append(own.tolist())
                seeds.append([{"gram": x["gram"], "place": x["place"]} for x, chosen in zip(found, rare, strict=True) if chosen])
            seed = pa.struct([("gram", pa.int64()), ("place", pa.int64())])
            columns = [batch["item_mark"], batch["words"], pa.array(weights, pa.list_(pa.float64())), pa.array(seeds, pa.list_(seed))]
            yield pa.RecordBatch.from_arrays(columns, ["item_mark", "words", "weights", "seeds"])

    schema = "item_mark bigint, words array<bigint>, weights array<double>, seeds array<struct<gram: bigint, place: bigint>>"
    return profile.join(words, "item_mark").select("item_mark", "words", "grams").mapInArrow(choose, schema)


def _parts(seeds: DataFrame) -> Iterator[np.ndarray]:
    """The different hashes of the seeds, in ordered parts of at most ``PART_HASHES``."""
    hashes = seeds.select("gram").distinct()
    count = hashes.count()
    # Twice as many parts as would do, since a hash does not cut them evenly.
    parts = 1 if count <= PART_HASHES else -(-2 * count // PART_HASHES)
    for part in range(parts if count else 0):
        chosen = hashes.where(F.pmod(F.xxhash64("gram"), F.lit(parts)) == part) if parts > 1 else hashes
        yield np.sort(chosen.toArrow()["gram"].to_numpy())


def _hits(documents: DataFrame, wanted: np.ndarray, sizes: Sequence[int]) -> DataFrame:
    """(doc_id, mark, gram, at): where the documents have the wanted n-grams of some sizes; mark tells texts of one id apart."""

    def find(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        hashes, owner = plain_words(split_words(batch["text"]))
        first = np.searchsorted(owner, np.arange(len(batch) + 1))
        every = []
        for n in sizes:
            grams, at = _grams(hashes, owner, n)
            grams = grams.view(np.int64)
            if len(wanted):
                found = wanted[np.minimum(np.searchsorted(wanted, grams), len(wanted) - 1)] == grams
            else:
                found = np.zeros(len(grams), bool)
            grams, at = grams[found], at[found]
            if n < N:
                # An item that is one n-gram stands whole at each of its places, so that the first will do.
                _, first_of = np.unique(np.stack([owner[at], grams]), axis=1, return_index=True)
                grams, at = grams[first_of], at[first_of]
            every.append((grams, at))
        grams, at = (np.concatenate(x) for x in zip(*every, strict=True))
        rows = owner[at]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"].take(pa.array(rows)), batch["mark"].take(pa.array(rows)), pa.array(grams), pa.array(at - first[rows])],
            ["doc_id", "mark", "gram", "at"],
        )

    kind = documents.schema["doc_id"].dataType.simpleString()
    marked = documents.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return map_texts(marked, find, f"doc_id {kind}, mark bigint, gram bigint, at bigint")


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman with linear gaps: the best score, and where the alignment starts and ends in ``text``."""
    n = len(text)
    score, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps, best = np.arange(n + 1) * GAP, (0, 0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(text == word, MATCH, MISMATCH)
        above = score + GAP
        cell, begin = above, start.copy()
        better = diagonal > cell[1:]
        cell[1:][better], begin[1:][better] = diagonal[better], start[:-1][better]
        # A gap in the item's direction costs the same for each word: a running maximum finds the best.
        level = cell - steps
        top = np.maximum.accumulate(level)
        origin = np.maximum.accumulate(np.where(level == top, np.arange(n + 1), 0))
        cell, begin = top + steps, begin[origin]
        empty = cell <= 0
        cell[empty] = 0
        begin[empty] = np.flatnonzero(empty)
        score, start = cell, begin
        j = int(score.argmax())
        if score[j] > best[0]:
            best = (int(score[j]), int(start[j]), j)
    return best


def _stretches(offsets: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Stretches of the document to align: around each place an item may begin, joined where they meet."""
    out: list[tuple[int, int]] = []
    for offset in np.unique(offsets).tolist():
        a, z = offset - length // 2, offset + length + length // 2
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], z)
        else:
            out.append((a, z))
    return out


def own_words(words: np.ndarray, weights: np.ndarray, stretch: np.ndarray, score: float) -> bool:
    """Whether a stretch holds enough of what makes an item its own, and not only a stem it shares."""
    return bool(weights[np.isin(words, stretch)].sum() >= score * weights.sum() - 1e-9)


def find_leaks(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, score: float = SCORE) -> DataFrame:
    """(doc_id, mark, item_id, score, start, end, item_words): items that a document holds, and in which of its words."""
    grams = staged(spark, item_grams(benchmark).withColumn("item_mark", F.xxhash64("words")), "grams")
    items = staged(spark, weighed_items(grams, score), "items")
    seeds = items.select("item_mark", F.explode("seeds").alias("seed")).select("item_mark", "seed.gram", "seed.place")
    sizes = sorted(r["n"] for r in items.select(F.least(F.size("words"), F.lit(N)).alias("n")).distinct().collect()) or [N]
    hits = None
    for part in _parts(seeds):
        found = _hits(documents, part, sizes)
        hits = found if hits is None else hits.union(found)
    if hits is None:
        hits = _hits(documents, np.empty(0, np.int64), sizes)
    hits = staged(spark, hits, "hits").withColumn("salt", F.pmod(F.xxhash64("mark", "at"), F.lit(SALTS)))
    salted = seeds.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    in_order = Window.partitionBy("doc_id", "mark").orderBy("item_mark")
    # The words join once for a document and item, not for each of their seeds.
    candidates = (
        hits.join(salted, ["gram", "salt"])
        .groupBy("doc_id", "mark", "item_mark")
        .agg(F.collect_set(F.col("at") - F.col("place")).alias("offsets"))
        .join(items.select("item_mark", "words", "weights"), "item_mark")
        .withColumn("chunk", F.floor((F.row_number().over(in_order) - 1) / CHUNK))
        .groupBy("doc_id", "mark", "chunk")
        .agg(F.collect_list(F.struct("item_mark", "words", "weights", "offsets")).alias("candidates"))
        .select(F.col("doc_id").alias("c_id"), F.col("mark").alias("c_mark"), "candidates")
    )
    marked = documents.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    joined = marked.join(
        candidates, (F.col("mark") == F.col("c_mark")) & F.col("doc_id").eqNullSafe(F.col("c_id"))
    ).select("doc_id", "mark", "text", "candidates")

    def score_all(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        hashes, owner = plain_words(split_words(batch["text"]))
        hashes = hashes.view(np.int64)
        first = np.searchsorted(owner, np.arange(len(batch) + 1))
        rows, out = [], []
        for row, found in enumerate(batch["candidates"].to_pylist()):
            text = hashes[first[row] : first[row + 1]]
            for candidate in found:
                words, weights = np.array(candidate["words"], np.int64), np.array(candidate["weights"])
                needed = score if len(words) >= WHOLE else 1.0
                best = (0, 0, 0)
                for a, z in _stretches(np.array(candidate["offsets"], np.int64), len(words)):
                    a = max(a, 0)
                    # Each match is worth its share at most, and only words that stand there match.
                    if np.isin(words, text[a:z]).sum() < needed * len(words):
                        continue
                    got, begin, end = align(words, text[a:z])
                    if got > best[0] and own_words(words, weights, text[a + begin : a + end], score):
                        best = (got, a + begin, a + end)
                share = best[0] / (MATCH * len(words))
                if share >= needed:
                    rows.append(row)
                    out.append((candidate["item_mark"], share, best[1], best[2], len(words)))
        at = pa.array(rows, pa.int64())
        marks, shares, begins, ends, lengths = zip(*out, strict=True) if out else ((), (), (), (), ())
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(at),
                batch["mark"].take(at),
                pa.array(marks, pa.int64()),
                pa.array(shares, pa.float64()),
                pa.array(begins, pa.int64()),
                pa.array(ends, pa.int64()),
                pa.array(lengths, pa.int64()),
            ],
            ["doc_id", "mark", "item_mark", "score", "start", "end", "item_words"],
        )

    doc_kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, mark bigint, item_mark bigint, score double, start bigint, end bigint, item_words bigint"
    found = map_texts(joined, score_all, schema)
    named = grams.select("item_id", "item_mark").distinct()
    return found.join(named, "item_mark").select("doc_id", "mark", "item_id", "score", "start", "end", "item_words")


def drop_leaks(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no test item of ``EVIDENCE`` words or more, with all their columns."""
    leaks = find_leaks(spark, documents, benchmark).where(F.col("item_words") >= EVIDENCE).select("doc_id", "mark")
    leaks = staged(spark, leaks, "leaks")
    leak_id, leak_mark = free_name(documents, "__leak_id"), free_name(documents, "__leak_mark")
    leaks = leaks.select(F.col("doc_id").alias(leak_id), F.col("mark").alias(leak_mark)).distinct()
    same = documents["doc_id"].eqNullSafe(leaks[leak_id]) & (F.xxhash64(documents["text"]) == leaks[leak_mark])
    return documents.join(leaks, same, "left_anti")
