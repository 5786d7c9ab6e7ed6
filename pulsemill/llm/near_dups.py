"""Near-duplicate documents: ProbMinHash signatures, banding, verification, components.

A text is a set of shingles of five words, each weighing as often as it occurs. Every shingle
sends arrivals of a Poisson process, its rate being its weight, to random registers; a
register keeps the shingle that arrived first. Two texts agree in a register with the
probability Jaccard similarity of their weights (Ertl, ProbMinHash). A shingle stops as soon
as its next arrival is later than the latest register of its text.

Registers are banded. In each bucket all texts are compared with one head, the text that meets
the most others over all its buckets, and the verified links give components. The texts of
buckets that still hold several components are dealt in small hands, several times over, and
each hand is compared with a head of its own. Texts of such buckets that are then still apart
are joined on their rarest shingles: two similar texts differ in so few shingles that one they
share must be among these, and its places in both bound how many they do not share. So no
bucket is expanded into all its pairs, and no link between texts that share a bucket is lost.

Texts with the same words in the same order are one node from the start, however many copies
there are. Similarity is exact: probability Jaccard of the whole texts, at least 0.8.

Defined results: a text without words is compared with nothing and is its own class; texts of
one to four words have one shingle, all their words; a null doc_id takes part by its text, its
class is the smallest doc_id that is not null (null if there is none); repeated rows share a
class; empty tables give empty results; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsemill.llm.frames import free_name, map_texts, staged, text_column
from pulsemill.llm.text import Words, mix, slices, split_words, windows

SHINGLE = 5
BANDS, ROWS = 24, 5
SIMILAR = 0.8
# Texts of buckets with several components are dealt this many times, in hands of about this many.
DEALS, HAND = 8, 8
# Pairs are compared in parts of about this many, so that few copies of their texts lie on disk at a time.
PART_PAIRS = 200_000

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and number of occurrences of every different shingle, ordered by text and hash."""
    hashes, owner, counts = words.hashes(), words.owner, words.counts
    keys, at = windows(hashes, words, n)
    rows = owner[at]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        own = np.zeros(len(short), np.uint64)
        for step in range(n - 1):
            there = step < counts[short]
            at = np.minimum(words.first[short] + step, len(hashes) - 1)
            own = np.where(there, mix(own + hashes[at]), own)
        rows, keys = np.concatenate([rows, short]), np.concatenate([keys, own])
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    if not len(keys):
        return rows, keys, np.empty(0, np.int64)
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])])
    at = np.flatnonzero(new)
    return rows[at], keys[at], np.diff(np.append(at, len(keys)))


def signatures(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """ProbMinHash registers of every text: the shingle that arrived first in each (texts x registers)."""
    first = np.full(texts * registers, np.inf)
    holder = np.zeros(texts * registers, np.uint64)
    latest = np.full(texts, np.inf)
    active, clock, draw = np.arange(len(keys)), np.zeros(len(keys)), 0
    while len(active):
        # Several arrivals at a time once few shingles are left, so that short texts need few rounds.
        many = int(min(max(1, 4096 // len(active)), 256))
        steps = (np.arange(draw, draw + many, dtype=np.uint64) + np.uint64(1)) * _STEP
        noise = mix(keys[active][:, None] + steps[None, :])
        place = (mix(noise ^ _STEP) >> np.uint64(11)) % np.uint64(registers)
        chance = ((noise >> np.uint64(11)).astype(float) + 1) / float(1 << 53)
        times = clock[active][:, None] + np.cumsum(-np.log(chance) / weights[active][:, None], axis=1)
        at = (rows[active][:, None] * registers + place.astype(np.int64)).ravel()
        flat, owner = times.ravel(), np.repeat(keys[active], many)
        early = flat < first[at]
        at, flat, owner = at[early], flat[early], owner[early]
        np.minimum.at(first, at, flat)
        won = first[at] == flat
        holder[at[won]] = owner[won]
        clock[active] = times[:, -1]
        draw += many
        touched = np.unique(rows[active])
        latest[touched] = first.reshape(texts, registers)[touched].max(1)
        active = active[clock[active] < latest[rows[active]]]
    return holder.reshape(texts, registers)


def band_keys(holders: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One key for each band of registers (texts x bands)."""
    out = np.empty((len(holders), bands), np.uint64)
    for band in range(bands):
        key = np.full(len(holders), band + 1, np.uint64)
        for row in range(rows):
            key = mix(key * np.uint64(0xD1342543DE82EF95) + holders[:, band * rows + row])
        out[:, band] = key
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two texts given as ordered shingles with their counts.

    A common shingle i contributes 1 / sum over j of max(x_j / x_i, y_j / y_i); with the
    common shingles ordered by x_i / y_i each sum is two running sums.
    """
    keys, x = a
    other, y = b
    if not len(keys) or not len(other):
        return 0.0
    at = np.minimum(np.searchsorted(other, keys), len(other) - 1)
    common = other[at] == keys
    if not common.any():
        return 0.0
    xs, ys = x[common].astype(float), y[at[common]].astype(float)
    order = np.argsort(xs / ys, kind="stable")
    xs, ys = xs[order], ys[order]
    ratio = xs / ys
    after = np.searchsorted(ratio, ratio, side="right")
    x_below = np.concatenate([[0], np.cumsum(xs)])[after]
    y_below = np.concatenate([[0], np.cumsum(ys)])[after]
    # Shingles of the second text alone have ratio 0, those of the first alone an infinite one.
    y_only, x_total = float(y.sum()) - ys.sum(), float(x.sum())
    return float((xs / ((x_total - x_below) + ratio * (y_below + y_only))).sum())


def node_of(text: str | None) -> bytes | None:
    """Names a text by its words in their order; None where it has none."""
    words = text.encode().split() if text else []
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def _nodes(column: pa.Array) -> pa.Array:
    return pa.array([node_of(x) for x in column.to_pylist()], pa.binary())


def with_node(documents: DataFrame, name: str = "node") -> DataFrame:
    return documents.withColumn(name, text_column(lambda column, _: _nodes(column), "binary")("text"))


def signed(documents: DataFrame) -> DataFrame:
    """(doc_id, node, keys): the band keys of every document with words."""

    def sign(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        words = split_words(batch["text"])
        keys = band_keys(signatures(*shingles(words), len(batch), BANDS * ROWS)).view(np.int64)
        some = pa.array(words.counts > 0)
        lists = pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * BANDS, keys.ravel())
        return pa.RecordBatch.from_arrays([batch["doc_id"], _nodes(batch["text"]), lists], ["doc_id", "node", "keys"]).filter(some)

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_texts(documents.select("doc_id", "text"), sign, f"doc_id {kind}, node binary, keys array<bigint>")


def _shared_buckets(bands: DataFrame) -> DataFrame:
    """(key, node, head, texts) of every bucket with two texts or more.

    The head is the text with the most neighbours over all its buckets: in a group of copies
    the one that the others were made from.
    """
    sizes = bands.groupBy("key").agg(F.count("*").alias("texts")).where("texts > 1")
    members = bands.join(sizes, "key")
    met = members.groupBy("node").agg(F.sum("texts").alias("met"))
    members = members.join(met, "node")
    rank = F.struct("met", F.xxhash64("node").alias("tie"), "node")
    heads = members.groupBy("key").agg(F.max(rank)["node"].alias("head"))
    return members.join(heads, "key").select("key", "node", "head", "texts")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs of nodes, worked out on the whole texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vector = None, None
        for batch in batches:
            for start, stop in slices(batch["b_text"]):
                part = batch.slice(start, stop - start)
                rows, keys, counts = shingles(split_words(part["b_text"]))
                bounds = np.searchsorted(rows, np.arange(len(part) + 1))
                out = []
                # Rows come ordered by the first text, so its shingles are cut once for a run of rows.
                for i, a in enumerate(part["a"].to_pylist()):
                    if a != held:
                        _, a_keys, a_counts = shingles(split_words(part["a_text"].slice(i, 1)))
                        held, vector = a, (a_keys, a_counts)
                    own = slice(bounds[i], bounds[i + 1])
                    out.append(similarity(vector, (keys[own], counts[own])))
                yield pa.RecordBatch.from_arrays([part["a"], part["b"], pa.array(out, pa.float64())], ["a", "b", "similarity"])

    joined = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("b_text")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("a_text")), "a")
        .select("a", "b", "a_text", "b_text")
    )
    return joined.mapInArrow(compare, "a binary, b binary, similarity double")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, label): the smallest node each node of (a, b) links can reach.

    Every round takes the smallest label among neighbours and then the label of that label;
    each is written, and the rounds end when none changes.
    """
    edges = staged(spark, links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = staged(spark, edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        own = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("next"))
        far = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        following = own.join(far, "next").select("node", F.least("next", "far").alias("label"), "was")
        following = staged(spark, following, "labels")
        labels = following.select("node", "label")
        if following.where("label != was").isEmpty():
            return labels


def node_classes(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(node, label) of every text that has a near-duplicate among different texts."""
    rows = staged(spark, signed(documents), "signed")
    signs = rows.dropDuplicates(["node"]).select("node", F.explode("keys").alias("key"))
    shared = staged(spark, _shared_buckets(signs), "buckets")
    pairs = shared.where("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    wanted = shared.select("node").distinct()
    texts = staged(
        spark, with_node(documents.select("text")).join(wanted, "node", "left_semi").dropDuplicates(["node"]), "texts"
    )
    first = staged(spark, _verified(pairs, texts), "verified")
    links = first.where(F.col("similarity") >= SIMILAR).select("a", "b")
    labels = components(spark, links)

    # First by hands, which joins what can be joined with few comparisons, then whatever is left.
    def left(split: DataFrame) -> DataFrame:
        return _apart(split, staged(spark, _rare_shingles(split.select("node").distinct(), texts), "rare"))

    for candidates in (_dealt, left):
        split = staged(spark, _split_buckets(shared, labels), "split")
        if split.isEmpty():
            break
        more = _similar(spark, staged(spark, candidates(split), "pairs"), texts)
        if not more.isEmpty():
            links = links.union(more)
            labels = components(spark, links)
    return labels


def _similar(spark: SparkSession, pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that are similar, compared part by part; a text's pairs are in one part."""
    parts = 1 + pairs.count() // PART_PAIRS
    found = None
    for part in range(parts):
        chosen = pairs.where(F.pmod(F.xxhash64("a"), F.lit(parts)) == part)
        verified = staged(spark, _verified(chosen, texts).where(F.col("similarity") >= SIMILAR).select("a", "b"), "similar")
        found = verified if found is None else found.union(verified)
    return found


def _split_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, head, texts, label) of the buckets whose texts are in different components."""
    named = shared.where("texts > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    apart = named.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least != most")
    return named.join(apart.select("key"), "key", "left_semi")


def _dealt(split: DataFrame) -> DataFrame:
    """Pairs of different components, one for each text of a hand at most: the text and the hand's head.

    In each deal a text goes with one of the heads it meets, the least by a hash of that deal, so
    texts that meet the same heads mostly go together and pairs are as many as texts.
    """
    deals = split.select("head", "node", "label").distinct().withColumn("deal", F.explode(F.array(*map(F.lit, range(DEALS)))))
    least = F.min(F.struct(F.xxhash64("head", "deal").alias("rank"), "head"))["head"]
    deals = deals.groupBy("deal", "node", "label").agg(least.alias("head"))
    deals = deals.join(deals.groupBy("deal", "head").agg(F.count("*").alias("texts")), ["deal", "head"])
    hand = F.pmod(F.xxhash64("node", "head", "deal"), F.ceil(F.col("texts") / HAND))
    deals = deals.select("head", "deal", hand.alias("hand"), "node", "label")
    rank = F.struct(F.xxhash64("deal", "node").alias("rank"), "node", "label")
    firsts = deals.groupBy("head", "deal", "hand").agg(F.min(rank).alias("h"))
    firsts = firsts.select("head", "deal", "hand", F.col("h.node").alias("other"), F.col("h.label").alias("other_label"))
    return (
        deals.join(firsts, ["head", "deal", "hand"])
        .where("label != other_label")
        .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        .distinct()
    )


def _rare_shingles(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(shingle, node, place, size, slack): the rarest shingles of each text, by their order among all its shingles.

    A similar text lacks no more than a share of 1 - SIMILAR of a text's weight, so the first
    shingle, in order of rarity, that two similar texts share has at most that share before it in
    either. ``slack`` is how much a text adds to the number of shingles that only one of two
    similar texts may have.
    """

    def spread(batch: pa.RecordBatch, _: object) -> pa.RecordBatch:
        rows, keys, counts = shingles(split_words(batch["text"]))
        sizes = np.bincount(rows, minlength=len(batch))
        totals = np.bincount(rows, counts, minlength=len(batch))
        slack = (2 * totals - sizes) * (1 - SIMILAR) / (1 + SIMILAR)
        columns = [
            batch["node"].take(pa.array(rows)),
            pa.array(keys.view(np.int64)),
            pa.array(counts.astype(np.int64)),
            pa.array(sizes[rows].astype(np.int64)),
            pa.array(totals[rows]),
            pa.array(slack[rows]),
        ]
        return pa.RecordBatch.from_arrays(columns, ["node", "shingle", "weight", "size", "total", "slack"])

    schema = "node binary, shingle bigint, weight bigint, size bigint, total double, slack double"
    every = map_texts(texts.join(nodes, "node", "left_semi").select("node", "text"), spread, schema)
    # A shingle without a row here is in one text.
    common = every.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1")
    by_rarity = Window.partitionBy("node").orderBy("texts", "shingle")
    before = F.coalesce(F.sum("weight").over(by_rarity.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        every.join(common, "shingle", "left")
        .withColumn("texts", F.coalesce("texts", F.lit(1)))
        .withColumn("place", F.row_number().over(by_rarity) - 1)
        .withColumn("before", before)
        .where(F.col("before") <= (1 - SIMILAR) * F.col("total") + 1e-9)
        .where("texts > 1")
        .select("shingle", "node", "place", "size", "slack")
    )


def _apart(split: DataFrame, rare: DataFrame) -> DataFrame:
    """Pairs of texts of different components that may still be similar, from their rarest shingles.

    The similarity of two texts is at most the larger weights of their common shingles over the
    larger weights of all, so the number of shingles that only one of them has is at most the sum
    of their slacks. From the places of a common shingle follows the least that number can be, if
    it is the first they share. In the text with fewer shingles to be shared, its place is not
    beyond its own slack.
    """
    rows = rare.join(split.select("node", "label").distinct(), "node").withColumn("least", F.col("size") - F.col("slack"))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("shingle", *(F.col(c).alias(f"{name}_{c}") for c in ("node", "label", "place", "size", "slack", "least")))

    x, y = side(rows.where(F.col("place") <= F.col("slack") + 1e-9), "x"), side(rows, "y")
    after = F.abs((F.col("x_size") - F.col("x_place")) - (F.col("y_size") - F.col("y_place")))
    only_one = F.col("x_place") + F.col("y_place") + after
    smaller = F.struct("x_least", "x_node") < F.struct(F.col("y_least").alias("x_least"), F.col("y_node").alias("x_node"))
    may_be = (F.col("x_label") != F.col("y_label")) & smaller & (only_one <= F.col("x_slack") + F.col("y_slack") + 1e-9)
    return (
        x.alias("x")
        .join(y.alias("y"), (F.col("x.shingle") == F.col("y.shingle")) & may_be)
        .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b"))
        .distinct()
    )


def _class_rows(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """(doc_id, node, class): node is null for a text without words, class names the component."""
    labels = node_classes(spark, documents)
    named = with_node(documents.select("doc_id", "text")).drop("text")
    return named.join(labels, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("class"))


def duplicate_classes(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest doc_id of its class), class_size."""
    rows = staged(spark, _class_rows(spark, documents), "classes")
    sizes = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    with_words = rows.where("class is not null").join(sizes, "class").select("doc_id", "class_id", "class_size")
    without = rows.where("class is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"))
    return with_words.union(without)


def keep_one(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """The documents without near-duplicates of a smaller doc_id (null ids last); texts without words stay.

    Of rows with the same id and words one stays, the first by a hash of its text.
    """
    rows = _class_rows(spark, documents).where("class is not null")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")
    chosen = staged(spark, rows.groupBy("class").agg(F.min(order).alias("c")).select("c.doc_id", "c.node"), "chosen")
    node, rank, kept_id, kept_node = (free_name(documents, n) for n in ("__node", "__rank", "__kept_id", "__kept_node"))
    named = with_node(documents, node)
    chosen = chosen.select(F.col("doc_id").alias(kept_id), F.col("node").alias(kept_node))
    kept = named.join(chosen, named["doc_id"].eqNullSafe(chosen[kept_id]) & (named[node] == chosen[kept_node]))
    same = Window.partitionBy(kept_id, kept_node).orderBy(F.xxhash64("text"))
    kept = kept.withColumn(rank, F.row_number().over(same)).where(F.col(rank) == 1).select(*documents.columns)
    return kept.union(named.where(F.col(node).isNull()).select(*documents.columns))
