"""Conversation prefix trie: a count-min sketch of prefix digests tells which prefixes may be shared.

Every conversation is rebuilt from the head of another one and its own later turns, and becomes a
row for each of its prefixes, under a 128-bit digest that is a running sum over its turns. Texts
are not shuffled, only digests, lengths and numbers.

A count-min sketch counts all prefixes. It never counts too low, so an estimate of one proves that
a prefix belongs to one conversation: its node is known where the row stands and is written at
once. Only prefixes that may be shared are shuffled and grouped exactly; the nodes just below them
also, to learn their parent. Sketch counters stop at two, which is all the screening asks. The
sketch has a bounded size; one that is too small for its input only sends more rows to the exact
grouping.

Sums over subtrees need no walk of the trie: the value of a node is carried by the prefix row of
its smallest member, sums from the end of each conversation up give what lies below each prefix,
and summed over the members of a node they give its subtree.

Defined results: rows without conv_id belong to no conversation and count nowhere; a null role or
text is empty; rows of one turn number are ordered by a digest of role and text, and repeated rows
are turns of their own; an empty table has no trie, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm.frames import staged
from pulsemill.llm.ordered_sums import running_sums

HEADS = 6  # a head has fewer turns than this
FAMILY = 100
# Cells in each of the four rows of the sketch: four for each prefix, within these bounds. A task
# counts in 4 * MOST_CELLS bytes and the finished sketch has an eighth of that.
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 24
_ROWS = 4
_SKETCH_BLOCK = 1 << 15
_IDS_PER_CHUNK = 1 << 16


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def read_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, chars, place), the place being 1: role and text are read here only."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.unhex(F.substring(digest, 1, 32)).alias("digest"),
        F.length(text).cast("bigint").alias("chars"),
        _long(1).alias("place"),
    )


def rebuilt_turns(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations, and a row (conv_id, total, ...) for each conversation."""
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    turns = running_sums(spark, read_turns(conversations), "conv_id", order, ["place"], "turns")
    length = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("own")).withColumn("h", length)
    # The first turns of the conversations that others start with: at most HEADS - 1 in a row.
    first = turns.where((F.col("place") < HEADS) & (F.col("conv_id") % FAMILY == 0))
    heads = first.groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("turns")
    )
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(heads, "base", "left")
    head = F.slice(F.coalesce("turns", F.expr("cast(array() as array<struct<place:bigint,digest:binary,chars:bigint>>)")), F.lit(1), F.col("h").cast("int"))
    convs = convs.withColumn("head", head).withColumn("k", F.size("head").cast("bigint"))
    convs = convs.withColumn("total", F.col("k") + F.greatest(F.col("own") - F.col("h"), _long(0)))
    convs = staged(spark, convs.select("conv_id", "h", "k", "total", "head"), "conversations")
    after = turns.join(convs.select("conv_id", "h", "k", "total"), "conv_id").where("place > h")
    after = after.select("conv_id", "total", (F.col("place") - F.col("h") + F.col("k")).alias("depth"), "digest", "chars")
    before = convs.select("conv_id", "total", F.explode("head").alias("turn"))
    before = before.select("conv_id", "total", F.col("turn.place").alias("depth"), "turn.digest", "turn.chars")
    return after.unionByName(before), convs


def prefix_rows(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """A row for each prefix but the empty one: its digest (a, b) and its last turn's part of it (turn_a, turn_b)."""
    a, b = F.xxhash64("depth", "digest"), F.xxhash64("digest", "depth", F.lit(1))
    parts = turns.select("conv_id", "total", "depth", "chars", a.alias("turn_a"), b.alias("turn_b"), a.alias("a"), b.alias("b"))
    return running_sums(spark, parts, "conv_id", [F.col("depth")], ["a", "b"], "prefixes")


def _cells(a: np.ndarray, b: np.ndarray, cells: int) -> list[np.ndarray]:
    """A prefix's cell in each row of the sketch."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    return [(x >> np.uint64(s)) & np.uint64(cells - 1) for x in (a, b) for s in (0, 32)]


def cells_for(n_prefixes: int) -> int:
    cells = LEAST_CELLS
    while cells < MOST_CELLS and cells < 4 * n_prefixes:
        cells *= 2
    return cells


def sketch(prefixes: DataFrame, cells: int) -> list[np.ndarray]:
    """For each row of the sketch one bit a cell: set where at least two prefixes were counted.

    A task counts its rows up to two in every cell and sends the cells as two bitmaps, in blocks;
    the blocks of all tasks are merged by number.
    """

    size = min(_SKETCH_BLOCK, _ROWS * cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((_ROWS, cells), np.uint8)
        for batch in batches:
            for row, places in zip(counts, _cells(np.asarray(batch["a"]), np.asarray(batch["b"]), cells), strict=True):
                at, n = np.unique(places, return_counts=True)
                row[at] = np.minimum(row[at] + np.minimum(n, 2).astype(np.uint8), 2)
        for start in range(0, _ROWS * cells, size):
            block = counts.reshape(-1)[start : start + size]
            if block.any():
                bits = [[np.packbits(block >= least).tobytes()] for least in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array([start // size]), *map(pa.array, bits)], ["block", "one", "two"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, number = np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8), None
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch["block"][i].as_py()
                more, twice = (np.frombuffer(batch[name][i].as_py(), np.uint8) for name in ("one", "two"))
                two |= twice | (one & more)
                one |= more
        yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([two.tobytes()])], ["block", "two"])

    counted = prefixes.select("a", "b").mapInArrow(count, "block long, one binary, two binary")
    merged = counted.groupBy("block").applyInArrow(merge, "block long, two binary")
    bits = np.zeros(_ROWS * cells // 8, np.uint8)
    for row in merged.toArrow().to_pylist():  # bounded by the sketch's size
        at = row["block"] * size // 8
        bits[at : at + size // 8] = np.frombuffer(row["two"], np.uint8)
    return list(bits.reshape(_ROWS, -1))


def screened_prefixes(spark: SparkSession, prefixes: DataFrame, cells: int) -> DataFrame:
    """Prefixes with their parent's digest (up_a, up_b) and whether the two may be shared."""
    sent = spark.sparkContext.broadcast(sketch(prefixes, cells))

    def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        held = np.ones(len(a), bool)
        for bits, at in zip(sent.value, _cells(a, b, cells), strict=True):
            at = at.astype(np.int64)
            held &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return held

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, turn_a, turn_b = (np.asarray(batch[name]) for name in ("a", "b", "turn_a", "turn_b"))
            up_a, up_b = ((x.view(np.uint64) - y.view(np.uint64)).view(np.int64) for x, y in ((a, turn_a), (b, turn_b)))
            new = {"up_a": up_a, "up_b": up_b, "shared": shared(a, b), "up_shared": shared(up_a, up_b) | (np.asarray(batch["depth"]) == 1)}
            kept = {name: batch[name] for name in ("conv_id", "total", "depth", "chars", "a", "b")}
            yield pa.RecordBatch.from_pydict(kept | {name: pa.array(x) for name, x in new.items()})

    kind = "conv_id long, total long, depth long, chars long, a long, b long, up_a long, up_b long, shared boolean, up_shared boolean"
    return staged(spark, prefixes.mapInArrow(screen, kind), "screened-prefixes")


def hash_ends(ended: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the conversations (a, b, conv_id) that end at each node.

    The ids are joined to runs of text in parallel, over ranges of node and id; a node's runs are
    then hashed one after the other.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def run() -> pa.RecordBatch:
            text = ",".join(map(str, ids))
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, ids[0], text)], ["a", "b", "first", "ids"])

        for batch in batches:
            for a, b, conv_id in zip(*(batch[name].to_pylist() for name in ("a", "b", "conv_id")), strict=True):
                if ids and ((a, b) != node or len(ids) == _IDS_PER_CHUNK):
                    yield run()
                    ids = []
                node = a, b
                ids.append(conv_id)
        if ids:
            yield run()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None

        def done(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "ends_sha256"])

        for batch in batches:
            found = []
            for a, b, ids in zip(*(batch[name].to_pylist() for name in ("a", "b", "ids")), strict=True):
                if (a, b) == node:
                    state.update(b"," + ids.encode())
                else:
                    if node is not None:
                        found.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(ids.encode())
            yield done(found)
        if node is not None:
            yield done([(*node, state.hexdigest())])

    ranged = ended.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    joined = ranged.mapInArrow(runs, "a long, b long, first long, ids string")
    return joined.repartition("a", "b").sortWithinPartitions("a", "b", "first").mapInArrow(hashes, "a long, b long, ends_sha256 string")


def _ends(ended: Column, conv_id: Column) -> Column:
    """The hash of one conversation's id, or of nothing."""
    return F.sha2(F.when(ended, conv_id.cast("string")).otherwise(F.lit("")).cast("binary"), 256)


def prefix_trie(spark: SparkSession, conversations: DataFrame, cells: int | None = None) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt_turns(spark, conversations)
    whole = convs.agg(F.count("*"), F.min("conv_id"), F.coalesce(F.sum("total"), _long(0)), F.max("total")).first()
    n_convs, root, n_prefixes, deepest = whole
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    rows = screened_prefixes(spark, prefix_rows(spark, turns), cells or cells_for(n_prefixes))

    ended = F.col("depth") == F.col("total")
    tails = rows.where("not shared")
    alone = [
        _long(1).alias("n_convs"), F.when(ended, 0).otherwise(1).cast("bigint").alias("n_children"), _long(1).alias("n_leaves"),
        _long(0).alias("saved_tokens"), _ends(ended, F.col("conv_id")).alias("ends_sha256"),
    ]
    below_tails = tails.where("not up_shared").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *alone)

    # Exact groups of the prefixes that may be shared. All prefixes of a group have one depth, parent and text.
    possible = rows.where("shared")
    groups = possible.groupBy("a", "b").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("first_conv"), F.max("total").alias("longest"),
        *(F.max(name).alias(name) for name in ("depth", "chars", "up_a", "up_b")),
    )
    groups = staged(spark, groups, "shared-prefixes")

    # A node's tokens, and a leaf if it is one, are carried by its smallest member.
    own = F.col("conv_id") == F.col("first_conv")
    leaf = own & ended & (F.col("longest") == F.col("depth"))
    carried = possible.select("conv_id", "total", "depth", "a", "b").join(groups.select("a", "b", "n_convs", "first_conv", "longest", "chars"), ["a", "b"])
    carried = carried.select(
        "conv_id", "depth", "a", "b", F.when(own, (F.col("n_convs") - 1) * F.col("chars")).otherwise(0).cast("bigint").alias("saved_tokens"),
        F.when(leaf, 1).otherwise(0).cast("bigint").alias("n_leaves"), F.lit(True).alias("group"),
    )
    ends_alone = tails.where(ended).select("conv_id", "depth", "a", "b", _long(0).alias("saved_tokens"), _long(1).alias("n_leaves"), F.lit(False).alias("group"))
    upward = running_sums(spark, carried.unionByName(ends_alone), "conv_id", [F.col("depth").desc()], ["saved_tokens", "n_leaves"], "subtrees")
    sums = [F.sum(name).alias(name) for name in ("saved_tokens", "n_leaves")]
    subtrees = upward.where("group").groupBy("a", "b").agg(*sums)

    tops = tails.where("up_shared")
    below = groups.select("up_a", "up_b").unionByName(tops.select("up_a", "up_b"))
    children = below.groupBy(F.col("up_a").alias("a"), F.col("up_b").alias("b")).agg(F.count("*").alias("n_children"))
    no_turns = convs.where("total = 0").select(_long(0).alias("a"), _long(0).alias("b"), "conv_id")
    ends = hash_ends(possible.where(ended).select("a", "b", "conv_id").unionByName(no_turns))

    parents = groups.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("first_conv").alias("parent_conv_id"))
    first = _long(root or 0).alias("parent_conv_id")

    def with_parent(df: DataFrame, smallest: str) -> DataFrame:
        """Nodes of depth 1 have the root for a parent, whose conversation is known. A parent without a group has
        one member, which is then the node's own: the sketch took the node for shared, but not what is above it."""
        deep = df.where("depth > 1").join(parents, ["up_a", "up_b"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", smallest))
        return deep.unionByName(df.where("depth = 1").select("*", first))

    tail_tops = with_parent(tops, "conv_id").select("conv_id", "depth", "parent_conv_id", *alone)
    # The root has all conversations; what lies below it is the sum over the nodes themselves.
    at_root = carried.unionByName(ends_alone).agg(*(F.coalesce(F.sum(name), _long(0)) for name in ("saved_tokens", "n_leaves"))).first()
    stats = [root, 0, None, n_convs, 0, 0, at_root[0], 1 if deepest == 0 else at_root[1]]
    top = spark.createDataFrame([tuple(stats)] if n_convs else [], "conv_id long, depth long, parent_conv_id long, n_convs long, a long, b long, saved_tokens long, n_leaves long")
    shared = with_parent(groups, "first_conv").withColumnRenamed("first_conv", "conv_id").join(subtrees, ["a", "b"])
    shared = shared.select(*top.columns).unionByName(top)
    exact = shared.join(children, ["a", "b"], "left").join(ends, ["a", "b"], "left").withColumns(
        {"n_children": F.coalesce("n_children", _long(0)), "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256))}
    )
    return exact.select(out).unionByName(tail_tops.select(out)).unionByName(below_tails.select(out))


# Prefixes as the turns' digests strung together; a node's subtree through all pairs of node and ancestor.
TRIE_SQL = """
with turns as (
  select conv_id, turn, length(coalesce(text, ''))::bigint as chars,
         left(sha256(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 32) as digest
  from {table} where conv_id is not null),
numbered as (select conv_id, chars, digest, row_number() over (partition by conv_id order by turn nulls first, digest) as place from turns),
convs as (
  select conv_id, count(*) as own, conv_id - conv_id % 100 as base,
         xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [1::bigint, 2, 3, 4, 5, 6, 7, 8]),
             lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))) % 6 as h
  from numbered group by conv_id),
rebuilt as (
  select c.conv_id, n.place as depth, n.chars, n.digest from convs c join numbered n on n.conv_id = c.base and n.place <= c.h
  union all
  select c.conv_id, n.place - c.h + least(c.h, coalesce(b.own, 0)), n.chars, n.digest
  from convs c join numbered n on n.conv_id = c.conv_id and n.place > c.h left join convs b on b.conv_id = c.base),
prefixes as (
  select conv_id, depth, chars, md5(string_agg(digest, '') over (partition by conv_id order by depth rows unbounded preceding)) as node from rebuilt
  union all
  select conv_id, 0, 0, '' from convs),
linked as (
  select *, lag(node) over w as parent, lead(depth) over w is null as last from prefixes window w as (partition by conv_id order by depth)),
nodes as (
  select node, any_value(depth) as depth, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs,
         ((count(*) - 1) * any_value(chars))::bigint as saved, bool_and(last) as childless,
         sha256(coalesce(string_agg(case when last then conv_id::varchar end, ',' order by conv_id), '')) as ends_sha256
  from linked group by node),
children as (select parent as node, count(*) as n_children from nodes group by parent),
subtrees as (
  select l.node, sum(n.childless::bigint)::bigint as n_leaves, sum(n.saved)::bigint as saved_tokens
  from nodes n join linked l on l.conv_id = n.conv_id and l.depth <= n.depth group by l.node)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0)::bigint as n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
from nodes n join subtrees s using (node) left join nodes p on p.node = n.parent left join children c on c.node = n.node
"""
