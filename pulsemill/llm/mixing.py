"""Mixing sources to target weights: hash-random order, distributed prefix sums, an exact cut.

Each source gets a target number of words. Its documents are put in a random but fixed order
by a hash, cut into ranges of the hash (as many as a range has rows), and summed: range totals
give offsets, a window inside each range gives the rest. Documents before the cut are taken whole, the one on the cut in
part. Where the target passes the source's size, every document is taken once per full epoch
and the cut falls in the last one.

Defined results: a null or empty text has size 0 and nothing is taken of it; a null source is
a source of its own and the last; rows alike in all of doc_id, size and text are counted first
and numbered after, so that repeats of one row, however many, meet in one row; empty tables
give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.frames import free_name
from pulsemill.llm.text import WORD_PATTERN

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
_KEY_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def random_key(doc_id: Column, text: Column) -> Column:
    """60 random bits of a row, the same on every run."""
    seed = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(seed), 1, _KEY_BITS // 4), 16, 10).cast("bigint")


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """Targets from (source, source_size): weights dealt in order, capped at ``most_epochs`` sizes.

    What a cap cuts off is dealt again by weight: all sources below their caps share one level,
    target = level * weight. Sorted by cap / weight, the level is found from running sums.
    ``totals`` has one row per source, so the windows over all of it stay small.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(ordered) - 1) % len(weights)
    weighted = (
        totals.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("bigint"))
        .withColumn("cap", F.col("source_size") * most_epochs)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    none = F.lit(0).cast("bigint")
    levelled = (
        weighted.withColumn("spent", F.coalesce(F.sum("cap").over(before), none))
        .withColumn("used", F.coalesce(F.sum("weight").over(before), none))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("weight_sum", F.sum("weight").over(everything))
        .withColumn("own_level", (F.col("budget") - F.col("spent")) / (F.col("weight_sum") - F.col("used")))
        .withColumn(
            "level",
            F.first(F.when(F.col("own_level") <= F.col("ratio"), F.col("own_level")), ignorenulls=True).over(everything),
        )
    )
    below = F.col("level").isNotNull() & (F.col("level") <= F.col("ratio"))
    target = F.when(below, F.col("level") * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return levelled.select("source", "source_size", "n_rows", target.alias("target"))


def _keyed(documents: DataFrame, size: str, key: str) -> DataFrame:
    return documents.withColumn(size, word_count(F.col("text"))).withColumn(key, random_key(F.col("doc_id"), F.col("text")))


def _places(keyed: DataFrame, size: str, key: str, **targets: object) -> DataFrame:
    """One row for rows alike in source, key, id and size: their number, and the words before them in their source."""
    rows = (
        keyed.select("doc_id", "source", F.col(size).alias("size"), F.col(key).alias("row_key"))
        .groupBy("source", "row_key", "doc_id", "size")
        .agg(F.count("*").alias("alike"))
    )
    totals = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("alike")).alias("source_size"), F.count("*").alias("n_rows"))
    per_source = source_targets(totals, **targets)
    placed = (
        rows.alias("r")
        .join(per_source.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
        .select("r.*", "t.source_size", "t.target", "t.n_rows")
        .withColumn("ranges", F.ceil(F.sqrt("n_rows")))
        .withColumn("range", F.floor(F.col("row_key") / F.lit(float(1 << _KEY_BITS)) * F.col("ranges")))
        .withColumn("words", F.col("size") * F.col("alike"))
    )
    offsets = placed.groupBy("source", "range").agg(F.sum("words").alias("range_words"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = offsets.select("source", "range", F.coalesce(F.sum("range_words").over(earlier), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy("source", "range").orderBy("row_key", F.col("doc_id").asc_nulls_first(), "size")
    before = F.coalesce(F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    same_range = F.col("p.source").eqNullSafe(F.col("o.source")) & (F.col("p.range") == F.col("o.range"))
    return (
        placed.withColumn("in_range", before)
        .alias("p")
        .join(offsets.alias("o"), same_range)
        .select(
            "p.source", "p.row_key", "p.doc_id", "p.size", "p.alike", "p.source_size", "p.target",
            (F.col("range_start") + F.col("in_range")).alias("before"),
        )
    )


def _taken(copy: Column) -> Column:
    """Words the mix takes of one of the rows alike, the first being copy 0."""
    before = F.col("before") + copy * F.col("size")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    cut = F.floor("target").cast("bigint") - epochs * F.col("source_size")
    return (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), cut - before))).cast("bigint")


def mix_rows(documents: DataFrame, **targets: object) -> DataFrame:
    """One row per document: doc_id, source, row_key, size, source_size, target, taken.

    ``row_key`` is the random key; documents alike in doc_id and text share it.
    """
    places = _places(_keyed(documents.select("doc_id", "source", "text"), "size", "row_key"), "size", "row_key", **targets)
    # Rows alike are numbered here, after the sums.
    copies = places.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("alike") - 1)).alias("copy"))
    return copies.select("doc_id", "source", "row_key", "size", "source_size", "target", _taken(F.col("copy")).alias("taken"))


def mix_documents(documents: DataFrame, **targets: object) -> DataFrame:
    """The documents the mix takes words of, with all their columns and ``taken`` (a free name if there is one)."""
    size, key, taken = (free_name(documents, name) for name in ("__size", "__row_key", "taken"))
    keyed = _keyed(documents, size, key)
    places = _places(keyed, size, key, **targets)
    here, there = keyed.alias("d"), places.alias("m")
    same = (
        (F.col(f"d.{key}") == F.col("m.row_key"))
        & F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
        & F.col("d.source").eqNullSafe(F.col("m.source"))
        & (F.col(f"d.{size}") == F.col("m.size"))
    )
    plan = F.struct("m.size", "m.source_size", "m.target", "m.before").alias("plan")
    whole = F.struct(*(F.col(f"d.`{c}`") for c in documents.columns)).alias("row")
    joined = here.join(there, same).select(whole, plan, F.struct("m.row_key", "m.doc_id", "m.source", "m.size").alias("alike"))
    copy = F.row_number().over(Window.partitionBy("alike").orderBy(F.lit(0))) - 1
    counted = joined.select("row", "plan.*", copy.alias("copy")).select("row", _taken(F.col("copy")).alias("words"))
    return counted.where("words > 0").select("row.*", F.col("words").alias(taken))


# The same rows without ranges: one running sum per source.
MIX_SQL = """
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint as row_key
  from {table}),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, source_size * 2 as cap,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as weight
  from totals),
levels as (
  select *, cap / weight as ratio,
         (1.5::double * sum(source_size) over () - coalesce(sum(cap) over w, 0)) / (sum(weight) over () - coalesce(sum(weight) over w, 0)) as own_level
  from weighted
  window w as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
level as (select own_level as level from levels where own_level <= ratio order by ratio, source nulls last limit 1),
targets as (
  select source, source_size,
         case when level is not null and level <= ratio then level * weight else cap::double end as target
  from levels left join level on true),
placed as (
  select s.*, t.source_size, t.target,
         coalesce(sum(s.size) over (partition by s.source order by s.row_key, s.doc_id nulls first, s.size
           rows between unbounded preceding and 1 preceding), 0)::bigint as before,
         case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end as epochs
  from sized s join targets t on s.source is not distinct from t.source),
mixed as (
  select doc_id, source, row_key, size::bigint as size, source_size, target,
         (epochs * size + greatest(0, least(size, floor(target)::bigint - epochs * source_size - before)))::bigint as taken
  from placed)
"""
