"""The catalogue of metric names: first sightings, hierarchy, panel layout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsemill.functions.scalars import subcategory, top_level

# Catalogue order: the load, archive and column a name was first seen in, then the name.
FIRST_SEEN = ["first_seq", "first_archive", "first_pos"]


def seen_metrics(columns: DataFrame) -> DataFrame:
    """First sighting of each name, from the columns (ingest_seq, archive, pos, metric) that
    gave at least one number, zeros included."""
    first = F.min(F.struct("ingest_seq", "archive", "pos")).alias("first")
    return columns.groupBy("metric").agg(first).select(
        "metric",
        F.col("first.ingest_seq").cast("long").alias("first_seq"),
        F.col("first.archive").alias("first_archive"),
        F.col("first.pos").cast("int").alias("first_pos"),
    )


def union_labels(*names: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [n.select("metric") for n in names]).distinct()


def categorise(names: DataFrame) -> DataFrame:
    metric = F.col("metric")
    return names.withColumns({"top_level": top_level(metric), "subcategory": subcategory(metric)})


def catalog_rollup(names: DataFrame) -> DataFrame:
    """Metrics per subcategory and group and in all; nulls mark the totals."""
    leaves = categorise(names).groupBy("top_level", "subcategory").agg(F.count("*").alias("n"))
    return leaves.rollup("top_level", "subcategory").agg(
        F.count("*").alias("n_sub"), F.sum("n").alias("n")
    )


def group_titles(names: DataFrame) -> DataFrame:
    """Row title of each top-level group."""
    leaves = categorise(names).groupBy("top_level", "subcategory").agg(F.count("*").alias("n"))
    groups = leaves.groupBy("top_level").agg(F.count("*").alias("n_sub"), F.sum("n").alias("n"))
    title = F.format_string(
        "[%s] - %d subcategories, %d metrics", F.upper("top_level"), F.col("n_sub"), F.col("n")
    )
    return groups.withColumn("title", title)


def numbered(df: DataFrame, group: list[str], blocks: list[str], order: list[str]) -> DataFrame:
    """Add ``position`` (1, 2, …) in the group by ``blocks`` then ``order``, and the group's ``total``.

    Counted in two levels: inside (group, block), plus the size of the blocks before it. Only
    block counts meet per group, so one huge group does not end up in one task.
    """
    sizes = df.groupBy(*group, *blocks).agg(F.count("*").alias("block_n"))
    before = Window.partitionBy(*group).orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = sizes.select(
        *group,
        *blocks,
        F.coalesce(F.sum("block_n").over(before), F.lit(0)).alias("offset"),
        F.sum("block_n").over(whole).alias("total"),
    )
    inside = Window.partitionBy(*group, *blocks).orderBy(*order)
    return (
        df.withColumn("position", F.row_number().over(inside))
        .join(offsets, [*group, *blocks])
        .withColumn("position", F.col("position") + F.col("offset"))
        .drop("offset")
    )


def panel_chunks(catalog: DataFrame, per_panel: int = 10) -> DataFrame:
    """Panel of each metric: up to ``per_panel`` per subcategory in catalogue order, two panels a row."""
    placed = numbered(
        categorise(catalog), ["top_level", "subcategory"], ["first_seq", "first_archive"], ["first_pos", "metric"]
    )
    chunk = F.floor((F.col("position") - 1) / per_panel)
    start = F.col("chunk") * per_panel + 1
    end = F.least(F.col("chunk") * per_panel + per_panel, F.col("total"))
    title = F.when(
        F.col("total") > per_panel,
        F.format_string("[%s] Metrics %d-%d of %d", "subcategory", start, end, "total"),
    ).otherwise(F.format_string("[%s] (%d metrics)", "subcategory", "total"))
    x = F.when(F.col("chunk") % 2 == 0, 0).otherwise(12)
    return placed.withColumn("chunk", chunk).select(
        "top_level", "subcategory", "metric", "position", "chunk", title.alias("title"), x.alias("x")
    )


def sort_catalog(names: DataFrame) -> DataFrame:
    return categorise(names).orderBy("top_level", "subcategory", "metric")


def sample_names(names: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` names and how many more there are."""
    total = names.agg(F.count("*")).scalar()
    return (
        names.select("metric").orderBy("metric").limit(n)
        .withColumn("remaining", F.greatest(total - n, F.lit(0)).cast("long"))
    )
