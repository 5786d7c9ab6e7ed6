"""Query side: ranges, predicates, windowed means, summaries, pivots and resampling."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsemill.schema import SERIES, TAGS

ANY = "ANY"


def _at(df: DataFrame, when) -> Column:
    """A time as a literal of the type of ``ts``, so that the comparison reaches the scan."""
    return F.lit(str(when)).cast(df.schema["ts"].dataType)


def time_range(df: DataFrame, start=None, stop=None) -> DataFrame:
    """``start <= ts < stop``, and the same on the day partitions where the table has them."""
    for bound, keep, keep_day in ((start, "__ge__", "__ge__"), (stop, "__lt__", "__le__")):
        if bound is None:
            continue
        df = df.filter(getattr(F.col("ts"), keep)(_at(df, bound)))
        if "d" in df.columns:
            df = df.filter(getattr(F.col("d"), keep_day)(F.lit(str(bound)).cast("timestamp").cast("date")))
    return df


def since(df: DataFrame, interval: str, anchor) -> DataFrame:
    """Rows from ``interval`` before ``anchor`` on; ``anchor`` is a time or a column."""
    base = anchor if isinstance(anchor, Column) else _at(df, anchor)
    edge = base - F.expr(f"INTERVAL {interval}")
    df = df.filter(F.col("ts") >= edge)
    if "d" in df.columns:
        df = df.filter(F.col("d") >= edge.cast("date"))
    return df


def where_field(df: DataFrame, field: str, measurement: str | None = None) -> DataFrame:
    if measurement is not None:
        df = df.filter(F.col("measurement") == measurement)
    return df.filter(F.col("field") == field)


def where_fields(df: DataFrame, names: list[str]) -> DataFrame:
    """Any of these fields; the list form of an anchored alternation, which a scan can use."""
    return df.filter(F.col("field").isin(list(names)))


_PREFIX = re.compile(r"\^((?:[\w/:-]|\\\.)+)")
_LITERAL = re.compile(r"(?:[\w/:-]|\\\.)+")


def regex_predicate(c: Column, pattern: str) -> Column:
    """Unanchored regex match. Literal prefixes and infixes become string tests: these reach
    the scan (prefix) or at least skip the regex engine."""
    prefix = _PREFIX.fullmatch(pattern)
    if prefix:
        return c.startswith(prefix.group(1).replace("\\.", "."))
    if _LITERAL.fullmatch(pattern):
        return c.contains(pattern.replace("\\.", "."))
    return c.rlike(pattern)


def where_metric(df: DataFrame, pattern: str) -> DataFrame:
    return df.filter(regex_predicate(F.col("metric"), pattern))


def metric_equals(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("metric") == name)


def tag_exact(df: DataFrame, tag: str, value: str) -> DataFrame:
    return df.filter(F.col(tag) == value)


def tag_regex(df: DataFrame, tag: str, pattern: str) -> DataFrame:
    """Unanchored: SERVER1 also takes SERVER10. ``.*`` means no filter."""
    return df if pattern == ".*" else df.filter(F.col(tag).rlike(pattern))


def tag_any(df: DataFrame, tag: str, value: str) -> DataFrame:
    return df if value == ANY else tag_exact(df, tag, value)


def aggregate_window(df: DataFrame, every: str, series: list[str], start=None, stop=None) -> DataFrame:
    """Mean per series and tumbling window, labelled with the window's end (cut at ``stop``).

    Empty windows give no row. Windows count from the epoch.
    """
    means = time_range(df, start, stop).groupBy(*series, F.window("ts", every)).agg(F.avg("value").alias("value"))
    end = F.col("window.end")
    if stop is not None:
        end = F.least(end, _at(df, stop))
    return means.select(*series, end.alias("t"), "value")


def series_summary(means: DataFrame, series: list[str], calcs: list[str], time: str = "t") -> DataFrame:
    """Legend figures per series: any of mean, max and last."""
    known = {"mean": F.avg("value"), "max": F.max("value"), "last": F.max_by("value", time)}
    return means.groupBy(*series).agg(*[known[c].alias(c) for c in calcs])


def series_count(df: DataFrame, series: list[str] = SERIES) -> DataFrame:
    return df.groupBy(*series).agg(F.count("*").alias("n"))


def tag_values(df: DataFrame, tag: str, interval: str, anchor, predicate: Column | None = None) -> DataFrame:
    """Distinct values of a tag in the time before ``anchor``, optionally for a chosen product."""
    recent = since(df, interval, anchor)
    if predicate is not None:
        recent = recent.filter(predicate)
    return recent.select(tag).distinct()


def pivot_series(means: DataFrame, metrics: list[str], keys: list[str], time: str = "t") -> DataFrame:
    """One column per listed metric."""
    return means.groupBy(*keys, time).pivot("metric", list(metrics)).agg(F.first("value"))


# Up to so many columns a pivot is one aggregate with a condition for each.
_FEW = 32


def pivot_window(
    df: DataFrame, every: str, metrics: list[str], keys: list[str] = TAGS, start=None, stop=None
) -> DataFrame:
    """Windowed means with one column per metric, any number of them.

    A few metrics take a single aggregate and shuffle; a condition for each of many would be
    tried on every row, so these are averaged by name first.
    """
    rows = time_range(df, start, stop).filter(F.col("metric").isin(list(metrics)))
    if len(metrics) <= _FEW:
        cells = [F.avg(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
        wide = rows.groupBy(*keys, F.window("ts", every)).agg(*cells)
    else:
        windowed = rows.select(*keys, "metric", "value", F.window("ts", every))
        wide = windowed.groupBy(*keys, "window").pivot("metric", list(metrics)).agg(F.avg("value"))
    end = F.col("window.end") if stop is None else F.least(F.col("window.end"), _at(df, stop))
    return wide.select(*keys, end.alias("t"), *[F.col(f"`{m}`") for m in metrics])


def pivot_map(df: DataFrame, every: str, keys: list[str] = TAGS, start=None, stop=None) -> DataFrame:
    """Windowed means with all metrics of a key and window in one map: a pivot that needs no names.

    A map has as many entries as metrics match, which is at most a report's width.
    """
    means = aggregate_window(df, every, [*keys, "metric"], start, stop)
    entries = F.array_sort(F.collect_list(F.struct("metric", "value")))
    return means.groupBy(*keys, "t").agg(F.map_from_entries(entries).alias("values"))


def metric_names(catalog: DataFrame, pattern: str) -> list[str]:
    """The names of a catalogue that match, for a pivot's columns."""
    return [r["metric"] for r in where_metric(catalog, pattern).select("metric").distinct().orderBy("metric").collect()]


def resample(
    df: DataFrame, every: str, series: list[str], order: list[str], fill: bool = False, chunk_steps: int = 10_000
) -> DataFrame:
    """Last sample per series and grid step; with ``fill`` the value is held over empty steps.

    Filling works in chunks of ``chunk_steps`` steps: the next sample is found inside
    (series, chunk) and, for the last one of a chunk, from one row per chunk. No task needs a
    whole series, and no generated array is longer than a chunk.
    """
    latest = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    keyed = df.groupBy(*series, F.window("ts", every)).agg(F.max_by("value", latest).alias("value"))
    grid = keyed.select(*series, F.col("window.start").alias("t"), "value")
    return _hold(grid, every, series, chunk_steps) if fill else grid


def _hold(grid: DataFrame, every: str, series: list[str], chunk_steps: int) -> DataFrame:
    count, unit = every.split()
    length = f"{int(count) * chunk_steps} {unit}"
    step, span = F.expr(f"INTERVAL {every}"), F.expr(f"INTERVAL {length}")
    chunked = grid.withColumn("chunk", F.window("t", length)["start"])
    firsts = chunked.groupBy(*series, "chunk").agg(F.min("t").alias("first_t"))
    later = Window.partitionBy(*series).orderBy("chunk")
    firsts = firsts.withColumn("after", F.lead("first_t").over(later)).drop("first_t")
    inside = Window.partitionBy(*series, "chunk").orderBy("t")
    bounded = (
        chunked.withColumn("next_t", F.lead("t").over(inside))
        .join(firsts, [*series, "chunk"])
        .withColumn("last_t", F.coalesce("next_t", "after", F.col("t") + step) - step)
        .drop("after", "next_t")
    )
    # Chunks first, then the steps of each: a long gap never becomes one huge array.
    pieces = bounded.withColumn("piece", F.explode(F.sequence("chunk", "last_t", span)))
    low = F.greatest("t", "piece")
    high = F.least(F.col("last_t"), F.col("piece") + span - step)
    steps = pieces.filter(low <= high).withColumn("t", F.explode(F.sequence(low, high, step)))
    return steps.select(*series, "t", "value")


def first_sample(df: DataFrame, n: int = 10) -> DataFrame:
    """Earliest value of the first ``n`` metrics by name, the smallest where several are earliest."""
    known = df.where(F.col("metric").isNotNull() & F.col("ts").isNotNull())
    least = F.min(F.struct("ts", F.col("value").isNull().alias("no_value"), "value")).alias("least")
    return known.groupBy("metric").agg(least).orderBy("metric").limit(n).select("metric", "least.ts", "least.value")
