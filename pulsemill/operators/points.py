"""Point identity: overwrite order, assembling and taking apart of points, union of loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.schema import POINT, SERIES, TAGS, WRITE_ORDER


def last_write_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` for each key.

    One aggregate with map-side combining: however often a key repeats, each task sends on
    a single row for it. Rows equal in ``order`` are told apart by their remaining columns.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    # A struct cannot be hash-aggregated, so Spark sorts by the keys. The leading hash decides
    # nearly every comparison on one number instead of several strings.
    grouped = df.groupBy(F.xxhash64(*keys).alias("key_hash"), *keys)
    winner = grouped.agg(F.max(F.struct(*order, *rest)).alias("w"))
    return winner.select(*[F.col(c) if c in keys else F.col(f"w.{c}").alias(c) for c in df.columns])


def resolve_samples(samples: DataFrame) -> DataFrame:
    """One value per series and time; also settles metrics that share a field name in a line."""
    return last_write_wins(samples, [*SERIES, "ts"], WRITE_ORDER)


def claimed_twice(lines: DataFrame) -> DataFrame:
    """Points (device and time) that more than one line writes to: how many, and whether all have one header."""
    # Numbers, since the smallest of binary values could only be found by sorting the lines.
    a, b = (F.when(F.col("header_id").isNotNull(), F.xxhash64(*parts)) for parts in (["header_id"], ["header_id", F.lit(1)]))
    one = (F.min(a) == F.max(a)) & (F.min(b) == F.max(b))
    return lines.groupBy(*TAGS, "ts").agg(F.count("*").alias("n"), one.alias("one_header")).filter("n > 1")


FOLD_WIDTH = 32


def fold_lines(lines: DataFrame, keys: list[str], order: list[str], most: int, width: int = FOLD_WIDTH) -> DataFrame:
    """Merge the lines of each key and header into one: slot by slot, the value of the line that is last in ``order``.

    ``lines`` have ``numbers`` and, as ``n``, how many lines share their key; ``most`` is the largest
    of these. The result has ``cells``: an array of structs of ``order`` and ``value``, null where no
    line has a number. Arrays are merged before any value stands alone, about ``width`` at a time; a
    key that more lines share takes a further round, so no group is ever larger, however hot.
    """
    place = [F.col(c).alias(c) for c in order]
    cells = F.transform("numbers", lambda x: F.when(x.isNotNull(), F.struct(*place, x.alias("value"))))
    rows = lines.select(*keys, "header_id", "n", F.xxhash64(*order).alias("chunk"), cells.alias("cells"))
    merge = F.aggregate(
        F.slice("all", 2, F.greatest(F.size("all"), F.lit(2)) - 1),
        F.element_at("all", 1),
        lambda done, more: F.zip_with(done, more, lambda a, b: F.greatest(a, b)),
    )
    while True:
        chunks = F.ceil(F.col("n") / width)
        # One round is enough where no key has more lines than a chunk.
        chunk = F.lit(0) if most <= width else F.pmod(F.xxhash64("chunk", F.lit(most)), chunks)
        rows = rows.withColumns({"chunk": chunk.cast("bigint"), "n": chunks.cast("bigint")})
        rows = rows.groupBy(*keys, "header_id", "chunk").agg(F.first("n").alias("n"), F.collect_list("cells").alias("all"))
        rows = rows.withColumn("cells", merge).drop("all")
        if most <= width:
            return rows.drop("chunk", "n")
        most = -(-most // width)


def shared_fields(columns: DataFrame) -> DataFrame:
    """Fields that more than one column of a header writes to."""
    return columns.groupBy("header_id", "field").agg(F.count("*").alias("n")).filter("n > 1").drop("n")


def resolve_collisions(line_values: DataFrame, line_key: list[str]) -> DataFrame:
    """Within one line, the last column of those that share a field name."""
    return last_write_wins(line_values, [*line_key, "field"], ["pos"])


def union_samples(*loads: DataFrame) -> DataFrame:
    return resolve_samples(reduce(lambda a, b: a.unionByName(b), loads))


def resolve_lines(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One line per key and header: of each slot the last value. The result of ``fold_lines`` without a known ``n``."""
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    most = counted.agg(F.max("n")).first()[0] or 0
    if most <= FOLD_WIDTH:
        return fold_lines(rows.withColumn("n", F.lit(most).cast("bigint")), keys, order, most)
    return fold_lines(rows.join(counted, keys), keys, order, most)


def assemble_points(samples: DataFrame) -> DataFrame:
    """One row per point with all its fields. A group is one report line: resolve first."""
    entries = F.array_sort(F.collect_list(F.struct("field", "value")))
    return samples.groupBy(*POINT).agg(F.map_from_entries(entries).alias("fields"))


def nonempty_points(points: DataFrame) -> DataFrame:
    return points.filter(F.size("fields") > 0)


def explode_points(points: DataFrame) -> DataFrame:
    return points.select(*POINT, F.explode("fields").alias("field", "value"))


def _escape(c: Column, special: str) -> Column:
    return F.regexp_replace(c, f"([{special}])", r"\\$1")


def number_text(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"\.0$", "")


def to_line_protocol(points: DataFrame) -> DataFrame:
    """``measurement,tag=v field=1.5,other=2 <ns>`` per point, keys in name order."""
    tags = [F.concat(F.lit(f",{t}="), _escape(F.col(t), ",= ")) for t in TAGS]
    entries = F.array_sort(F.map_entries("fields"))
    fields = F.transform(
        entries, lambda e: F.concat(_escape(e["key"], ",= "), F.lit("="), number_text(e["value"]))
    )
    nanos = (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).cast("string")
    line = F.concat(
        _escape(F.col("measurement"), ", "), *tags, F.lit(" "), F.array_join(fields, ","), F.lit(" "), nanos
    )
    return points.select(line.alias("line"))
