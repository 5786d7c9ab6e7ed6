"""From report lines to typed values.

A report is wide: its header may name ten thousand columns and every file has its own.
Lines stay arrays of text, headers become a narrow table of columns, and the two meet on two
numbers after the cells are exploded. Choosing metrics means filtering that narrow table: the
cells of other columns are never read as numbers, exploded or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pulsemill.functions.scalars import (
    clean_cell,
    decimal_text,
    finite,
    is_null_token,
    names_nothing,
    normalise_header,
    parse_ts,
    sanitize_field,
    split_line,
    strip,
    to_number,
)
from pulsemill.operators.joins import BROADCAST_LIMIT, Side, measured_bytes, side_join, stage_side
from pulsemill.schema import CATEGORY_RULES
from pulsemill.session import scratch_path

LINE_KEY = ["archive", "block_start", "row_id"]


class Headers(NamedTuple):
    """``archives``: every archive, with or without a header. ``files``: archive, header_id, width.
    ``layouts``: header_id and the positions of its wanted columns. ``columns``: header_id, slot
    (place among the wanted), pos, metric, field; ``side`` is the same with its size."""

    archives: DataFrame
    files: Side
    layouts: Side
    columns: DataFrame
    columns_size: int

    @property
    def side(self) -> Side:
        return Side(self.columns, self.columns_size)


def _header(line: Column) -> Column:
    """A first line as header; null for a timestamped one."""
    opens_with_ts = parse_ts(F.substring_index(strip(line), ",", 1)).isNotNull()
    return F.when(~opens_with_ts, strip(line))


def header_lines(lines: DataFrame) -> DataFrame:
    """First non-blank line of each archive as (archive, header).

    It may stand in any block, behind blank ones. Timestamped lines are carried as null, so
    what gets sorted per archive is one id per line and not the line. An archive that opens
    with a timestamped line has a null header: all its lines then fail the arity check. An
    archive of blank lines has a null header too.
    """
    place = F.when(strip(F.col("line")) != "", F.struct("block_start", "row_id"))
    candidates = lines.select("archive", place.alias("place"), _header(F.col("line")).alias("header"))
    return candidates.groupBy("archive").agg(F.min_by("header", "place").alias("header"))


def read_headers(
    spark: SparkSession,
    lines: DataFrame,
    select: Callable[[DataFrame], DataFrame] = lambda columns: columns,
    first_lines: DataFrame | None = None,
) -> Headers:
    """Header tables of a set of reports, written once so that later plans only look them up.

    ``select`` chooses among the columns (header_id, pos, metric, field). ``first_lines`` (archive,
    header), if the source knows them already, saves a pass over the lines.
    """
    path = scratch_path(spark, "headers")
    if first_lines is None:
        first_lines = header_lines(lines)
    else:
        first_lines = first_lines.select("archive", _header(F.col("header")).alias("header"))
    # 128 bits of a hash tell headers apart.
    header_id = F.unhex(F.substring(F.sha2("header", 256), 1, 32))
    width = F.size(split_line(F.col("header")))
    files = first_lines.select("archive", header_id.alias("header_id"), F.when(F.col("header").isNotNull(), width).alias("width"), "header")
    files.write.parquet(f"{path}/lines")
    first = spark.read.schema(files.schema).parquet(f"{path}/lines")
    columns = (
        first.filter("header IS NOT NULL")
        .groupBy("header_id")
        .agg(F.first("header").alias("header"))
        .select("header_id", F.posexplode(normalise_header(F.col("header"))).alias("pos", "metric"))
        .filter("pos > 0")
        .withColumn("field", sanitize_field(F.col("metric")))
    )
    # A group is one header, so a list is never longer than a line.
    wanted = select(columns).groupBy("header_id").agg(F.array_sort(F.collect_list(F.struct("pos", "metric", "field"))).alias("wanted"))
    names = F.aggregate("wanted", F.lit(0).cast("bigint"), lambda n, c: n + F.octet_length(c["metric"]) + F.octet_length(c["field"]))
    seen = Observation()
    wanted = wanted.observe(seen, F.sum(48 + 8 * F.size("wanted")).alias("layouts"), F.sum(80 * F.size("wanted") + names).alias("columns"))
    wanted.write.parquet(f"{path}/wanted")
    layouts = spark.read.schema(wanted.schema).parquet(f"{path}/wanted")
    sizes = {name: seen.get.get(name) or 0 for name in ("layouts", "columns")}
    return Headers(
        first.select("archive"),
        stage_side(spark, first.select("archive", "header_id", "width"), f"{path}/files"),
        Side(layouts.select("header_id", F.col("wanted.pos").alias("positions")), sizes["layouts"]),
        layouts.select("header_id", F.posexplode("wanted").alias("slot", "column")).select("header_id", "slot", "column.*"),
        sizes["columns"],
    )


def attach_header(lines: DataFrame, headers: Headers, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Give each non-blank line its header_id, header width and wanted positions (all null if
    the file has no header)."""
    kept = lines.filter(strip(F.col("line")) != "")
    known = side_join(kept, headers.files, "archive", "left", limit)
    return side_join(known, headers.layouts, "header_id", "left", limit)


def parse_lines(attached: DataFrame) -> DataFrame:
    """Split lines into cells and read the timestamp; nothing is dropped yet."""
    cells = split_line(F.col("line"))
    parsed = attached.withColumn("cells", cells).withColumn("ts", parse_ts(F.col("cells")[0]))
    fits = F.coalesce(F.size("cells") == F.col("width"), F.lit(False))
    return parsed.withColumn("arity_ok", fits).drop("line")


def check_arity(rows: DataFrame) -> DataFrame:
    return rows.filter("arity_ok")


def check_ts(rows: DataFrame) -> DataFrame:
    """Drop rows without a readable timestamp; the header line goes with them."""
    return rows.filter("ts IS NOT NULL")


def read_numbers(parsed: DataFrame) -> DataFrame:
    """Turn ``cells`` into an array with one double per wanted column, and count the cells that
    are none. Each cell is read once, inside its line's array. Lines that fail a check get no
    array.
    """
    usable = F.col("arity_ok") & F.col("ts").isNotNull()
    wanted = F.transform("positions", lambda pos: clean_cell(F.get("cells", pos)))
    cleaned = parsed.withColumn("cells", F.when(usable, F.coalesce(wanted, F.array().cast("array<string>"))))
    numbers = F.transform(F.transform("cells", decimal_text), finite)
    read = cleaned.withColumn("numbers", numbers)
    # Only cells that gave no number can be null tokens.
    missing = F.filter("cells", lambda cell, i: F.get("numbers", i).isNull() & names_nothing(cell))
    n_text = F.size("numbers") - F.size(F.array_compact("numbers")) - F.col("n_null")
    counted = read.withColumn("n_null", F.when(usable, F.size(missing))).withColumn("n_text", F.when(usable, n_text))
    return counted.drop("cells", "positions")


_LINE_ONLY = ("cells", "positions", "numbers", "width", "arity_ok", "n_null", "n_text", "member")


def melt(rows: DataFrame, columns: DataFrame | Side, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """One row per number, named by its header column.

    Past the limit of a broadcast, lines and not values are shuffled to their header's columns.
    """
    keep = [c for c in rows.columns if c not in _LINE_ONLY]
    table, size = columns if isinstance(columns, Side) else (columns, measured_bytes(columns))
    if size <= limit:
        values = rows.select(*keep, F.posexplode("numbers").alias("slot", "value")).filter("value IS NOT NULL")
        return side_join(values, Side(table, size), ["header_id", "slot"], "inner", limit).drop("header_id", "slot")
    # A group is one header, so a list is never longer than a line.
    listed = F.collect_list(F.struct("slot", "pos", "metric", "field")).alias("columns")
    headers = table.groupBy("header_id").agg(listed)
    named = _salted(rows, headers).select(
        *[c for c in keep if c != "header_id"],
        F.explode(F.transform("columns", lambda c: F.struct(F.get("numbers", c["slot"]).alias("value"), c.alias("column")))).alias("cell"),
    )
    kept = named.filter("cell.value IS NOT NULL")
    return kept.select(*[c for c in keep if c != "header_id"], "cell.value", "cell.column.pos", "cell.column.metric", "cell.column.field")


def _salted(lines: DataFrame, headers: DataFrame, salts: int = 8) -> DataFrame:
    """Join lines with their header by shuffling both; the lines of one header go to ``salts`` tasks."""
    own = [c for c in LINE_KEY if c in lines.columns] or ["numbers"]
    dealt = lines.withColumn("salt", F.pmod(F.xxhash64(*own), F.lit(salts)).cast("int"))
    copies = headers.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, ["header_id", "salt"]).drop("salt")


def header_fields(columns: DataFrame) -> DataFrame:
    """One row per header: its fields, each with the columns that write to it."""
    writers = F.collect_list(F.struct("slot", "pos", "metric")).alias("writers")
    fields = columns.groupBy("header_id", "field").agg(writers)
    return fields.groupBy("header_id").agg(F.collect_list(F.struct("field", "writers")).alias("fields"))


def _line_fields(lines: DataFrame, columns: DataFrame | Side, order: list[str], limit: int) -> DataFrame:
    """Lines with ``fields``: of the columns that write to a field, the last that has a number."""
    source = "cells" if order else "numbers"

    def written(writer: Column) -> Column:
        cell = F.get(source, writer["slot"])
        value = cell["value"] if order else cell
        return F.when(
            cell.isNotNull(),
            F.struct(*[cell[c].alias(c) for c in order], writer["pos"].alias("pos"), value.alias("value"), writer["metric"].alias("metric")),
        )

    table, size = columns if isinstance(columns, Side) else (columns, measured_bytes(columns))
    headers = header_fields(table)
    joined = lines.join(F.broadcast(headers), "header_id") if size <= limit else _salted(lines, headers)
    last = F.transform("fields", lambda f: F.struct(f["field"].alias("field"), F.array_max(F.transform(f["writers"], written)).alias("last")))
    return joined.withColumn("fields", F.filter(last, lambda f: f["last"].isNotNull()))


def melt_fields(
    lines: DataFrame, columns: DataFrame | Side, order: list[str] | None = None, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """One row per field of each line: of the columns that write to it, the last that has a number.

    Lines come with ``numbers``, or from ``fold_lines`` with ``cells``, whose ``order`` then comes
    first and is given out. Everything happens inside a line; no value is compared across rows.
    """
    keep = [c for c in lines.columns if c not in (*_LINE_ONLY, "header_id")]
    named = _line_fields(lines, columns, order or [], limit).select(*keep, F.explode("fields").alias("of"))
    return named.select(*keep, "of.field", "of.last.*")


def assemble_lines(
    lines: DataFrame, columns: DataFrame | Side, order: list[str] | None = None, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """Lines, each the only one of its point, with ``fields`` as a map: points without a detour through single values."""
    keep = [c for c in lines.columns if c not in (*_LINE_ONLY, "header_id")]
    entries = F.transform("fields", lambda f: F.struct(f["field"], f["last"]["value"]))
    named = _line_fields(lines, columns, order or [], limit)
    return named.select(*keep, F.map_from_entries(F.array_sort(entries)).alias("fields"))


def numeric_columns(rows: DataFrame, columns: DataFrame | Side, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Columns of each archive that gave a number. Counted by slot, named afterwards."""
    cells = rows.select("archive", "header_id", F.posexplode("numbers").alias("slot", "value"))
    found = cells.filter("value IS NOT NULL").groupBy("archive", "header_id", "slot").agg(F.count("*").alias("n"))
    return side_join(found, columns, ["header_id", "slot"], "inner", limit).drop("header_id", "slot")


def _policies(policy: list[str] | tuple[str, ...]) -> set[str]:
    return {p.strip().lower() for p in policy if p.strip()}


def skips_zero(policy: list[str] | tuple[str, ...]) -> bool:
    return "skip_zero" in _policies(policy)


def gives_value(skip_zero: bool = False) -> Column:
    """Whether a line's array holds a number that the value filter keeps."""
    return F.coalesce(F.exists("numbers", lambda x: x.isNotNull() & ((x != 0) | F.lit(not skip_zero))), F.lit(False))


def value_filter(df: DataFrame, policy: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``skip_zero`` drops zeros; ``skip_empty`` and ``skip_none`` are accepted, since
    cells that are not numbers never get this far."""
    names = _policies(policy)
    unknown = names - {"skip_zero", "skip_empty", "skip_none"}
    if unknown:
        raise ValueError(f"unknown value filter: {sorted(unknown)}")
    return df.filter(F.col("value") != 0) if "skip_zero" in names else df


def category(metric: Column) -> Column:
    """Category of a metric name, null for names no rule covers."""
    result = F.lit(None).cast("string")
    for prefix, name, _ in reversed(CATEGORY_RULES):
        result = F.when(metric.startswith(prefix), F.lit(name)).otherwise(result)
    return result


def _rejected_prefixes(enabled: dict[str, bool] | None) -> list[str]:
    enabled = enabled or {}
    return [prefix for prefix, name, default in CATEGORY_RULES if not enabled.get(name, default)]


def is_rejected(metric: Column, enabled: dict[str, bool] | None = None) -> Column:
    rejected = F.lit(False)
    for prefix in _rejected_prefixes(enabled):
        rejected = rejected | metric.startswith(prefix)
    return rejected


def category_filter(df: DataFrame, enabled: dict[str, bool] | None = None) -> DataFrame:
    """Drop metrics of disabled categories; names no rule covers always pass."""
    return df.filter(~is_rejected(F.col("metric"), enabled))


def category_stats(names: DataFrame, enabled: dict[str, bool] | None = None) -> DataFrame:
    """Metrics removed per category."""
    rejected = names.filter(is_rejected(F.col("metric"), enabled))
    return rejected.groupBy(category(F.col("metric")).alias("category")).agg(F.count("*").alias("removed"))


def category_totals(names: DataFrame, enabled: dict[str, bool] | None = None) -> DataFrame:
    """Metrics before and after the category filter."""
    rejected = F.count_if(is_rejected(F.col("metric"), enabled))
    return names.agg(F.count("*").alias("before"), rejected.alias("removed"), (F.count("*") - rejected).alias("after"))


def cell_kind(raw: Column) -> Column:
    """'number', 'null' or 'text'."""
    return (
        F.when(is_null_token(raw), "null").when(to_number(raw).isNotNull(), "number").otherwise("text")
    )


_COUNTS = ["total", "numeric", "null_token", "text"]


def profile_state(rows: DataFrame) -> DataFrame:
    """What each column of each archive holds: counts of cells by kind, first and last time.

    Cells are counted by position, before they have names. States of different archives add up.
    """
    cells = rows.select("archive", "header_id", "ts", F.posexplode("cells").alias("pos", "raw")).filter("pos > 0")
    kinds = cells.withColumn("kind", cell_kind(F.col("raw")))
    return kinds.groupBy("archive", "header_id", "pos").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("kind") == "number").alias("numeric"),
        F.count_if(F.col("kind") == "null").alias("null_token"),
        F.count_if(F.col("kind") == "text").alias("text"),
        F.min("ts").alias("min_ts"),
        F.max("ts").alias("max_ts"),
    )


def name_profile(state: DataFrame, columns: DataFrame | Side, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The states with their metrics' names: archive, metric and figures."""
    table, size = columns if isinstance(columns, Side) else (columns, measured_bytes(columns))
    named = side_join(state, Side(table.select("header_id", "pos", "metric"), size), ["header_id", "pos"], "inner", limit)
    return named.select("archive", "metric", *_COUNTS, "min_ts", "max_ts")


def sum_profiles(profiles: DataFrame) -> DataFrame:
    """One row per metric over any number of archives, and whether it ever gives a number."""
    summed = profiles.groupBy("metric").agg(
        *[F.sum(c).alias(c) for c in _COUNTS], F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts")
    )
    return summed.withColumn("valid", F.col("numeric") > 0)


def metric_profile(rows: DataFrame, columns: DataFrame | Side, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """What each metric holds, and whether it ever gives a number."""
    return sum_profiles(name_profile(profile_state(rows), columns, limit))


def ingest_counters(rows: DataFrame, policy: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """One row per archive: lines, points, values and what was skipped.

    Counting happens inside each line's array, so the only shuffle is one small row per
    archive and task. The header line is not a data line and is taken off again.
    """
    skip_zero = skips_zero(policy)
    numeric = F.coalesce(F.size(F.array_compact("numbers")), F.lit(0))
    zeros = F.coalesce(F.size(F.filter("numbers", lambda x: x == 0)), F.lit(0))
    per_line = rows.select(
        "archive",
        "arity_ok",
        "ts",
        F.col("width").isNotNull().cast("long").alias("headed"),
        "n_null",
        "n_text",
        numeric.cast("long").alias("numeric"),
        (zeros if skip_zero else F.lit(0)).cast("long").alias("filtered"),
    )
    kept = F.col("numeric") - F.col("filtered")
    header = F.max("headed")
    return per_line.groupBy("archive").agg(
        (F.count("*") - header).alias("lines"),
        F.count_if(kept > 0).alias("points"),
        F.sum(kept).alias("values"),
        F.coalesce(F.sum("n_null"), F.lit(0)).cast("long").alias("skipped_null"),
        F.coalesce(F.sum("n_text"), F.lit(0)).cast("long").alias("skipped_text"),
        F.sum("filtered").alias("skipped_filtered"),
        F.count_if(~F.col("arity_ok")).alias("bad_arity"),
        (F.count_if(F.col("arity_ok") & F.col("ts").isNull()) - header).alias("bad_ts"),
    )
