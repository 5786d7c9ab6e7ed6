"""Column expressions for report text, names and titles. All of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsemill.schema import NULL_TOKENS, TS_FORMAT

BLANKS = " \t\n\r\x0b\x0c"
# Plain decimal notation only: try_cast alone would also take 1d, 0x1p3, nan and inf.
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def clean_cell(c: Column) -> Column:
    """Trim, then drop surrounding double quotes."""
    return F.btrim(strip(c), F.lit('"'))


def split_line(line: Column) -> Column:
    """Cells of a report line. Quotes do not protect commas in this format."""
    return F.split(strip(line), ",")


def normalise_header(line: Column) -> Column:
    return F.transform(split_line(line), clean_cell)


def finite(c: Column) -> Column:
    return F.when(F.abs(c) < float("inf"), c)


def decimal_text(cell: Column) -> Column:
    """Cast a clean cell in plain decimal notation to double, anything else to null (1e999
    gives infinity)."""
    return F.when(cell.rlike(_NUMBER), cell.try_cast("double"))


def to_number(c: Column) -> Column:
    return finite(decimal_text(clean_cell(c)))


def names_nothing(cell: Column) -> Column:
    """Is this clean cell one of the tokens for a missing value?"""
    return F.lower(cell).isin(NULL_TOKENS)


def is_null_token(c: Column) -> Column:
    return names_nothing(clean_cell(c))


def parse_ts(c: Column) -> Column:
    return F.try_to_timestamp(strip(c), F.lit(TS_FORMAT))


def sanitize_field(metric: Column) -> Column:
    return F.translate(metric, ".- ", "___")


def top_level(metric: Column) -> Column:
    return F.substring_index(metric, ".", 1)


def subcategory(metric: Column) -> Column:
    return F.substring_index(metric, ".", 2)


def megabytes(n_bytes: Column) -> Column:
    return F.round(n_bytes / F.lit(1024 * 1024), 2)


def kilobytes(n_bytes: Column) -> Column:
    return F.round(n_bytes / F.lit(1024), 2)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def drop_suffix(name: Column, suffix: str) -> Column:
    kept = F.substr(name, F.lit(1), F.length(name) - len(suffix))
    return F.when(name.endswith(suffix), kept).otherwise(name)
