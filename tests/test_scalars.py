import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsemill.functions import scalars as f


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(expression(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, number",
    [
        ("1.23", 1.23), ("0.000", 0.0), (" 7 ", 7.0), ('"5"', 5.0), ("-2e3", -2000.0), (".5", 0.5), ("4.", 4.0),
        ("+1", 1.0), ("\t8\r", 8.0), ("", None), ("N/A", None), ("?", None), ("none", None), ("NULL", None),
        ("abc", None), ("1d", None), ("1f", None), ("0x1p3", None), ("nan", None), ("inf", None), ("1e999", None),
        ("1_000", None), ("-1e999", None),
    ],
)
def test_to_number(spark, text, number):
    assert one(spark, text, f.to_number) == number


@pytest.mark.parametrize("text, is_null", [("", True), (" n/a ", True), ('"?"', True), ("None", True), ("nul", False), ("0", False)])
def test_null_tokens(spark, text, is_null):
    assert one(spark, text, f.is_null_token) is is_null


@pytest.mark.parametrize(
    "text, ts",
    [
        ("2025-10-09 12:00:00", dt.datetime(2025, 10, 9, 12)),
        ("  2025-10-09 12:00:00 ", dt.datetime(2025, 10, 9, 12)),
        ('"2025-10-09 12:00:00"', None),
        ("2025-1-9 1:00:00", None),
        ("2025-02-30 12:00:00", None),
        ("bad", None),
    ],
)
def test_parse_ts(spark, text, ts):
    assert one(spark, text, lambda c: f.parse_ts(c).cast("timestamp_ntz")) == ts


def test_names(spark):
    assert one(spark, "kernel.all.load-1 minute", f.sanitize_field) == "kernel_all_load_1_minute"
    assert one(spark, ' "Time" ,"a.b", c ', f.normalise_header) == ["Time", "a.b", "c"]
    assert [one(spark, m, f.top_level) for m in ("a.b.c", "a")] == ["a", "a"]
    assert [one(spark, m, f.subcategory) for m in ("a.b.c", "a.b", "a")] == ["a.b", "a.b", "a"]
    assert one(spark, "x.tar.xz", lambda c: f.drop_suffix(c, ".tar.xz")) == "x"
    assert one(spark, "x.tar", lambda c: f.drop_suffix(c, ".tar.xz")) == "x.tar"
