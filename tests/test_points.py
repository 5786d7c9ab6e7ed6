import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import points as p
from pulsemill.operators import reports as r
from pulsemill.schema import SAMPLES

T0 = dt.datetime(2025, 10, 9, 12, tzinfo=dt.timezone.utc)


def sample(value, seq=1, archive="a", row=0, pos=1, metric="a.b", serial="1", block=0):
    return ("m", "S", serial, T0, metric, metric.replace(".", "_").replace("-", "_"), pos, value, archive, block, row, seq, T0.date())


def frame(spark, rows):
    return spark.createDataFrame(rows, SAMPLES)


def test_later_load_line_and_column_win(spark):
    rows = [
        sample(1.0), sample(2.0, row=5), sample(3.0, row=2, pos=9), sample(9.0, block=7, row=1),
        sample(4.0, serial="2"), sample(5.0, serial="2", pos=2, metric="a-b"),
        sample(6.0, serial="3", seq=2), sample(7.0, serial="3", seq=1, archive="z", row=99),
    ]
    won = {x["serialNumber"]: x["value"] for x in p.resolve_samples(frame(spark, rows)).collect()}
    assert won == {"1": 9.0, "2": 5.0, "3": 6.0}


def test_resolve_ignores_order_and_repetition(spark):
    rows = [sample(float(i), seq=i % 3, row=i, serial=str(i % 4)) for i in range(40)]
    once = p.resolve_samples(frame(spark, rows))
    again = p.union_samples(frame(spark, rows[::-1]).repartition(7), once)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_repeated_key_is_combined_before_the_shuffle(spark, plan_of):
    plan = plan_of(p.resolve_samples(frame(spark, [sample(1.0)])))
    assert "partial_max" in plan and plan.count("Exchange") == 1


def test_line_protocol(spark):
    points = spark.createDataFrame(
        [("sys, m", "R 1", "a=b", T0, {"z": 5.0, "a": 1.25, "k 1": 0.0})],
        "measurement string, product_type string, serialNumber string, ts timestamp, fields map<string,double>",
    )
    line = p.to_line_protocol(points).first()["line"]
    assert line == r"sys\,\ m,product_type=R\ 1,serialNumber=a\=b a=1.25,k\ 1=0,z=5 1760011200000000000"


def test_points_without_fields_are_dropped(spark):
    df = spark.sql("select map('a', 1.0D) as fields union all select map_filter(map('a', 1.0D), (k, v) -> false)")
    assert p.nonempty_points(df).count() == 1
    assert df.filter(F.size("fields") == 0).count() == 1


# --- resolution on lines ------------------------------------------------------------------


def _lines(spark, draw, n, points, headers, slots=5):
    rows = [
        (draw.randrange(points), draw.randrange(headers), i // 7, i, [draw.choice([None, float(draw.randrange(9))]) for _ in range(slots)])
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "point long, header_id long, block_start long, row_id long, numbers array<double>")


def _columns(spark, headers, fields):
    """Fields of each header's slots; a field may have several."""
    rows = [(h, slot, slot + 1, f"{h}.{slot}", f) for h in range(headers) for slot, f in enumerate(fields)]
    return spark.createDataFrame(rows, "header_id long, slot int, pos int, metric string, field string")


@pytest.mark.parametrize("width", [2, 32])
def test_lines_are_folded_as_values_are_resolved(spark, width):
    """One hot point holds most lines; columns share fields. Any width gives what the sort over values gives."""
    draw = random.Random(4)
    order = ["block_start", "row_id"]
    lines, columns = _lines(spark, draw, 400, 6, 3).unionByName(_lines(spark, draw, 300, 1, 1).withColumn("row_id", F.col("row_id") + 1000)), _columns(spark, 3, "aabca")
    counted = lines.join(lines.groupBy("point").agg(F.count("*").alias("n")), "point")
    most = counted.agg(F.max("n")).first()[0]
    folded = p.fold_lines(counted, ["point"], order, most, width)
    assert folded.count() == lines.select("point", "header_id").distinct().count()
    got = p.last_write_wins(r.melt_fields(folded, columns, order), ["point", "field"], [*order, "pos"])
    want = p.last_write_wins(r.melt(lines, columns), ["point", "field"], [*order, "pos"])
    rows = lambda df: sorted(map(str, df.select("point", "field", "block_start", "row_id", "pos", "metric", "value").collect()))
    assert rows(got) == rows(want)


def test_no_group_of_a_fold_grows_with_a_hot_key(spark):
    n = 3_000
    lines = spark.range(n).selectExpr("1L point", "1L header_id", "id row_id", f"{n}L n", "array(double(id), if(id % 100 = 7, id * 1.0D, null)) numbers")
    folded = p.fold_lines(lines, ["point"], ["row_id"], n, 16).first()
    assert [(c["row_id"], c["value"]) for c in folded["cells"]] == [(n - 1, n - 1.0), (2907, 2907.0)]


def test_values_of_one_line_are_not_shuffled(spark, plan_of):
    """Columns that share a field are settled inside the line."""
    lines, columns = _lines(spark, random.Random(1), 50, 5, 1), _columns(spark, 1, "aab")
    settled = r.melt_fields(lines, columns)
    plan = plan_of(settled)
    assert "hashpartitioning(point" not in plan and "SortMergeJoin" not in plan
    want = p.last_write_wins(r.melt(lines, columns), ["row_id", "field"], ["pos"])
    assert sorted(map(str, settled.select("row_id", "field", "pos", "value").collect())) == sorted(map(str, want.select("row_id", "field", "pos", "value").collect()))


def test_points_straight_from_lines(spark):
    lines, columns = _lines(spark, random.Random(3), 60, 60, 2), _columns(spark, 2, "abacb")
    direct = r.assemble_lines(lines, columns)
    fields = {x["row_id"]: x["fields"] for x in direct.collect()}
    long = {}
    for x in r.melt_fields(lines, columns).collect():
        long.setdefault(x["row_id"], {})[x["field"]] = x["value"]
    assert {k: v for k, v in fields.items() if v} == long


def test_no_value_is_sorted_in_the_registered_queries(spark, plan_of):
    import __spark_entry__ as e

    for name in ("q_last_write_wins", "q_assemble_points"):
        plan = plan_of(e.queries()[name](spark, "/root/testdata/sf0.001"))
        above = plan[: plan.index("collect_list")]
        assert "Sort " not in above and "Exchange hashpartitioning" not in above


def test_claims_are_counted_without_sorting(spark, plan_of):
    """Headers are ids of bytes; lines of a claim have one header or not, and a missing one counts as none."""
    rows = [("S", "1", 1, b"a"), ("S", "1", 1, b"a"), ("S", "1", 2, b"a"), ("S", "1", 2, b"b"), ("S", "1", 3, b"b"), ("S", "2", 1, None), ("S", "2", 1, b"b")]
    claims = p.claimed_twice(spark.createDataFrame(rows, "product_type string, serialNumber string, ts long, header_id binary"))
    assert sorted(r[:] for r in claims.collect()) == [("S", "1", 1, 2, True), ("S", "1", 2, 2, False), ("S", "2", 1, 2, True)]
    assert "Sort" not in plan_of(claims)
