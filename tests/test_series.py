import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pulsemill.operators import series as s
from pulsemill.plans.panels import SAVED_PANELS, panel_query
from pulsemill.schema import SAMPLES
from pulsemill.sinks.samples import read_samples, write_samples

START = dt.datetime(2025, 10, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "serialNumber string, metric string, ts timestamp_ntz, value double")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    names = ["psoc.now.cpu.a", "psoc.now.fan.rpm", "kernel.all.cpu.user", "mem.util.free"]
    rows = [
        ("system_metrics", f"SERVER{k % 12}", str(k), START + dt.timedelta(hours=7 * k), names[k % 4],
         names[k % 4].replace(".", "_"), 1, float(k), "a", 0, k, 1, (START + dt.timedelta(hours=7 * k)).date())
        for k in range(200)
    ]
    path = str(tmp_path_factory.mktemp("store"))
    write_samples(spark.createDataFrame(rows, SAMPLES), path)
    return read_samples(spark, path)


def test_range_prunes_partitions_and_reaches_the_scan(store, plan_of):
    plan = plan_of(s.where_metric(s.time_range(store, "2025-10-05 03:00:00", "2025-10-06 00:00:00"), r"^psoc\.now\.cpu\."))
    assert re.search(r"PartitionFilters: \[[^]]*d#\d+ >= 2025-10-05", plan)
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    assert "StringStartsWith(metric,psoc.now.cpu.)" in plan


def test_tag_filters_prune_partitions(store, plan_of):
    assert re.search(r"PartitionFilters: \[[^]]*RLIKE\(product_type", plan_of(s.tag_regex(store, "product_type", "SERVER1")))
    assert re.search(r"PartitionFilters: \[[^]]*product_type#\d+ = SERVER1", plan_of(s.tag_exact(store, "product_type", "SERVER1")))
    fields = plan_of(s.where_fields(store, ["mem_util_free", "psoc_now_fan_rpm"]))
    assert re.search(r"PushedFilters: \[In\(field", fields)


def test_unanchored_tag_match(store):
    found = {x["product_type"] for x in s.tag_regex(store, "product_type", "SERVER1").collect()}
    assert found == {"SERVER1", "SERVER10", "SERVER11"}
    assert s.tag_regex(store, "product_type", ".*").count() == store.count()
    assert s.tag_any(store, "product_type", "ANY").count() == store.count()


@pytest.mark.parametrize("pattern", [r"^psoc\.", "heater", r"^a.b", r"a\.b|c", "^x$", r"disk\.dev", "a+", r"^net:if-1"])
def test_regex_predicate_means_the_regex(spark, pattern):
    names = ["psoc.now", "xpsoc.now", "now.heater.x", "a.b", "aXb", "c", "x", "xx", "disk.dev.read", "net:if-1.in", "a\nb"]
    df = spark.createDataFrame([(n,) for n in names], "metric string")
    found = {x["metric"] for x in s.where_metric(df, pattern).collect()}
    assert found == {n for n in names if re.search(pattern, n)}


def test_window_labels_and_edges(spark):
    at = lambda h, m: START + dt.timedelta(hours=h, minutes=m)
    df = frame(spark, [("1", "m", at(0, 10), 1.0), ("1", "m", at(0, 40), 3.0), ("1", "m", at(2, 5), 5.0), ("1", "m", at(2, 30), 9.0)])
    got = s.aggregate_window(df, "1 hour", ["metric"], at(0, 10), at(2, 30)).orderBy("t").collect()
    assert [(x["t"], x["value"]) for x in got] == [(at(1, 0), 2.0), (at(2, 30), 5.0)]


def test_summary_of_window_means(spark):
    at = lambda h: START + dt.timedelta(hours=h)
    df = spark.createDataFrame([("m", at(1), 4.0), ("m", at(3), 2.0), ("m", at(2), 9.0)], "metric string, t timestamp_ntz, value double")
    row = s.series_summary(df, ["metric"], ["mean", "max", "last"]).first()
    assert (row["mean"], row["max"], row["last"]) == (5.0, 9.0, 2.0)


def test_pivot_forms_agree(store):
    names = ["psoc.now.cpu.a", "mem.util.free"]
    rows = store.filter(F.col("metric").isin(names))
    keys = ["product_type", "serialNumber"]
    long = s.aggregate_window(rows, "1 day", [*keys, "metric"])
    two_step = s.pivot_series(long, names, keys).select(*keys, "t", *[f"`{n}`" for n in names])
    one_step = s.pivot_window(rows, "1 day", names, keys)
    assert sorted(map(str, two_step.collect())) == sorted(map(str, one_step.collect()))


def test_a_family_of_1500_metrics_pivots(spark):
    at = lambda h: START + dt.timedelta(hours=h)
    names = [f"proc.x{i:04d}" for i in range(1500)]
    df = spark.range(1500).crossJoin(spark.range(3).withColumnRenamed("id", "h")).selectExpr(
        "'1' serialNumber", "format_string('proc.x%04d', id) metric", f"timestamp_ntz'{at(0)}' + make_interval(0, 0, 0, 0, h) ts", "double(id + h) value"
    )
    assert s.metric_names(df, r"^proc\.") == names
    wide = s.pivot_window(df, "1 hour", names, ["serialNumber"]).orderBy("t").collect()
    assert len(wide) == 3 and [len(x) for x in wide] == [1502] * 3 and wide[2]["proc.x1499"] == 1501.0
    mapped = s.pivot_map(df, "1 hour", ["serialNumber"]).orderBy("t").collect()
    assert [len(x["values"]) for x in mapped] == [1500] * 3 and all(mapped[h]["values"][n] == wide[h][n] for h in range(3) for n in names)


def test_few_and_many_columns_agree(store, monkeypatch):
    names, keys = s.metric_names(store, ""), ["product_type", "serialNumber"]
    one = s.pivot_window(store, "1 day", names, keys, "2025-10-03 00:00:00", "2025-10-20 05:00:00")
    monkeypatch.setattr(s, "_FEW", 0)
    many = s.pivot_window(store, "1 day", names, keys, "2025-10-03 00:00:00", "2025-10-20 05:00:00")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect())) and one.columns == many.columns


@pytest.mark.parametrize("key", sorted(SAVED_PANELS))
def test_saved_panels_select_what_their_pattern_says(store, key):
    panel = SAVED_PANELS[key]
    got = panel_query(store, panel, "1 day", "2025-10-01 00:00:00", "2026-01-01 00:00:00")
    same = panel_query(store, panel, "1 day", "2025-10-01 00:00:00", "2026-01-01 00:00:00", measurement="system_metrics")
    assert same.count() == got.count()
    shown = got.select(F.explode(F.map_keys("values")).alias("metric")) if panel.pivot else got
    found = {x["metric"] for x in shown.select("metric").distinct().collect()}
    names = {x["metric"] for x in store.select("metric").distinct().collect()}
    assert found == {n for n in names if (n == panel.pattern if panel.exact else re.search(panel.pattern, n))}


@pytest.mark.parametrize("chunk_steps", [2, 7, 10_000])
def test_hold_last_value_over_gaps(spark, chunk_steps):
    rng = random.Random(chunk_steps)
    rows = []
    for serial in "ab":
        minute = rng.randint(0, 30)
        for _ in range(40):
            minute += rng.choice([1, 2, 7, 45])
            rows.append((serial, "m", START + dt.timedelta(minutes=minute, seconds=rng.randint(0, 59)), float(rng.randint(0, 99))))
    df = frame(spark, rows)
    expected = {}
    for serial in "ab":
        last = {}
        for _, _, ts, value in sorted((x for x in rows if x[0] == serial), key=lambda x: x[2]):
            last[ts.replace(second=0)] = (ts, value)
        t, held = min(last), None
        while t <= max(last):
            held = last[t][1] if t in last else held
            expected[serial, t] = held
            t += dt.timedelta(minutes=1)
    got = s.resample(df, "1 minute", ["serialNumber"], ["ts"], fill=True, chunk_steps=chunk_steps).collect()
    assert {(x["serialNumber"], x["t"]): x["value"] for x in got} == expected
    assert len(got) == len(expected)


def test_since_and_tag_values(store):
    top = store.agg(F.max("ts")).scalar()
    recent = s.tag_values(store, "serialNumber", "14 hours", top)
    assert {x["serialNumber"] for x in recent.collect()} == {"197", "198", "199"}
    dependent = s.tag_values(store, "serialNumber", "30 days", top, F.col("product_type") == "SERVER7")
    assert "199" in {x["serialNumber"] for x in dependent.collect()}


def test_first_sample(spark):
    at = lambda m: START + dt.timedelta(minutes=m)
    rows = [("1", f"m{i:02d}", at(5 - k), float(10 * i + k)) for i in range(15) for k in range(3)]
    rows.append(("2", "m00", at(3), -1.0))
    got = {x["metric"]: x["value"] for x in s.first_sample(frame(spark, rows)).collect()}
    assert got == {f"m{i:02d}": float(10 * i + 2) for i in range(1, 10)} | {"m00": -1.0}


def test_saved_pivots_show_every_matching_metric(spark, monkeypatch):
    from pulsemill.registered import panels
    from pulsemill.registered.registry import QUERIES

    rows = [("SERVER1", "1", m, float(v)) for v, m in enumerate(("psoc.now.cpu.cpu0", "psoc.now.cpu.cpu1", "psoc.now.cpu.cpu2"))]
    samples = spark.createDataFrame(rows, "product_type string, serialNumber string, metric string, value double")
    samples = samples.withColumn("ts", F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
    monkeypatch.setattr(panels, "panel_samples", lambda spark, sf: samples)
    (row,) = QUERIES["q_saved_q1"](spark, "").collect()
    assert (row["psoc_now_cpu_cpu0"], row["psoc_now_cpu_cpu2"]) == (0.0, 2.0)
