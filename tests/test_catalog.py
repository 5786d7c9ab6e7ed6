import random

from pulsemill.operators import catalog as c
from pulsemill.operators.inventory import last_n_lines, outcome_totals, run_ledger
from pulsemill.sinks import tables


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "metric string")


def test_published_group_sizes(spark):
    sizes = {"disk.a": 16, "disk.b": 46, "disk.c": 184, "disk.d": 64, "kernel.x": 28, "kernel.y": 7, "kernel.z": 112}
    df = names(spark, [f"{k}.m{i}" for k, n in sizes.items() for i in range(n)])
    rows = {(x["top_level"], x["subcategory"]): (x["n_sub"], x["n"]) for x in c.catalog_rollup(df).collect()}
    assert rows["disk", None] == (4, 310) and rows["kernel", None] == (3, 147) and rows[None, None] == (7, 457)
    assert rows["disk", "disk.c"] == (1, 184)
    titles = {x["title"] for x in c.group_titles(df).collect()}
    assert titles == {"[DISK] - 4 subcategories, 310 metrics", "[KERNEL] - 3 subcategories, 147 metrics"}


def test_panel_layout(spark):
    rng = random.Random(1)
    rows = [(f"disk.dev.m{i}", rng.randint(1, 2), f"arch{rng.randint(0, 3)}", rng.randint(1, 50)) for i in range(23)]
    rows += [("mem.util.free", 1, "arch0", 1), ("hinv", 1, "arch0", 2)]
    df = spark.createDataFrame(rows, tables.CATALOG)
    panels = {x["metric"]: x for x in c.panel_chunks(df).collect()}
    order = [x[0] for x in sorted(rows[:23], key=lambda x: (x[1], x[2], x[3], x[0]))]
    for i, metric in enumerate(order):
        row = panels[metric]
        start, end = i // 10 * 10 + 1, min(i // 10 * 10 + 10, 23)
        assert (row["position"], row["chunk"], row["x"]) == (i + 1, i // 10, 12 if i // 10 == 1 else 0)
        assert row["title"] == f"[disk.dev] Metrics {start}-{end} of 23"
    assert panels["mem.util.free"]["title"] == "[mem.util] (1 metrics)"
    assert (panels["hinv"]["top_level"], panels["hinv"]["subcategory"]) == ("hinv", "hinv")


def test_numbering_never_gathers_a_group(spark, plan_of):
    df = spark.createDataFrame([("a.b.c", 1, "x", 1)], tables.CATALOG)
    windows = [line for line in plan_of(c.panel_chunks(df)).splitlines() if "Window [row_number" in line]
    assert windows and all("first_archive" in line.split("windowspecdefinition")[1] for line in windows)


def test_catalog_appends_only_new_names(spark, tmp_path):
    path = str(tmp_path / "catalog")
    first = spark.createDataFrame([("a", 1, "x", 1), ("b", 1, "x", 2)], tables.CATALOG)
    second = spark.createDataFrame([("b", 2, "y", 1), ("c", 2, "y", 2)], tables.CATALOG)
    for load in (first, second, second):
        tables.append_catalog(spark, load, path)
    rows = {x["metric"]: x["first_seq"] for x in tables.read_catalog(spark, path).collect()}
    assert rows == {"a": 1, "b": 1, "c": 2}
    assert tables.read_catalog(spark, path).count() == 3


def test_first_sighting(spark):
    rows = [("m", 2, "a", 1), ("m", 1, "b", 9), ("m", 1, "b", 4), ("n", 1, "c", 1)]
    df = spark.createDataFrame(rows, "metric string, ingest_seq long, archive string, pos int")
    seen = {x["metric"]: tuple(x)[1:] for x in c.seen_metrics(df).collect()}
    assert seen == {"m": (1, "b", 4), "n": (1, "c", 1)}


def test_sample_names(spark):
    df = names(spark, [f"m{i:02d}" for i in range(14)])
    rows = c.sample_names(df).collect()
    assert [x["metric"] for x in rows] == [f"m{i:02d}" for i in range(10)] and {x["remaining"] for x in rows} == {4}
    assert {x["remaining"] for x in c.sample_names(names(spark, ["a", "b"])).collect()} == {0}


def test_tail_is_cut_before_the_shuffle(spark, plan_of):
    rows = [("a", "f1", 0, i, f"line {i}" if i % 4 else " ") for i in range(30)] + [("b", "f2", 0, 1, "only")]
    df = spark.createDataFrame(rows, "log string, path string, block_start long, row_id long, line string")
    tail = last_n_lines(df)
    assert sorted(x["line"] for x in tail.collect()) == ["line 25", "line 26", "line 27", "line 29", "only"]
    plan = plan_of(tail)
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ledger_of_a_repeated_run_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "ledger")
    counters = spark.createDataFrame([("a", 5), ("b", 0)], "archive string, points long")
    failed = spark.createDataFrame([("c", "ReadError")], "archive string, error string")
    for seq in (1, 2, 2):
        tables.append_ledger(run_ledger(counters, seq, failed), path)
    totals = {x["status"]: x["n"] for x in outcome_totals(spark.read.parquet(path)).collect()}
    assert totals == {"processed": 2, "failed": 4}
