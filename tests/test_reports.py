import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsemill.operators import reports as r
from pulsemill.operators.joins import keep_validated
from pulsemill.operators.points import assemble_points, explode_points, resolve_samples
from pulsemill.plans.ingest import IngestOptions, read_lines, resolved_samples, tag_rows, to_samples
from pulsemill.schema import POINT
from pulsemill.sources.reports import read_name_list, read_wide_reports

GOLDEN = '''
"Time","kernel.all.load-1 minute","mem.util.free","a.b","a-b"
2025-10-09 12:00:00,1.23,0.000,5,
2025-10-09 12:00:01,N/A,?,5,7

2025-10-09 12:00:02,1,2
bad,1,2,3,4
'''


def load(spark, path, policy=(), enabled=None):
    lines = read_wide_reports(spark, str(path))
    headers = r.read_headers(spark, lines, lambda columns: r.category_filter(columns, enabled))
    rows = read_lines(lines, headers)
    options = IngestOptions(policy=tuple(policy))
    return rows, to_samples(r.melt(tag_rows(rows, options), headers.columns), options, 1)


def triples(samples):
    rows = samples.select(F.date_format("ts", "HH:mm:ss").alias("t"), "field", "value").collect()
    return sorted((x["t"], x["field"], x["value"]) for x in rows)


def test_golden_report(spark, tmp_path):
    (tmp_path / "r.csv").write_text(GOLDEN)
    rows, samples = load(spark, tmp_path)
    expected = [
        ("12:00:00", "a_b", 5.0),
        ("12:00:00", "kernel_all_load_1_minute", 1.23),
        ("12:00:00", "mem_util_free", 0.0),
        ("12:00:01", "a_b", 7.0),
    ]
    assert triples(resolve_samples(samples)) == expected
    counters = r.ingest_counters(rows).drop("archive").first().asDict()
    assert counters == {
        "lines": 4, "points": 2, "values": 5, "skipped_null": 3, "skipped_text": 0, "skipped_filtered": 0,
        "bad_arity": 1, "bad_ts": 1,
    }


def test_skip_zero(spark, tmp_path):
    (tmp_path / "r.csv").write_text(GOLDEN)
    rows, samples = load(spark, tmp_path, policy=["skip_zero", "skip_none"])
    assert ("12:00:00", "mem_util_free", 0.0) not in triples(samples)
    counters = r.ingest_counters(rows, ["skip_zero"]).first()
    assert (counters["values"], counters["skipped_filtered"]) == (4, 1)
    with pytest.raises(ValueError):
        r.value_filter(samples, ["skip_everything"])


def test_filtered_column_leaves_the_earlier_one(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Time,a.b,a-b\n2025-10-09 12:00:00,5,0\n2025-10-09 12:00:01,5,x\n")
    _, samples = load(spark, tmp_path, policy=["skip_zero"])
    assert triples(resolve_samples(samples)) == [("12:00:00", "a_b", 5.0), ("12:00:01", "a_b", 5.0)]


def write_many(folder, n_files, n_lines, seed=0):
    rng, expected = random.Random(seed), []
    for i in range(n_files):
        names = [f"m{i}.k{j}.x" for j in range(rng.randint(1, 6))]
        text = ["", "  "][: rng.randint(0, 2)] + ["Time," + ",".join(f'"{n}"' for n in names)]
        for k in range(n_lines):
            stamp, values = f"2025-10-09 12:{k // 60 % 60:02d}:{k % 60:02d}", [rng.randint(0, 999) for _ in names]
            text.append(stamp + "," + ",".join(map(str, values)))
            expected += [(stamp, n, float(v)) for n, v in zip(names, values)]
        (folder / f"r{i}.csv").write_text("\n".join(text) + "\n")
    return sorted(expected)


@pytest.mark.parametrize("block", ["4k", "128m"])
def test_every_file_has_its_own_header(spark, tmp_path, block):
    """Small blocks cut files into many splits, large ones pack several files into a task."""
    expected = write_many(tmp_path, 12, 300)
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        rows, samples = load(spark, tmp_path)
        found = samples.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"), "metric", "value").collect()
        assert sorted(map(tuple, found)) == expected
        counters = r.ingest_counters(rows).agg(F.sum("lines"), F.sum("bad_ts"), F.sum("points")).first()
        assert tuple(counters) == (3600, 0, 3600)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_lookup_joins_shuffle_beyond_the_limit(spark, tmp_path, plan_of):
    expected = write_many(tmp_path, 5, 20)
    lines = read_wide_reports(spark, str(tmp_path))
    headers = r.read_headers(spark, lines)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        attached = r.attach_header(lines, headers, limit=0)
        rows = r.read_numbers(r.parse_lines(attached))
        values = r.melt(rows, headers.columns, limit=0)
        assert "BroadcastHashJoin" not in plan_of(values)
        assert values.count() == len(expected)
        assert "BroadcastHashJoin" in plan_of(r.melt(rows, headers.columns))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_file_without_header_fails_its_lines(spark, tmp_path):
    (tmp_path / "r.csv").write_text("2025-10-09 12:00:00,1,2\n2025-10-09 12:00:01,1,2\n")
    rows, samples = load(spark, tmp_path)
    assert samples.count() == 0
    counters = r.ingest_counters(rows).first()
    assert (counters["lines"], counters["bad_arity"], counters["points"]) == (2, 2, 0)


def test_profile_finds_columns_that_never_give_a_number(spark, tmp_path):
    (tmp_path / "r.csv").write_text(
        "Time,kernel.all.load,pmcd.hostname\n2025-10-09 12:00:00,1,host\n2025-10-09 12:00:01,?,host\n"
    )
    lines = read_wide_reports(spark, str(tmp_path))
    headers = r.read_headers(spark, lines)
    rows = r.check_ts(r.check_arity(r.parse_lines(r.attach_header(lines, headers))))
    profile = {x["metric"]: x for x in r.metric_profile(rows, headers.columns).collect()}
    load_row, host = profile["kernel.all.load"], profile["pmcd.hostname"]
    assert (load_row["total"], load_row["numeric"], load_row["null_token"], load_row["valid"]) == (2, 1, 1, True)
    assert (host["numeric"], host["text"], host["valid"]) == (0, 2, False)


def test_categories(spark):
    names = ["proc.x", "disk.x", "vfs.x", "filesys.x", "mem.x", "network.x", "kernel.x", "swap.x", "nfs.x", "swapdev.x", "psoc.now"]
    df = spark.createDataFrame([(n,) for n in names], "metric string")
    kept = {x["metric"] for x in r.category_filter(df).collect()}
    assert kept == set(names) - {"proc.x", "nfs.x"}
    kept = {x["metric"] for x in r.category_filter(df, {"file": False, "proc": True, "swap": False}).collect()}
    assert kept == set(names) - {"vfs.x", "filesys.x", "nfs.x", "swap.x"}
    stats = {x["category"]: x["removed"] for x in r.category_stats(df, {"file": False}).collect()}
    assert stats == {"proc": 1, "nfs": 1, "file": 2}
    assert r.category_totals(df, {"file": False}).first().asDict() == {"before": 11, "removed": 4, "after": 7}


def test_published_filter_counts(spark):
    """1,882 valid names lose 6 of proc and 7 of swap: 1,869 are left."""
    names = [f"proc.{i}" for i in range(6)] + [f"swap.{i}" for i in range(7)] + [f"other.{i}" for i in range(1869)]
    df = spark.createDataFrame([(n,) for n in names], "metric string")
    assert r.category_filter(df, {"swap": False}).count() == 1869


def test_validated_list_is_applied_to_the_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "r.csv").write_text(GOLDEN)
    (tmp_path / "names.txt").write_text("mem.util.free\n\n  a.b  \n")
    names = read_name_list(spark, str(tmp_path / "names.txt"))
    lines = read_wide_reports(spark, str(tmp_path / "in"))
    headers = r.read_headers(spark, lines, lambda columns: keep_validated(columns, names))
    assert sorted(x["metric"] for x in headers.columns.collect()) == ["a.b", "mem.util.free"]
    rows = read_lines(lines, headers)
    assert {tuple(x["numbers"]) for x in rows.filter("numbers IS NOT NULL").collect()} == {(0.0, 5.0), (None, 5.0)}
    assert sorted(x["metric"] for x in r.melt(rows, headers.columns).collect()) == ["a.b", "a.b", "mem.util.free"]


def test_reports_with_no_wanted_column(spark, tmp_path):
    (tmp_path / "r.csv").write_text("Time,proc.a,nfs.b\n2025-10-09 12:00:00,1,2\n")
    rows, samples = load(spark, tmp_path)
    assert samples.count() == 0
    assert tuple(r.ingest_counters(rows).select("lines", "points", "values", "bad_ts").first()) == (1, 0, 0, 0)


def test_only_contested_values_are_resolved(spark, tmp_path, plan_of):
    """Lines of one device that claim a time twice, and columns that share a field."""
    (tmp_path / "1.csv").write_text("Time,a.b,c,a-b\n2025-10-09 12:00:00,1,2,3\n2025-10-09 12:00:01,4,5,\n")
    (tmp_path / "2.csv").write_text("Time,c,d\n2025-10-09 12:00:01,7,8\n2025-10-09 12:00:02,9,x\n2025-10-09 12:00:02,,10\n")
    lines = read_wide_reports(spark, str(tmp_path))
    headers, options = r.read_headers(spark, lines), IngestOptions()
    rows = tag_rows(read_lines(lines, headers), options)
    resolved = resolved_samples(spark, rows, headers.columns, options, 1)
    everything = resolve_samples(to_samples(r.melt(rows, headers.columns), options, 1))
    assert sorted(map(str, resolved.collect())) == sorted(map(str, everything.collect()))
    assert triples(resolved) == [
        ("12:00:00", "a_b", 3.0), ("12:00:00", "c", 2.0), ("12:00:01", "a_b", 4.0), ("12:00:01", "c", 7.0),
        ("12:00:01", "d", 8.0), ("12:00:02", "c", 9.0), ("12:00:02", "d", 10.0),
    ]
    apart = IngestOptions(device_key=lambda a: F.substring_index(a, "/", -1), registry=spark.sql("select '1.csv' device, 'S' product_type, '1' serialNumber"))
    first = rows.filter("archive like '%1.csv'").drop("product_type", "serialNumber")
    columns = headers.columns.filter("metric <> 'a-b'")
    assert "Aggregate" not in plan_of(resolved_samples(spark, tag_rows(first, apart), columns, apart, 1))


cell = st.one_of(
    st.integers(-999, 999).map(str), st.sampled_from(["", "N/A", "?", "none", "x", "1e2", "0.0", ' "3" ', "1d"])
)


def python_number(text):
    text = text.strip().strip('"')
    try:
        return None if text in ("1d", "x") else float(text)
    except ValueError:
        return None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(cell, min_size=3, max_size=3), min_size=1, max_size=12))
def test_melt_and_assemble_agree_with_a_plain_reader(spark, tmp_path_factory, table):
    folder = tmp_path_factory.mktemp("report")
    lines = [f"2025-10-09 12:00:{i:02d}," + ",".join(row) for i, row in enumerate(table)]
    (folder / "r.csv").write_text("\n".join(["Time,a.b,c,a-b", *lines]) + "\n")
    expected = set()
    for i, row in enumerate(table):
        fields = {}
        for name, text in zip(("a_b", "c", "a_b"), row):
            if python_number(text) is not None:
                fields[name] = python_number(text)
        expected |= {(f"12:00:{i:02d}", k, v) for k, v in fields.items()}
    _, samples = load(spark, folder)
    resolved = resolve_samples(samples)
    assert set(triples(resolved)) == expected
    assert set(triples(explode_points(assemble_points(resolved)))) == expected
    assert assemble_points(resolved).select(*POINT).distinct().count() == len({t for t, _, _ in expected})


def test_past_the_broadcast_limit_lines_are_shuffled_and_not_values(spark, tmp_path, plan_of):
    """One header has nearly all lines: they are dealt over several tasks, and exploded after the join."""
    (tmp_path / "a.csv").write_text("Time,a.b,a-b,c\n" + "".join(f"2025-10-09 12:{i // 60:02d}:{i % 60:02d},{i},,x\n" for i in range(900)))
    (tmp_path / "b.csv").write_text("Time,c\n2025-10-09 12:00:00,5\n")
    lines = read_wide_reports(spark, str(tmp_path), "*.csv")
    headers = r.read_headers(spark, lines)
    read_lines(lines, headers).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    far, near = r.melt(rows, headers.columns, limit=0), r.melt(rows, headers.columns)
    assert sorted(map(str, far.select(sorted(near.columns)).collect())) == sorted(map(str, near.select(sorted(near.columns)).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(r.melt(rows, headers.columns, limit=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan[: plan.index("Generate")] and plan.index("Generate") < plan.index("SortMergeJoin")
    dealt = r._salted(rows, headers.columns.groupBy("header_id").agg(F.count("*").alias("n")))
    assert dealt.select(F.pmod(F.xxhash64(*r.LINE_KEY), F.lit(8))).distinct().count() == 8
    settled = r.melt_fields(rows.filter("numbers IS NOT NULL"), headers.columns, limit=0)
    assert sorted(map(str, settled.collect())) == sorted(map(str, r.melt_fields(rows.filter("numbers IS NOT NULL"), headers.columns).collect()))


def test_validation_is_incremental(spark, tmp_path, monkeypatch):
    """Archives are profiled once; an empty list is made anew; a kept one is loaded, category rules applied."""
    from pulsemill.plans import validation as v
    from pulsemill.sinks.tables import write_validated

    (tmp_path / "in").mkdir()
    put = lambda name, text: (tmp_path / "in" / name).write_text(text)
    put("1.csv", "Time,mem.a,host,proc.x\n2025-10-09 12:00:00,1,h,4\n2025-10-09 12:00:01,?,h,\n")
    put("2.csv", "\n\n")
    lines = lambda: read_wide_reports(spark, str(tmp_path / "in"))
    paths = v.ValidationPaths(str(tmp_path / "v"))
    names = lambda **more: sorted(x["metric"] for x in v.valid_metrics(spark, lines(), paths, **more).collect())
    assert names() == ["mem.a"] and names(enabled={"proc": True}) == ["mem.a", "proc.x"]
    assert names(skip=True) == ["host", "mem.a"]
    put("3.csv", "Time,host,disk.b,late\n2025-10-10 12:00:00,7,1,?\n")
    assert names() == ["mem.a"]  # the list is kept
    write_validated(spark.createDataFrame([], "metric string"), paths.validated)
    seen = []
    real = r.profile_state
    monkeypatch.setattr(r, "profile_state", lambda rows: (seen.extend(x["archive"][-5:] for x in rows.select("archive").distinct().collect()), real(rows))[1])
    assert names() == ["disk.b", "host", "mem.a"] and seen == ["3.csv"]
    profiles = v.update_profiles(spark, lines(), paths.profiles)
    assert profiles.count() == 6 and seen == ["3.csv"]
    total = {x["metric"]: (x["total"], x["numeric"], x["text"]) for x in r.sum_profiles(profiles).collect()}
    assert total["host"] == (3, 1, 2) and total["late"] == (1, 0, 0)
