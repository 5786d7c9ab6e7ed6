import datetime as dt
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pulsemill.schema import SAMPLES
from pulsemill.session import apply_settings
from pulsemill.sinks import samples as store
from pulsemill.sinks.samples import (
    indexed_tag_values, merge_samples, read_samples, read_spans, recover_samples, time_spans, upsert_samples, write_samples,
)


def rows(days, seq, shift=0.0, product="S"):
    out = []
    for day in days:
        ts = dt.datetime(2025, 10, day, 12, tzinfo=dt.timezone.utc)
        for i in range(50):
            at = ts + dt.timedelta(seconds=i)
            out.append(("m", product, "007", at, "a.b", "a_b", 1, i + shift, "x", 0, i, seq, at.date()))
    return out


def files(path, day):
    return sorted(f.name for f in Path(path).glob(f"product_type=*/d=2025-10-{day:02d}/bucket=*/*.parquet"))


def test_upsert_replaces_only_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "samples")
    upsert_samples(spark, spark.createDataFrame(rows([1, 2, 3], 1), SAMPLES), path)
    before = {day: files(path, day) for day in (1, 2, 3)}
    upsert_samples(spark, spark.createDataFrame(rows([2, 4], 2, shift=100.0), SAMPLES), path)
    assert files(path, 1) == before[1] and files(path, 3) == before[3] and files(path, 2) != before[2]
    stored = read_samples(spark, path)
    assert stored.count() == 200
    assert {x["serialNumber"] for x in stored.select("serialNumber").distinct().collect()} == {"007"}
    newest = stored.filter("d IN (DATE'2025-10-02', DATE'2025-10-04')")
    assert newest.filter("value >= 100").count() == 100 and stored.filter("value < 100").count() == 100


def test_other_times_and_devices_are_appended(spark, tmp_path):
    path = str(tmp_path / "samples")
    upsert_samples(spark, spark.createDataFrame(rows([1, 2], 1), SAMPLES), path)
    before = files(path, 1)
    later = [(*r[:3], r[3] + dt.timedelta(hours=1), *r[4:]) for r in rows([1], 2)]
    other = [(*r[:2], "008", *r[3:]) for r in rows([1], 2)]
    upsert_samples(spark, spark.createDataFrame(later + other, SAMPLES), path)
    assert set(before) < set(files(path, 1))
    assert read_samples(spark, path).count() == 200


def test_older_load_does_not_overwrite(spark, tmp_path):
    path = str(tmp_path / "samples")
    upsert_samples(spark, spark.createDataFrame(rows([1], 5, shift=100.0), SAMPLES), path)
    upsert_samples(spark, spark.createDataFrame(rows([1], 2), SAMPLES), path)
    stored = read_samples(spark, path)
    assert stored.count() == 50 and stored.filter("value < 100").count() == 0


def test_loading_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "samples")
    load = spark.createDataFrame(rows([1, 2], 1), SAMPLES)
    upsert_samples(spark, load, path)
    once = sorted(map(str, read_samples(spark, path).collect()))
    upsert_samples(spark, load, path)
    assert sorted(map(str, read_samples(spark, path).collect())) == once


def test_empty_load(spark, tmp_path):
    path = str(tmp_path / "samples")
    upsert_samples(spark, spark.createDataFrame(rows([1], 1), SAMPLES), path)
    upsert_samples(spark, spark.createDataFrame([], SAMPLES), path)
    assert read_samples(spark, path).count() == 50


def test_hot_partition_becomes_several_files(spark, tmp_path):
    path = str(tmp_path / "samples")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        hot = spark.range(40000).selectExpr(
            "'m' measurement", "'S' product_type", "string(id % 50) serialNumber",
            "timestamp_seconds(1759320000 + id % 20000) ts", "'a.b' metric", "'a_b' field", "1 pos", "rand(1) value",
            "'x' archive", "0L block_start", "id row_id", "1L ingest_seq", "DATE'2025-10-01' d",
        )
        write_samples(hot, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(path, 1)) > 2
    assert read_samples(spark, path).count() == 40000


# --- the index of spans, and replacement that survives a crash ----------------------------


def device(serial, day=1, seq=1, shift=0.0, hour=0):
    return [(*r[:2], serial, r[3] + dt.timedelta(hours=hour), *r[4:]) for r in rows([day], seq, shift)]


def buckets(path, day=1):
    """Names of the files in each bucket of a day."""
    return {b.name: sorted(f.name for f in b.glob("*.parquet")) for b in Path(path).glob(f"product_type=S/d=2025-10-{day:02d}/bucket=*")}


def poison(path, days):
    """Files that no reader survives, in every directory of some days."""
    for folder in (f for day in days for f in Path(path).glob(f"product_type=*/d={day}/bucket=*")):
        (folder / "part-broken.parquet").write_bytes(b"no parquet at all")


def test_one_device_reloaded_rewrites_one_bucket(spark, tmp_path):
    path = str(tmp_path / "samples")
    first = [r for serial in range(40) for r in device(f"{serial:03d}")]
    upsert_samples(spark, spark.createDataFrame(first, SAMPLES), path)
    before = buckets(path)
    upsert_samples(spark, spark.createDataFrame(device("007", seq=2, shift=100.0), SAMPLES), path)
    after = buckets(path)
    assert len(before) == 8 and sum(after[b] != before[b] for b in before) == 1
    stored = read_samples(spark, path)
    assert stored.count() == 40 * 50 and stored.filter("value >= 100").count() == 50
    own = store.read_device(spark, path, "m", "S", "007")
    assert own.count() == 50 and own.filter("value < 100").count() == 0


def test_a_stray_day_reads_no_other(spark, tmp_path):
    path = str(tmp_path / "samples")
    days = range(1, 11)
    upsert_samples(spark, spark.createDataFrame(rows(days, 1), SAMPLES), path)
    stray = (*rows([1], 2)[0][:3], dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc), *rows([1], 2)[0][4:-1], dt.date(1970, 1, 1))
    load = rows([10], 2, shift=100.0) + [stray]
    poison(path, [f"2025-10-{d:02d}" for d in days if d != 10])
    index = Path(f"{path}-spans")
    for day in days:
        if day != 10:
            (index / f"d=2025-10-{day:02d}" / "part-broken.parquet").write_bytes(b"x")
    upsert_samples(spark, spark.createDataFrame(load, SAMPLES), path)
    newest = read_samples(spark, path).filter("d IN (DATE'2025-10-10', DATE'1970-01-01')")
    assert newest.count() == 51 and newest.filter("value >= 100").count() == 50


def test_many_product_types_stay_apart(spark, tmp_path):
    """More types than any list of them: only the one that overlaps is replaced."""
    path = str(tmp_path / "samples")
    one = spark.createDataFrame([r for i in range(600) for r in rows([1], 1, product=f"S{i}")[:1]], SAMPLES)
    upsert_samples(spark, one, path)
    other = one.withColumn("ts", one.ts + dt.timedelta(minutes=1)).withColumn("ingest_seq", one.ingest_seq + 1)
    poison_free = sorted(str(f) for f in Path(path).rglob("*.parquet"))
    again = one.filter("product_type = 'S7'").withColumn("value", one.value + 100).withColumn("ingest_seq", one.ingest_seq + 1)
    upsert_samples(spark, other.filter("product_type <> 'S7'").unionByName(again), path)
    kept = set(poison_free) & {str(f) for f in Path(path).rglob("*.parquet")}
    assert len(poison_free) - len(kept) == 1 and read_samples(spark, path).count() == 599 * 2 + 1


def test_spans_meet_at_their_ends(spark, tmp_path):
    path = str(tmp_path / "samples")
    upsert_samples(spark, spark.createDataFrame(device("a"), SAMPLES), path)
    before = buckets(path)
    last = device("a", seq=2, shift=100.0)[-1:]
    upsert_samples(spark, spark.createDataFrame(last, SAMPLES), path)
    assert buckets(path) != before and read_samples(spark, path).count() == 50
    assert read_spans(spark, path).count() == 1  # a span inside a known one adds nothing


class Crash(Exception):
    pass


def crash_at(monkeypatch, step):
    """Die before or in the middle of a step of the merge."""
    real = store.write_samples

    def write(samples, root, mode="append"):
        if mode == "overwrite" and step == "half replaced":
            # What a commit leaves that dies between taking the old directories away and putting the new ones there.
            import shutil

            first = samples.select("product_type", "d").first()
            shutil.rmtree(f"{root}/product_type={first['product_type']}/d={first['d']}")
            raise Crash
        if (mode == "overwrite") == (step == "before replacing"):
            raise Crash
        real(samples, root, mode)

    monkeypatch.setattr(store, "write_samples", write)


@pytest.mark.parametrize("step", ["half replaced", "before replacing", "before appending"])
@pytest.mark.parametrize("then", ["the same load", "another load", "recovery"])
def test_a_crash_loses_no_row(spark, tmp_path, step, then):
    path = str(tmp_path / "samples")
    upsert_samples(spark, spark.createDataFrame(rows([1, 2], 1), SAMPLES), path)
    # Day 1 is replaced, day 3 appended.
    load = spark.createDataFrame(rows([1, 3], 2, shift=100.0), SAMPLES)
    with pytest.MonkeyPatch.context() as patch:
        crash_at(patch, step)
        with pytest.raises(Crash):
            upsert_samples(spark, load, path)
    if then == "the same load":
        upsert_samples(spark, load, path)
    elif then == "another load":
        upsert_samples(spark, spark.createDataFrame(rows([5], 3), SAMPLES), path)
    else:
        recover_samples(spark, path)
    newer = read_samples(spark, path).select("d", (F.col("value") >= 100).alias("newer"))
    got = {(r["d"].day, r["newer"]): r["count"] for r in newer.groupBy("d", "newer").count().collect()}
    want = {(1, True): 50, (2, False): 50} | {"the same load": {(3, True): 50}, "another load": {(5, False): 50}, "recovery": {}}[then]
    assert got == want
    assert not list(Path(f"{path}-pending").glob("*"))


def test_an_unfinished_staging_is_dropped(spark, tmp_path):
    path = str(tmp_path / "samples")
    upsert_samples(spark, spark.createDataFrame(rows([1], 1), SAMPLES), path)
    half = Path(f"{path}-pending/half")
    half.mkdir(parents=True)
    (half / "part-0.parquet").write_bytes(b"half a file")
    recover_samples(spark, path)
    assert not half.exists() and read_samples(spark, path).count() == 50


def test_tag_values_read_the_index_only(spark, tmp_path):
    path = str(tmp_path / "samples")
    load = [r for serial, day in (("a", 1), ("b", 5), ("c", 9)) for r in device(serial, day)]
    load += [(r[0], "T", *r[2:]) for r in device("z", 9)]
    upsert_samples(spark, spark.createDataFrame(load, SAMPLES), path)
    poison(path, ["*"])
    values = lambda *a: sorted(r[0] for r in indexed_tag_values(spark, path, *a).collect())
    assert values("serialNumber", "5 days", "2025-10-10 00:00:00") == ["b", "c", "z"]
    assert values("serialNumber", "30 days", "2025-10-10 00:00:00", F.col("product_type") == "S") == ["a", "b", "c"]
    assert values("product_type", "1 day", "2025-10-10 00:00:00") == ["S", "T"]
    assert values("serialNumber", "1 second", "2025-10-09 12:00:49") == ["c", "z"]
    assert values("serialNumber", "0 seconds", "2025-10-09 12:00:50") == []


def test_pruning_by_the_load(spark, tmp_path, plan_of):
    path = str(tmp_path / "samples")
    first = spark.createDataFrame(rows([1, 2], 1), SAMPLES)
    upsert_samples(spark, first, path)
    spans = tmp_path / "new"
    time_spans(first).select(*store.SPANS.names).write.parquet(str(spans))
    plan = plan_of(store.overlaps(read_spans(spark, path), spark.read.schema(store.SPANS).parquet(str(spans))))
    assert "dynamicpruning" in plan and merge_samples is not None


def test_merge_sorts_rows_once(spark, plan_of, tmp_path):
    """Rows of a merge are shuffled as they are read, then sorted and resolved."""
    stored, fresh = (spark.createDataFrame(rows([1], seq), SAMPLES) for seq in (1, 2))
    plan = plan_of(store.merged(stored, fresh))
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1
    assert plan.rindex("SortAggregate") < plan.index("Sort [") < plan.index("Exchange")
    assert {r["ingest_seq"] for r in store.merged(stored, fresh).collect()} == {2}


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    """More folders than tasks: listing them runs one job of a bounded number of tasks."""
    apply_settings(spark)
    for i in range(150):
        (tmp_path / f"report={i}").mkdir()
        (tmp_path / f"report={i}" / "lines.txt").write_text("x\n")
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "listing")
    read = spark.read.option("recursiveFileLookup", "true").text(str(tmp_path))
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds) <= 64
    assert read.count() == 150
