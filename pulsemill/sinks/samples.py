"""The sample store: a long table in directories, and an index of the time spans in it.

``root`` holds the samples by product type, day and device bucket. ``root-spans`` holds, for each
device, day and load, the first and last time the load wrote. A load learns from the index alone
which directories it may have to merge with; no sample is read for that.

The index is written before the samples, so it may say more than the store holds, never less. If the
process dies at any point, the next load finishes a replacement under way (see ``replacement``), and
a load that is repeated meets itself in the index and is merged. One load writes to a store at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.operators.joins import side_join
from pulsemill.operators.points import resolve_samples
from pulsemill.operators.series import since
from pulsemill.schema import DEVICE_BUCKETS, PARTITIONS, SAMPLES, SERIES
from pulsemill.session import scratch_path
from pulsemill.sinks.replacement import recover, replace
from pulsemill.sinks.tables import read_table

STORED = T.StructType([*SAMPLES.fields, T.StructField("bucket", T.IntegerType())])
SPANS = T.StructType(
    [
        T.StructField("product_type", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("measurement", T.StringType()),
        T.StructField("serialNumber", T.StringType()),
        T.StructField("low", T.TimestampType()),
        T.StructField("high", T.TimestampType()),
        T.StructField("d", T.DateType()),
    ]
)
_DEVICE_DAY = ["product_type", "d", "measurement", "serialNumber"]


def device_bucket() -> Column:
    return F.pmod(F.xxhash64("measurement", "serialNumber"), F.lit(DEVICE_BUCKETS)).cast("int")


def read_samples(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, STORED).select(*SAMPLES.names)


def read_device(spark: SparkSession, root: str, measurement: str, product_type: str, serial: str) -> DataFrame:
    """Samples of one device; only its bucket is read."""
    device = spark.range(1).select(F.lit(measurement).alias("measurement"), F.lit(serial).alias("serialNumber"))
    bucket = device.select(device_bucket()).first()[0]
    own = (F.col("product_type") == product_type) & (F.col("serialNumber") == serial) & (F.col("measurement") == measurement)
    return read_table(spark, root, STORED).filter(own & (F.col("bucket") == bucket)).select(*SAMPLES.names)


def write_samples(samples: DataFrame, root: str, mode: str = "append") -> None:
    """Write the store's layout, partitioned by product type, day and device bucket.

    The rebalance splits a partition that holds much of the data over many tasks and files and
    merges small ones. Rows are sorted by field, so that a metric predicate skips row groups.
    """
    laid_out = (
        samples.select(*SAMPLES.names, device_bucket().alias("bucket"))
        .hint("rebalance", *PARTITIONS)
        .sortWithinPartitions(*PARTITIONS, "field", "serialNumber", "ts")
    )
    writer = laid_out.write.mode(mode).partitionBy(*PARTITIONS)
    writer.option("partitionOverwriteMode", "dynamic").parquet(root)


def upsert_samples(spark: SparkSession, samples: DataFrame, root: str) -> None:
    """Merge a load into the store, last write wins; repeating a load changes nothing."""
    merge_samples(spark, resolve_samples(samples.select(*SAMPLES.names)), root)


def merge_samples(spark: SparkSession, fresh: DataFrame, root: str, spans: DataFrame | None = None) -> None:
    """Merge a load that has one value per series and time.

    Directories in which no device's new time span meets one in the index are only appended to;
    the others are read, resolved, staged and replaced. ``spans`` (see ``time_spans``) saves a
    pass over the load where the caller knows them already.
    """
    recover_samples(spark, root)
    work = scratch_path(spark, "merge")
    if spans is None:
        fresh = _staged(spark, fresh, f"{work}/new", SAMPLES)
        spans = time_spans(fresh)
    new = _staged(spark, spans, f"{work}/spans", SPANS)
    meetings = _staged(spark, overlaps(read_spans(spark, root), new), f"{work}/meetings", MEETINGS)
    _extend_index(new, meetings, root)
    met = meetings.groupBy(*PARTITIONS).agg(F.count("*").alias("n")).filter("n > 0")
    if met.isEmpty():
        write_samples(fresh, root)
        return
    # One row for each directory to replace, out of the list that Spark itself keeps of a store. The
    # comparison lets it prune the store's other directories before they are read.
    met = F.broadcast(met)
    keyed = fresh.withColumn("bucket", device_bucket())
    stored = read_table(spark, root, STORED).join(met, PARTITIONS, "left_semi")
    replace(spark, merged(stored, keyed.join(met, PARTITIONS, "left_semi")), root, _overwrite)
    if not new.join(met, PARTITIONS, "left_anti").isEmpty():
        write_samples(keyed.join(met, PARTITIONS, "left_anti"), root)


def merged(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The last of each series and time. Neither side repeats one, so rows are shuffled before they are
    sorted and resolved: nothing could be resolved, only sorted once more, where they are read."""
    both = stored.select(*SAMPLES.names).unionByName(fresh.select(*SAMPLES.names))
    return resolve_samples(both.repartition(*SERIES, "ts"))


def _staged(spark: SparkSession, df: DataFrame, path: str, schema: T.StructType) -> DataFrame:
    df.select(*schema.names).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def _overwrite(samples: DataFrame, root: str) -> None:
    write_samples(samples, root, mode="overwrite")


def recover_samples(spark: SparkSession, root: str) -> None:
    """Finish a replacement that an earlier process staged and did not see through."""
    recover(spark, SAMPLES, root, _overwrite)


# --- the index ----------------------------------------------------------------------------

# Where a device's new span meets a known one, and whether it lies inside it.
MEETINGS = T.StructType([*(f for f in SPANS if f.name not in ("low", "high")), T.StructField("inside", T.BooleanType())])


def _index(root: str) -> str:
    return f"{root.rstrip('/')}-spans"


def read_spans(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, _index(root), SPANS)


def time_spans(rows: DataFrame) -> DataFrame:
    """First and last time of each device and day."""
    spans = rows.groupBy(*_DEVICE_DAY).agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    return spans.withColumn("bucket", device_bucket())


def overlaps(known: DataFrame, new: DataFrame) -> DataFrame:
    """Interval join of known spans with a load's: the known buckets in which a device's spans meet.

    The load's spans are broadcast while they are small; the comparison of their ends, true of every
    span, marks them as a choice of days, and Spark then reads only these days of the index.
    """
    sides = new.filter("low <= high").select(*_DEVICE_DAY, F.col("low").alias("new_low"), F.col("high").alias("new_high"))
    meet = (F.col("new_low") <= F.col("high")) & (F.col("low") <= F.col("new_high"))
    inside = (F.col("low") <= F.col("new_low")) & (F.col("new_high") <= F.col("high"))
    return side_join(known, sides, _DEVICE_DAY, "inner").filter(meet).select(*_DEVICE_DAY, "bucket", inside.alias("inside"))


def _extend_index(new: DataFrame, meetings: DataFrame, root: str) -> None:
    """Add the spans that no known span contains, so that a repeated load adds nothing."""
    fresh = side_join(new, meetings.filter("inside").select(*_DEVICE_DAY), _DEVICE_DAY, "left_anti").select(*SPANS.names)
    fresh.hint("rebalance", "d").write.mode("append").partitionBy("d").parquet(_index(root))


def indexed_tag_values(
    spark: SparkSession, root: str, tag: str, interval: str, anchor, predicate: Column | None = None
) -> DataFrame:
    """Distinct values of a tag in the time before ``anchor``, from the index: no sample is read.

    A device counts if one of its spans ends in that time, which is when it has a sample there.
    """
    spans = read_spans(spark, root).select("product_type", "serialNumber", "measurement", "d", F.col("high").alias("ts"))
    recent = since(spans, interval, anchor)
    if predicate is not None:
        recent = recent.filter(predicate)
    return recent.select(tag).distinct()
