"""From report lines to the sample store."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.operators import reports as r
from pulsemill.operators.catalog import seen_metrics
from pulsemill.operators.inventory import run_ledger
from pulsemill.operators.joins import Side, keep_validated, side_join, stage_side, with_device_tags, with_tags
from pulsemill.operators.points import claimed_twice, fold_lines, resolve_samples, shared_fields
from pulsemill.schema import DEFAULT_MEASUREMENT, DEFAULT_PRODUCT_TYPE, DEFAULT_SERIAL, SAMPLES, TAGS
from pulsemill.session import scratch_path
from pulsemill.sinks import samples as sample_store
from pulsemill.sinks import tables
from pulsemill.sources.archives import EXPANDED, quarantine, report_headers


@dataclass(frozen=True)
class IngestOptions:
    """What to read and how to tag it. ``registry`` (device, product_type, serialNumber) gives
    tags per device; ``device_key`` finds the device of an archive from its path."""

    measurement: str = DEFAULT_MEASUREMENT
    product_type: str = DEFAULT_PRODUCT_TYPE
    serial: str = DEFAULT_SERIAL
    registry: DataFrame | None = None
    device_key: Callable[[Column], Column] = lambda archive: archive
    validated: DataFrame | None = None
    categories: dict[str, bool] = field(default_factory=dict)
    policy: tuple[str, ...] = ()


@dataclass(frozen=True)
class StorePaths:
    """Folders of the store: samples, catalog, ledger and, if kept, the raw lines."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name not in ("samples", "catalog", "ledger", "bronze"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


def read_lines(lines: DataFrame, headers: r.Headers) -> DataFrame:
    """Lines with their timestamp, header, numbers and check results."""
    return r.read_numbers(r.parse_lines(r.attach_header(lines, headers)))


def wanted_columns(columns: DataFrame, options: IngestOptions) -> DataFrame:
    """The metric columns to read: category rules first, then the validated list."""
    kept = r.category_filter(columns, options.categories)
    return kept if options.validated is None else keep_validated(kept, options.validated)


def tag_rows(rows: DataFrame, options: IngestOptions) -> DataFrame:
    """Device tags, looked up once per line and not once per value."""
    if options.registry is None:
        return with_tags(rows, options.product_type, options.serial)
    keyed = rows.withColumn("device", options.device_key(F.col("archive")))
    tagged = with_device_tags(keyed, options.registry, options.product_type, options.serial, on="device")
    return tagged.drop("device")


def to_samples(values: DataFrame, options: IngestOptions, ingest_seq: int) -> DataFrame:
    full = r.value_filter(values, options.policy).withColumns(
        {
            "measurement": F.lit(options.measurement),
            "ingest_seq": F.lit(ingest_seq).cast("long"),
            "d": F.to_date("ts"),
        }
    )
    return full.select(*SAMPLES.names)


def resolved_samples(
    spark: SparkSession, rows: DataFrame, columns: DataFrame | Side, options: IngestOptions, ingest_seq: int
) -> DataFrame:
    """Samples of tagged lines, one per series and time.

    Two values can only meet if two lines claim the same device and time, or two columns of a
    header share a field. Both are found on lines and headers, of which there are thousands of
    times fewer than values, and settled on lines too: columns that share a field inside their
    line, lines of one header as arrays, slot by slot. Only points that lines of different headers
    claim are settled value by value, after the lines of each header are one.
    """
    path = scratch_path(spark, "contested")
    usable = rows.filter("arity_ok AND ts IS NOT NULL")
    if r.skips_zero(options.policy):  # a zero that is skipped overwrites nothing
        usable = usable.withColumn("numbers", F.transform("numbers", lambda x: F.when(x != 0, x)))
    table = columns.table if isinstance(columns, Side) else columns
    claims, key = stage_side(spark, claimed_twice(usable), f"{path}/claims"), [*TAGS, "ts"]
    shared, column = stage_side(spark, shared_fields(table), f"{path}/fields"), ["header_id", "field"]

    def samples(values: DataFrame) -> DataFrame:
        return to_samples(values, options, ingest_seq)

    lone = side_join(usable, claims, key, "left_anti") if claims.size else usable
    if shared.size:
        plain = side_join(table, shared, column, "left_anti")
        parts = [samples(r.melt(lone, plain)), samples(r.melt_fields(lone, side_join(table, shared, column, "left_semi")))]
    else:
        parts = [samples(r.melt(lone, columns))]
    if claims.size:
        most, alike = claims.table.agg(F.max("n"), F.bool_and("one_header")).first()
        folded = fold_lines(side_join(usable, claims, key, "inner"), [*key, "one_header"], r.LINE_KEY, most)
        values = r.melt_fields(folded, columns, r.LINE_KEY)
        parts.append(samples(values.filter("one_header")))
        if not alike:
            parts.append(resolve_samples(samples(values.filter("NOT one_header"))))
    return reduce(DataFrame.unionByName, parts)


def ingest_lines(
    spark: SparkSession,
    lines: DataFrame,
    store: StorePaths,
    ingest_seq: int,
    options: IngestOptions = IngestOptions(),
    failed: DataFrame | None = None,
    first_lines: DataFrame | None = None,
    listed: DataFrame | None = None,
) -> None:
    """Load reports into the store: samples, catalogue and ledger.

    ``failed`` (archive, error) are archives that could not be read, ``first_lines`` (archive,
    header) the headers if they are known, ``listed`` (archive) files that may hold no line at all.
    """
    headers = r.read_headers(spark, lines, lambda columns: wanted_columns(columns, options), first_lines)
    # Text is parsed once; samples, catalogue and ledger all start from the staged arrays.
    staged = scratch_path(spark, "lines")
    read_lines(lines, headers).write.parquet(staged)
    rows = spark.read.parquet(staged)
    tagged = tag_rows(rows, options)
    samples = resolved_samples(spark, tagged, headers.side, options, ingest_seq)
    usable = tagged.filter("arity_ok AND ts IS NOT NULL").filter(r.gives_value(r.skips_zero(options.policy)))
    dated = usable.withColumns({"d": F.to_date("ts"), "measurement": F.lit(options.measurement)})
    sample_store.merge_samples(spark, samples, store.samples, sample_store.time_spans(dated))
    seen = r.numeric_columns(rows, headers.side).withColumn("ingest_seq", F.lit(ingest_seq).cast("long"))
    tables.append_catalog(spark, seen_metrics(seen), store.catalog)
    given = headers.archives if listed is None else headers.archives.unionByName(listed.select("archive"))
    ledger = run_ledger(r.ingest_counters(rows, options.policy), ingest_seq, failed, given)
    tables.append_ledger(ledger, store.ledger)


def ingest_archives(
    spark: SparkSession,
    expanded: DataFrame,
    store: StorePaths,
    ingest_seq: int,
    options: IngestOptions = IngestOptions(),
    keep_bronze: bool = False,
) -> None:
    """Load compressed archives, each unpacked once, into a table that everything else reads."""
    path = f"{store.bronze}/load={ingest_seq}" if keep_bronze else scratch_path(spark, "expanded")
    tables.write_bronze(expanded, path, mode="overwrite")
    expanded = spark.read.schema(EXPANDED).parquet(path)
    lines, failed = quarantine(expanded)
    ingest_lines(spark, lines, store, ingest_seq, options, failed, report_headers(expanded))
