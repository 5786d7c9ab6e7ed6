"""Which metrics ever give a number: profiles kept per archive, and a validated list that is loaded or made."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsemill.operators import reports as r
from pulsemill.operators.joins import side_join
from pulsemill.sinks.replacement import recover, replace
from pulsemill.sinks.tables import read_table, write_validated
from pulsemill.sources.reports import read_name_list

_COUNTS = ("total", "numeric", "null_token", "text")
PROFILES = T.StructType(
    [
        T.StructField("archive", T.StringType()),
        T.StructField("metric", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in _COUNTS],
        T.StructField("min_ts", T.TimestampType()),
        T.StructField("max_ts", T.TimestampType()),
        T.StructField("part", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ValidationPaths:
    """Folders of the profiles and of the validated list."""

    root: str

    @property
    def profiles(self) -> str:
        return f"{self.root.rstrip('/')}/profiles"

    @property
    def validated(self) -> str:
        return f"{self.root.rstrip('/')}/validated"


def _overwrite(rows: DataFrame, root: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(root)


def update_profiles(spark: SparkSession, lines: DataFrame, path: str, first_lines: DataFrame | None = None) -> DataFrame:
    """Profile the archives that have no profile yet and return all profiles (archive, metric, figures).

    An archive is profiled as a whole or not at all, and once: one without any usable line has a row
    without a metric.
    """
    recover(spark, PROFILES, path, _overwrite)
    known = read_table(spark, path, PROFILES).select("archive").distinct()
    fresh = side_join(lines, known, "archive", "left_anti")
    headers = r.read_headers(spark, fresh, first_lines=first_lines)
    rows = r.check_ts(r.check_arity(r.parse_lines(r.attach_header(fresh, headers))))
    named = r.name_profile(r.profile_state(rows), headers.side)
    profiles = named.unionByName(headers.archives.join(known, "archive", "left_anti"), allowMissingColumns=True)
    if not headers.archives.isEmpty():
        replace(spark, profiles.withColumn("part", F.lit(uuid.uuid4().hex)).select(*PROFILES.names), path, _overwrite)
    return read_table(spark, path, PROFILES).filter("metric IS NOT NULL").drop("part")


def read_validated(spark: SparkSession, path: str) -> DataFrame | None:
    """The validated list; none if there is no list, or nothing on it."""
    try:
        names = read_name_list(spark, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if names.isEmpty() else names


def valid_metrics(
    spark: SparkSession,
    lines: DataFrame,
    paths: ValidationPaths,
    enabled: dict[str, bool] | None = None,
    skip: bool = False,
    first_lines: DataFrame | None = None,
) -> DataFrame:
    """Names to read (metric): the validated list if there is one, else a new one from the profiles.

    A list that is missing or empty is made anew; only archives without a profile are read for it.
    With ``skip`` all names of the headers pass, and no list is read or written. Category rules
    apply to whatever comes out, so a kept list does not keep an earlier choice of categories.
    """
    if skip:
        return r.category_filter(r.read_headers(spark, lines, first_lines=first_lines).columns.select("metric").distinct(), enabled)
    names = read_validated(spark, paths.validated)
    if names is None:
        profiles = update_profiles(spark, lines, paths.profiles, first_lines)
        write_validated(r.sum_profiles(profiles).filter("valid"), paths.validated)
        names = read_name_list(spark, paths.validated)
    return r.category_filter(names, enabled)
