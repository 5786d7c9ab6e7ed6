"""Files, logs and run outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsemill.functions.scalars import strip


def newest_first(inventory: DataFrame) -> DataFrame:
    return inventory.orderBy(F.col("modified").desc(), "name")


def state_counts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("state").agg(F.count("*").alias("n"))


def last_n_lines(logs: DataFrame, n: int = 5, position: tuple[str, ...] = ("path", "block_start", "row_id")) -> DataFrame:
    """The last ``n`` lines of each log, blank ones dropped after they were counted.

    Spark cuts to ``n`` rows per log in every task before it shuffles.
    """
    latest = Window.partitionBy("log").orderBy(*[F.col(c).desc() for c in position])
    tail = logs.withColumn("rn", F.row_number().over(latest)).filter(F.col("rn") <= n)
    return tail.filter(strip(F.col("line")) != "")


def run_ledger(
    counters: DataFrame, ingest_seq: int, failed: DataFrame | None = None, listed: DataFrame | None = None
) -> DataFrame:
    """One row per archive of a run: processed with its counters, or failed with the reason.

    ``counters``, ``failed`` (archive, error) and ``listed`` (archive), the archives that the run
    was given, are reconciled by full outer joins: an archive that any of them names has its row,
    also if nothing of it was ever counted. Counters of such an archive are 0.
    """
    numbers = [c for c in counters.columns if c != "archive"]
    rows = counters.withColumn("counted", F.lit(True))
    if failed is not None:
        rows = rows.join(failed.select("archive", F.col("error").alias("reason")), "archive", "full")
    else:
        rows = rows.withColumn("reason", F.lit(None).cast("string"))
    if listed is not None:
        rows = rows.join(listed.select("archive").distinct(), "archive", "full")
    unread = F.when(F.col("counted").isNull(), "no lines in report").otherwise("no usable points")
    error = F.coalesce("reason", F.when(F.coalesce("points", F.lit(0)) == 0, unread))
    return rows.select(
        F.lit(ingest_seq).cast("long").alias("ingest_seq"),
        "archive",
        F.when(error.isNull(), "processed").otherwise("failed").alias("status"),
        error.alias("error"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
    )


def outcome_totals(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count("*").alias("n"))
