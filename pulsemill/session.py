"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

import pulsemill

# Functions that run in tasks travel with their code, so the package need not be installed on the workers.
cloudpickle.register_pickle_by_value(pulsemill)

# Telemetry timestamps carry no zone and are read as UTC.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Folders are listed by at most this many tasks: one for each of thousands of folders costs more than the listing.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    # Stream state lives on disk beside the executor and in the checkpoint, not in its heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "pulsemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options the operators rely on in a session somebody else made."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Tables that cut lineage go here, so that they outlive any executor. Only a local
    session without ``spark.checkpoint.dir`` falls back to the machine's temp folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="pulsemill-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
