"""The canonical long table, its keys, and the fixed values of the report format."""

from __future__ import annotations

from pyspark.sql import types as T

DEFAULT_MEASUREMENT = "system_metrics"

SAMPLES = T.StructType(
    [
        T.StructField("measurement", T.StringType()),
        T.StructField("product_type", T.StringType()),
        T.StructField("serialNumber", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("pos", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("archive", T.StringType()),
        T.StructField("block_start", T.LongType()),
        T.StructField("row_id", T.LongType()),
        T.StructField("ingest_seq", T.LongType()),
        T.StructField("d", T.DateType()),
    ]
)

TAGS = ["product_type", "serialNumber"]
SERIES = ["measurement", *TAGS, "field"]
POINT = ["measurement", *TAGS, "ts"]
# A point is overwritten by the later load, then the later line, then the later column.
WRITE_ORDER = ["ingest_seq", "archive", "block_start", "row_id", "pos"]
# The store's directories. A device's samples of a day lie in one bucket; the number is part of the
# store's layout and stays as it is.
PARTITIONS = ["product_type", "d", "bucket"]
DEVICE_BUCKETS = 8

# Fixed values of the input format (they must equal what the tools that write it use).
NULL_TOKENS = ["", "n/a", "?", "none", "null"]
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_PRODUCT_TYPE = "SERVER1"
DEFAULT_SERIAL = "1234"

# Metric name prefix, category, kept by default.
CATEGORY_RULES = [
    ("proc.", "proc", False),
    ("disk.", "disk", True),
    ("vfs.", "file", True),
    ("filesys.", "file", True),
    ("mem.", "mem", True),
    ("network.", "network", True),
    ("kernel.", "kernel", True),
    ("swap.", "swap", True),
    ("nfs.", "nfs", False),
]
