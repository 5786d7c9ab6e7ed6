"""Rows every operator must bear: nulls in any column, empty and very long texts, ties, repeats, clashing names."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use themselves.
        T.StructField("node", T.StringType()),
        T.StructField("taken", T.LongType()),
        T.StructField("mark", T.StringType()),
        T.StructField("__rank", T.StringType()),
    ]
)


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "web", len(r[1] or ""), "n", 7, "m", "r") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    long_text = " ".join(f"word{i % 977} other{i}" for i in range(60_000))
    prose = "the cat sat on the mat and looked at the long road that led away from the old house by the sea"
    return [
        (None, prose), (1, None), (2, ""), (3, " \n\t "), (4, prose), (5, prose), (5, prose), (5, "short one"),
        (6, long_text), (7, "é" * 50 + " ünï ☃ 𝒳 " * 20), (8, "x" * 200_000), (9, prose, None), (None, None, None), (None, prose),
    ]


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


def all_ids():
    return sorted((r[0] for r in odd_rows()), key=lambda x: (x is None, x))
