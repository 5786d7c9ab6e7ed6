import corpus_pipeline
import pytest

import __spark_entry__ as e
from pulsemill.llm import decontaminate, near_dups, quality, secret_scan
from pulsemill.llm.frames import read_table

SF_DIR = "/root/testdata/sf0.001"
CORPUS = sorted(k for k in e.queries() if k.startswith("op"))


@pytest.mark.parametrize("name", CORPUS)
def test_queries_run(spark, name):
    rows = e.queries()[name](spark, SF_DIR)
    assert rows.columns and rows.count() >= 0


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in CORPUS) == list(range(1, 14))


def test_stages_against_their_reports(spark):
    """Each stage keeps what its operator's own report says, judged on the stage's input."""
    docs = read_table(spark, SF_DIR, "documents")
    columns = docs.columns
    labels, benchmark = read_table(spark, SF_DIR, "labels"), read_table(spark, SF_DIR, "benchmark")

    def kept(df):
        return {r["doc_id"] for r in df.select("doc_id").collect()}

    stages = dict(corpus_pipeline.STAGES)
    report = quality.line_quality(docs, quality.fit_field(docs, labels)).where("kept")
    docs = stages["quality rules"](spark, docs, SF_DIR).cache()
    assert docs.columns == columns and kept(docs) == kept(report)
    classes = near_dups.duplicate_classes(spark, docs).collect()
    unique = stages["near-duplicates"](spark, docs, SF_DIR).cache()
    assert unique.columns == columns and kept(unique) == {r["class_id"] for r in classes}
    leaks = kept(decontaminate.find_leaks(spark, unique, benchmark))
    clean = stages["decontamination"](spark, unique, SF_DIR).cache()
    assert clean.columns == columns and kept(clean) == kept(unique) - leaks
    masked = stages["secrets"](spark, clean, SF_DIR)
    assert masked.columns == columns and kept(masked) == kept(clean)
    assert secret_scan.scan_secrets(masked).where("n_access > 0 or n_hex > 0").count() == 0


def test_the_whole_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.columns == [*read_table(spark, SF_DIR, "documents").columns, "taken"]
    assert rows.where("taken <= 0").count() == 0 and rows.count() > 0
