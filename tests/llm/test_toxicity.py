import zlib

from cases import all_ids, documents, ids, odd_rows

from pulsemill.llm.toxicity import fit, score_toxicity

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = score_toxicity(docs, fit(docs, labels)).join(labels, "doc_id").where("held_out and toxic is not null").collect()
    assert len(scored) > 20
    assert sum(r["predicted"] == r["toxic"] for r in scored) / len(scored) >= 0.9
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in scored)


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows = [(i, "you awful stupid thing go away" if i % 2 else "a calm day by the quiet lake") for i in range(60)]
    docs = documents(spark, rows)
    labels = [(i, i % 2) for i in range(60)]
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    a, b = (fit(docs, spark.createDataFrame(x, "doc_id bigint, toxic int")) for x in (labels, turned))
    assert a.bias == b.bias and (a.places == b.places).all() and (a.values == b.values).all()
    again = fit(docs, spark.createDataFrame(labels[::-1], "doc_id bigint, toxic int"))
    assert a.bias == again.bias and (a.values == again.values).all()


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (6, 0), (7, 1)], "doc_id bigint, toxic int")
    for some in (labels, labels.limit(0)):
        scored = score_toxicity(docs, fit(docs, some))
        assert ids(scored) == all_ids()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored.collect())
    assert score_toxicity(docs.limit(0), fit(docs.limit(0), labels)).collect() == []
