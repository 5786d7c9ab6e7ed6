import duckdb
import pandas as pd
import pytest
from cases import all_ids, documents, ids, odd_rows

import __spark_entry__ as e
from check_queries import compare, connect
from pulsemill.llm.mixing import mix_documents, mix_rows


def test_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(e.queries()["op8_source_mix"](spark, sf_dir).toPandas(), connect(sf_dir).sql(e.oracle_sql()["op8_source_mix"]).df()) == "ok"


def test_odd_rows_against_sql(spark):
    docs = documents(spark, odd_rows())
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(r[0], r[1], r[2] if len(r) > 2 else "web") for r in odd_rows()], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    got = mix_rows(docs).select("doc_id", "size", "source_size", "target", "taken").toPandas()
    want = con.sql(e.oracle_sql()["op8_source_mix"]).df()
    assert len(got) == len(want) and got["taken"].sum() == want["taken"].sum()
    assert ids(mix_rows(docs)) == all_ids()


def test_targets_are_met_to_the_word(spark):
    docs = documents(spark, [(i, "w " * (i % 37), f"s{i % 7}") for i in range(900)])
    per = mix_rows(docs).groupBy("source", "target", "source_size").agg({"taken": "sum"}).collect()
    assert all(abs(r["sum(taken)"] - r["target"]) < 1 for r in per)
    assert sum(r["target"] for r in per) == pytest.approx(1.5 * sum(r["source_size"] for r in per))


def test_documents_of_the_mix(spark):
    docs = documents(spark, odd_rows())
    mixed = mix_documents(docs)
    assert mixed.columns == [*docs.columns, "taken_"]
    words = mix_rows(docs).agg({"taken": "sum"}).first()[0]
    assert mixed.agg({"taken_": "sum"}).first()[0] == words
    assert mix_documents(docs.limit(0)).collect() == [] and mix_rows(docs.limit(0)).collect() == []
