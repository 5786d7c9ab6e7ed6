import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from cases import documents, odd_rows

import __spark_entry__ as e
from check_queries import compare, connect
from pulsemill.llm import ranked_search
from pulsemill.llm.ranked_search import SEARCH_SQL, _pack, _unpack, search

ITEMS = "item_id long, text string, place string, score long"


def brute(rows, items):
    con = duckdb.connect()
    con.register("docs", pd.DataFrame([r[:2] for r in rows], columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": object}))
    con.register("items", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64", "text": object}))
    return con.sql(SEARCH_SQL.format(documents="docs", benchmark="items")).df()


def found(spark, rows, items, **more):
    return search(spark, documents(spark, rows), spark.createDataFrame([(i, t, "p", 1) for i, t in items], ITEMS), **more).drop("place").toPandas()


def test_against_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert compare(e.queries()["op13_ranked_search"](spark, sf_dir).toPandas(), connect(sf_dir).sql(e.oracle_sql()["op13_ranked_search"]).df()) == "ok"


@pytest.mark.parametrize("shard,per_block,per_pass", [(1 << 24, 128, 1 << 20), (4_000, 4, 30)])
def test_random_texts(spark, monkeypatch, shard, per_block, per_pass):
    """Many shards, blocks and passes give what scoring every document gives; scores tie often."""
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", shard)
    monkeypatch.setattr(ranked_search, "POSTINGS_PER_BLOCK", per_block)
    monkeypatch.setattr(ranked_search, "TERMS_PER_PASS", per_pass)
    draw = random.Random(7)
    words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(3_000)]
    rows = [(i, " ".join(draw.choices(words, k=draw.choice([1, 3, 3, 20, 60])))) for i in range(900)] + [(5_000, "w1 w2")] * 30
    items = [(i, " ".join(draw.choices(words, k=draw.randint(1, 25)))) for i in range(40)]
    assert compare(found(spark, rows, items), brute(rows, items)) == "ok"


def test_odd_rows(spark):
    rows = odd_rows() + [(i, "Straße 42, naïve-word A_b\x00c ÀÉ", None) for i in range(12)]
    items = [(1, None), (2, ""), (3, " .,! "), (None, "the cat"), (4, "the THE tHe cat"), (4, "the THE tHe cat"), (5, "straße a b C àé"), (6, "ÀÉ nowhere"), (7, "x" * 200_000)]
    got = found(spark, rows, items).astype({"doc_id": "Int64", "item_id": "Int64"})
    assert compare(got, brute(rows, items)) == "ok"
    assert set(got["item_id"].dropna()) == {4, 5, 6, 7} and len(got[got["item_id"] == 4]) == 2 * len(got[got["item_id"].isna()])
    assert found(spark, rows, []).empty and found(spark, [], items).empty


def test_equal_scores_rank_by_id(spark):
    rows = [(i, "same words here") for i in random.Random(1).sample(range(-40, 40), 60)] + [(None, "same words here")] * 3 + [(100 + i, "other text") for i in range(400)]
    got = found(spark, rows, [(1, "words")]).sort_values("rank")
    assert got["doc_id"].tolist() == sorted(r[0] for r in rows[:60])[:10]
    assert found(spark, rows, [(1, "words")], top=63)["doc_id"].isna().sum() == 3


def test_blocks_are_rejected_before_they_are_unpacked(spark, monkeypatch):
    """The rare term decides; of the common term's blocks only few are read."""
    monkeypatch.setattr(ranked_search, "POSTINGS_PER_BLOCK", 16)
    import pyarrow as pa

    texts = pa.array([("rare " * 5 + "common") if i % 400 < 20 else "common " + "filler " * 30 for i in range(4_000)])
    hashes, counts = ranked_search._terms(texts)
    vocabulary = np.unique(ranked_search._terms(pa.array(["rare common"]))[0])
    keep = np.isin(hashes, vocabulary)
    batch = ranked_search._shard([pa.array(range(4_000), pa.int64())], [counts], np.repeat(np.arange(4_000), counts)[keep], hashes[keep])
    shard = ranked_search._Shard(batch, 0, 4_000, int(counts.sum()))
    rare, common = (int(ranked_search._terms(pa.array([w]))[0].view(np.int64)[0]) for w in ("rare", "common"))
    query = ranked_search._Query([(rare, 6_000), (common, 1)])
    shard.search(query, 10)
    assert len(query.heap) == 10 and len(shard.unpacked) < len(shard.blocks) / 4


def test_round_trip_of_blocks():
    draw = np.random.default_rng(3)
    for top in (200, 60_000, 1 << 20, 1 << 40):
        docs, tfs = np.unique(draw.integers(0, top, 100)), None
        tfs = draw.integers(1, top, len(docs))
        a, b = _unpack(_pack(docs, tfs))
        assert (a == docs).all() and (b == tfs).all()
