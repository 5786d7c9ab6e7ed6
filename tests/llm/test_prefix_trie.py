import random
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as e
from check_queries import compare, connect
from pulsemill.llm import ordered_sums, prefix_trie
from pulsemill.llm.ordered_sums import running_sums

TURNS = "conv_id long, turn long, role string, text string, depth string, total string, a string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], TURNS)


def brute(rows):
    con = duckdb.connect()
    df = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64", "role": object, "text": object})
    con.register("conversations", df)
    return con.sql(prefix_trie.TRIE_SQL.format(table="conversations")).df().astype({"parent_conv_id": "Int64"})


def trie(spark, rows, **more):
    return prefix_trie.prefix_trie(spark, table(spark, rows), **more).toPandas().astype({"parent_conv_id": "Int64"})


def conversations(seed, n, deep=9):
    """Conversations over few texts, so that many prefixes are shared; some ids are missing."""
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(-250, 3 * n), n):
        shared = draw.randint(0, deep)
        rows += [(c, t, "ua"[t % 2], draw.choice("pqr") if t < shared else f"own {c} {t}") for t in range(draw.randint(1, deep))]
    draw.shuffle(rows)
    return rows


ODD = [
    (None, 0, "user", "nowhere"), (0, None, "user", "first"), (0, 0, None, "second"), (0, 0, None, "second"), (0, 0, "user", None),
    (0, 7, "user", "é𝒳" * 70_000), (7, 0, None, None), (7, 1, "user", ""), (100, 0, "u", "ab"), (101, 0, "ua", "b"), (103, None, None, None),
    (205, 0, "u", "lone"), (-5, 0, "u", "below zero"), (-100, 0, "u", "x"), (-200, 0, "u", "x"), (9_000_000_000, 1, "u", "x"),
]


def test_against_sql(spark):
    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        assert compare(e.queries()["op12_prefix_trie"](spark, sf_dir).toPandas(), connect(sf_dir).sql(e.oracle_sql()["op12_prefix_trie"]).df()) == "ok"


@pytest.mark.parametrize("cells", [8, 1 << 16])
def test_random_conversations(spark, cells):
    """A sketch of eight cells a row screens nothing out; the nodes are the same."""
    rows = conversations(5, 400)
    assert compare(trie(spark, rows, cells=cells), brute(rows)) == "ok"


@pytest.mark.parametrize("cells", [64, 256, 1024])
def test_prefixes_taken_for_shared(spark, cells):
    """A sketch that is nearly full takes single prefixes for shared, some of them below ones that it knows are single."""
    rows = [(c, t, "u", f"same {t}" if t < 2 else f"own {c} {t}") for c in range(60) for t in range(7)]
    assert compare(trie(spark, rows, cells=cells), brute(rows)) == "ok"


def test_odd_rows(spark):
    assert compare(trie(spark, ODD), brute(ODD)) == "ok"
    assert trie(spark, [r for r in ODD if r[0] is None]).empty and trie(spark, []).empty


def test_turnless_conversations(spark):
    """A family without its base: conversations shorter than their head have no turn left."""
    rows = [(c, 0, "u", "x") for c in range(301, 340)]
    got = trie(spark, rows)
    assert compare(got, brute(rows)) == "ok"
    gone = [c for c in range(301, 340) if zlib.crc32(str(c).encode()) % 6]
    assert len(got) == 2 and got["n_convs"].tolist() != [39, 39] and gone
    only = [(c, 0, "u", "x") for c in gone]
    assert trie(spark, only)[["n_convs", "n_leaves", "n_children"]].to_numpy().tolist() == [[len(gone), 1, 0]]
    assert compare(trie(spark, only), brute(only)) == "ok"


def test_copies_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_IDS_PER_CHUNK", 7)
    rows = [(c, t, "u", f"same {t}") for c in range(0, 200) for t in range(6)]
    rows += [(c, t, "u", f"long {t}") for c in (1000, 2000) for t in range(700)] + [(3000, t, "u", f"long {min(t, 650)}") for t in range(700)]
    assert compare(trie(spark, rows), brute(rows)) == "ok"


def test_sketch_never_counts_too_low(spark):
    turns, _ = prefix_trie.rebuilt_turns(spark, table(spark, conversations(6, 300)))
    prefixes = prefix_trie.prefix_rows(spark, turns)
    for cells in (64, 1 << 16):
        rows = prefix_trie.screened_prefixes(spark, prefixes, cells).toPandas()
        n = rows.groupby(["a", "b"])["conv_id"].transform("count")
        assert (rows["shared"] | (n == 1)).all()
    assert (~rows["shared"]).sum() >= 0.9 * (n == 1).sum()


def test_running_sums_over_ranges(spark, monkeypatch):
    """One key holds most rows, so it lies in many ranges; sums wrap at 64 bits."""
    draw = random.Random(2)
    rows = [(5 if draw.random() < 0.8 else draw.randint(-3, 40), i, draw.randint(-(1 << 63), (1 << 63) - 1), 1) for i in range(3_000)]
    df = spark.createDataFrame(rows, "key long, at long, x long, n long").repartition(7)
    got = running_sums(spark, df, "key", [F.col("at").desc()], ["x", "n"], "test-sums").collect()
    want, held = {}, {}
    for key, at, x, _ in sorted(rows, key=lambda r: -r[1]):
        total, n = held.get(key, (0, 0))
        held[key] = (total + x, n + 1)
        want[at] = ((total + x + (1 << 63)) % (1 << 64) - (1 << 63), n + 1)
    assert {r["at"]: (r["x"], r["n"]) for r in got} == want
    assert ordered_sums.running_sums(spark, df.limit(0), "key", [F.col("at")], ["x"], "test-sums").collect() == []
