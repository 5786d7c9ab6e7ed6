import random
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import all_ids, documents, ids, odd_rows
from pyspark.sql import functions as F

from pulsemill.llm import near_dups
from pulsemill.llm.near_dups import BANDS, ROWS, duplicate_classes, keep_one, shingles, signatures, similarity
from pulsemill.llm.text import split_words


def vector(text):
    w = text.split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_similarity(a, b):
    x, y = vector(a), vector(b)
    every = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in every) for i in set(x) & set(y))


def fast_similarity(a, b):
    parts = [shingles(split_words(pa.array([t]))) for t in (a, b)]
    return similarity(*((k, c) for _, k, c in parts))


def edited(r, words, edits):
    out = list(words)
    for _ in range(edits):
        out[r.randrange(len(out))] = f"e{r.random()}"
    return " ".join(out)


def corpus():
    r = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"g{g}w{r.randint(0, 300)}" for _ in range(r.randint(60, 200))]
        rows += [edited(r, base, r.randint(0, 4)) for _ in range(r.randint(1, 12))]
    # One large group whose members are close to its base but often not to each other.
    base = [f"h{i}" for i in range(200)]
    rows += [edited(r, base, r.randint(1, 12)) for _ in range(120)]
    r.shuffle(rows)
    return list(enumerate(rows))


def brute_classes(rows):
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if a.split()[:1] and fast_similarity(a, b) >= 0.8:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i, _ in rows}


def test_similarity_against_its_definition():
    r = random.Random(2)
    for _ in range(60):
        a = [f"w{r.randint(0, 5)}" for _ in range(r.randint(1, 40))]
        b = edited(r, a, r.randint(0, 3))
        assert abs(fast_similarity(" ".join(a), b) - brute_similarity(" ".join(a), b)) < 1e-9


def test_registers_agree_with_the_probability_of_similarity():
    r = random.Random(4)
    a = [f"w{r.randint(0, 30)}" for _ in range(300)]
    b = edited(r, a, 12)
    rows, keys, counts = shingles(split_words(pa.array([" ".join(a), b])))
    got = signatures(rows, keys, counts, 2, 4000)
    assert abs(np.mean(got[0] == got[1]) - brute_similarity(" ".join(a), b)) < 0.04
    assert BANDS * ROWS <= 4000


def test_classes_against_all_pairs(spark):
    rows = corpus()
    got = {r["doc_id"]: r["class_id"] for r in duplicate_classes(spark, documents(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = duplicate_classes(spark, docs).collect()
    assert ids(duplicate_classes(spark, docs)) == all_ids()
    assert {r["class_id"] for r in got if r["doc_id"] in (4, 9)} == {4} and {r["class_size"] for r in got if r["doc_id"] == 4} == {6}
    kept = keep_one(spark, docs)
    assert kept.columns == docs.columns
    # Texts without words stay; of the six equal texts one does.
    assert ids(kept) == [1, 2, 3, 4, 5, 6, 7, 8, None]
    empty = docs.limit(0)
    assert duplicate_classes(spark, empty).collect() == [] and keep_one(spark, empty).collect() == []


def test_rare_shingles_lose_no_similar_pair(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(6):
        base = [r.choice(vocabulary) for _ in range(r.randint(6, 90))] * r.choice([1, 1, 2, 5])
        texts += [edited(r, base, r.randint(0, 6)) for _ in range(14)]
    texts = [t for t in dict.fromkeys(texts) if t]
    nodes = [near_dups.node_of(t) for t in texts]
    table = spark.createDataFrame(list(zip(nodes, texts)), "node binary, text string")
    split = table.select(F.lit(1).alias("key"), "node", F.col("node").alias("label"))
    rare = near_dups._rare_shingles(table.select("node"), table)
    found = {frozenset((bytes(p.a), bytes(p.b))) for p in near_dups._apart(split, rare).collect()}
    similar = {
        frozenset((nodes[i], nodes[j]))
        for i in range(len(texts))
        for j in range(i)
        if nodes[i] != nodes[j] and fast_similarity(texts[i], texts[j]) >= near_dups.SIMILAR
    }
    assert similar and similar <= found
    assert len(found) < len(texts) * (len(texts) - 1) // 2
