import hashlib
import random
import re

from cases import documents, odd_rows

from pulsemill.llm.repeats import remove_repeats


def brute(rows, window=13):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    result = remove_repeats(spark, documents(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    return sorted(map(tuple, result.collect()), key=str)


def test_random_texts_with_shared_passages(spark):
    r = random.Random(5)
    passages = [[f"p{k}w{i}" for i in range(r.randint(10, 60))] for k in range(12)] + [["same"] * 40, ["a", "b"] * 20]
    rows = []
    for i in range(150):
        words = []
        for _ in range(r.randint(0, 6)):
            passage = r.choice(passages)
            a = r.randint(0, 8)
            words += passage[a : r.randint(a + 1, len(passage))] if r.random() < 0.5 else [f"w{r.randint(0, 400)}" for _ in range(20)]
        rows.append((i, r.choice([" ", "\n", " \t "]).join(words)))
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_rows()]
    assert got(spark, rows) == brute(rows)
    assert remove_repeats(spark, documents(spark, rows).limit(0)).collect() == []


def test_against_sql(spark):
    import __spark_entry__ as e
    from check_queries import compare, connect

    for sf_dir in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        got = e.queries()["op3_repeated_spans"](spark, sf_dir).toPandas()
        assert compare(got, connect(sf_dir).sql(e.oracle_sql()["op3_repeated_spans"]).df()) == "ok"
