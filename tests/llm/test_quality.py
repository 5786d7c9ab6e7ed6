import itertools
import random
import re
from collections import Counter

import pytest
from cases import all_ids, documents, ids, odd_rows

from pulsemill.llm.quality import NEUTRAL, fit_field, keep_quality, line_quality, viterbi


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered), failed


def test_base_counts(spark):
    r = random.Random(9)
    parts = ["a", "bé", "☃", "#", "x|y", "\n", "\n\n", " ", "\t", "\r\n", "one two three four five six", "line of words here\n", "\x0b", " "]
    rows = [(i, "".join(r.choice(parts) + r.choice(["", " "]) for _ in range(r.randint(0, 60)))) for i in range(300)]
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {x["doc_id"]: tuple(x[c] for c in columns) for x in line_quality(documents(spark, rows), NEUTRAL).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_viterbi_against_all_labellings():
    r = random.Random(10)
    for _ in range(200):
        scores = [r.uniform(-2, 2) for _ in range(r.randint(1, 8))]
        stay = r.uniform(-1, 2), r.uniform(-1, 2)

        def value(labels, scores=scores, stay=stay):
            total = sum(s for s, keep in zip(scores, labels, strict=True) if keep)
            return total + sum(stay[0] if a else stay[1] for a, b in itertools.pairwise(labels) if a == b)

        best = max(value(x) for x in itertools.product((True, False), repeat=len(scores)))
        assert value(viterbi(scores, *stay)) == pytest.approx(best)


def test_labels_agree_with_the_verdict(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = line_quality(docs, fit_field(docs, labels)).join(labels, "doc_id").where("quality is not null and not base_failed").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert sum(good) / len(good) >= 0.95


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    labels = spark.createDataFrame([(4, 1), (None, 0), (7, 0), (5, None)], "doc_id bigint, quality int")
    for field in (fit_field(docs, labels), fit_field(docs, labels.limit(0))):
        assert ids(line_quality(docs, field)) == all_ids()
        kept = keep_quality(docs, field)
        assert kept.columns == docs.columns and {1, 2, 3, 8}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert line_quality(docs.limit(0), NEUTRAL).collect() == []
