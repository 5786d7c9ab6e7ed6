import random

import numpy as np
from cases import documents, odd_rows

from pulsemill.llm.decontaminate import GAP, MATCH, MISMATCH, N, SCORE, WHOLE, align, drop_leaks, find_leaks


def brute_best(item, text):
    h = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (MATCH if a == b else MISMATCH), h[i - 1, j] + GAP, h[i, j - 1] + GAP)
    return int(h.max())


def test_alignment_against_the_full_table():
    r = random.Random(6)
    for _ in range(300):
        item = np.array([r.randint(0, 6) for _ in range(r.randint(1, 15))])
        text = np.array([r.randint(0, 6) for _ in range(r.randint(0, 30))], int)
        score, start, end = align(item, text)
        assert score == brute_best(item, text)
        assert brute_best(item, text[start:end]) == score


def table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string, mark string")


def test_exact_and_edited_items_are_found_and_others_left(spark):
    r = random.Random(7)
    items = [(k, " ".join(f"q{k}x{i}" for i in range(r.randint(12, 60))), "m") for k in range(20)]
    rows, want = [], set()
    for i in range(200):
        words = [f"w{r.randint(0, 500)}" for _ in range(r.randint(0, 200))]
        if i % 4 == 0:
            k = r.randrange(20)
            copy = items[k][1].upper().split()
            for _ in range(len(copy) // 12):
                copy[r.randrange(len(copy))] = "changed"
            at = r.randint(0, len(words))
            words[at:at] = copy
            want.add((i, k))
        rows.append((i, " ".join(words)))
    docs = documents(spark, rows)
    found = {(x["doc_id"], x["item_id"]) for x in find_leaks(spark, docs, table(spark, items)).collect()}
    assert found == want
    kept = drop_leaks(spark, docs, table(spark, items))
    assert kept.columns == docs.columns
    assert {x["doc_id"] for x in kept.collect()} == {i for i, _ in rows} - {i for i, _ in want}


def test_an_item_in_every_document_is_found_in_each(spark):
    item = " ".join(f"c{i}" for i in range(30))
    docs = documents(spark, [(i, f"start{i} {item} end{i}") for i in range(60)])
    assert find_leaks(spark, docs, table(spark, [(1, item, "m")])).count() == 60


def test_edited_copies_of_a_hot_item_are_found(spark):
    words = [f"c{i}" for i in range(30)]
    rows = [(i, f"start{i} {' '.join(words)} end{i}") for i in range(40)]
    rows.append((100, " ".join("changed" if i % 5 == 2 else w for i, w in enumerate(words))))
    found = find_leaks(spark, documents(spark, rows), table(spark, [(1, " ".join(words), "m")])).collect()
    assert {x["doc_id"] for x in found} == {i for i, _ in rows}


def test_items_of_few_words_are_found_as_a_whole(spark):
    items = table(spark, [(1, "One", "m"), (2, "two words", "m"), (3, "now three words", "m"), (4, "these are four words", "m")])
    rows = [(10, "only one."), (20, "or two (words) here"), (30, "so now three words follow"), (40, "these are four words"), (50, "words two three now")]
    found = {(x["doc_id"], x["item_id"], x["score"]) for x in find_leaks(spark, documents(spark, rows), items).collect()}
    assert found == {(10, 1, 1.0), (20, 2, 1.0), (30, 3, 1.0), (40, 4, 1.0)}


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    items = table(spark, [(None, odd_rows()[0][1], None), (1, None, None), (2, "", None), (3, "short one", None), (4, "none of these words anywhere", None)])
    found = find_leaks(spark, docs, items).collect()
    assert {(x["doc_id"], x["item_id"]) for x in found} >= {(4, None), (9, None), (None, None)}
    assert find_leaks(spark, docs.limit(0), items).collect() == [] and find_leaks(spark, docs, items.limit(0)).collect() == []
    assert drop_leaks(spark, docs, items.limit(0)).count() == len(odd_rows())


def edited(r, words):
    """A copy with words changed, left out and put in, up to a quarter of them."""
    out = list(words)
    for _ in range(r.randint(0, len(words) // 4)):
        at = r.randrange(len(out))
        out[at : at + r.randint(0, 1)] = [f"edit{r.randint(0, 9)}"] * r.randint(0, 1)
    return out


def brute_leaks(rows, items):
    """Every item aligned with every whole document; words weigh by the items that hold the n-grams around them."""
    grams = {k: [tuple(w[i : i + N]) for i in range(len(w) - N + 1)] for k, w in items}
    different = {tuple(w): k for k, w in items}.values()
    found = set()
    for k, words in items:
        held = [sum(g in grams[other] for other in different) for g in grams[k]]
        weights = [1 / max(held[max(i - N + 1, 0) : i + 1]) for i in range(len(words))]
        code = {}
        item = np.array([code.setdefault(w, len(code)) for w in words])
        for doc, text in rows:
            there = np.array([code.setdefault(w, len(code)) for w in text], int)
            best, start, end = align(item, there)
            own = sum(w for w, x in zip(weights, item, strict=True) if x in there[start:end])
            if best >= SCORE * MATCH * len(words) and own >= SCORE * sum(weights) - 1e-9:
                found.add((doc, k))
    return found


def test_seeds_find_what_aligning_all_pairs_finds(spark):
    r = random.Random(11)
    stems = [[f"s{k}x{i}" for i in range(r.randint(3, 8))] for k in range(3)]
    items = [(k, r.choice(stems) + [f"v{r.randint(0, 60)}" for _ in range(r.randint(WHOLE, 25))]) for k in range(40)]
    items += [(100 + k, list(items[k][1])) for k in range(5)]
    rows = []
    for i in range(300):
        text = [f"v{r.randint(0, 60)}" for _ in range(r.randint(0, 40))]
        if i % 3 == 0:
            text += edited(r, r.choice(items)[1])
        elif i % 3 == 1:
            text += r.choice(stems)
        rows.append((i, text + [f"v{r.randint(0, 60)}" for _ in range(r.randint(0, 20))]))
    docs = documents(spark, [(i, " ".join(text)) for i, text in rows])
    found = find_leaks(spark, docs, table(spark, [(k, " ".join(w), "m") for k, w in items])).collect()
    want = brute_leaks(rows, items)
    assert {(x["doc_id"], x["item_id"]) for x in found} == want and len(want) >= 100


def test_a_stem_that_many_items_share_is_no_leak(spark):
    stem = "which of the following is true about"
    own = [f"{stem} " + " ".join(f"own{k}x{i}" for i in range(7)) for k in range(200)]
    items = table(spark, [(k, text, "m") for k, text in enumerate(own)])
    rows = [(i, f"note {i} {stem} the weather {i}") for i in range(200)] + [(1000 + k, f"a {own[k]} z") for k in range(0, 200, 20)]
    found = {(x["doc_id"], x["item_id"]) for x in find_leaks(spark, documents(spark, rows), items).collect()}
    assert found == {(1000 + k, k) for k in range(0, 200, 20)}


def test_items_too_short_to_be_evidence_drop_nothing(spark):
    items = table(spark, [(1, "the", "m"), (2, "a b", "m"), (3, "yes it is", "m"), (4, "only this was asked", "m")])
    rows = [(1, "the cat"), (2, "a b the"), (3, "yes it is"), (4, "he said only this was asked"), (5, "only this was"), (6, "the the the")]
    docs = documents(spark, rows)
    found = sorted((x["doc_id"], x["item_id"]) for x in find_leaks(spark, docs, items).collect())
    assert found == [(1, 1), (2, 1), (2, 2), (3, 3), (4, 4), (6, 1)]
    assert {x["doc_id"] for x in drop_leaks(spark, docs, items).collect()} == {1, 2, 3, 5, 6}
