import random

import public_tokenizers
import pytest
from cases import documents, odd_rows

from pulsemill.llm.token_counts import MODEL, count_tokens, load_encoder, token_counts


@pytest.fixture(scope="module")
def encoder():
    return load_encoder(public_tokenizers.path(MODEL))


def texts():
    r = random.Random(3)
    words = ["the", "Straße", "naïve", "東京", "𝒳", "1234567", "x" * 30, "...", "\n", "  ", "\t", "a" * 3, "<s>", "</s>", "ﬁ", " ", "é"]
    for _ in range(25):
        yield r.choice([" ", "", "  "]).join(r.choice(words) for _ in range(600))
    yield "a" * 3000
    yield " " * 3000
    yield "ab " * 1000


def test_chunks_count_as_the_whole_text(encoder):
    for text in texts():
        assert count_tokens(encoder, text, chunk=200, overlap=16) == len(encoder.model.encode(text)), text[:80]


def test_rows(spark, encoder):
    rows = odd_rows()
    got = sorted(map(tuple, token_counts(documents(spark, rows), public_tokenizers.path(MODEL)).collect()), key=str)
    want = []
    for r in rows:
        n = len(encoder.model.encode(r[1] or ""))
        want.append((r[0], len((r[1] or "").encode()), n, n > 4096))
    assert got == sorted(want, key=str)
    assert token_counts(documents(spark, rows).limit(0), public_tokenizers.path(MODEL)).collect() == []
