"""Token counts of a public tokenizer; huge texts are encoded in overlapping chunks.

A text above ``CHUNK`` characters is cut in chunks that overlap. Both chunks at a seam are
encoded with offsets, and are spliced where both begin a token and the boundary is proven
stable: no piece of the vocabulary contains the two characters that meet there, so no merge
can ever cross it, whatever stands around. Where an overlap has no such place it is widened,
up to the end of the text.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows get equal
results. Memory is bounded by one chunk's encoding besides the text itself, unless a text has
no stable boundary at all: then it is encoded whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.frames import struct_array, text_column
from pulsemill.llm.text import raw_bytes

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK = 1 << 16
OVERLAP = 256
_SPACE_MARK = "▁"


@dataclass
class Encoder:
    """The tokenizer, and the pairs of characters that stand side by side in some piece."""

    model: Any
    pairs: set[tuple[str, str]]


def load_encoder(path: str) -> Encoder:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pairs: set[tuple[str, str]] = set()
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)):
            piece = model.id_to_piece(i)
            pairs.update(zip(piece, piece[1:], strict=False))
    return Encoder(model, pairs)


def stable(encoder: Encoder, text: str, at: int) -> bool:
    """Whether no merge can cross the place before character ``at``."""
    a, b = (_SPACE_MARK if c == " " else c for c in text[at - 1 : at + 1])
    return (a, b) not in encoder.pairs


def token_starts(encoder: Encoder, text: str, a: int, z: int) -> np.ndarray:
    """Where the tokens of text[a:z] begin, as places of the whole text; one entry per token."""
    part = text[a:z]
    pieces = encoder.model.encode(part, return_type="proto").pieces
    begins = np.fromiter((p.begin for p in pieces), np.int64, len(pieces))
    # The library counts bytes; the character of a byte is the number of first bytes up to it.
    heads = (np.frombuffer(part.encode(), np.uint8) & 0xC0) != 0x80
    return a + np.concatenate([[0], np.cumsum(heads)])[begins]


def count_tokens(encoder: Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of one text, chunk by chunk where it is longer than ``chunk``."""
    n = len(text)
    if n <= chunk:
        return len(encoder.model.encode(text))
    total, cut, start, seam = 0, 0, 0, chunk
    while True:
        width = overlap
        while True:
            # The chunk at hand runs on over the seam, the next one starts before it.
            end = min(seam + width, n)
            left = token_starts(encoder, text, start, end)
            if end == n:
                return total + int((left >= cut).sum())
            before = max(seam - width, 0)
            right = np.unique(token_starts(encoder, text, before, min(end + width, n)))
            both = np.intersect1d(np.unique(left), right)
            both = both[(both >= seam) & (both > cut)]
            splice = next((p for p in both.tolist() if stable(encoder, text, p)), None)
            if splice is not None:
                break
            width *= 2
        total += int(((left >= cut) & (left < splice)).sum())
        cut, start, seam = splice, max(splice - overlap, 0), splice + chunk
        # A start that cuts a token open must lie before a stable place at or before the cut: the cut itself is one.


def token_counts(documents: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""

    def count(column: pa.Array, encoder: Encoder) -> pa.Array:
        sizes = np.diff(raw_bytes(column)[1])
        texts = [x or "" for x in column.to_pylist()]
        short = [len(x) <= CHUNK for x in texts]
        whole = iter(encoder.model.encode([x for x, s in zip(texts, short, strict=True) if s], num_threads=1))
        n = [len(next(whole)) if s else count_tokens(encoder, x) for x, s in zip(texts, short, strict=True)]
        return struct_array(n_bytes=pa.array(sizes.astype(np.int64)), n_tokens=pa.array(n, pa.int64()))

    counts = text_column(count, "struct<n_bytes:bigint,n_tokens:bigint>", lambda: load_encoder(model_path))
    counted = documents.select("doc_id", counts("text").alias("m")).select("doc_id", "m.*")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
