"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are lower-cased (ASCII) and freed of punctuation, then one to three neighbouring words
and pairs with one word between them are hashed to ``2 ** BITS`` places; a place counts once
per text. The learner keeps a gradient sum and a squared-gradient sum per place, which gives
each its own rate, and an L1 penalty that leaves most weights at exactly zero, so the result
is a short list of (place, weight) that travels with the tasks. FTRL learns row after row; its
sample is bounded, so one task does that, and scoring uses all.

Defined results: a null or empty text scores by the bias alone; a document labelled twice is
toxic if any label says so; null labels and ids do not train; labels of only one kind or none
give the score of that share; repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.frames import text_column
from pulsemill.llm.text import mix, slices, split_words

BITS = 20
# Training reads at most this many labelled rows, the smallest by hash of their id.
SAMPLE_ROWS = 20_000
EPOCHS = 8
FOLDS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 0.1

_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[np.frombuffer(b".,;:!?\"'()[]{}<>*_-#", np.uint8)] = True


@dataclass(frozen=True)
class Weights:
    """A sparse linear model: the places with a weight, in order, and the bias."""

    places: np.ndarray
    values: np.ndarray
    bias: float


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The text of each feature and its place, for all features of all texts."""
    words = split_words(column)
    h = words.hashes(lower=True, skip=_PUNCTUATION[words.data] if len(words.data) else None)
    owner = words.owner
    rows, keys = [owner], [mix(h + np.uint64(1))]
    for kind, steps in enumerate(((0, 1), (0, 1, 2), (0, 2)), start=2):
        reach = steps[-1]
        n = max(len(h) - reach, 0)
        key = np.full(n, kind, np.uint64)
        for step in steps:
            key = mix(key + h[step : step + n])
        inside = owner[:n] == owner[reach : reach + n]
        rows.append(owner[:n][inside])
        keys.append(key[inside])
    return np.concatenate(rows), (np.concatenate(keys) >> np.uint64(64 - BITS)).astype(np.int64)


def _once_per_text(rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique((rows << BITS) | places)
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def learn(texts: list[np.ndarray], labels: list[int], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """FTRL-proximal over texts given as arrays of places; returns places, weights and the bias."""
    n = (1 << BITS) + 1
    z, squares = np.zeros(n), np.zeros(n)
    bias_place = np.array([n - 1])

    def weigh(at: np.ndarray) -> np.ndarray:
        # The penalties leave out the bias.
        l1 = np.where(at == n - 1, 0.0, L1)
        w = -(z[at] - np.sign(z[at]) * l1) / ((BETA + np.sqrt(squares[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(epochs):
        for places, label in zip(texts, labels, strict=True):
            at = np.concatenate([places, bias_place])
            w = weigh(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - label
            rate = (np.sqrt(squares[at] + g * g) - np.sqrt(squares[at])) / ALPHA
            z[at] += g - rate * w
            squares[at] += g * g
    touched = np.flatnonzero(z[:-1])
    w = weigh(touched)
    return touched[w != 0], w[w != 0], float(weigh(bias_place)[0])


def held_out(doc_id: Column) -> Column:
    """The rows that never train: crc32 of the id as text, modulo 5, is 0. A null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Weights:
    """Learn from at most ``sample_rows`` labelled rows that are not held out."""
    chosen = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .withColumn("order", F.xxhash64("doc_id"))
        .orderBy("order", "doc_id")
        .limit(sample_rows)
    )
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("order", "text", "toxic")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[np.ndarray] = []
        marks: list[int] = []
        for batch in batches:
            for a, z in slices(batch["text"]):
                part = batch.slice(a, z - a)
                rows, places = _once_per_text(*features(part["text"]))
                bounds = np.searchsorted(rows, np.arange(len(part) + 1))
                texts += [places[bounds[i] : bounds[i + 1]].astype(np.int32) for i in range(len(part))]
                marks += part["toxic"].to_pylist()
        if marks:
            places, values, bias = learn(texts, marks)
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(values)], ["place", "weight"])
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([bias])], ["place", "weight"])

    # The sample is learnt in one order, so the weights are the same on every run.
    ordered = sample.repartition(1).sortWithinPartitions("order", F.xxhash64("text"))
    learnt = ordered.mapInArrow(train, "place bigint, weight double").collect()
    rows = sorted((r["place"], r["weight"]) for r in learnt)
    bias = rows.pop(0)[1] if rows else 0.0
    return Weights(np.array([p for p, _ in rows], np.int64), np.array([w for _, w in rows], float), bias)


def score_column(weights: Weights):
    """A column function: the chance that a text is toxic."""

    def dense() -> np.ndarray:
        out = np.zeros(1 << BITS)
        out[weights.places] = weights.values
        return out

    def score(column: pa.Array, table: np.ndarray) -> pa.Array:
        rows, places = features(column)
        heavy = table[places] != 0
        rows, places = _once_per_text(rows[heavy], places[heavy])
        total = np.bincount(rows, table[places], len(column)) + weights.bias
        return pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))

    return text_column(score, "double", dense)


def score_toxicity(documents: DataFrame, weights: Weights) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(weights)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
