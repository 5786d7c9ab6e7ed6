"""Quality rules: a linear-chain conditional random field labels lines as content or boilerplate.

Every line with a word is described by a few binned features. The field's node weights come
from a logistic regression, its edge weights from counted neighbours (piecewise training of
the two kinds of factor). Viterbi decoding labels the lines of a text together; the share of
words in content lines decides whether the text stays.

Defined results: a null or empty text has no words, fails the base rule and is not kept;
repeated rows get equal results; extra columns pass through ``keep_quality`` untouched;
without usable labels the field falls back on weights of zero and every line is content.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.llm.frames import map_texts, struct_array, text_column
from pulsemill.llm.text import Words, mix, split_words, windows

SYMBOLS = b"#*$%&|<>"
# The classifier is fitted on at most this many labelled rows, the smallest by hash of their id.
SAMPLE_ROWS = 20_000
CONTENT_SHARE = 0.5

# Common function words of English, German, French and Spanish.
FUNCTION_WORDS = """
the of and to in a is that for it was on are as with this be by an at from or not have which
der die das und ist in den von zu mit sich auf für nicht ein eine als auch im dem es an werden aus
le la les de des du et un une est en que qui dans pour sur au avec pas il ne par plus se ce
el los las y del una es por con para como su al lo no más pero sus
""".split()

# Upper bounds of the bins of each feature; a value above the last bound falls in one more bin.
BINS: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (0.0, 0.1, 0.5),
    "upper_share": (0.3, 0.7),
    "exclamations_per_word": (0.0, 0.2),
    "function_share": (0.0, 0.1, 0.25),
    "words": (2, 7, 20),
    "digit_share": (0.0, 0.2),
    "ends_sentence": (0.0,),
    "repeated_line": (0.0,),
}
_WIDTHS = [len(b) + 1 for b in BINS.values()]
_OFFSETS = np.concatenate([[0], np.cumsum(_WIDTHS)[:-1]])
N_WEIGHTS = int(sum(_WIDTHS))


@dataclass(frozen=True)
class LineField:
    """Weights of the field, for content against boilerplate."""

    bias: float
    node: tuple[float, ...]
    stay_content: float
    stay_boilerplate: float


NEUTRAL = LineField(1.0, (0.0,) * N_WEIGHTS, 0.0, 0.0)


def _per_run(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[ends] - total[starts]


def _byte_class(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[np.frombuffer(values, np.uint8)] = True
    return out


_PUNCTUATION = _byte_class(b".,;:!?\"'()[]{}-" + SYMBOLS)


def _function_hashes() -> np.ndarray:
    words = split_words(pa.array(FUNCTION_WORDS))
    return np.unique(words.hashes())


def lines_of(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line that has a word, and the text it is in. Lines end at a line feed or with the text."""
    cuts = np.flatnonzero(words.data == 10)
    starts = np.union1d(words.offsets[:-1], cuts + 1)
    starts = starts[starts < len(words.data)] if len(words.data) else starts[:0]
    # A line ends at the next line feed or where the next text begins.
    feed = np.append(cuts, len(words.data))[np.searchsorted(cuts, starts)]
    owner = np.searchsorted(words.offsets, starts, side="right") - 1
    ends = np.minimum(feed, words.offsets[owner + 1])
    some = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    return starts[some], ends[some], owner[some]


def _repeated(words: Words, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks lines equal to an earlier line of their text; compared byte by byte."""
    out, seen, last = np.zeros(len(starts), bool), set(), -1
    data = words.data.tobytes()
    for i, (a, z, o) in enumerate(zip(starts.tolist(), ends.tolist(), owner.tolist(), strict=True)):
        if o != last:
            seen, last = set(), o
        line = data[a:z]
        if line in seen:
            out[i] = True
        seen.add(line)
    return out


def line_features(words: Words, function_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins of every line's features (lines x features), its words, its text, and whether it repeats."""
    starts, ends, owner = lines_of(words)
    first, after = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    n_words = (after - first).astype(float)
    data = words.data
    upper, lower = (data >= 65) & (data <= 90), (data >= 97) & (data <= 122)
    n_upper, n_lower = _per_run(upper, starts, ends), _per_run(lower, starts, ends)
    digits = _per_run((data >= 48) & (data <= 57), starts, ends)
    function = np.isin(words.hashes(lower=True, skip=_PUNCTUATION[data] if len(data) else None), function_hashes)
    repeated = _repeated(words, starts, ends, owner)
    last = words.ends[after - 1] - 1 if len(starts) else np.empty(0, np.int64)
    values = {
        "symbols_per_word": _per_run(_byte_class(SYMBOLS)[data], starts, ends) / np.maximum(n_words, 1),
        "upper_share": n_upper / np.maximum(n_upper + n_lower, 1),
        "exclamations_per_word": _per_run(data == 33, starts, ends) / np.maximum(n_words, 1),
        "function_share": _per_run(function, first, after) / np.maximum(n_words, 1),
        "words": n_words,
        "digit_share": digits / np.maximum(digits + n_upper + n_lower, 1),
        "ends_sentence": np.isin(data[last], np.frombuffer(b".!?\"", np.uint8)).astype(float),
        "repeated_line": repeated.astype(float),
    }
    bins = np.stack([np.searchsorted(BINS[k], v, side="left") for k, v in values.items()], 1)
    return bins, n_words.astype(np.int64), owner, repeated


def node_scores(bins: np.ndarray, field: LineField) -> np.ndarray:
    weights = np.asarray(field.node)
    return field.bias + weights[bins + _OFFSETS].sum(1)


def viterbi(scores: list[float], stay_content: float, stay_boilerplate: float) -> list[bool]:
    """The best labelling of one text's lines; True is content. A tie goes to content."""
    content, boilerplate, back = 0.0, 0.0, []
    for i, score in enumerate(scores):
        if i:
            to_content = content + stay_content >= boilerplate
            to_boilerplate = content > boilerplate + stay_boilerplate
            back.append((to_content, to_boilerplate))
            content, boilerplate = (
                content + stay_content if to_content else boilerplate,
                content if to_boilerplate else boilerplate + stay_boilerplate,
            )
        content += score
    label, labels = content >= boilerplate, []
    for step in reversed(range(len(scores))):
        labels.append(label)
        if step:
            label = back[step - 1][0 if label else 1]
    return labels[::-1]


def content_words(bins: np.ndarray, n_words: np.ndarray, owner: np.ndarray, rows: int, field: LineField) -> np.ndarray:
    """Words in lines labelled content, for each text."""
    scores, out = node_scores(bins, field), np.zeros(rows, np.int64)
    bounds = np.searchsorted(owner, np.arange(rows + 1))
    plain = scores.tolist()
    for row, (a, z) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if z > a:
            labels = viterbi(plain[a:z], field.stay_content, field.stay_boilerplate)
            out[row] = int(n_words[a:z][labels].sum())
    return out


def repeat_words(words: Words, n: int = 5) -> np.ndarray:
    """For each text, the words inside windows of n words that occur twice or more in it."""
    owner, hashes = words.owner, words.hashes()
    keys, at = windows(hashes, words, n)
    keys = mix(keys + mix(owner[at].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(hashes) + n + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + n, -1)
    covered = np.cumsum(change)[: len(hashes)] > 0
    return np.bincount(owner[covered], minlength=len(words.first) - 1)


MEASURES = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,"
    "n_repeat_words:bigint,content_words:bigint,base_failed:boolean,kept:boolean>"
)


def measures(field: LineField, content_share: float = CONTENT_SHARE):
    """A column function: base counts, words in content lines and the verdict for each text."""

    def measure(column: pa.Array, function_hashes: np.ndarray) -> pa.Array:
        words, rows = split_words(column), len(column)
        bins, line_words, owner, repeated = line_features(words, function_hashes)
        counts = words.counts.astype(np.int64)
        heads = (words.data & 0xC0) != 0x80
        chars = np.bincount(words.owner, _per_run(heads, words.starts, words.ends), rows).astype(np.int64)
        symbols = _per_run(_byte_class(SYMBOLS)[words.data], words.offsets[:-1], words.offsets[1:])
        repeats = repeat_words(words).astype(np.int64)
        content = content_words(bins, line_words, owner, rows, field)
        failed = (counts < 10) | (100 * repeats > 20 * counts)
        return struct_array(
            n_words=pa.array(counts),
            word_chars=pa.array(chars),
            n_symbols=pa.array(symbols.astype(np.int64)),
            n_dup_lines=pa.array(np.bincount(owner[repeated], minlength=rows).astype(np.int64)),
            n_repeat_words=pa.array(repeats),
            content_words=pa.array(content),
            base_failed=pa.array(failed),
            kept=pa.array(~failed & (content >= content_share * counts)),
        )

    return text_column(measure, MEASURES, _function_hashes)


# Fitting

_BIN_COLUMNS = list(BINS)


def _line_counts(sample: DataFrame, field: LineField | None) -> list:
    """Counts of (features, label) and of neighbouring labels over the sample's lines, map-side first.

    Without a field every line has its text's label; with one, lines of bad texts that the
    field finds to be content are relabelled.
    """

    def tally(batch: pa.RecordBatch, function_hashes: np.ndarray) -> pa.RecordBatch:
        words = split_words(batch["text"])
        bins, _, owner, _ = line_features(words, function_hashes)
        label = np.asarray(batch["quality"], np.int64)[owner]
        if field is not None:
            label = np.where(label == 1, 1, (node_scores(bins, field) >= 0).astype(np.int64))
        follows = np.full(len(owner), -1, np.int64)
        follows[1:] = np.where(owner[1:] == owner[:-1], label[:-1], -1)
        key = np.column_stack([label, follows, bins]) if len(owner) else np.empty((0, 2 + len(BINS)), np.int64)
        found, n = np.unique(key, axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(found[:, k])) for k in range(found.shape[1])] + [pa.array(n.astype(np.int64))],
            ["label", "follows", *_BIN_COLUMNS, "n"],
        )

    names = ["label", "follows", *_BIN_COLUMNS]
    schema = ", ".join(f"{c} bigint" for c in [*names, "n"])
    # One row for each combination of bins at most, however large the sample is.
    return map_texts(sample, tally, schema, prepare=_function_hashes).groupBy(*names).agg(F.sum("n").alias("n")).collect()


def _logistic(bins: np.ndarray, label: np.ndarray, n: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Weights (bias first) by gradient ascent with an L2 penalty; the two labels weigh the same."""
    x = np.zeros((len(n), N_WEIGHTS + 1))
    x[:, 0] = 1
    for k in range(bins.shape[1]):
        x[np.arange(len(n)), 1 + _OFFSETS[k] + bins[:, k]] = 1
    share = np.array([n[label == v].sum() for v in (0, 1)], float)
    weight = n / np.maximum(share[label], 1) / 2
    w = np.zeros(N_WEIGHTS + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ w))
        w += 2.0 * (x.T @ (weight * (label - p)) - 1e-4 * w)
    return w


def fit_field(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LineField:
    """Fit the field on at most ``sample_rows`` labelled texts (``doc_id``, ``quality`` 0 or 1)."""
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("bigint").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "quality")
    weights, stay, rows = None, (0.0, 0.0), []
    for _ in range(2):
        field = None if weights is None else LineField(weights[0], tuple(weights[1:]), 0.0, 0.0)
        rows = _line_counts(sample, field)
        label = np.array([r["label"] for r in rows], np.int64)
        if len(set(label.tolist())) < 2:
            break
        n = np.array([r["n"] for r in rows], float)
        bins = np.array([[r[c] for c in _BIN_COLUMNS] for r in rows], np.int64)
        weights = [float(w) for w in _logistic(bins, label, n)]
    if weights is None:
        return NEUTRAL
    pairs = {(a, b): 1.0 for a in (0, 1) for b in (0, 1)}
    for r in rows:
        if r["follows"] >= 0:
            pairs[r["follows"], r["label"]] += r["n"]
    stay = [math.log(pairs[v, v] / pairs[v, 1 - v]) for v in (1, 0)]
    return LineField(weights[0], tuple(weights[1:]), stay[0], stay[1])


def line_quality(documents: DataFrame, field: LineField) -> DataFrame:
    """One row per document: doc_id, base counts, words in content lines, base_failed, kept."""
    return documents.select("doc_id", measures(field)("text").alias("m")).select("doc_id", "m.*")


def keep_quality(documents: DataFrame, field: LineField) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    return documents.where(measures(field)("text")["kept"])


def fitted_field(spark: SparkSession, sf_dir: str) -> LineField:
    return fit_field(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
