"""Ranked lexical search: Block-Max MaxScore over document shards, then a merge of the shards' heaps.

``build_index`` reads every text once. A task cuts its documents into shards of bounded size and
writes, for each term of the vocabulary, posting lists in compressed blocks, each with the largest
term count and the smallest document length in it: with the corpus statistics these two bound the
score of every posting in the block. Corpus statistics (documents with a term, all terms, documents
holding a term) are sums over the shards.

``search`` answers all queries on every shard. The lists of a query are taken in falling order of
their bounds in the shard. While the bounds still to come could lift a new document into the heap,
lists are essential and read whole; the rest are non-essential and only looked up for documents
found so far. Before such a lookup the bound of the block that would hold the document is added to
its score and to the bounds that remain; a document that stays below the heap's last score is
rejected and its block, if no other document needs it, never unpacked. Heaps go on from shard to
shard inside a task; the heaps of all tasks are merged by a top-k window.

A score is the sum over a query's different terms of w * ((10**9 * tf) div (1000 * tf + 8 * m)), w =
floor(1000 * ln((2N + 2) / (2df + 1))), m = 10 + (90 * n * N) div L, in 64-bit integers.

Queries are answered in blocks of bounded size, each a pass over the index; the index holds the
terms of the queries it is built for (document lengths and statistics cover all terms). Terms are
compared by 64-bit hashes of their bytes.

Defined results: null and empty texts have no terms, are counted nowhere and never found; a query
without terms finds nothing; repeated terms of a query count once; repeated rows of documents or
queries are answered one by one; a query with a null id is answered like any other. Equal scores
rank by document id, null last.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsemill.llm.frames import staged
from pulsemill.llm.text import slices, split_words

TOP = 10
# A shard is closed when it holds this much text; one longer text is a shard of its own.
SHARD_BYTES = 16 << 20
POSTINGS_PER_BLOCK = 128
# Queries are answered together up to this many terms (of all queries, repeats counted).
TERMS_PER_PASS = 1 << 20

# Terms are ASCII letters and digits and everything outside ASCII; other bytes part them.
_PARTS = np.ones(256, bool)
_PARTS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

_INDEX = """n_docs long, n_terms long, ids array<long>, lengths array<long>, terms array<long>, holders array<long>,
  first_block array<long>, last_doc array<long>, most_tf array<long>, least_length array<long>, blocks array<binary>"""


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each term of some texts, A-Z in lower case, and the number of terms of each text."""
    words = split_words(column, _PARTS)
    return words.hashes(lower=True), words.counts


def _pack(docs: np.ndarray, tfs: np.ndarray) -> bytes:
    """A block: gaps between documents and counts, each in as few bytes as the largest needs."""
    gaps = np.diff(docs, prepend=0)
    kinds = [1 if x.max() < 1 << 8 else 2 if x.max() < 1 << 16 else 4 if x.max() < 1 << 32 else 8 for x in (gaps, tfs)]
    return bytes(kinds) + gaps.astype(f"<u{kinds[0]}").tobytes() + tfs.astype(f"<u{kinds[1]}").tobytes()


def _unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    a, b = block[0], block[1]
    n = (len(block) - 2) // (a + b)
    gaps = np.frombuffer(block, f"<u{a}", n, 2)
    return np.cumsum(gaps, dtype=np.int64), np.frombuffer(block, f"<u{b}", n, 2 + a * n).astype(np.int64)


def _shard(ids: list[pa.Array], lengths: list[np.ndarray], docs: np.ndarray, terms: np.ndarray) -> pa.RecordBatch:
    """One row of the index. ``docs`` and ``terms`` are the places of vocabulary terms, by document."""
    length = np.concatenate(lengths)
    order = np.lexsort((docs, terms))
    docs, terms = docs[order], terms[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (terms[1:] != terms[:-1])
    at = np.flatnonzero(new)
    tfs, docs, terms = np.diff(at, append=len(new)), docs[at], terms[at]
    starts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.empty(0, np.int64)
    ends = np.r_[starts[1:], len(terms)] if len(starts) else starts
    first, last, most, least, blocks = [0], [], [], [], []
    for a, z in zip(starts.tolist(), ends.tolist(), strict=True):
        for i in range(a, z, POSTINGS_PER_BLOCK):
            j = min(z, i + POSTINGS_PER_BLOCK)
            last.append(int(docs[j - 1]))
            most.append(int(tfs[i:j].max()))
            least.append(int(length[docs[i:j]].min()))
            blocks.append(_pack(docs[i:j], tfs[i:j]))
        first.append(len(blocks))
    row = [
        int((length > 0).sum()), int(length.sum()), pa.concat_arrays(ids), length, terms[starts].view(np.int64), ends - starts,
        first, last, most, least, blocks,
    ]
    kinds = [pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 8, pa.list_(pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds, strict=True)], _NAMES)


_NAMES = [part.split()[0] for part in _INDEX.split(",")]


def build_index(spark: SparkSession, documents: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """The shards of ``documents`` (doc_id, text), staged: lists for the sorted term hashes of ``vocabulary``."""
    sent = spark.sparkContext.broadcast(vocabulary)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        likely = np.zeros(1 << 16, bool)  # most terms are turned away by 16 bits
        likely[(known >> np.uint64(48)).astype(np.int64)] = True
        ids, lengths, docs, terms, held, n = [], [], [], [], 0, 0
        for batch in batches:
            for a, z in slices(batch["text"]):
                texts = batch["text"].slice(a, z - a)
                hashes, counts = _terms(texts)
                owner = np.repeat(np.arange(n, n + len(counts)), counts)
                keep = likely[(hashes >> np.uint64(48)).astype(np.int64)]
                hashes, owner = hashes[keep], owner[keep]
                if len(known):
                    keep = known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes
                    hashes, owner = hashes[keep], owner[keep]
                ids.append(batch["doc_id"].slice(a, z - a).cast(pa.int64()))
                lengths.append(counts)
                docs.append(owner)
                terms.append(hashes)
                held, n = held + texts.nbytes, n + len(counts)
                if held >= SHARD_BYTES:
                    yield _shard(ids, lengths, np.concatenate(docs), np.concatenate(terms))
                    ids, lengths, docs, terms, held, n = [], [], [], [], 0, 0
        if ids:
            yield _shard(ids, lengths, np.concatenate(docs), np.concatenate(terms))

    return staged(spark, documents.select("doc_id", "text").mapInArrow(shards, _INDEX), "search-index")


def query_terms(queries: DataFrame) -> DataFrame:
    """(place, query, terms): a number for each row, its id, and the hashes of its different terms; none without terms."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = _terms(batch["text"])
            found = [np.unique(x).view(np.int64) for x in np.split(hashes, np.cumsum(counts)[:-1])] if len(counts) else []
            lists = pa.array(found, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch["place"], batch["query"].cast(pa.int64()), lists], ["place", "query", "terms"])

    rows = queries.select(F.monotonically_increasing_id().alias("place"), F.col("item_id").alias("query"), "text")
    return rows.mapInArrow(terms, "place long, query long, terms array<long>").where("size(terms) > 0")


def _passes(spark: SparkSession, queries: DataFrame) -> Iterator[DataFrame]:
    """The queries in blocks of about ``TERMS_PER_PASS`` terms: whole ranges of places."""
    rows = staged(spark, query_terms(queries), "search-queries")
    total = rows.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    n = -(-total // TERMS_PER_PASS)
    if n == 1:
        yield rows
    elif n:
        part = F.pmod(F.xxhash64("place"), F.lit(n))
        for k in range(n):
            yield rows.where(part == k)


@dataclass
class _Query:
    """A query's terms with their weights, and the heap of its best documents so far."""

    terms: list[tuple[int, int]] = field(default_factory=list)
    heap: list[tuple[int, float, int, int | None]] = field(default_factory=list)

    def floor(self, top: int) -> int:
        """What a document must reach."""
        return self.heap[0][0] if len(self.heap) == top else 1

    def offer(self, score: int, doc_id: int | None, top: int) -> None:
        # The worst of the heap comes first: lowest score, then highest id, null highest.
        entry = (score, -float("inf"), 0, None) if doc_id is None else (score, 0.0, -doc_id, doc_id)
        if len(self.heap) < top:
            heapq.heappush(self.heap, entry)
        elif entry[:3] > self.heap[0][:3]:
            heapq.heapreplace(self.heap, entry)


class _Shard:
    """A row of the index with the corpus statistics: bounds of lists and blocks, and blocks unpacked when needed."""

    def __init__(self, batch: pa.RecordBatch, i: int, n_all: int, terms_all: int) -> None:
        def numbers(name: str) -> np.ndarray:
            return np.asarray(batch[name][i].values, np.int64)

        self.ids = batch["ids"][i].values
        self.length, self.first, self.last = numbers("lengths"), numbers("first_block"), numbers("last_doc")
        self.blocks = batch["blocks"][i].values
        self.norm = self._norms(self.length, n_all, terms_all)
        self.bound = self._part(numbers("most_tf"), self._norms(numbers("least_length"), n_all, terms_all))
        self.lists = {t: k for k, t in enumerate(numbers("terms").tolist())}
        starts = self.first[:-1]
        self.list_bound = np.maximum.reduceat(self.bound, starts) if len(starts) else starts
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @staticmethod
    def _norms(length: np.ndarray, n_all: int, terms_all: int) -> np.ndarray:
        if len(length) and int(length.max()) * n_all * 90 >= 1 << 63:
            return np.array([10 + 90 * x * n_all // terms_all for x in length.tolist()], np.int64)
        return 10 + (90 * length * n_all) // max(terms_all, 1)

    @staticmethod
    def _part(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """The score of a term before its weight: rises with its count, falls with the document's length."""
        return (1_000_000_000 * tf) // (1000 * tf + 8 * norm)

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and parts of a block."""
        if b not in self.unpacked:
            docs, tfs = _unpack(self.blocks[b].as_py())
            self.unpacked[b] = docs, self._part(tfs, self.norm[docs])
        return self.unpacked[b]

    def search(self, query: _Query, top: int) -> None:
        lists = [(weight * int(self.list_bound[k]), weight, k) for t, weight in query.terms if (k := self.lists.get(t)) is not None]
        lists.sort(reverse=True)
        rest = sum(x[0] for x in lists)
        floor = query.floor(top)
        if rest < floor:
            return
        score = np.zeros(len(self.length), np.int64)
        place = 0
        # Essential lists: a document in none of them cannot reach the floor.
        while place < len(lists) and rest >= floor:
            bound, weight, k = lists[place]
            for b in range(self.first[k], self.first[k + 1]):
                docs, parts = self.block(b)
                score[docs] += weight * parts
            place, rest = place + 1, rest - bound
            # Scores only rise, so the top-th of the scores so far is a floor too.
            if place < len(lists) and len(score) > top:
                floor = max(floor, int(np.partition(score, -top)[-top]))
        found = np.flatnonzero(score)
        for bound, weight, k in lists[place:]:
            found = found[score[found] + rest >= floor]
            if not len(found):
                return
            rest -= bound
            a, z = int(self.first[k]), int(self.first[k + 1])
            block = a + np.searchsorted(self.last[a:z], found)
            inside = block < z
            reach = score[found]
            reach[inside] += weight * self.bound[block[inside]]
            live = reach + rest >= floor
            found, block = found[live], block[live]
            asked = block < z
            wanted, owner = found[asked], block[asked]
            for b in np.unique(owner).tolist():
                docs, parts = self.block(b)
                here = wanted[owner == b]
                at = np.minimum(np.searchsorted(docs, here), len(docs) - 1)
                hit = docs[at] == here
                score[here[hit]] += weight * parts[at[hit]]
        found = found[score[found] >= floor]
        if len(found) > top:
            best = score[found]
            found = found[best >= np.partition(best, -top)[-top]]
        for doc, reached in zip(found.tolist(), score[found].tolist(), strict=True):
            query.offer(reached, self.ids[doc].as_py(), top)


def search(spark: SparkSession, documents: DataFrame, queries: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` best documents (doc_id, text) of each row of ``queries`` (item_id, text): item_id, rank, doc_id, score.

    A row's results share a ``place``, a number of the row in this run.
    """
    result = None
    for block in _passes(spark, queries):
        heaps = _search_pass(spark, documents, block, top)
        result = heaps if result is None else result.unionByName(heaps)
    if result is None:
        return spark.createDataFrame([], "place long, item_id long, rank int, doc_id long, score long")
    # The heaps of all tasks are cut to ``top`` rows a query before they are shuffled and again after.
    best = Window.partitionBy("place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = result.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("place", F.col("query").alias("item_id"), "rank", "doc_id", "score")


def _search_pass(spark: SparkSession, documents: DataFrame, block: DataFrame, top: int) -> DataFrame:
    # A pass holds TERMS_PER_PASS terms or one row of queries more: 8 to 30 MB.
    asked = block.select("place", "query", "terms").toArrow()
    owner = np.repeat(np.arange(asked.num_rows), np.asarray(asked["terms"].combine_chunks().value_lengths()))
    hashes = np.asarray(asked["terms"].combine_chunks().flatten()).view(np.uint64)
    index = build_index(spark, documents, np.unique(hashes))
    n_all, terms_all = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    lists = index.select(F.explode(F.arrays_zip("terms", "holders")).alias("list"))
    df = lists.groupBy(F.col("list.terms").alias("term")).agg(F.sum("list.holders").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2 * n_all + 2)) / (2 * F.col("df") + 1)))
    weights = df.select("term", weight.cast("bigint").alias("weight")).toArrow()  # at most one row for each term asked
    order = np.argsort(np.asarray(weights["term"]))
    terms, weight = np.asarray(weights["term"])[order], np.asarray(weights["weight"])[order]
    sent = spark.sparkContext.broadcast((asked["place"].to_pylist(), asked["query"].to_pylist(), owner, hashes.view(np.int64), terms, weight))

    def heaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, ids, owner, hashes, terms, weight = sent.value
        queries = [_Query() for _ in places]
        if len(terms):
            at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            held = (terms[at] == hashes) & (weight[at] > 0)
            for q, t, w in zip(owner[held].tolist(), hashes[held].tolist(), weight[at][held].tolist(), strict=True):
                queries[q].terms.append((t, w))
        for batch in batches:
            for i in range(batch.num_rows):
                shard = _Shard(batch, i, n_all, terms_all)
                for query in queries:
                    shard.search(query, top)
        rows = [(places[q], ids[q], e[3], e[0]) for q, query in enumerate(queries) for e in query.heap]
        columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 4
        yield pa.RecordBatch.from_arrays(columns, ["place", "query", "doc_id", "score"])

    return index.mapInArrow(heaps, "place long, query long, doc_id long, score long")


# Every score of every document that shares a term with the item.
SEARCH_SQL = """
with terms as (
  select number, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from (select row_number() over () as number, doc_id, text from {documents})),
lengths as (select number, doc_id, count(*) as n from terms group by number, doc_id),
totals as (select count(*) as n_all, sum(n)::bigint as terms_all from lengths),
postings as (select number, term, count(*) as tf from terms group by number, term),
weights as (
  select term, floor(1000 * ln((2 * n_all + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from postings, totals group by term, n_all),
asked as (
  select distinct place, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from (select row_number() over () as place, item_id, text from {benchmark})),
scored as (
  select a.place, a.item_id, l.doc_id, l.number,
         sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * l.n * t.n_all) // t.terms_all))))::bigint as score
  from asked a join weights w using (term) join postings p using (term) join lengths l using (number), totals t
  group by a.place, a.item_id, l.doc_id, l.number),
ranked as (
  select item_id, (row_number() over (partition by place order by score desc, doc_id nulls last))::integer as rank, doc_id, score
  from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
