"""Ranked lexical search as a search for the largest inner products, by buckets of equal length.

A document is a vector of impacts, one for each term that a query has too; a query is a vector of term weights;
a score is their inner product. Documents are ordered by the length of their vectors, longest first, and taken
in buckets. A bucket whose longest vector can't reach a query's threshold (Cauchy-Schwarz) ends the search for
that query in its part of the data, as all later ones are shorter. Inside a bucket a query's coordinates are
taken by falling weight until the rest of them, times the bucket's length, can't reach the threshold: only
documents with one of these coordinates can. Of those, each is bounded by what these coordinates add up to
plus the length of the rest of both vectors. What survives is scored again, exactly, in integers.

A query's threshold is the k-th best score so far. Tasks don't know of each other; so that not each of them
starts from nothing, a search over a sixty-fourth of the documents comes first: its k-th best score is one that
at least k documents reach. It only prunes, no document is judged by the sample.

Texts are read once. What is kept of them are the numbers of the queries' terms; all statistics count all
documents and all their terms. Queries are taken in blocks of bounded size, each with a pass of its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlake.session import fresh_path

TOP = 50
BLOCK_BYTES = 4 << 20
# Documents of a bucket.
BUCKET = 512
# The search that sets the first thresholds takes one document in this many.
FIRST_SEARCH = 64
# Bounds are doubles; a document is left out only if it fails by more than they can err.
SLACK = 1 + 1e-9

# Fixed values of the score: a term's weight is floor(WEIGHT * ln((2N + 2) / (2df + 1))), its impact
# IMPACT * tf div (WEIGHT * tf + DAMPING * m), with m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * N) div L.
WEIGHT, IMPACT, DAMPING, LENGTH_SHARE = 1000, 1_000_000_000, 20, 50

# ASCII letters and digits and every byte of a longer code point make up terms; only A-Z change.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()

FOUND = "item int, doc_id bigint, score bigint"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, in order and with repeats."""
    return text.encode().translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Queries:
    """The distinct terms of each item of a block, by number, and the terms' numbers."""

    ids: list[int | None]
    terms: list[list[int]]
    numbers: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Queries:
        numbers: dict[bytes, int] = {}
        terms = [
            [numbers.setdefault(term, len(numbers)) for term in dict.fromkeys(terms_of(text or ""))] for _, text in rows
        ]
        return cls([item for item, _ in rows], terms, numbers)


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[Queries]:
    """The items in blocks of about ``block_bytes`` of text."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // block_bytes)
    for part in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield Queries.of([tuple(row) for row in own.collect()])


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _term_counts(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms n, and the known terms with their counts, of every document that has a term."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            rows, sizes, lengths, terms, counts = [], [], [0], [], []
            for at, text in enumerate(batch.column("text")):
                own = terms_of(text.as_py() or "")
                if own:
                    found = Counter(map(number.get, own))
                    found.pop(None, None)
                    rows.append(at)
                    sizes.append(len(own))
                    terms += found.keys()
                    counts += found.values()
                    lengths.append(len(terms))
            offsets = pa.array(lengths, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(values, kind)) for values, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(count, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


def _weights(counted: DataFrame, n_docs: int, n_terms: int) -> np.ndarray:
    """The weight of each of the block's terms."""
    weights = np.full(n_terms, math.floor(WEIGHT * math.log(2 * n_docs + 2)), np.int64)
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for term, df in holding.collect():  # no more rows than the block has terms
        weights[term] = math.floor(WEIGHT * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return weights


def _impacts(counted: DataFrame, n_docs: int, all_terms: int) -> DataFrame:
    """doc_id, terms, impacts and the vector's squared length, of the documents that have a known term."""
    m = F.expr(f"{100 - LENGTH_SHARE}L + ({LENGTH_SHARE}L * n * {n_docs}L) div {all_terms}L")
    impact = f"transform(counts, tf -> ({IMPACT}L * tf) div ({WEIGHT}L * tf + {DAMPING}L * m))"
    squares = "aggregate(impacts, 0D, (sum, x) -> sum + double(x) * double(x))"
    return (
        counted.where(F.size("terms") > 0)
        .withColumn("m", m)
        .select("doc_id", "terms", F.expr(impact).alias("impacts"))
        .withColumn("squares", F.expr(squares))
    )


# --- search in one bucket ---------------------------------------------------------------


class Query:
    """One item's weights by falling weight, and its best documents so far."""

    def __init__(self, terms: list[int], weights: np.ndarray, top: int, threshold: int):
        order = np.array(sorted((t for t in terms if weights[t] > 0), key=lambda t: (-weights[t], t)), np.int64)
        self.terms, self.weights = order, weights[order]
        # rest[n]: length of the coordinates from the n-th on
        squares = (self.weights.astype(np.float64) ** 2)[::-1].cumsum()[::-1]
        self.rest = np.sqrt(np.append(squares, 0.0))
        self.by_number = np.argsort(self.terms)
        self.top, self.first = top, threshold
        self.scores = self.ids = np.empty(0, np.int64)
        self.missing = np.empty(0, bool)

    @property
    def threshold(self) -> int:
        """A score that is too low if it isn't reached; no score of 0 counts."""
        own = int(self.scores[-1]) if len(self.scores) == self.top else 1
        return max(1, self.first, own)

    def take(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """Keeps the best of what it has and the given documents, by score, then id, a missing id last."""
        enough = scores >= self.threshold
        scores, ids, missing = (
            np.concatenate([old, new[enough]]) for old, new in zip((self.scores, self.ids, self.missing), (scores, ids, missing))
        )
        best = np.lexsort((ids, missing, -scores))[: self.top]
        self.scores, self.ids, self.missing = scores[best], ids[best], missing[best]


class Bucket:
    """Documents of similar vector length, with their impacts by document and by term."""

    def __init__(self, ids: np.ndarray, missing: np.ndarray, bounds: np.ndarray, terms: np.ndarray, impacts: np.ndarray, squares: np.ndarray):
        self.ids, self.missing, self.bounds, self.terms, self.impacts, self.squares = ids, missing, bounds, terms, impacts, squares
        self.length = math.sqrt(squares.max(initial=0.0))
        order = np.argsort(terms, kind="stable")
        self.doc = np.repeat(np.arange(len(ids)), np.diff(bounds))[order]
        self.value = impacts[order].astype(np.float64)
        self.having, self.start = np.unique(terms[order], return_index=True)
        self.start = np.append(self.start, len(terms))

    def _postings(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the terms' documents in ``doc`` and ``value``, and for each the term's place in ``terms``."""
        at = np.minimum(np.searchsorted(self.having, terms), max(0, len(self.having) - 1))
        found = np.flatnonzero(self.having[at] == terms) if len(self.having) else at[:0]
        return _spans(self.start[at[found]], self.start[at[found] + 1], found)

    def search(self, query: Query) -> None:
        """Gives the query what documents of the bucket are among its best."""
        threshold = query.threshold
        # Documents without one of the first ``few`` coordinates stay below the threshold.
        few = int(np.searchsorted(-query.rest, -threshold / (self.length * SLACK), side="right")) if self.length else 0
        place, which = self._postings(query.terms[:few])
        doc, value = self.doc[place], self.value[place]
        partial = np.bincount(doc, query.weights[which] * value, len(self.ids))
        rest = self.squares - np.bincount(doc, value * value, len(self.ids))
        bound = partial + query.rest[few] * np.sqrt(np.maximum(rest, 0.0))
        has = np.zeros(len(self.ids), bool)
        has[doc] = True
        survivors = np.flatnonzero(has & (bound * SLACK >= threshold))
        if len(survivors):
            query.take(self._exact(query, survivors), self.ids[survivors], self.missing[survivors])

    def _exact(self, query: Query, docs: np.ndarray) -> np.ndarray:
        """Scores of some documents, in integers."""
        place, which = _spans(self.bounds[docs], self.bounds[docs + 1], np.arange(len(docs)))
        numbers = query.terms[query.by_number]
        at = np.minimum(np.searchsorted(numbers, self.terms[place]), len(numbers) - 1)
        same = numbers[at] == self.terms[place]
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, which[same], query.weights[query.by_number][at[same]] * self.impacts[place[same]])
        return scores


def _spans(starts: np.ndarray, ends: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the name of the range each is from."""
    sizes = ends - starts
    offsets = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if len(sizes) else np.empty(0, np.int64)
    return (np.arange(len(offsets)) + offsets).astype(np.int64), np.repeat(names, sizes)


def _buckets(batch: pa.RecordBatch, size: int) -> Iterator[Bucket]:
    for first in range(0, batch.num_rows, size):
        part = batch.slice(first, size)
        ids = part.column("doc_id")
        lengths = part.column("terms").value_lengths().to_numpy(zero_copy_only=False)
        yield Bucket(
            ids.fill_null(0).to_numpy(),
            ids.is_null().to_numpy(zero_copy_only=False),
            np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
            part.column("terms").flatten().to_numpy(),
            part.column("impacts").flatten().to_numpy(),
            part.column("squares").to_numpy(),
        )


def _search(vectors: DataFrame, terms: list[list[int]], weights: np.ndarray, top: int, thresholds: np.ndarray, bucket: int) -> DataFrame:
    """item, doc_id, score: the best documents of each task for each item that reach its threshold."""
    given = vectors.sparkSession.sparkContext.broadcast((terms, weights, thresholds))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_terms, own_weights, own_thresholds = given.value
        queries = [Query(t, own_weights, top, int(own_thresholds[n])) for n, t in enumerate(own_terms)]
        active = [query for query in queries if len(query.terms)]
        for batch in batches:
            for documents in _buckets(batch, bucket):
                # Vectors come longest first: a query that this bucket is too short for is done.
                active = [query for query in active if query.rest[0] * documents.length * SLACK >= query.threshold]
                for query in active:
                    documents.search(query)
        items = np.repeat(np.arange(len(queries), dtype="i4"), [len(query.scores) for query in queries])
        if len(items):
            ids, missing, scores = (np.concatenate([getattr(q, name) for q in queries]) for name in ("ids", "missing", "scores"))
            yield pa.RecordBatch.from_arrays([pa.array(items), pa.array(ids, mask=missing), pa.array(scores)], ["item", "doc_id", "score"])

    return vectors.sortWithinPartitions(F.col("squares").desc()).mapInArrow(search, FOUND)


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _best_of_block(docs: DataFrame, queries: Queries, top: int, bucket: int) -> DataFrame:
    counted = _written(_term_counts(docs, queries.numbers), "term-counts")
    n_docs, all_terms = counted.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return docs.sparkSession.createDataFrame([], FOUND + ", rank int")
    weights = _weights(counted, n_docs, len(queries.numbers))
    vectors = _impacts(counted, n_docs, all_terms)
    thresholds = np.zeros(len(queries.ids), np.int64)
    some = vectors.where(F.pmod(F.xxhash64("doc_id", "squares"), F.lit(FIRST_SEARCH)) == 0)
    first = _ranked(_search(some, queries.terms, weights, top, thresholds, bucket), top)
    for item, score in first.where(F.col("rank") == top).select("item", "score").collect():
        thresholds[item] = score
    return _ranked(_search(vectors, queries.terms, weights, top, thresholds, bucket), top)


def _named(spark: SparkSession, best: DataFrame, ids: list[int | None]) -> DataFrame:
    """The items' ids in place of their numbers; a block's items are as many as fit into it."""
    names = spark.createDataFrame(list(enumerate(ids)), "item int, item_id bigint")
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES, bucket: int = BUCKET) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` best documents with a score above 0 for each row of ``items``.

    Equal scores rank by doc_id, a null id last. Repeated rows of ``docs`` are ranked each, repeated items are
    answered each; a null or empty text has no term, and so neither counts as a document nor finds any; very
    long texts are taken whole; other columns are ignored. Without documents or without items that have a
    term the result is empty.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    for queries in _blocks(items, block_bytes):
        if queries.numbers:
            result = result.unionByName(_named(spark, _best_of_block(narrow, queries, top, bucket), queries.ids))
    return result
