"""Benchmark decontamination by SimHash over item-sized windows.

Each benchmark item has a 64-bit SimHash of its five-word shingles, weighted by how often they occur.
Windows as long as an item slide over every document, and their SimHashes are looked up in a
multi-index: fingerprints are cut into one block more than the radius, so that two fingerprints
within the radius must agree on at least one whole block, and none within it is missed. Candidates
are verified by the exact weighted-shingle similarity (the cosine of the two windows' shingle
counts; for windows of equal length without repeats, the share of the item's shingles found).

A window that shares no shingle at all with an item has similarity 0, so windows are only opened where
a shingle of the document is one of an item's; nothing is lost by it, and the rest of a document costs
no more than its hashes. The benchmark is the stated query set: it is taken in blocks of bounded size,
each carried to the tasks that read the documents. No document is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm.words import chunks, mix, shingles, words_of

SHINGLE = 5
SIMILARITY = 0.8
BITS = 64
# At a cosine of 0.8 two fingerprints differ in 13.1 bits on average, with a deviation of 3.2.
RADIUS = 25
# Text of the items that one pass over the documents carries along.
BLOCK_BYTES = 8 << 20

SCHEMA = "doc_id bigint, item_id bigint, similarity double, start_word bigint, n_words bigint, hamming int"


def _signs(codes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    return (np.unpackbits(mix(codes, 7).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) << 1) - 1


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1).reshape(-1, 8).view(np.uint64).ravel()


@dataclass
class Item:
    item_id: int | None
    words: int
    shingles: np.ndarray  # distinct, sorted
    counts: np.ndarray
    fingerprint: int


class Index:
    """Items by shingle, and by the blocks of their fingerprints."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.items: list[Item] = []
        self.by_shingle: dict[int, set[int]] = defaultdict(set)  # shingle -> items
        self.by_block: dict[tuple[int, int], list[int]] = defaultdict(list)
        for item_id, text in rows:
            words = words_of([(text or "").encode()])
            codes, _ = shingles(words, SHINGLE)
            if not len(codes):
                continue
            distinct, counts = np.unique(codes, return_counts=True)
            fingerprint = int(_fingerprints(_signs(codes).sum(axis=0)[None])[0])
            number = len(self.items)
            self.items.append(Item(item_id, len(words.hashes), distinct, counts, fingerprint))
            for code in distinct.tolist():
                self.by_shingle[code].add(number)
            for key in _blocks(fingerprint):
                self.by_block[key].append(number)
        self.known = np.sort(np.fromiter(self.by_shingle, np.uint64, len(self.by_shingle)))

    def within_radius(self, fingerprint: int, wanted: set[int]) -> list[tuple[int, int]]:
        """(item, distance) of the wanted items whose fingerprint is within the radius."""
        met = {n for key in _blocks(fingerprint) for n in self.by_block.get(key, ()) if n in wanted}
        found = ((n, (self.items[n].fingerprint ^ fingerprint).bit_count()) for n in sorted(met))
        return [(n, distance) for n, distance in found if distance <= RADIUS]


def _blocks(fingerprint: int) -> list[tuple[int, int]]:
    """The fingerprint in one block more than the radius, each with its number."""
    ends = [BITS * n // (RADIUS + 1) for n in range(RADIUS + 2)]
    return [(n, (fingerprint >> low) & ((1 << (high - low)) - 1)) for n, (low, high) in enumerate(zip(ends, ends[1:]))]


def similarity(item: Item, codes: np.ndarray) -> float:
    """Cosine of the shingle counts of an item and of a window."""
    distinct, counts = np.unique(codes, return_counts=True)
    _, mine, theirs = np.intersect1d(item.shingles, distinct, assume_unique=True, return_indices=True)
    dot = float((item.counts[mine] * counts[theirs]).sum())
    return dot / float(np.sqrt((item.counts**2).sum() * (counts**2).sum()))


def leaks(codes: np.ndarray, index: Index) -> dict[int, tuple[float, int, int, int]]:
    """item -> (similarity, first word, words, distance) of its best window in one text's shingles."""
    at = np.searchsorted(index.known, codes)
    hits = np.flatnonzero(index.known[np.minimum(at, len(index.known) - 1)] == codes) if len(index.known) else at[:0]
    starts: dict[int, set[int]] = defaultdict(set)  # shingles in a window -> starts of windows to open
    wanted: dict[int, set[int]] = defaultdict(set)
    for hit in hits.tolist():
        for number in index.by_shingle[int(codes[hit])]:
            size = min(index.items[number].words - SHINGLE + 1, len(codes))
            wanted[size].add(number)
            starts[size].update(range(max(0, hit - size + 1), min(hit, len(codes) - size) + 1))
    best: dict[int, tuple[float, int, int, int]] = {}
    for size, opened in starts.items():
        first = np.array(sorted(opened))
        for part in np.split(first, np.flatnonzero(np.diff(first) > size) + 1):  # stretches of the text
            low, high = int(part[0]), int(part[-1]) + size
            sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(_signs(codes[low:high]), axis=0, dtype=np.int32)])
            prints = _fingerprints(sums[part - low + size] - sums[part - low])
            for start, fingerprint in zip(part.tolist(), prints.tolist()):
                for number, distance in index.within_radius(fingerprint, wanted[size]):
                    score = similarity(index.items[number], codes[start : start + size])
                    found = (score, -start, size + SHINGLE - 1, distance)
                    if score >= SIMILARITY and found > best.get(number, (0.0,)):
                        best[number] = found
    return {number: (score, -start, size, distance) for number, (score, start, size, distance) in best.items()}


def _leaks_of(batch: pa.RecordBatch, index: Index) -> Iterator[tuple[int, dict]]:
    """Row number and leaks of the texts that have any."""
    texts = [(text or "").encode() for text in batch.column("text").to_pylist()]
    for first, end in chunks(texts):
        words = words_of(texts[first:end])
        codes, whole = shingles(words, SHINGLE)
        for n in np.unique(words.text[: len(codes)][whole & np.isin(codes, index.known)]).tolist():
            low, high = words.bounds[n], words.bounds[n + 1] - SHINGLE + 1
            if found := leaks(codes[low:high], index):
                yield first + n, found


def _item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark's rows in parts of about ``block_bytes`` of text."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-total // block_bytes)
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield [tuple(row) for row in own.collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and benchmark item that has a window in it, with the best such window.

    Of equally similar windows the first counts. Items and texts of fewer than five words, nulls among
    them, have no shingle and match nothing. A document shorter than an item is one window. Null ids
    stay null, repeated rows and items are reported each, other columns are ignored; without documents
    or without items the result is empty.
    """
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = docs.sparkSession.createDataFrame([], SCHEMA)
    for rows in _item_blocks(benchmark, block_bytes):

        def report(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            index = Index(rows)
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                found = [
                    (ids[n], index.items[item].item_id, *best)
                    for n, matched in _leaks_of(batch, index)
                    for item, best in sorted(matched.items())
                ]
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32())
                columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc_id", "item_id", "similarity", "start_word", "n_words", "hamming"]
                )

        result = result.unionByName(narrow.mapInArrow(report, SCHEMA))
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item is found."""
    kept = docs
    for rows in _item_blocks(benchmark, block_bytes):

        def keep(batches: Iterator[pa.RecordBatch], rows=rows) -> Iterator[pa.RecordBatch]:
            index = Index(rows)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[n for n, _ in _leaks_of(batch, index)]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(keep, docs.schema)
    return kept
