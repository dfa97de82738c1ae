"""Bounded-space online best-fit packing of token sequences.

Documents become pieces of at most ``capacity`` tokens. The pieces are dealt evenly to a few packers,
where they arrive in random waves, each wave longest first; a packer is one task that sees its pieces
one at a time and places each where it fits most tightly. It keeps at most ``open_bins`` bins
open, in a bitset keyed by free space: the lowest set bit at or above a piece's length names the
tightest bin, and when one bin too many is open the lowest set bit of all names the fullest, which
closes. A piece's place is final when it has been seen, so a packer's memory is its open bins.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from merchlake.llm.text import is_latin, latin_words, texts_of
from merchlake.llm.token_counts import byte_names

# Documents for one packer. More packers leave more bins half full at the end.
DOCS_PER_PACKER = 50_000
OPEN_BINS = 16_384
# Documents whose pieces arrive as one wave, longest first: a wave opens fewer bins than may be open.
DOCS_PER_WAVE = 10_000
# Words longer than this go to the tokenizers library, whose merging is not quadratic.
LONG_WORD = 500
_ROWS_PER_BATCH = 4_000

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class TokenIds:
    """Token ids of whole texts, as the tokenizers library gives them without added special tokens.

    Latin texts take a faster library with the same vocabulary, provided that its rule (merge the
    pair whose token has the lowest id) is the file's rule; everything else takes the tokenizers
    library itself.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        ids, special = stored["model"]["vocab"], {t["content"]: t["id"] for t in stored["added_tokens"]}
        merged = [ids["".join(pair)] for pair in stored["model"]["merges"]]
        byte_of = {name: byte for byte, name in enumerate(byte_names())}
        self.fast = None
        if merged == sorted(merged):
            ranks = {bytes(byte_of[c] for c in token): i for token, i in ids.items() if token not in special}
            pattern = latin_words().pattern
            for point in range(0x300):  # the other library's pattern language writes code points differently
                pattern = pattern.replace(f"\\U{point:08x}", f"\\x{{{point:x}}}")
            self.fast = tiktoken.Encoding("latin", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def of(self, text: str) -> list[int]:
        if self.fast and is_latin(text) and max(map(len, text.split(" "))) <= LONG_WORD:
            return self.fast.encode(text, allowed_special="all")
        return self.library.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=4)
def _token_ids(path: str) -> TokenIds:
    return TokenIds(path)


class BestFit:
    """Places lengths of at most ``capacity`` into bins; returns (bin, offset) for each."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0  # bit f: an open bin has f tokens free
        self.open = self.used = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        found = bins.pop()
        if not bins:
            self.mask &= ~(1 << free)
        return found

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            if self.open == self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)
                self.open -= 1
            free, found = self.capacity, self.used
            self.used += 1
            self.open += 1
        left = free - length
        if left:
            self.by_free[left].append(found)
            self.mask |= 1 << left
        else:
            self.open -= 1
        return found, self.capacity - free


def piece_bounds(tokens: int, capacity: int) -> list[int]:
    """Starts of a document's pieces and its end: all pieces but the first are full."""
    first = tokens if tokens <= capacity else tokens % capacity or capacity
    return [0, *range(first, tokens, capacity), tokens]


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """Every document's token ids and ``end_id``, cut into pieces of at most ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _token_ids(vocabulary)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS_PER_BATCH):
                batch, rows, ids = whole.slice(at, _ROWS_PER_BATCH), [], []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
                    found = np.array([*tokenizer.of(text), end_id], "<u4")
                    bounds = piece_bounds(len(found), capacity)
                    for piece, (start, end) in enumerate(zip(bounds, bounds[1:])):
                        part = found[start:end]
                        rows.append((doc_id, piece, start, end - start, zlib.crc32(part.tobytes())))
                        if with_ids:
                            ids.append(part.astype("i4"))
                yield _batch(rows, ids if with_ids else None)

    def _batch(rows: list[tuple], ids: list[np.ndarray] | None) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows) if rows else [[]] * 5, kinds)]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if ids is not None:
            ends = np.cumsum([0, *map(len, ids)], dtype="i4")
            arrays.append(pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, "i4"), *ids])))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(cut, PIECE_SCHEMA + ", ids array<int>" * with_ids)


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int,
    end_id: int,
    with_ids: bool = False,
    open_bins: int = OPEN_BINS,
    docs_per_packer: int = DOCS_PER_PACKER,
) -> DataFrame:
    """Pieces of all documents and their places: sequence and offset; with ``with_ids`` also the ids.

    A null or empty text is a document of ``end_id`` alone. Repeated rows and null ``doc_id`` are
    packed like any others; other columns are ignored. An empty table gives an empty result.
    """
    count = docs.count()
    packers = max(1, -(-count // docs_per_packer))
    waves = max(1, -(-count // (packers * DOCS_PER_WAVE)))
    pieces = pieces_of(docs, vocabulary, capacity, end_id, with_ids)
    # The partition number spreads the pieces of repeated rows. The sort sets the waves, and makes the
    # order of arrival the same when a lost task is run again.
    spread = F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id()).alias("spread")
    dealt = (
        pieces.select("*", spread)
        .repartition(packers, "spread")
        .sortWithinPartitions(F.pmod("spread", F.lit(waves)), F.desc("length"), "spread", "doc_id", "piece")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = np.array([bins.place(n) for n in batch.column("length").to_pylist()], "i8").reshape(-1, 2)
            yield batch.drop_columns("spread").append_column("sequence_id", pa.array(placed[:, 0] + base)).append_column(
                "offset", pa.array(placed[:, 1])
            )

    schema = f"{PIECE_SCHEMA}{', ids array<int>' * with_ids}, sequence_id bigint, offset bigint"
    return dealt.mapInArrow(place, schema)
