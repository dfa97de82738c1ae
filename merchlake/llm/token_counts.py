"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as one symbol per byte. A heap holds its adjacent pairs by rank; the pair of lowest
rank (the leftmost of equals) is merged, its neighbours are linked to the new symbol, and the two
pairs that arise are pushed. Pairs that no longer exist are passed over when they come up. Every
merge takes away one symbol, so the count is the number of bytes less the number of merges, and
no token identifier is ever written down.

Texts are counted where they are read: one Python pass over Arrow batches, no shuffle.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from merchlake.llm.text import is_latin, latin_words, texts_of

# Words whose count a Python worker remembers before it forgets them all.
REMEMBERED_WORDS = 300_000

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"


class MergeRanks:
    """Ranks of a byte-level vocabulary: pair of symbols -> (rank, merged symbol)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        ids = stored["model"]["vocab"]
        self.first = [ids[name] for name in byte_names()]
        self.pairs = {}
        for rank, (left, right) in enumerate(stored["model"]["merges"]):
            self.pairs[ids[left], ids[right]] = (rank, ids[left + right])
        special = [token["content"] for token in stored["added_tokens"]]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def count(self, word: bytes) -> int:
        """Tokens of one word: its bytes less the merges that the ranks allow."""
        symbols, size, pairs = [self.first[byte] for byte in word], len(word), self.pairs
        if size < 2:
            return size
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [
            (found[0], at, left, right)
            for at, (left, right) in enumerate(zip(symbols, symbols[1:]))
            if (found := pairs.get((left, right)))
        ]
        heapify(heap)
        merges = 0
        while heap:
            _, at, left, right = heappop(heap)
            next_at = after[at]
            if symbols[at] != left or next_at >= size or symbols[next_at] != right:
                continue  # one of the two was merged meanwhile
            merged = symbols[at] = pairs[left, right][1]
            symbols[next_at] = -1
            beyond = after[at] = after[next_at]
            merges += 1
            if beyond < size:
                before[beyond] = at
                if found := pairs.get((merged, symbols[beyond])):
                    heappush(heap, (found[0], at, merged, symbols[beyond]))
            ahead = before[at]
            if ahead >= 0 and (found := pairs.get((symbols[ahead], merged))):
                heappush(heap, (found[0], ahead, symbols[ahead], merged))
        return size - merges


def byte_names() -> list[str]:
    """How a byte-level vocabulary writes each byte: printable ones as themselves, the rest from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(byte) if byte in printable else chr(next(spare)) for byte in range(256)]


class WordCounts(dict):
    """word -> tokens; counts a word when it is first asked for."""

    def __init__(self, ranks: MergeRanks):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> int:
        count = self.ranks.count(word.encode("utf-8"))
        # A dict that only ever grew would outgrow the worker; very long words are seldom seen again.
        if len(word) <= 64:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = count
        return count


@lru_cache(maxsize=4)
def _counter(path: str) -> tuple[MergeRanks, WordCounts]:
    ranks = MergeRanks(path)
    return ranks, WordCounts(ranks)


_SPLITTER = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)


def _words(text: str) -> list[str]:
    """The words within which merges may happen, split just as the tokenizer library does."""
    if is_latin(text):
        return latin_words().findall(text)
    return [text[start:end] for _, (start, end) in _SPLITTER.pre_tokenize_str(text)]


def count_text(text: str, path: str) -> int:
    """Tokens of one whole text. A special token spelled out in it counts as one token."""
    ranks, counts = _counter(path)
    if not (ranks.special and ranks.special.search(text)):
        return sum(map(counts.__getitem__, _words(text)))
    parts = ranks.special.split(text)
    return len(parts) - 1 + sum(sum(map(counts.__getitem__, _words(part))) for part in parts)


def token_counts(docs: DataFrame, vocabulary: str, limit: int) -> DataFrame:
    """Bytes and tokens of every whole text, one row per row of ``docs``.

    ``vocabulary`` is the path of a byte-level BPE in the tokenizers library's JSON format. A null or
    empty text has no bytes and no tokens; a null ``doc_id`` stays null, repeated rows are counted each,
    other columns are ignored, and an empty table gives an empty table.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch)
            tokens = [count_text(text, vocabulary) for text in texts]
            columns = [
                batch.column("doc_id"),
                pa.array([len(text.encode("utf-8")) for text in texts], pa.int64()),
                pa.array(tokens, pa.int64()),
                pa.array([n > limit for n in tokens], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(count, SCHEMA)
