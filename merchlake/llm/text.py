"""Small helpers that several text operators share."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame


def spare_name(frame: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``frame`` has."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of an Arrow batch, a null as an empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]


def packed_texts(rows: DataFrame) -> DataFrame:
    """The rows with their column ``text`` compressed, a null as it is."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = pa.array([t if t is None else squeeze(t.encode()) for t in batch.column(at).to_pylist()], pa.binary())
            yield batch.set_column(at, "text", texts)

    schema = ", ".join(f"{name} {'binary' if name == 'text' else kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(pack, schema)


def _ranges(points: list[int]) -> str:
    spans: list[list[int]] = []
    for point in points:
        if spans and spans[-1][1] == point - 1:
            spans[-1][1] = point
        else:
            spans.append([point, point])
    return "".join(f"\\U{low:08x}-\\U{high:08x}" for low, high in spans)


def _of_category(kind: str, end: int) -> str:
    return _ranges([p for p in range(end) if unicodedata.category(chr(p)).startswith(kind)])


# Below this code point the standard library's tables and those of the tokenizer libraries agree
# on letters, numbers and white space; above it they follow different Unicode versions.
LATIN_END = 0x300
_BEYOND_LATIN = re.compile(f"[^\\x00-\\U{LATIN_END - 1:08x}]")


def is_latin(text: str) -> bool:
    return text.isascii() or not _BEYOND_LATIN.search(text)


@lru_cache(maxsize=1)
def latin_words() -> re.Pattern:
    """The split before the merges of a byte-level tokenizer, for Latin texts.

    Fixed values: the contractions and the order of the alternatives.
    """
    letter, number = _of_category("L", LATIN_END), _of_category("N", LATIN_END)
    space = "\\t-\\r \\x85\\xa0"
    return re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        f"|[{space}]+(?![^{space}])|[{space}]+"
    )
