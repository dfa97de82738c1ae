"""Words of many texts at once as 64-bit hashes, with their byte positions.

Texts are laid end to end in one buffer and everything is done on whole arrays. A word is a run of
letters, digits and underscores: of ASCII bytes those, and every byte of a longer code point except
Latin-1 and general punctuation. Case is folded for ASCII and Latin-1, which moves no byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD_BYTE = np.array(
    [chr(b).isalnum() or b == 0x5F if b < 0x80 else True for b in range(256)], dtype=bool
)
CHUNK_BYTES = 1 << 19


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spreads 64-bit values over the whole range; different seeds give unrelated results."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64) + np.uint64((seed * 2 + 1) * _BASE % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse, as many as the longest buffer so far has bytes."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def upto(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]), dtype=np.uint64)
                for base in (_BASE, _INVERSE)
            )
        return self.up, self.down


_POWERS = _Powers()


def fold(data: np.ndarray) -> np.ndarray:
    """The bytes with ASCII and Latin-1 capitals made small."""
    folded = data.copy()
    folded[(data >= 0x41) & (data <= 0x5A)] += 0x20
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)]
    folded[capital] += 0x20
    return folded


def _word_bytes(data: np.ndarray) -> np.ndarray:
    inside = _WORD_BYTE[data]
    latin = np.flatnonzero(data[:-1] == 0xC2)  # signs, no letters worth keeping apart
    inside[latin] = inside[latin + 1] = False
    general = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))  # dashes, quotes, spaces
    for step in range(3):
        inside[general + step] = False
    return inside


@dataclass
class Words:
    """Words of several texts: hash, text number, and first and end byte in the word's text."""

    hashes: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # text n has words bounds[n] to bounds[n + 1]


def words_of(texts: list[bytes]) -> Words:
    """All words of UTF-8 texts, in order."""
    joined = np.frombuffer(b" ".join(texts) + b"   ", np.uint8)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    folded = fold(joined)
    edges = np.diff(_word_bytes(folded).astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    up, down = _POWERS.upto(len(folded))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((folded + np.uint64(1)) * up[: len(folded)], dtype=np.uint64)])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    bounds = np.searchsorted(starts, begins)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(hashes, text, starts - begins[text], ends - begins[text], bounds)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``size`` words from each word on, and whether they all belong to one text."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    found = np.zeros(n, np.uint64)
    for step in range(size):
        found = found * np.uint64(_BASE) + words.hashes[step : step + n]
    return mix(found), words.text[:n] == words.text[size - 1 :]


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together, at least one text each."""
    first = total = 0
    for n, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield first, n + 1
            first, total = n + 1, 0
    if first < len(texts):
        yield first, len(texts)
