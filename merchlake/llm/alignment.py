"""Alignment of two sequences of hashes within a band that widens by one diagonal for each edit."""

from __future__ import annotations

import numpy as np

# Sequences of up to so many words are compared word by word, longer ones a diagonal at once.
SHORT = 200


def align(a: np.ndarray, b: np.ndarray, most_edits: int) -> list[tuple[int, int, int]] | None:
    """Matching runs (place in a, place in b, length) of an alignment with fewest edits, or None beyond ``most_edits``.

    With e edits only the diagonals within e of the main one can be reached, and only from those within the edits
    that are left of the last one can one still arrive; each keeps how far down it one can get. Matches cost
    nothing; a replaced, missing or added word is one edit.
    """
    target = len(b) - len(a)
    breaks: dict[int, np.ndarray] = {}
    # Word by word is faster where there are few.
    short = min(len(a), len(b)) <= SHORT
    words, others = (a.tolist(), b.tolist()) if short else ([], [])

    def slide(diagonal: int, at: int) -> int:
        """How far matches lead from a[at], b[at + diagonal] on."""
        if at >= len(a) or at + diagonal >= len(b):
            return at
        if short:
            end = min(len(words), len(others) - diagonal)
            while at < end and words[at] == others[at + diagonal]:
                at += 1
            return at
        if diagonal not in breaks:
            low, high = max(0, -diagonal), min(len(a), len(b) - diagonal)
            unequal = np.flatnonzero(a[low:high] != b[low + diagonal : high + diagonal]) + low
            breaks[diagonal] = np.append(unequal, high)
        stops = breaks[diagonal]
        return int(stops[np.searchsorted(stops, at)])

    reached: list[dict[int, tuple[int, int, int]]] = []  # per edits: diagonal -> (from, to, diagonal before)
    for edits in range(most_edits + 1):
        row: dict[int, tuple[int, int, int]] = {}
        last = reached[-1] if reached else {}
        left = most_edits - edits
        for diagonal in range(max(-edits, -len(a), target - left), min(edits, len(b), target + left) + 1):
            start, before = (0, 0) if not edits else (-1, 0)
            # One more word of a (replaced or left out), or one more of b only.
            for origin, step in ((diagonal, 1), (diagonal + 1, 1), (diagonal - 1, 0)):
                if origin in last and start < (came := last[origin][1] + step) <= min(len(a), len(b) - diagonal):
                    start, before = came, origin
            if start >= 0:
                row[diagonal] = (start, slide(diagonal, start), before)
        reached.append(row)
        if target in row and row[target][1] == len(a):
            runs, diagonal = [], target
            for step in range(edits, -1, -1):
                start, end, before = reached[step][diagonal]
                if end > start:
                    runs.append((start, start + diagonal, end - start))
                diagonal = before
            return runs[::-1]
    return None
