"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classed as smaller or larger than their successor. The leftmost-smaller substrings are
sorted, named, and, where names repeat, ordered by the suffix array of the string of names; from their
order that of all suffixes is induced, linearly. Over small alphabets a whole bucket is induced at once:
what it pushes into each other bucket keeps the bucket's order, and what it pushes into itself forms its
next round. Over names, the substrings are short and are sorted by radix, and suffixes are induced one by one.
"""

from __future__ import annotations

import numpy as np

# With more symbols than this, buckets are too small to be worth an array operation each.
BUCKET_ALPHABET = 1_024


def _smaller(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the end marker's counts as smaller."""
    size = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    decided = np.minimum.accumulate(np.where(differs, np.arange(size), size - 1)[::-1])[::-1]
    return np.append(text[:-1] < text[1:], True)[decided]


def _push(found: np.ndarray, text: np.ndarray, ends: np.ndarray, chosen: np.ndarray, step: int) -> None:
    """Appends suffixes, in order, to the front (1) or back (-1) edge of their buckets."""
    symbols = text[chosen]
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    counts = np.bincount(symbols, minlength=len(ends))
    rank = np.arange(len(order)) - (np.cumsum(counts) - counts)[ordered]
    if step > 0:
        found[ends[ordered] + rank] = chosen[order]
        ends += counts
    else:
        found[ends[ordered] - 1 - rank] = chosen[order]
        ends -= counts


def _induce_buckets(text: np.ndarray, symbols: int, smaller: np.ndarray, order: np.ndarray) -> np.ndarray:
    counts = np.bincount(text, minlength=symbols)
    ends = np.cumsum(counts)
    starts = ends - counts
    found = np.full(len(text), -1, np.int32)
    tails = ends.copy()
    _push(found, text, tails, order[::-1], -1)
    placed, heads = tails.copy(), starts.copy()
    for symbol in np.flatnonzero(counts).tolist():
        low = starts[symbol]
        while low < (high := heads[symbol]):
            before = found[low:high] - 1
            _push(found, text, heads, before[(before >= 0) & ~smaller[before]], 1)
            low = high
        before = found[placed[symbol] : ends[symbol]] - 1
        if len(before):
            _push(found, text, heads, before[(before >= 0) & ~smaller[before]], 1)
    tails = ends.copy()
    tails[0] = 0  # the end marker stays where it is
    for symbol in np.flatnonzero(counts)[::-1].tolist():
        high = ends[symbol]
        while (low := tails[symbol]) < high:
            before = found[low:high][::-1] - 1
            _push(found, text, tails, before[(before >= 0) & smaller[before]], -1)
            high = low
        before = found[starts[symbol] : heads[symbol]][::-1] - 1
        if len(before):
            _push(found, text, tails, before[(before >= 0) & smaller[before]], -1)
    return found


def _induce_in_order(text: np.ndarray, symbols: int, smaller: np.ndarray, order: np.ndarray) -> np.ndarray:
    counts = np.bincount(text, minlength=symbols)
    ends = np.cumsum(counts)
    # Symbol before each suffix if that suffix is larger, or smaller, than this one; an empty place has none.
    before = np.append(text[-1:], text[:-1]).astype(np.int64)
    before_smaller = np.append(smaller[-1:], smaller[:-1])
    before[0], none = -1, len(text)
    larger_before = np.append(np.where(before_smaller, -1, before), -1).tolist()
    smaller_before = np.append(np.where(before_smaller, before, -1), -1).tolist()
    found = np.full(len(text), none, np.int64)
    _push(found, text, ends.copy(), order[::-1], -1)
    found, heads, tails = found.tolist(), (ends - counts).tolist(), ends.tolist()
    for suffix in found:  # places ahead fill up on the way
        code = larger_before[suffix]
        if code >= 0:
            place = heads[code]
            found[place] = suffix - 1
            heads[code] = place + 1
    for suffix in reversed(found):
        code = smaller_before[suffix]
        if code >= 0:
            place = tails[code] = tails[code] - 1
            found[place] = suffix - 1
    return np.array(found, np.int32)


def _radix_names(text: np.ndarray, smaller: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Marks in the order of their substrings, and the substrings' numbers in text order, by rounds of two symbols.

    Of equal symbols the smaller suffix's counts as the higher, as induction would have it.
    """
    size = np.append(np.diff(marks) + 1, 1)
    values = np.append((text.astype(np.uint64) << np.uint64(1)) + smaller + np.uint64(1), np.uint64(0))
    names, left, offset = np.zeros(len(marks), np.int64), np.arange(len(marks)), 0
    while len(left):
        key = names[left].astype(np.uint64)
        for step in (offset, offset + 1):
            inside = size[left] > step
            key = (key << np.uint64(22)) | values[np.where(inside, marks[left] + step, len(text))]
        # Members of a group stay within the numbers that the group spans.
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.append(True, ordered[1:] != ordered[:-1])
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(left)), 0))
        group = names[left][order]
        start = np.maximum.accumulate(np.where(np.append(True, group[1:] != group[:-1]), np.arange(len(left)), 0))
        names[left[order]] = group + first - start
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(left)))
        offset += 2
        tied = np.repeat(sizes > 1, sizes)
        left = left[order][tied]
        left = np.sort(left[size[left] > offset])
    ordered = marks[np.argsort(names, kind="stable")]
    distinct, dense = np.unique(names, return_inverse=True)
    return ordered, dense.astype(np.int32), len(distinct)


def _names(text: np.ndarray, marks: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Number of each leftmost-smaller substring in sorted order, equal ones alike, listed in text order."""
    size = np.full(len(text), 1, np.int32)  # symbols from one mark to the next, both included
    size[marks[:-1]] = np.diff(marks) + 1
    first, second = ordered[:-1], ordered[1:]
    same = size[first] == size[second]
    left = np.flatnonzero(same)
    for step in range(int(size.max(initial=1))):
        left = left[size[first[left]] > step]
        if not len(left):
            break
        equal = text[first[left] + step] == text[second[left] + step]
        same[left[~equal]] = False
        left = left[equal]
    numbers = np.concatenate([[0], np.cumsum(~same)]).astype(np.int32)
    by_place = np.zeros(len(text), np.int32)
    by_place[ordered] = numbers
    return by_place[marks], int(numbers[-1]) + 1


def suffix_array(text: np.ndarray, symbols: int) -> np.ndarray:
    """Starts of the suffixes in order; ``text`` holds numbers below ``symbols`` and ends with its only 0."""
    if len(text) == 1:
        return np.zeros(1, np.int32)
    by_bucket = symbols <= BUCKET_ALPHABET
    induce = _induce_buckets if by_bucket else _induce_in_order
    smaller = _smaller(text)
    is_mark = np.zeros(len(text), bool)
    is_mark[1:] = smaller[1:] & ~smaller[:-1]
    marks = np.flatnonzero(is_mark).astype(np.int32)
    if by_bucket or symbols >= 1 << 20:  # symbols too large to be packed
        found = induce(text, symbols, smaller, marks)
        ordered = found[is_mark[found]]
        names, distinct = _names(text, marks, ordered)
    else:
        ordered, names, distinct = _radix_names(text, smaller, marks)
    if distinct < len(marks):
        ordered = marks[suffix_array(names, distinct)]
    return induce(text, symbols, smaller, ordered)


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each start of ``length`` bytes in each text, whether they also start anywhere else in the texts.

    One suffix array of all texts, a separator between them. The common prefix with the suffix before is
    kept by place in the text (permuted): where both suffixes follow the same symbol it is one less than
    at the place before, so only the other places are compared.
    """
    sizes = np.array([len(text) for text in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.frombuffer(b"\0".join(texts) + b"\0\0", np.uint8).astype(np.uint16) + np.uint16(2)
    joined[begins[1:] - 1] = 1
    joined[-1] = 0
    order = suffix_array(joined, 258)
    ahead = np.empty(len(joined), np.int32)
    ahead[order[1:]], ahead[order[0]] = order[:-1], -1
    place = np.arange(len(joined), dtype=np.int32)
    end = np.append(np.repeat(begins[1:] - 1, sizes + 1), len(joined) - 1).astype(np.int32)
    starts = end - place >= length
    compared = starts & (ahead >= 0)
    follows = np.zeros(len(joined), bool)
    follows[1:] = (ahead[1:] > 0) & (joined[:-1] == joined[np.maximum(ahead[1:], 1) - 1])
    follows[begins[:-1]] = False
    explicit = np.flatnonzero(compared & ~follows).astype(np.int32)
    # Four symbols at a time.
    padded = np.append(joined, np.zeros(4, np.uint16)).astype(np.uint64)
    four = padded[:-4] | padded[1:-3] << np.uint64(16) | padded[2:-2] << np.uint64(32) | padded[3:-1] << np.uint64(48)
    common = np.zeros(len(joined), np.int32)
    active, other = explicit, ahead[explicit]
    done = 0
    while len(active):
        unequal = four[active + done] ^ four[other + done]
        stop = np.flatnonzero(unequal)
        lowest = unequal[stop] & (~unequal[stop] + np.uint64(1))
        common[active[stop]] = done + (np.log2(lowest.astype(np.float64)).astype(np.int32) >> 4)
        done += 4
        go = (unequal == 0) & (active + done < end[active])
        ended = (unequal == 0) & ~go
        common[active[ended]] = end[active[ended]] - active[ended]
        active, other = active[go], other[go]
        inside = other + done < len(four)
        common[active[~inside]] = done
        active, other = active[inside], other[inside]
    last = np.maximum.accumulate(np.where(~follows | ~compared, place, 0))
    prefix = np.where(compared, common[last] - (place - last), 0)
    repeated = starts & (prefix >= length)
    repeated[ahead[repeated]] = True
    return [repeated[b : b + max(0, s - length + 1)] for b, s in zip(begins.tolist(), sizes.tolist())]
