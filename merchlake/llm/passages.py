"""Fuzzy passages that documents share, by collinear chaining of k-mer seeds.

Texts meet at seeds, all three-word k-mers that two of them have, and must have ENOUGH_MEETINGS near each other. A
passage of 50 words with a fifth of them edited still has 18 in common, so seeds lose none. Most seeds stand in one
text only; so that these don't cost a row each, tasks send their seeds packed, by ranges of hashes, and only what a
range finds in two texts becomes rows.

A seed of few texts is joined for every pair of them. Of the seeds of many texts those are enough, at each place,
that have ENOUGH_MEETINGS - 1 others at least as frequent near them: of the seeds that two texts have in common in a
passage, the rarest has as many in both. So a line that stands in many texts, but is too short for a passage, leads to
no pair, and what does is joined for every pair of texts, with one exception: texts in which the seed stands in the
same run of frequent seeds, of a passage's length, are copies there. Each is joined to the first and the last of them
(by key), and to every text that has the seed in another run.

Anchors of a pair of texts, its four-word k-mers, are chained. Every place of one in the text to be cut counts, in the
source the first. They are sorted along one text, a Fenwick tree over the other gives the best chain
to continue, gaps being paid for by their length. Chains are aligned word by word, bridging edits, extended
beyond their ends, and kept if they are long and alike enough.

The text with the smaller key is the source and keeps its passage, so cutting passages elsewhere never
loses the last copy. Further copies of a whole text are passages of the first one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm.alignment import align
from merchlake.llm.text import packed_texts, spare_name
from merchlake.llm.words import Words, chunks, mix, shingles, words_of
from merchlake.session import delete, fresh_path, scratch

SEED_WORDS = 4
# Texts meet at shorter seeds, of which a passage has more: a line of ten words has half as many as are needed.
MEETING_WORDS = 3
# A seed of up to this many texts is joined for all pairs of them; of more, where others as frequent stand near it.
FEW_TEXTS = 8
# Seeds that a task packs at once, and bytes of all texts for each range of hashes.
PACKED_SEEDS, RANGE_BYTES = 1_500_000, 16 << 20
# Words of texts that a task keeps ready for their next pairs.
KNOWN_WORDS = 2_000_000
# Bytes of all texts for each group; a cell of pairs holds at most two groups, compressed.
GROUP_BYTES = 16 << 20
# Bytes that travel in one round of cells, as a multiple of the texts'.
ROUND_SHARE = 2
# Bits of a seed's hash; texts that meet by chance only are told apart later.
SEED_BITS = 48
# Anchors within a run are kept at places that leave these remainders up to the length of a seed.
THINNED = 24
MIN_WORDS = 50
SIMILARITY = 0.8
# n words of which a fifth is edited keep n / 5 - 3 seeds or more, seven of 50. Seven of them always lie this close.
ENOUGH_SEEDS, WITHIN_WORDS = 7, 72
# As many of three words: 2 n / 5 - 2 or more, 18 of 50; where a longer passage's edits are gathered, 17 lie this close.
ENOUGH_MEETINGS = 16
# What one seed is worth, and what a word of gap costs: a gap of this many words, both texts counted, uses up a seed.
SEED_WORTH = 120
# A gap between seeds must match at least half its words, unless it is this short.
SHORT_GAP = 16
# Beyond a chain's end, edits are bridged if this many words match after at most that many do not.
BRIDGE_MATCHES, BRIDGE_WORDS = 5, 3
# Where a passage would be too short otherwise, replaced words are bridged for as little as this.
REPLACED_MATCHES = 1

SPAN_SCHEMA = (
    "key bigint, source_key bigint, start bigint, end bigint, source_start bigint, source_end bigint, "
    "n_words bigint, similarity double"
)


def sliding(values: np.ndarray, width: int, best: np.ufunc, fill: int) -> np.ndarray:
    """best (minimum or maximum) of every ``width`` consecutive values."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, fill, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:count], ahead[width - 1 : width - 1 + count])


def seeds_of(words: Words, size: int = SEED_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and word number of each seed, at every place; texts shorter than a passage have none."""
    codes, whole = shingles(words, size)
    kept = np.flatnonzero(whole)
    kept = kept[np.diff(words.bounds)[words.text[kept]] >= MIN_WORDS]
    text = words.text[kept]
    return mix(codes[kept], 5) >> np.uint64(64 - SEED_BITS), text, kept - words.bounds[text]


# --- chains -----------------------------------------------------------------------------


class _PrefixBest:
    """A Fenwick tree: the best (value, number) at places up to a given one."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(float("-inf"), -1)] * (size + 1)

    def add(self, place: int, value: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            self.best[place] = max(self.best[place], value)
            place += place & -place

    def upto(self, place: int) -> tuple[float, int]:
        found = self.best[0]
        while place > 0:
            found = max(found, self.best[place])
            place -= place & -place
        return found


def chains(anchors: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Disjoint chains of at least two anchors, rising in both texts, the best first."""
    ordered = sorted(set(anchors))
    columns = sorted({y for _, y in ordered})
    tree, scores, before = _PrefixBest(len(columns)), [], []
    at = 0
    while at < len(ordered):
        end = at
        while end < len(ordered) and ordered[end][0] == ordered[at][0]:
            x, y = ordered[end]
            # Gap costs are linear, so that a chain's value less its cost up to here is one number.
            value, previous = tree.upto(bisect_left(columns, y))
            gained = value - (x + y)
            before.append(previous if gained > 0 else -1)
            scores.append(SEED_WORTH + max(0, gained))
            end += 1
        for n in range(at, end):  # anchors at one place of the first text don't follow each other
            x, y = ordered[n]
            tree.add(bisect_left(columns, y), (scores[n] + x + y, n))
        at = end
    used, found = [False] * len(ordered), []
    for n in sorted(range(len(ordered)), key=lambda n: (-scores[n], n)):
        chain = []
        while n >= 0 and not used[n]:
            used[n] = True
            chain.append(ordered[n])
            n = before[n]
        if len(chain) > 1:
            found.append(chain[::-1])
    return found


# Words left out of either text, and how many must match behind them; the shortest bridges come first.
_BRIDGES = [
    (x, total - x, BRIDGE_MATCHES)
    for total in range(1, 2 * BRIDGE_WORDS + 1)
    for x in range(total + 1)
    if max(x, total - x) <= BRIDGE_WORDS
]


def _extend(a: np.ndarray, b: np.ndarray, replaced: int) -> list[tuple[int, int, int]]:
    """Words of a and of b taken in, and how many match, at each stop when going on from the front of both."""
    i = j = matched = 0
    stops = []
    while True:
        size = min(len(a) - i, len(b) - j)
        unequal = np.flatnonzero(a[i : i + size] != b[j : j + size])
        run = int(unequal[0]) if len(unequal) else size
        i, j, matched = i + run, j + run, matched + run
        stops.append((i, j, matched))
        ahead, across = (side[n : n + BRIDGE_WORDS + BRIDGE_MATCHES].tolist() for side, n in ((a, i), (b, j)))
        for x, y, least in (*_BRIDGES, *((n, n, replaced) for n in range(1, BRIDGE_WORDS + 1))):
            if len(ahead) >= x + least and ahead[x : x + least] == across[y : y + least]:
                i, j = i + x, j + y
                break
        else:
            return stops


def _gap_matches(a: np.ndarray, b: np.ndarray) -> int | None:
    """Words that match between two anchors, None if they are too few."""
    if len(a) == len(b) and np.array_equal(a, b):
        return len(a)
    longer = max(len(a), len(b))
    most_edits = longer if longer <= SHORT_GAP else longer // 2
    # No alignment matches more words than there are common ones, nor makes up for a greater difference in length.
    if longer - min(len(a), len(b)) > most_edits:
        return None
    if longer > SHORT_GAP and (Counter(a.tolist()) & Counter(b.tolist())).total() < longer - most_edits:
        return None
    runs = align(a, b, most_edits)
    return None if runs is None else sum(length for _, _, length in runs)


def _stretches(chain: list[tuple[int, int]], a: np.ndarray, b: np.ndarray) -> list[list[int]]:
    """[start, end in a, start, end in b, matches] of the parts of a chain that align well."""
    found: list[list[int]] = []
    for x, y in chain:
        if found:
            _, i, _, j, _ = last = found[-1]
            if x - i == y - j and x <= i:  # overlaps the seed before, on its diagonal
                grown = max(0, x + SEED_WORDS - i)
                last[1], last[3], last[4] = i + grown, j + grown, last[4] + grown
                continue
            if x < i or y < j:
                continue  # overlaps it on another diagonal
            matched = _gap_matches(a[i:x], b[j:y])
            if matched is not None:
                last[1], last[3] = x + SEED_WORDS, y + SEED_WORDS
                last[4] += matched + SEED_WORDS
                continue
        found.append([x, x + SEED_WORDS, y, y + SEED_WORDS, SEED_WORDS])
    return found


def passages_of(chain: list[tuple[int, int]], a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """(start, end in a, start, end in b, similarity) of the passages that a chain leads to."""
    result = []
    for start, end, other, other_end, matched in _stretches(chain, a, b):
        for replaced in (BRIDGE_MATCHES, REPLACED_MATCHES):
            before = _extend(a[:start][::-1], b[:other][::-1], replaced)
            after = _extend(a[end:], b[other_end:], replaced)
            while True:  # stops that make the passage too unlike are given back
                (i, j, more), (k, m, most) = before[-1], after[-1]
                alike = (matched + more + most) / max(end + k - start + i, other_end + m - other + j)
                if alike >= SIMILARITY or len(before) == len(after) == 1:
                    break
                max(before, after, key=len).pop()
            if min(end + k - start + i, other_end + m - other + j) >= MIN_WORDS and alike >= SIMILARITY:
                result.append((start - i, end + k, other - j, other_end + m, alike))
                break
    return result


# --- Spark ------------------------------------------------------------------------------


def _key(text: Column) -> Column:
    return F.xxhash64(text)


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _packed(seed: np.ndarray, key: np.ndarray, word: np.ndarray, many: np.ndarray) -> bytes:
    """Seeds in rising order with the keys and words they stand at, as compressed bytes."""
    at, keys = pd.factorize(key)  # by hash, as sorting the keys would cost as much as sorting the seeds
    # Numbers are written byte by byte of equal rank: the high ones are mostly zero.
    columns = [np.diff(seed, prepend=np.uint64(0)), at.astype(np.uint32), word.astype(np.uint32)]
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    head = np.array([len(seed), len(keys)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, keys.tobytes(), np.packbits(many).tobytes(), *planes]))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, n_keys = data[:16].view(np.int64).tolist()
    at = 16 + 8 * n_keys
    keys, many = data[16:at].view(np.int64), np.unpackbits(data[at : at + -(-n // 8)], count=n).astype(bool)
    at += -(-n // 8)
    columns = []
    for kind in (np.uint64, np.uint32, np.uint32):
        width = np.dtype(kind).itemsize
        columns.append(np.ascontiguousarray(data[at : at + width * n].reshape(width, n).T).view(kind).reshape(n))
        at += width * n
    return np.cumsum(columns[0], dtype=np.uint64), keys[columns[1]], columns[2].astype(np.int32), many


def _groups(seed: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows sorted by seed and text: each row's group of equal seeds, its text's rank in the group, and texts by group."""
    fresh = np.ones(len(seed), bool)
    fresh[1:] = seed[1:] != seed[:-1]
    other = fresh.copy()
    other[1:] |= text[1:] != text[:-1]
    group, number = np.cumsum(fresh) - 1, np.cumsum(other) - 1
    return group, number - number[np.flatnonzero(fresh)][group], np.bincount(group, weights=other).astype(np.int64)


def _pack_task(batches: Iterator[pa.RecordBatch], ranges: int, size: int) -> Iterator[pa.RecordBatch]:
    """range, many and packed: a task's seeds by range of hashes.

    Seeds of many texts of one task are sent apart, at any number of ranges, as they are known to be shared; of
    each one row stays as a mark for the other tasks.
    """
    width = np.uint64(-(-(1 << SEED_BITS) // ranges))
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    seen: set[int] = set()

    def settle() -> pa.RecordBatch:
        seed, key, word = (np.concatenate(columns) for columns in zip(*parts))
        order = np.argsort(seed, kind="stable")  # a text's rows come together, and so stay within a seed
        seed, key, word = seed[order], key[order], word[order]
        group, _, texts = _groups(seed, key)
        many = texts[group] > FEW_TEXTS
        first = np.ones(len(seed), bool)
        first[1:] = group[1:] != group[:-1]
        rows: list[tuple[int, bool, bytes]] = []
        kept = np.flatnonzero(~many | first)
        at = (seed[kept] // width).astype(np.int64)
        edges = np.flatnonzero(np.diff(at, prepend=-1))
        for low, high in zip(edges, np.append(edges[1:], len(kept))):
            own = kept[low:high]
            rows.append((int(at[low]), False, _packed(seed[own], key[own], word[own], many[own])))
        if many.any():
            rows.append((int(seed[0]) % ranges, True, _packed(seed[many], key[many], word[many], many[many])))
        kinds = (pa.int32(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kind) for n, kind in enumerate(kinds)], ["range", "many", "packed"])

    for batch in batches:
        pairs = zip(batch.column("key").to_pylist(), batch.column("text").to_pylist())
        fresh = {key: text.encode() for key, text in pairs if key not in seen}  # copies within the part count once
        seen.update(fresh)
        keys, texts = np.fromiter(fresh, np.int64, len(fresh)), list(fresh.values())
        for low, high in chunks(texts):
            hashes, text, word = seeds_of(words_of(texts[low:high]), size)
            parts.append((hashes, keys[low + text], word.astype(np.int32)))
            if sum(len(part[0]) for part in parts) >= PACKED_SEEDS:
                yield settle()
                parts.clear()
                seen.clear()
    if sum(len(part[0]) for part in parts):
        yield settle()


_MEETINGS = "seed bigint, key bigint, word int, source_key bigint, source_word int"


def _meetings(columns: list[np.ndarray], source: list[np.ndarray] | None = None) -> pa.RecordBatch:
    seed, key, word = columns
    arrays = [pa.array(seed.view(np.int64)), pa.array(key), pa.array(word.astype(np.int32))]
    for kind, values in zip((pa.int64(), pa.int32()), source or (None, None)):
        arrays.append(pa.nulls(len(key), kind) if values is None else pa.array(values, kind))
    return pa.RecordBatch.from_arrays(arrays, ["seed", "key", "word", "source_key", "source_word"])


def _meet_task(batches: Iterator[pa.RecordBatch], every: bool = False) -> Iterator[pa.RecordBatch]:
    """All pairs of the texts of a seed of few texts, as anchors, and the rows of seeds of many texts without a source.

    Every place of a text meets the first place in a source, and with ``every`` each further one in it the text's first.
    Most seeds stand alone in their range; these go before the others are sorted by text and word.
    """
    parts: list[tuple] = []
    last = None

    def settle() -> Iterator[pa.RecordBatch]:
        seed, key, word, many = (np.concatenate(columns) for columns in zip(*parts))
        order = np.argsort(seed, kind="stable")  # merges runs that are in order
        repeated = np.diff(seed[order]) == 0
        shared = order[np.append(repeated, False) | np.insert(repeated, 0, False) | many[order]]
        seed, key, word, many = (c[shared] for c in (seed, key, word, many))
        order = np.lexsort((word, key, seed))
        seed, key, word, many = (c[order] for c in (seed, key, word, many))
        group, rank, texts = _groups(seed, key)
        marked = np.bincount(group, weights=many) > 0
        most = (texts > FEW_TEXTS) | marked
        yield _meetings([c[most[group]] for c in (seed, key, word)])
        few = np.flatnonzero((texts > 1)[group] & ~most[group])
        # The first row of each text of a group, and how many texts come before a row's own.
        firsts = few[np.flatnonzero(np.diff(group[few] * (FEW_TEXTS + 1) + rank[few], prepend=-1))]
        starts = np.searchsorted(group[firsts], group[few])
        sources = np.repeat(starts, rank[few]) + _counted(rank[few])
        own, source = np.repeat(few, rank[few]), firsts[sources]
        yield _meetings([seed[own], key[own], word[own]], [key[source], word[source]])
        if every:
            again = ~np.isin(few, firsts)
            later = (texts[group] - 1 - rank)[few[again]]
            own = firsts[np.repeat((starts + rank[few] + 1)[again], later) + _counted(later)]
            source = np.repeat(few[again], later)
            yield _meetings([seed[own], key[own], word[own]], [key[source], word[source]])

    for batch in batches:
        for at, many, blob in zip(*(batch.column(name).to_pylist() for name in ("range", "many", "packed"))):
            if at != last and parts:
                yield from settle()
                parts.clear()
            last = at
            if many:
                yield _meetings(list(_unpacked(blob)[:3]))
            else:
                parts.append(_unpacked(blob))
    if parts:
        yield from settle()


def _counted(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each size, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _seed_meetings(keyed: DataFrame, size: int = SEED_WORDS, every: bool = False) -> DataFrame:
    """Anchors of seeds of few texts, and seeds of many texts without a source."""
    n_bytes = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-n_bytes // RANGE_BYTES))
    packed = keyed.mapInArrow(lambda batches: _pack_task(batches, ranges, size), "range int, many boolean, packed binary")
    return packed.repartition("range").sortWithinPartitions("range").mapInArrow(lambda batches: _meet_task(batches, every), _MEETINGS)


_CODE = np.int64(1) << 32  # a place is below it


def _dense(row: np.ndarray, place: np.ndarray, counts: np.ndarray, enough: int, size: int) -> np.ndarray:
    """Rows that have ``enough`` of their seeds of ``size`` words within WITHIN_WORDS words, one that counts among them."""
    code, at = np.unique(row * _CODE + place, return_inverse=True)
    own = np.zeros(len(code), bool)
    own[at[counts]] = True
    first = np.arange(len(code) - enough + 1)
    last = first + enough - 1
    near = code[last] - code[first] <= WITHIN_WORDS - size  # rows lie further apart
    before = np.concatenate([[0], np.cumsum(own)])
    return np.unique(code[first[near & (before[last + 1] > before[first])]] // _CODE)


def _list(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Of a column of lists of numbers: the row of each number, and the number."""
    lists = batch.column(name)
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(batch.num_rows), sizes), lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _possible(pairs: DataFrame, common: DataFrame, side: str, places: str) -> DataFrame:
    """The pairs whose ``places`` in one text can lie in a passage: seeds in common or frequent ones are near enough."""
    columns = pairs.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (own, place), (other, frequent) = _list(batch, places), _list(batch, "common")
            counts = np.arange(len(own) + len(other)) < len(own)
            kept = _dense(np.concatenate([own, other]), np.concatenate([place, frequent]), counts, ENOUGH_MEETINGS, MEETING_WORDS)
            yield batch.select(columns).take(pa.array(kept))

    there = common.withColumnRenamed("key", side)
    return pairs.join(there, side, "left").select(*columns, "common").mapInArrow(task, pairs.schema)


def _telling(
    seed: np.ndarray, n: np.ndarray, text: np.ndarray, word: np.ndarray, enough: int = ENOUGH_SEEDS, size: int = SEED_WORDS
) -> np.ndarray:
    """Of places sorted by text and word, those with enough others of seeds at least as frequent near them."""
    rank = np.empty(len(seed), np.int64)
    order = np.lexsort((seed, n))
    fresh = np.ones(len(seed), bool)
    fresh[1:] = np.diff(seed[order]) != 0
    rank[order] = np.cumsum(fresh)
    others = np.zeros(len(seed), np.int64)
    for ahead in range(1, WITHIN_WORDS - size + 1):  # places of a text are different words
        near = (text[ahead:] == text[:-ahead]) & (word[ahead:] - word[:-ahead] <= WITHIN_WORDS - size)
        if not near.any():
            break
        others[:-ahead] += near & (rank[ahead:] >= rank[:-ahead])
        others[ahead:] += near & (rank[:-ahead] >= rank[ahead:])
    return others >= enough - 1


def _runs(seed: np.ndarray, text: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Of each place the code of the run of frequent seeds it stands in, 0 if that is shorter than a passage."""
    fresh = np.ones(len(seed), bool)
    fresh[1:] = (np.diff(word) != 1) | (np.diff(text) != 0)
    starts = np.flatnonzero(fresh)
    run = np.cumsum(fresh) - 1
    sizes = np.diff(np.append(starts, len(seed)))
    codes = np.add.reduceat(mix(seed.view(np.uint64) + mix(np.arange(len(seed)) - starts[run], 1)), starts).view(np.int64)
    return np.where(sizes > MIN_WORDS - MEETING_WORDS, codes | 1, 0)[run]


def _telling_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """seed, key, run and the telling seed one word before, if any, of a text's telling places, of (key, places)."""
    for batch in batches:
        lists = batch.column("places")
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        columns = (lists.flatten().field(name).to_numpy(zero_copy_only=False) for name in ("word", "seed", "n"))
        word, seed, n = (np.ascontiguousarray(c).astype(np.int64) for c in columns)
        text = np.repeat(np.arange(batch.num_rows), sizes)
        kept = _telling(seed, n, text, word, ENOUGH_MEETINGS, MEETING_WORDS)
        follows = np.zeros(len(seed), bool)
        follows[1:] = kept[:-1] & (np.diff(word) == 1) & (np.diff(text) == 0)
        before = np.where(follows, np.roll(seed, 1), -1)
        runs, key = _runs(seed, text, word), batch.column("key").to_numpy(zero_copy_only=False)[text]
        columns = [pa.array(c[kept]) for c in (seed, key, runs, before)]
        yield pa.RecordBatch.from_arrays(columns, ["seed", "key", "run", "before"])


def _frequent_pairs(seeds: DataFrame) -> DataFrame:
    """key and source_key of the texts that may share a passage whose common seeds are all frequent, of (seed, key, word).

    Two texts meet at the first telling seed of each stretch that they have in common, not at every one.
    """
    counted = seeds.join(seeds.groupBy("seed").agg(F.count_distinct("key").alias("n")), "seed")
    listed = counted.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("word", "seed", "n"))).alias("places"))
    telling = listed.mapInArrow(_telling_task, "seed bigint, key bigint, run bigint, before bigint").distinct()
    telling = _written(telling, "telling")
    loners, members = telling.where("run = 0"), telling.where("run <> 0")

    def meeting(one: DataFrame, other: DataFrame, condition: str) -> DataFrame:
        others = other.select("seed", *[F.col(c).alias(f"other_{c}") for c in other.columns if c != "seed"])
        return one.join(others, "seed").where("before <> other_before OR before = -1").where(condition)

    copies = members.select("run", "key").distinct()
    ends = copies.groupBy("run").agg(F.array(F.min("key"), F.max("key")).alias("ends"))
    runs = members.select("seed", "run", "before").distinct()
    crossed = meeting(runs, runs, "run < other_run").select("run", "other_run").distinct()
    met = [
        meeting(loners, loners, "key > other_key"),
        meeting(loners, members, "key <> other_key"),
        copies.join(ends, "run").withColumn("other_key", F.explode("ends")),
        crossed.join(copies, "run").join(copies.select(F.col("run").alias("other_run"), F.col("key").alias("other_key")), "other_run"),
    ]
    pairs = reduce(DataFrame.unionByName, [m.select("key", "other_key") for m in met]).where("key <> other_key")
    return pairs.select(F.greatest("key", "other_key").alias("key"), F.least("key", "other_key").alias("source_key")).distinct()


def _chainable(pair: np.ndarray, x: np.ndarray, y: np.ndarray, n_pairs: int) -> np.ndarray:
    """Which pairs have two anchors near enough to be chained, neither before the other in one text and behind it in the other."""
    order = np.lexsort((y, x, pair))
    pair, x, y = pair[order], x[order], y[order]
    along, across = np.diff(x), np.diff(y)
    found = np.zeros(n_pairs, bool)
    found[pair[1:][(pair[1:] == pair[:-1]) & (along > 0) & (across > 0) & (along + across < SEED_WORTH)]] = True
    bounds = np.searchsorted(pair, np.arange(n_pairs + 1))
    for n in np.flatnonzero(~found & (np.diff(bounds) > 2)):  # these may still chain with others between them
        own = slice(bounds[n], bounds[n + 1])
        found[n] = bool(chains(list(zip(x[own].tolist(), y[own].tolist()))))
    return found


def _thinned(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each run of anchors that overlap on one diagonal the first, the last and some between."""
    order = np.lexsort((x, y - x))
    x, y = x[order], y[order]
    joined = (np.diff(y - x) == 0) & (np.diff(x) <= SEED_WORDS)
    inside = np.append(joined, False) & np.insert(joined, 0, False) & (x % THINNED > SEED_WORDS)
    return x[~inside], y[~inside]


def anchored_pairs(keyed: DataFrame) -> DataFrame:
    """key and source_key of the pairs of texts that may share a passage."""
    met = _written(_seed_meetings(keyed, MEETING_WORDS, every=True), "meetings")
    seeds = _written(met.where(F.col("source_key").isNull()).select("seed", "key", "word").distinct(), "frequent")
    # Dealt by text, so that its frequent seeds are joined where its pairs are.
    pairs = met.where(F.col("source_key").isNotNull()).repartition("key").groupBy("key", "source_key")
    pairs = pairs.agg(F.collect_set("word").alias("words"), F.collect_set("source_word").alias("source_words"))
    # A text's list is no longer than the text.
    common = _written(seeds.groupBy("key").agg(F.collect_set("word").alias("common")), "common")
    pairs = _written(_possible(pairs, common, "key", "words").select("key", "source_key", "source_words"), "possible")
    pairs = _written(_possible(pairs, common, "source_key", "source_words").select("key", "source_key"), "possible")
    return pairs.unionByName(_written(_frequent_pairs(seeds), "frequent-pairs")).distinct()


def _by_group(pairs: DataFrame, groups: int) -> DataFrame:
    """The pairs with the groups their texts fall into by key, written by that of the text to be cut."""
    row, column = (F.pmod(F.xxhash64(name), F.lit(groups)).cast("int") for name in ("key", "source_key"))
    placed = pairs.select("key", "source_key", row.alias("row"), column.alias("column"))
    path = fresh_path(pairs.sparkSession, "anchors")
    placed.repartition("row").write.partitionBy("row").parquet(path)
    return pairs.sparkSession.read.schema(placed.schema).parquet(path)


def _members(pairs: DataFrame) -> DataFrame:
    """The texts of each cell of pairs, once each."""
    return pairs.select("row", "column", F.explode(F.array("key", "source_key")).alias("key")).distinct()


def _rounds(pairs: DataFrame, texts: DataFrame) -> Iterator[DataFrame]:
    """(row, column, key, source_key, text) by cell: its texts, which have no source, and then its pairs, which have no text.

    A cell holds the pairs of two groups of texts, and a text travels once to each cell that has a pair of it, however
    many pairs that are. A round takes cells to which ROUND_SHARE times the texts' bytes travel, so that what is shuffled
    at once grows with the texts, not with their pairs.
    """
    sizes = texts.select("key", F.octet_length("text").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    # A number for each group of texts.
    sent = _members(pairs).join(sizes, "key").groupBy("row").agg(F.sum("size").alias("size")).collect()
    rows: list[int] = []
    size = 0
    for n, (row, own) in enumerate(sent, 1):
        rows.append(row)
        size += own
        if size < ROUND_SHARE * total and n < len(sent):
            continue
        own_pairs = pairs.where(F.col("row").isin(rows))
        met = _members(own_pairs).join(texts, "key")
        found = met.select("row", "column", "key", F.lit(None).cast("bigint").alias("source_key"), "text")
        found = found.unionByName(own_pairs.withColumn("text", F.lit(None).cast("binary")))
        tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # bytes don't tell how many pairs a cell has
        yield found.repartition(tasks, "row", "column").sortWithinPartitions("row", "column", F.col("text").isNull(), "key", "source_key")
        rows, size = [], 0


def _chain_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The passages of each cell's pairs."""
    unpack = zstandard.ZstdDecompressor().decompress
    cell, packed, known, n_words = None, {}, {}, 0

    def seeded(key: int) -> _Seeded:
        nonlocal n_words
        if key not in known:
            if n_words > KNOWN_WORDS:
                known.clear()
                n_words = 0
            known[key] = _Seeded(unpack(packed[key]))
            n_words += len(known[key].words.hashes)
        return known[key]

    for batch in batches:
        found: list[tuple] = []
        for row, column, key, source_key, text in zip(*(c.to_pylist() for c in batch.columns)):
            if (row, column) != cell:
                cell = row, column
                packed.clear()
            if text is not None:
                packed[key] = text
            else:
                found += _pair_spans(key, source_key, seeded(key), seeded(source_key))
        columns = [pa.array([row[n] for row in found], pa.int64()) for n in range(7)]
        columns.append(pa.array([row[7] for row in found], pa.float64()))
        names = ["key", "source_key", "start", "end", "source_start", "source_end", "n_words", "similarity"]
        yield pa.RecordBatch.from_arrays(columns, names)


def spans(docs: DataFrame) -> DataFrame:
    """Passages between distinct texts, by the texts' keys; places are bytes, the source has the smaller key."""
    spark = docs.sparkSession
    keyed = docs.where(F.col("text").isNotNull()).select(_key(F.col("text")).alias("key"), F.col("text").cast("string"))
    path = fresh_path(spark, "spans")
    spark.createDataFrame([], SPAN_SCHEMA).write.parquet(path)
    with scratch(spark, "chains"):
        n_bytes = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        placed = fresh_path(spark, "pairs")
        with scratch(spark, "seeds"):  # seeds and links go as soon as the pairs are written
            found = anchored_pairs(keyed)
            found.write.parquet(placed)
        pairs = _by_group(spark.read.schema(found.schema).parquet(placed), max(1, -(-n_bytes // GROUP_BYTES)))
        delete(spark, placed)
        needed = pairs.select("key").unionByName(pairs.select(F.col("source_key").alias("key"))).distinct()
        texts = _written(
            packed_texts(keyed).join(needed, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")), "anchored-texts"
        )
        for cells in _rounds(pairs, texts):
            cells.mapInArrow(_chain_task, SPAN_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(SPAN_SCHEMA).parquet(path)


class _Seeded:
    """A text's words and its seeds, in rising order, with their places."""

    def __init__(self, text: bytes):
        self.words = words_of([text])
        seed, _, at = seeds_of(self.words)
        order = np.argsort(seed, kind="stable")
        self.seed, self.at = seed[order], at[order]


def _common(own: _Seeded, source: _Seeded) -> tuple[np.ndarray, np.ndarray]:
    """Anchors: every place in ``own`` of a seed that both have, with its first place in ``source`` and the one of equal number.

    The places of ``source`` are counted anew when they run out, so that a text of few words repeated is covered. Where
    words repeat at once, only places of equal number are anchors.
    """
    shorter, longer = sorted((own, source), key=lambda side: len(side.seed))
    fresh = np.ones(len(shorter.seed), bool)
    fresh[1:] = shorter.seed[1:] != shorter.seed[:-1]
    seed = shorter.seed[fresh]
    seed = seed[np.append(longer.seed, np.uint64(0))[np.searchsorted(longer.seed, seed)] == seed]
    (low, high), (first, end) = ([np.searchsorted(text.seed, seed, side) for side in ("left", "right")] for text in (own, source))
    number = _counted(high - low)
    each = np.repeat(np.arange(len(seed)), high - low)
    x, again = own.at[low[each] + number], number % (end - first)[each]
    further = again > 0
    plain = ~further | (np.diff(x, prepend=0) > SEED_WORDS)
    at = np.append(first[each][plain], (first[each] + again)[further])
    return np.append(x[plain], x[further]), source.at[at]


def _pair_spans(key: int, source_key: int, own: _Seeded, source: _Seeded) -> Iterator[tuple]:
    x, y = _common(own, source)
    if not len(_dense(np.zeros(len(x), np.int64), x, np.ones(len(x), bool), ENOUGH_SEEDS, SEED_WORDS)):
        return
    if not _chainable(np.zeros(len(x), np.int64), x, y, 1)[0]:
        return
    a, b, (x, y) = own.words, source.words, _thinned(x, y)
    for chain in chains(list(zip(x.tolist(), y.tolist()))):
        for start, end, other, other_end, alike in passages_of(chain, a.hashes, b.hashes):
            places = (a.start[start], a.end[end - 1], b.start[other], b.end[other_end - 1], end - start)
            yield (key, source_key, *map(int, places), alike)


def _word_counts(rows: DataFrame) -> DataFrame:
    """doc_id, key, bytes and words of each text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.encode() for text in batch.column("text").to_pylist()]
            n = [np.diff(words_of(texts[low:high]).bounds) for low, high in chunks(texts)]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            counts = pa.array(np.concatenate([np.empty(0, np.int64), *n]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), sizes, counts], ["doc_id", "key", "size", "n"])

    return rows.select("doc_id", _key(F.col("text")).alias("key"), "text").mapInArrow(count, "doc_id bigint, key bigint, size bigint, n bigint")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, source_doc_id, the passage's bytes in both texts, its words and similarity: a row for each passage.

    Passages have at least 50 words, of which at least 80 % match in order. Of equal texts the one with the
    least id stands for all; the others have one row that is the whole text, if it is long enough. A null text
    has no passages; a null id comes after all others; other columns are ignored; an empty table gives an
    empty result.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("text").isNotNull())
    found = spans(rows)
    ids = _word_counts(rows)
    firsts = ids.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    whole = (
        ids.join(firsts.where("copies > 1"), "key")
        .where((F.col("n") >= MIN_WORDS) & ~F.col("doc_id").eqNullSafe(F.col("first")))
        .select(
            "doc_id",
            F.col("first").alias("source_doc_id"),
            F.lit(0).cast("bigint").alias("start"),
            F.col("size").cast("bigint").alias("end"),
            F.lit(0).cast("bigint").alias("source_start"),
            F.col("size").cast("bigint").alias("source_end"),
            F.col("n").cast("bigint").alias("n_words"),
            F.lit(1.0).alias("similarity"),
        )
    )
    own = firsts.select("key", F.col("first").alias("doc_id"))
    source = firsts.select(F.col("key").alias("source_key"), F.col("first").alias("source_doc_id"))
    near = found.join(own, "key").join(source, "source_key")
    return near.select(whole.columns).unionByName(whole)


def _cut(text: str, cuts: list[dict]) -> str:
    data, at, kept = text.encode(), 0, []
    for cut in sorted(cuts, key=lambda c: (c["start"], c["end"])):
        if cut["end"] > at:
            kept.append(data[at : max(at, cut["start"])])
            at = max(at, cut["end"])
    return b"".join([*kept, data[at:]]).decode()


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, their texts without the passages that a source keeps.

    Every copy of a text is cut alike; a text of which no word is left goes, a text without passages
    (null too) stays as it is.
    """
    columns, key, cuts = docs.columns, spare_name(docs, "key"), spare_name(docs, "cuts")
    found = (
        spans(docs.select("text"))
        .groupBy(F.col("key").alias(key))
        # A text's passages are disjoint or few: at most one for each of its seeds.
        .agg(F.collect_set(F.struct("start", "end")).alias(cuts))
    )
    joined = docs.withColumn(key, _key(F.col("text"))).join(found, key, "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = batch.column("text").to_pylist(), batch.column(cuts).to_pylist()
            left = [_cut(text, own) if own else text for text, own in zip(texts, removed)]
            stays = [not own or any(map(str.isalnum, text)) for text, own in zip(left, removed)]
            out = batch.select(columns)
            out = out.set_column(columns.index("text"), "text", pa.array(left, out.schema.field("text").type))
            yield out.filter(pa.array(stays, pa.bool_()))

    return joined.select(*[F.col(f"`{name}`") for name in columns], cuts).mapInArrow(cut, docs.schema)
