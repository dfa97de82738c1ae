"""Near-duplicate documents by Order MinHash, verified by banded alignment.

A document's k-mers are its five-word shingles, each labelled with how many equal ones came before it.
A sketch takes the k-mers with the smallest hashes and keeps them in text order, so that two documents
agree on it only where they share k-mers in the same order: the sketch follows edit similarity rather
than set similarity. Documents that agree on a sketch of two k-mers meet in a bucket. A small bucket
gives its pairs; in a larger one every document is first paired with the bucket's first and last only, and
the bucket is divided by longer sketches (four, then eight k-mers), which joins most of what belongs together.
Whatever large bucket is then still of several classes is compared in full: its documents are dealt to
blocks, and each pair of blocks is one small task that counts shared shingles by a matrix product and aligns
only what may be similar. The largest class of a bucket isn't compared with itself, so this work grows with
what the first step left apart, times the bucket.

Pairs are verified by aligning the two word sequences within a band of diagonals that widens by one for
each edit; the similarity is that of the shingles the alignment matches, out of all of both documents.
Verified pairs are joined to classes as connected components. Equal texts are one node throughout.

Whichever way, every pair that agrees on a sketch of two k-mers ends in one class or is compared. Per pair, ten sketches miss a similarity of 0.8 with probability (1 - 0.8 * 0.8)^10, about 4 in 100,000.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm.alignment import align
from merchlake.llm.components import components
from merchlake.llm.text import packed_texts, spare_name
from merchlake.llm.words import chunks, mix, shingles, words_of
from merchlake.session import fresh_path

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 10
DEPTHS = (2, 4, 8)
SMALL_BUCKET = 8
# Texts and bytes of a block of a large bucket, and the shingles a matrix product takes at once.
BLOCK_TEXTS, BLOCK_BYTES, PRODUCT_SHINGLES = 512, 4 << 20, 4096
# How many of the smallest hashes are looked at first; twice and more what a sketch takes.
_EXPECTED = 24


def text_key(text: Column) -> Column:
    """128-bit key of a text; equal just where the texts are."""
    return F.unhex(F.md5(text))


# --- sketches ---------------------------------------------------------------------------


def _labelled(codes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes of k-mers that tell the first, second, ... equal k-mer of a text apart."""
    order = np.lexsort((codes, text))
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[order][1:] != codes[order][:-1]) | (text[order][1:] != text[order][:-1])
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(codes)), 0))
    nth = np.empty(len(codes), np.uint64)
    nth[order] = np.arange(len(codes)) - first
    return mix(codes + mix(nth, 3))


def sketches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts that have k-mers, and for each of them SKETCHES x DEPTHS bucket numbers."""
    words = words_of(texts)
    codes, whole = shingles(words, SHINGLE)
    kmers, text = codes[whole], words.text[: len(codes)][whole]
    having, row, counts = np.unique(text, return_inverse=True, return_counts=True)
    result = np.zeros((len(having), SKETCHES, len(DEPTHS)), np.uint64)
    if not len(having):
        return having, result
    labelled = _labelled(kmers, row)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    deepest = DEPTHS[-1]
    limit = np.where(counts <= _EXPECTED, 2.0**64, _EXPECTED / counts * 2.0**64)
    limit = np.minimum(limit, 2.0**64 - 2048).astype(np.uint64)
    wanted = np.minimum(counts, deepest)
    for sketch in range(SKETCHES):
        hashes = mix(labelled, 11 + sketch)
        chosen = np.flatnonzero(hashes <= limit[row])
        for n in np.flatnonzero(np.bincount(row[chosen], minlength=len(having)) < wanted):
            chosen = chosen[row[chosen] != n]  # too few below the limit: take all of this text's
            chosen = np.concatenate([chosen, np.arange(first[n], first[n] + counts[n])])
        chosen = chosen[np.lexsort((hashes[chosen], row[chosen]))]
        start = np.searchsorted(row[chosen], np.arange(len(having)))
        rank = np.arange(len(chosen)) - start[row[chosen]]
        chosen, rank = chosen[rank < deepest], rank[rank < deepest]
        place = np.full((len(having), deepest), len(kmers), np.int64)
        place[row[chosen], rank] = chosen
        padded = np.append(labelled, np.uint64(0))
        for level, depth in enumerate(DEPTHS):
            in_order = padded[np.sort(place[:, :depth], axis=1)]
            found = np.full(len(having), sketch * len(DEPTHS) + level, np.uint64)
            for column in in_order.T:
                found = mix(found * np.uint64(0x9E3779B97F4A7C15) + column)
            result[:, sketch, level] = found
    return having, result


def _sketch_table(keyed: DataFrame) -> DataFrame:
    """key, bucket numbers (SKETCHES arrays of DEPTHS) and bytes, once for each distinct text with k-mers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.encode() for text in batch.column("text").to_pylist()]
            for first, end in chunks(texts):
                having, found = sketches(texts[first:end])
                flat = pa.array(found.view(np.int64).reshape(-1))
                inner = pa.FixedSizeListArray.from_arrays(flat, len(DEPTHS)).cast(pa.list_(pa.int64()))
                outer = pa.FixedSizeListArray.from_arrays(inner, SKETCHES).cast(pa.list_(pa.list_(pa.int64())))
                keys = batch.column("key").slice(first, end - first).take(pa.array(having))
                sizes = pa.array([len(texts[first + n]) for n in having], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, outer, sizes], ["key", "sketches", "size"])

    found = keyed.mapInArrow(sketch, "key binary, sketches array<array<bigint>>, size bigint")
    return found.groupBy("key").agg(F.first("sketches").alias("sketches"), F.first("size").alias("size"))


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def candidate_pairs(sketched: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of keys that meet in a bucket."""
    current = sketched.select("key", F.explode("sketches").alias("b"))
    pairs = []
    for level in range(len(DEPTHS)):
        bucket = F.col("b")[level].alias("bucket")
        sizes = (
            current.groupBy(bucket)
            .agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .where("n > 1")
        )
        met = _written(current.select("key", "b", bucket).join(sizes, "bucket"), f"buckets-{level}")
        small = met.where(F.col("n") <= SMALL_BUCKET).groupBy("bucket").agg(F.collect_list("key").alias("keys"))
        pairs.append(
            small.select(F.explode("keys").alias("a"), "keys")
            .select("a", F.explode("keys").alias("b"))
            .where(F.col("a") < F.col("b"))
        )
        large = met.where(F.col("n") > SMALL_BUCKET)
        pairs.append(large.select(F.col("low").alias("a"), F.col("key").alias("b")).where(F.col("a") < F.col("b")))
        pairs.append(large.select(F.col("key").alias("a"), F.col("high").alias("b")).where(F.col("a") < F.col("b")))
        current = large.select("key", "b")
    return reduce(DataFrame.unionByName, pairs).distinct()


# --- verification -----------------------------------------------------------------------


def aligned_similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """Share of five-word shingles matched by the best alignment of two word sequences, or 0 if below ``least``."""
    total = len(a) + len(b) - 2 * (SHINGLE - 1)
    if min(len(a), len(b)) < SHINGLE:
        return 0.0
    # m matched of n1 + n2 - m: at least this many, and every word that is not matched takes one away.
    needed = least * total / (1 + least)
    runs = align(a, b, int(max(len(a), len(b)) - needed))
    matched = sum(max(0, length - SHINGLE + 1) for _, _, length in runs or ())
    found = matched / (total - matched)
    return found if found >= least else 0.0


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles in common, counted as often as both have them: no alignment matches more."""
    left, n = np.unique(a, return_counts=True)
    right, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def similar(a: bytes, b: bytes, least: float = SIMILARITY) -> bool:
    words = words_of([a, b])
    left, right = words.hashes[: words.bounds[1]], words.hashes[words.bounds[1] :]
    codes, whole = shingles(words, SHINGLE)
    side = words.text[: len(codes)]
    first, second = codes[whole & (side == 0)], codes[whole & (side == 1)]
    if not len(first) or not len(second):
        return False
    shared = _shared(first, second)
    if shared < least * (len(first) + len(second) - shared):
        return False
    return aligned_similarity(left, right, least) >= least


def verified(pairs: DataFrame, keyed: DataFrame) -> DataFrame:
    """The pairs (a, b) of keys whose texts are similar."""
    needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    # Copies collapse before the shuffle; only texts that are in a pair go on.
    texts = _written(
        packed_texts(keyed).groupBy("key").agg(F.first("text").alias("text")).join(needed, "key", "left_semi"), "paired-texts"
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
            same = [similar(unpack(a), unpack(b)) for a, b in zip(left, right)]
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    first = texts.select(F.col("key").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("key").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        check, "a binary, b binary"
    )


# --- large buckets of several classes -----------------------------------------------------


def open_cells(sketched: DataFrame, roots: DataFrame) -> DataFrame:
    """bucket, low and high block, and the block, key and root of each text of the large buckets with several roots.

    A text has a row for each pair of blocks that its own is part of; blocks of a bucket's largest class
    aren't paired with each other.
    """
    rooted = sketched.join(roots, sketched["key"] == roots["node"], "left").select(
        "key", F.coalesce("root", "key").alias("root"), "size", F.transform("sketches", lambda b: b[0]).alias("b")
    )
    met = rooted.select("key", "root", "size", F.explode("b").alias("bucket"))
    by_root = met.groupBy("bucket", "root").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    whole = by_root.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("size").alias("bytes"), F.max(F.struct("n", "size", "root")).alias("major")
    )

    def blocks(texts: Column, size: Column) -> Column:
        return F.greatest(F.ceil(texts / BLOCK_TEXTS), F.ceil(size / BLOCK_BYTES), F.lit(1))

    several = whole.where((F.col("n") > SMALL_BUCKET) & (F.col("n") > F.col("major.n"))).select(
        "bucket",
        F.col("major.root").alias("major"),
        blocks(F.col("n") - F.col("major.n"), F.col("bytes") - F.col("major.size")).alias("minors"),
        blocks(F.col("major.n"), F.col("major.size")).alias("majors"),
    )
    minor = F.col("root") != F.col("major")
    dealt = met.join(several, "bucket").withColumn(
        "block",
        F.when(minor, F.pmod(F.xxhash64("key"), "minors")).otherwise(F.col("minors") + F.pmod(F.xxhash64("key"), "majors")),
    )
    others = F.sequence(F.lit(0).cast("bigint"), F.col("minors") + F.when(minor, F.col("majors")).otherwise(0) - 1)
    return dealt.withColumn("other", F.explode(others)).select(
        "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "key", "root"
    )


def _shared_counts(row: np.ndarray, codes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shingles in common of the texts ``left`` with the texts ``right``; ``codes`` are labelled, ``row`` their texts."""
    _, number, times = np.unique(codes, return_inverse=True, return_counts=True)
    common = times > 1
    number, row = (np.cumsum(common) - 1)[number[common[number]]], row[common[number]]
    order = np.argsort(number, kind="stable")
    number, row = number[order], row[order]
    n_texts = 1 + max(left.max(), right.max())
    result = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(common.sum()), PRODUCT_SHINGLES):
        start, end = np.searchsorted(number, [first, first + PRODUCT_SHINGLES])
        has = np.zeros((n_texts, PRODUCT_SHINGLES), np.float32)
        has[row[start:end], number[start:end] - first] = 1
        result += has[left] @ has[right].T
    return result


def _cell_links(cell: pa.Table) -> pa.Table:
    """Similar pairs (a < b) of a cell's two blocks that join different roots; pairs that meet in a sketch before are left to it."""
    keys, roots = cell.column("key").to_pylist(), cell.column("root").to_pylist()
    bucket, low, high = (cell.column(name)[0].as_py() for name in ("bucket", "low", "high"))
    block, met = cell.column("block").to_numpy(), np.array(cell.column("b").to_pylist(), np.int64)
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    found = []
    if len(left) and len(right):
        unpack = zstandard.ZstdDecompressor().decompress
        words = words_of([unpack(text) for text in cell.column("text").to_pylist()])
        codes, whole = shingles(words, SHINGLE)
        codes, row = codes[whole], words.text[: len(codes)][whole]
        counts = np.bincount(row, minlength=len(keys))
        shared = _shared_counts(row, _labelled(codes, row), left, right)
        maybe = shared >= SIMILARITY * (counts[left][:, None] + counts[right][None, :] - shared) - 1e-3
        joined: dict[bytes, bytes] = {}

        def root(node: bytes) -> bytes:
            while node in joined:
                node = joined[node]
            return node

        for i, j in zip(*np.nonzero(maybe)):
            x, y = int(left[i]), int(right[j])
            if low == high and x >= y or met[x][np.argmax(met[x] == met[y])] != bucket:
                continue
            first, second = root(roots[x]), root(roots[y])
            if first == second:
                continue  # in one class already, or by a pair of this cell
            a, b = (words.hashes[words.bounds[n] : words.bounds[n + 1]] for n in (x, y))
            if aligned_similarity(a, b, SIMILARITY):
                joined[first] = second
                found.append((min(keys[x], keys[y]), max(keys[x], keys[y])))
    return pa.table({"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())})


def links_left(sketched: DataFrame, roots: DataFrame, keyed: DataFrame) -> DataFrame | None:
    """Similar pairs (a, b) of different roots that share a large bucket; None if no large bucket has several roots."""
    cells = _written(open_cells(sketched, roots), "cells")
    if cells.isEmpty():
        return None
    needed = cells.select("key").distinct()
    firsts = sketched.select("key", F.transform("sketches", lambda b: b[0]).alias("b"))
    texts = _written(
        packed_texts(keyed.join(needed, "key", "left_semi")).groupBy("key").agg(F.first("text").alias("text")).join(firsts, "key"),
        "open-texts",
    )
    found = cells.join(texts, "key").groupBy("bucket", "low", "high").applyInArrow(_cell_links, "a binary, b binary")
    return _written(found, "links-left")


# --- classes ----------------------------------------------------------------------------


def class_roots(keyed: DataFrame) -> DataFrame:
    """(node, root) of distinct texts (key, text) that are near a text with a smaller key."""
    sketched = _written(_sketch_table(keyed), "sketches")
    pairs = _written(candidate_pairs(sketched), "pairs")
    near = _written(verified(pairs, keyed), "near")
    roots = components(near)
    more = links_left(sketched, roots, keyed)
    return roots if more is None or more.isEmpty() else components(near.unionByName(more))


def _rooted(ids: DataFrame, roots: DataFrame) -> DataFrame:
    """key, root, least id and number of rows of each distinct text of ``ids`` (doc_id, key)."""
    texts = ids.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"))
    return texts.join(roots, texts["key"] == roots["node"], "left").select(
        "key", F.coalesce("root", "key").alias("root"), "low", "n"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, of which each class (see ``classes``) keeps one.

    The row with the least id stays; a null id stays only where its class has no other. Of rows alike in id
    and text one stays. Rows with a null text all stay.
    """
    key, first, low = (spare_name(docs, name) for name in ("key", "first", "low"))
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    ids = rows.select("doc_id", text_key(F.col("text")).alias("key"))
    roots = class_roots(rows.where(F.col("text").isNotNull()).select(text_key(F.col("text")).alias("key"), "text"))
    # Nulls sort last: a class's first text is one with the least id.
    rank = F.struct(F.col("low").isNull(), F.col("low"), F.col("key"))
    firsts = _rooted(ids, roots).groupBy("root").agg(F.min(rank).alias("first"))
    firsts = _written(firsts.select("first.key", "first.low"), "firsts")
    # Rows that repeat a kept row in id and text; as a rule there are none, and the texts needn't be shuffled for them.
    repeats = ids.groupBy("key", "doc_id").agg(F.count("*").alias("n")).where("n > 1").join(firsts, "key")
    repeated = repeats.where(F.col("doc_id").eqNullSafe(F.col("low"))).limit(1).count() > 0
    marked = firsts.select(F.col("key").alias(first), F.col("low").alias(low))
    keyed = docs.withColumn(key, text_key(F.col("text")))
    kept = keyed.join(marked, F.col(key) == F.col(first), "left").where(
        F.col("text").isNull() | (F.col(first).isNotNull() & F.col("doc_id").eqNullSafe(F.col(low)))
    )
    if repeated:
        kept = kept.where(F.col("text").isNull()).unionByName(
            kept.where(F.col("text").isNotNull()).dropDuplicates(["doc_id", key])
        )
    return kept.select(*[F.col(f"`{name}`") for name in docs.columns])


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least id in the class), class_size and whether the row is the one to keep.

    One row per row of ``docs``. Equal texts are in one class, and so are texts linked by similarity;
    a null text is in a class of its own, texts of fewer than five words only with equal ones. The kept
    row of a class is one with the least id; rows that repeat it in id and text are marked alike. A null
    id is greater than all others. Other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = rows.where(F.col("text").isNotNull()).select(text_key(F.col("text")).alias("key"), "text")
    roots = class_roots(keyed)
    ids = rows.select("doc_id", text_key(F.col("text")).alias("key"))
    rooted = _rooted(ids, roots)
    whole = rooted.groupBy("root").agg(F.min("low").alias("class_id"), F.sum("n").alias("class_size"))
    by_key = rooted.join(whole, "root").select("key", "class_id", "class_size")
    return ids.join(by_key, "key", "left").select(
        "doc_id",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce(F.col("doc_id") == F.col("class_id"), F.col("key").isNull() | F.col("class_id").isNull()).alias("kept"),
    )
