"""Removal of long repeated byte strings with sharded suffix arrays.

Every string of ``length`` bytes chooses the smallest hash among the 32-byte grams in it, so equal strings
choose the same one wherever they stand. Neighbouring strings mostly choose the same gram: a text falls
into segments, a few for each kilobyte, and two equal strings always lie in segments of one hash. Hashes
that occur once are done with; only their number has been shuffled. The segments of the others are brought
together by hash and put into shards of bounded size, and each shard's suffix array, built by induced
sorting, tells through its common prefixes which strings start elsewhere too. A segment that occurs many
times whole enters its shard twice, which is as good as every time.

A hash whose segments are too much for a shard (the edges of a passage that very many texts share) is
settled by counting its strings one by one by 128-bit hashes instead, which Spark spreads and pre-aggregates.
Texts travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm.passages import sliding
from merchlake.llm.suffix_array import repeated_windows
from merchlake.llm.text import packed_texts
from merchlake.llm.words import chunks, mix
from merchlake.session import fresh_path

LENGTH = 400
GRAM = 32
# Longest segment, in strings; longer stretches with one smallest gram (runs of a byte) are divided.
MAX_STRINGS = 4_096
SHARD_BYTES = 1 << 20
# Different segments of one hash beyond this many bytes are counted string by string.
MAX_GROUP_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15


def _key(text: Column) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit(1), text).alias("key_b")]


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes (a power of two) from each byte on, by doubling."""
    found, width, power = data.astype(np.uint64) + np.uint64(1), 1, _BASE
    while width < size:
        found = found[: max(0, len(found) - width)] * np.uint64(power) + found[width:]
        width, power = 2 * width, power * power % (1 << 64)
    return mix(found)


def segments(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Smallest gram, content hash, text, first byte and number of strings of each segment, and whether its gram recurs."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    grams, width = _gram_hashes(data, GRAM), length - GRAM + 1
    least = sliding(grams, width, np.minimum, np.iinfo(np.uint64).max)
    at = np.arange(len(least))
    text = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    inside = at + length <= begins[text + 1]
    breaks = np.ones(len(least), bool)
    breaks[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
    run = np.maximum.accumulate(np.where(breaks, at, 0))
    breaks |= (at - run) % MAX_STRINGS == 0
    edges = np.flatnonzero(breaks)
    count = np.diff(np.append(edges, len(least)))
    edges, count = edges[inside[edges]], count[inside[edges]]
    # The content hash is built of hashed bytes in eights, and so does not follow from any algebra of the text.
    eights = _gram_hashes(data, 8)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(eights * _powers(_BASE, len(eights)), dtype=np.uint64)])
    end = edges + count + length - 1 - 7
    inverse = _powers(pow(_BASE, -1, 1 << 64), len(eights))
    content = mix((sums[end] - sums[edges]) * inverse[edges], 9) if len(edges) else sums[:0]
    # Places whose gram is the smallest of some string; a gram at two of them may bound strings that overlap.
    around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    chosen, times = np.unique(grams[sliding(around, width, np.maximum, 0) == grams] if len(least) else grams[:0], return_counts=True)
    recurs = np.isin(least[edges], chosen[times > 1])
    return least[edges], content, text[edges], edges - begins[text[edges]], count, recurs


_TABLES: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    if len(_TABLES.get(base, ())) < size:
        _TABLES[base] = np.cumprod(
            np.concatenate([np.ones(1, np.uint64), np.full(size, base, np.uint64)]), dtype=np.uint64
        )
    return _TABLES[base][:size]


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = fresh_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _segment_table(keyed: DataFrame, length: int) -> DataFrame:
    """gram, content, strings, key_a, key_b, start, recurs of every segment of every row."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.encode() for text in batch.column("text").to_pylist()]
            for first, end in chunks(texts):
                gram, content, text, start, count, recurs = segments(texts[first:end], length)
                rows = pa.array(first + text)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram.view(np.int64)),
                        pa.array(content.view(np.int64)),
                        pa.array(count.astype("i4")),
                        batch.column("key_a").take(rows),
                        batch.column("key_b").take(rows),
                        pa.array(start.astype("i4")),
                        pa.array(recurs),
                    ],
                    ["gram", "content", "strings", "key_a", "key_b", "start", "recurs"],
                )

    return keyed.mapInArrow(
        cut, "gram bigint, content bigint, strings int, key_a bigint, key_b bigint, start int, recurs boolean"
    )


def _segment_texts(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted segments (gram, content, strings, lead, large, key_a, key_b, start) with their bytes."""
    lists = wanted.groupBy("key_a", "key_b").agg(
        F.collect_list(F.struct("gram", "content", "strings", "lead", "large", "start", "length")).alias("wants")
    )
    # Copies of a text collapse where they are read; a text's list is no longer than the text.
    texts = packed_texts(keyed).groupBy("key_a", "key_b").agg(F.first("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for text, wants in zip(batch.column("text").to_pylist(), batch.column("wants").to_pylist()):
                data, rows = unpack(text), wants
                columns = [pa.array([w[name] for w in rows]) for name in ("gram", "content")]
                columns.append(pa.array([w["strings"] for w in rows], pa.int32()))
                columns += [pa.array([w[name] for w in rows], pa.bool_()) for name in ("lead", "large")]
                columns.append(
                    pa.array([data[w["start"] : w["start"] + w["strings"] + w["length"] - 1] for w in rows], pa.binary())
                )
                yield pa.RecordBatch.from_arrays(columns, ["gram", "content", "strings", "lead", "large", "bytes"])

    return texts.join(lists, ["key_a", "key_b"]).select("text", "wants").mapInArrow(
        cut, "gram bigint, content bigint, strings int, lead boolean, large boolean, bytes binary"
    )


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, count) of each run of true values."""
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]


_FOUND = "gram bigint, content bigint, strings int, first int, repeated int"


def _by_suffix_arrays(cut: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Runs of repeated strings in each lead segment; all segments of a hash are in one shard."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size, last = 0, None

        def settle() -> pa.RecordBatch:
            flags = repeated_windows([row[4] for row in shard], length)
            found = [(*row[:3], *run) for row, own in zip(shard, flags) if row[3] for run in _runs(own)]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            columns = [pa.array([row[n] for row in found], kind) for n, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, ["gram", "content", "strings", "first", "repeated"])

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("gram", "content", "strings", "lead", "bytes"))):
                if size >= shard_bytes and row[0] != last:
                    yield settle()
                    shard, size = [], 0
                shard.append(row)
                size, last = size + len(row[4]), row[0]
        if shard:
            yield settle()

    return cut.repartition("gram").sortWithinPartitions("gram").mapInArrow(search, _FOUND)


def _by_counting(cut: DataFrame, length: int) -> DataFrame:
    """The same for hashes with too many segments: strings that occur at least twice, by 128-bit hashes."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row, data = batch.slice(at, 1), np.frombuffer(batch.column("bytes")[at].as_py(), np.uint8)
                count = len(data) - length + 1
                sides = []
                for seed, size in ((1, 16), (2, 8)):
                    grams = mix(_gram_hashes(data, size), seed)
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(grams * _powers(_BASE, len(grams)), dtype=np.uint64)])
                    ends = np.arange(count) + length - size + 1
                    inverse = _powers(pow(_BASE, -1, 1 << 64), count)
                    sides.append(pa.array(mix((sums[ends] - sums[:count]) * inverse, seed).view(np.int64)))
                same = row.take(pa.array(np.zeros(count, np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*sides, *(same.column(n) for n in ("gram", "content", "strings", "lead")), pa.array(np.arange(count, dtype="i4"))],
                    ["hash_a", "hash_b", "gram", "content", "strings", "lead", "first"],
                )

    each = cut.mapInArrow(
        strings, "hash_a bigint, hash_b bigint, gram bigint, content bigint, strings int, lead boolean, first int"
    )
    often = each.groupBy("hash_a", "hash_b").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return (
        each.where("lead")
        .join(often, ["hash_a", "hash_b"])
        .select("gram", "content", "strings", "first", F.lit(1).alias("repeated"))
    )


def repeated_strings(
    keyed: DataFrame,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    max_group_bytes: int = MAX_GROUP_BYTES,
) -> DataFrame:
    """key_a, key_b, start, runs (first, repeated): runs of string starts that occur elsewhere, counted from ``start``, a byte
    of the distinct text (key_a, key_b, text).

    Copies of a text are not "elsewhere" here; see ``strip_repeats``.
    """
    # Written once: cutting the texts costs more than the table, and it is read twice.
    found = _written(_segment_table(keyed, length), "all-segments")
    place = F.xxhash64("key_a", "key_b", "start")
    # Only hashes that occur at two places can have repeated strings.
    places = found.groupBy("gram").agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.max("recurs").alias("recurs")
    )
    met = places.where("low != high or recurs").select("gram")
    members = _written(found.drop("recurs").join(met, "gram"), "segments")
    whole = members.groupBy("gram", "content", "strings").agg(
        F.min(F.struct("key_a", "key_b", "start")).alias("low"), F.max(F.struct("key_a", "key_b", "start")).alias("high")
    )
    sizes = whole.groupBy("gram").agg(F.sum(F.col("strings").cast("bigint") + length - 1).alias("bytes"))
    wanted = (
        whole.join(sizes, "gram")
        .select(
            "gram",
            "content",
            "strings",
            (F.col("bytes") > max_group_bytes).alias("large"),
            "low",
            F.explode(F.array_distinct(F.array("low", "high"))).alias("at"),
        )
        .select(
            "gram", "content", "strings", "large", (F.col("at") == F.col("low")).alias("lead"), F.lit(length).alias("length"), "at.*"
        )
    )
    cut = _written(_segment_texts(keyed, wanted), "segment-texts")
    runs = _by_suffix_arrays(cut.where("not large"), length, shard_bytes).unionByName(
        _by_counting(cut.where("large"), length)
    )
    segment = ["gram", "content", "strings"]
    # A segment's runs are one row, so that the join makes one row for each member, however many strings repeat.
    by_segment = runs.groupBy(*segment).agg(F.collect_list(F.struct("first", "repeated")).alias("runs"))
    joined = by_segment.mapInArrow(_joined_runs, by_segment.schema)
    return members.join(joined, segment).select("key_a", "key_b", "start", "runs")


def _joined_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with ``runs`` (first, repeated) that follow each other made one."""
    for batch in batches:
        found = []
        for runs in batch.column("runs").to_pylist():
            joined: list[list[int]] = []
            for first, count in sorted((r["first"], r["repeated"]) for r in runs):
                if joined and first <= joined[-1][0] + joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], first + count - joined[-1][0])
                else:
                    joined.append([first, count])
            found.append([{"first": first, "repeated": count} for first, count in joined])
        at = batch.schema.get_field_index("runs")
        yield batch.set_column(at, "runs", pa.array(found, batch.schema.field(at).type))


def removed_spans(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by runs (first start, number of starts) of strings of ``length``."""
    spans: list[list[int]] = []
    for first, count in sorted(runs):
        end = first + count + length - 1
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([first, end])
    return [(a, b) for a, b in spans]


def strip_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    shard_bytes: int = SHARD_BYTES,
    max_group_bytes: int = MAX_GROUP_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every text, one row per row of ``docs``.

    A byte goes if it lies in a string of ``length`` bytes that starts at another place too, in the same or
    another document as given. So a text that has a copy goes whole, if it is that long. A null text is
    empty; a null id stays null; repeated rows are copies of each other; other columns are ignored; an
    empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    keyed = rows.select(*_key(F.col("text")), "text")
    near = repeated_strings(keyed.where(F.octet_length("text") >= length), length, shard_bytes, max_group_bytes)
    copies = (
        keyed.select("key_a", "key_b", F.octet_length("text").alias("size"))
        .where(F.col("size") >= length)
        .groupBy("key_a", "key_b")
        .agg(F.count("*").alias("n"), F.first("size").alias("size"))
        .where("n > 1")
        .select(
            "key_a",
            "key_b",
            F.lit(0).alias("start"),
            F.array(F.struct(F.lit(0).alias("first"), (F.col("size") - length + 1).alias("repeated"))).alias("runs"),
        )
    )
    # A list holds at most a run for every few bytes of its text.
    lists = near.unionByName(copies).groupBy("key_a", "key_b").agg(F.collect_set(F.struct("start", "runs")).alias("runs"))
    joined = packed_texts(rows.select("doc_id", *_key(F.col("text")), "text")).join(lists, ["key_a", "key_b"], "left")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            found = []
            for packed, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
                data = unpack(packed)
                own = [(part["start"] + r["first"], r["repeated"]) for part in runs or () for r in part["runs"]]
                spans = removed_spans(own, length)
                edges = [0, *(edge for span in spans for edge in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                found.append((len(data), len(data) - len(kept), len(spans), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array([row[n] for row in found], kind) for n, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    return joined.select("doc_id", "text", "runs").mapInArrow(
        strip, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
