"""Quality rules with cross-document line frequency.

Lines are normalised (lower case, runs of white space as one space, trimmed) and hashed; a line is
counted once for each distinct document of a host. Lines in more documents of the host than the
limit are boilerplate: they are removed, and a document of which too little is left is rejected,
as is one that fails the base rules. Copies of one text on a host count as one document, so that a
text is not rejected merely for having been copied; that is for deduplication to judge.

Only DataFrame functions are used. No text is shuffled: the base counts never leave the scan, and
of the lines only hashes and word counts travel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words, and what counts as a symbol.
SEPARATORS = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# A line in more documents of its host than this is boilerplate.
MAX_DOCUMENTS = 20
# Per cent of a document's words that must be left.
MIN_LEFT_PERCENT = 30


def _length_without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, "")).cast("bigint")


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though ``use`` refers to it inside lambdas."""
    return F.transform(F.array(value), use)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda word: word != "")


def _window_hashes(words: Column) -> Column:
    """A hash of the five words from each word on; none where fewer than five are left."""

    def hashes(codes: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(codes) - WINDOW)
        return F.when(
            F.size(codes) >= WINDOW,
            F.transform(starts, lambda at: F.xxhash64(*[F.get(codes, at + n) for n in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>"))

    return _with(F.transform(words, lambda word: F.xxhash64(word)), hashes)


def _repeat_words(windows: Column) -> Column:
    """Words that lie in a window whose hash comes at least twice."""

    def covered(starts: Column) -> Column:
        gained = F.transform(
            starts, lambda at, n: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, n + 1) - at, F.lit(WINDOW)))
        )
        return F.aggregate(gained, F.lit(0), lambda total, more: total + more)

    def repeated(ordered: Column) -> Column:
        starts = F.transform(
            ordered,
            lambda entry, n: F.when(
                F.coalesce(F.get(ordered, n - 1)["h"] == entry["h"], F.lit(False))
                | F.coalesce(F.get(ordered, n + 1)["h"] == entry["h"], F.lit(False)),
                entry["at"],
            ),
        )
        return _with(F.sort_array(F.filter(starts, lambda at: at.isNotNull())), covered)

    def count(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
        return F.when(
            F.size(hashes) > F.size(F.array_distinct(hashes)), _with(F.sort_array(placed), repeated)
        ).otherwise(F.lit(0))

    return _with(windows, count).cast("bigint")


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, host, the text's key and its base counts, one row per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, SEPARATORS, "") != "")
    return (
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce("source", F.lit("")).alias("host"),
            *_text_key(text),
            _words(text).alias("words"),
            lines.alias("lines"),
            _length_without(text, SEPARATORS).alias("word_chars"),
            (F.length(text) - _length_without(text, SYMBOLS)).cast("bigint").alias("n_symbols"),
        )
        .select(
            "doc_id",
            "host",
            "key_a",
            "key_b",
            F.size("words").cast("bigint").alias("n_words"),
            "word_chars",
            "n_symbols",
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(_window_hashes(F.col("words"))).alias("n_repeat_words"),
        )
    )


def _text_key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit(1), text).alias("key_b")]


def document_lines(docs: DataFrame) -> DataFrame:
    """host, the text's key, a line's hash, the words of all its occurrences, and the text's documents (copies), for each distinct text of a host."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def described(normal: Column) -> Column:
        breaks = F.length(normal) - F.length(F.translate(normal, " ", ""))
        return F.struct(F.xxhash64(normal).alias("line"), F.when(normal == "", 0).otherwise(breaks + 1).alias("words"))

    def normalised(line: Column) -> Column:
        return F.trim(F.regexp_replace(line, WORD_BREAK, " "))

    lines = F.transform(F.split(F.lower(text), "\n"), lambda line: _with(normalised(line), described))
    per_row = docs.select(
        F.coalesce("source", F.lit("")).alias("host"),
        *_text_key(text),
        F.filter(lines, lambda line: line["words"] > 0).alias("lines"),
    )
    distinct = per_row.groupBy("host", "key_a", "key_b").agg(F.first("lines").alias("lines"), F.count("*").alias("copies"))
    return (
        distinct.select("host", "key_a", "key_b", "copies", F.explode("lines").alias("found"))
        .groupBy("host", F.col("found.line").alias("line"), "key_a", "key_b")
        .agg(F.sum("found.words").alias("words"), F.first("copies").alias("copies"))
    )


def quality(
    docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_left_percent: int = MIN_LEFT_PERCENT
) -> DataFrame:
    """Base counts, words removed as boilerplate and the verdict, one row per row of ``docs``.

    A null text has no words and fails the base rules; a null source is a host of its own; a null
    ``doc_id`` stays null; repeated rows all get the same verdict; other columns are ignored; an empty
    table gives an empty result.
    """
    lines = document_lines(docs)
    frequent = (
        lines.groupBy("host", "line").agg(F.sum("copies").alias("documents")).where(F.col("documents") > max_documents)
    )
    removed = (
        lines.join(frequent, ["host", "line"]).groupBy("host", "key_a", "key_b").agg(F.sum("words").alias("removed"))
    )
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (left < MIN_WORDS) | (100 * left < min_left_percent * F.col("n_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        base_counts(docs)
        .join(removed, ["host", "key_a", "key_b"], "left")
        .withColumn("n_removed_words", F.coalesce("removed", F.lit(0)).cast("bigint"))
        .withColumn("base_failed", failed)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & ~depleted).alias("kept"),
            "n_removed_words",
        )
    )
