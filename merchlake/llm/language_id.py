"""Language identification by compression.

For each language a raw-content zstandard dictionary is cut from a bounded sample of labelled texts.
A text is compressed once with each dictionary, in blocks of fixed size so that a long text cannot
become its own dictionary, and the language whose dictionary gives the fewest bytes wins. Where the
runner-up comes close, the margin is narrow and the text is rejected. Only words count: texts and
dictionaries are lower-cased and cut down to their words, a word repeated on the spot written once.

The dictionaries are the whole model: a few languages of ``DICTIONARY_BYTES`` each, carried to the
tasks with the function that uses them. Texts are judged where they are read, without a shuffle.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.llm.text import texts_of

UNKNOWN = "und"
# The fit reads at most this many texts of each language, and this many characters of each.
TEXTS_PER_LANGUAGE = 64
DICTIONARY_BYTES = 1 << 16
BLOCK_BYTES = 1 << 14
# A best size within this share of the runner-up's is too close to call.
NARROW_MARGIN = 0.002
_LEVEL = 9
_WORD = re.compile(r"[^\W\d_]+")


def words_only(text: str) -> str:
    return " ".join(word for word, _ in groupby(_WORD.findall(text.lower())))


def fit(labelled: DataFrame) -> dict[str, bytes]:
    """A dictionary for each value of ``lang``, from rows (text, lang, rank) of lowest rank.

    Rows with a null language or text are passed over; no rows give no languages.
    """
    by_rank = Window.partitionBy("lang").orderBy("rank", "text")
    sample = (
        labelled.where(F.col("lang").isNotNull() & (F.col("text") != ""))
        .select("lang", F.substring("text", 1, DICTIONARY_BYTES).alias("text"), "rank")
        .withColumn("n", F.row_number().over(by_rank))
        .where(F.col("n") <= TEXTS_PER_LANGUAGE)
    )
    number = F.count("*").over(Window.partitionBy("lang")).alias("of")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Equal shares of each text, so that one long text does not fill the dictionary.
            shares = [max(DICTIONARY_BYTES // of, 512) for of in batch.column("of").to_pylist()]
            words = [words_only(text)[:share] for text, share in zip(batch.column("text").to_pylist(), shares)]
            yield batch.select(["lang", "n"]).append_column("words", pa.array(words, pa.string()))

    shares = sample.select("lang", "n", "text", number).mapInArrow(cut, "lang string, n int, words string")
    texts: dict[str, list[str]] = defaultdict(list)
    # No more than DICTIONARY_BYTES characters for each language.
    for row in shares.orderBy("lang", "n").collect():
        texts[row.lang].append(row.words)
    return {
        lang: "\n".join(dict.fromkeys(own)).encode()[:DICTIONARY_BYTES] for lang, own in sorted(texts.items())
    }


class Judge:
    """Picks a language for one text; made anew in each task from the dictionaries."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.by_lang = []
        for lang, content in sorted(dictionaries.items()):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=_LEVEL)
            compressor = zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)
            self.by_lang.append((lang, compressor.compress))

    def of(self, text: str) -> tuple[str, float, bool]:
        """The language, a score that is 0.5 where the margin is just too narrow, and whether to reject."""
        if not self.by_lang or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        data = words_only(text).encode()
        blocks = [data[at : at + BLOCK_BYTES] for at in range(0, len(data), BLOCK_BYTES)]
        sizes = sorted((sum(len(compress(block)) for block in blocks), lang) for lang, compress in self.by_lang)
        if len(sizes) == 1:
            return sizes[0][1], 1.0, False
        margin = 1 - sizes[0][0] / sizes[1][0]
        return sizes[0][1], margin / (margin + NARROW_MARGIN), margin < NARROW_MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], held_out: Column) -> DataFrame:
    """lang_pred, score (0 to 1) and ``rejected`` for every whole text, one row per row of ``docs``.

    A text that is null or has no letter is ``und``, scored 0 and rejected; so is every text if no
    language was learned. Equal sizes go to the language that sorts first, and are rejected. A null
    ``doc_id`` stays null, repeated rows are judged each, and other columns are ignored.
    """
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean"

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Judge(dictionaries).of
        for batch in batches:
            found = [of(text) for text in texts_of(batch)]
            kinds = (pa.string(), pa.float64(), pa.bool_())
            columns = [pa.array([row[n] for row in found], kind) for n, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *columns],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"), F.col("text").alias("text")
    )
    return narrow.mapInArrow(judge, schema)


def accepted(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not rejected."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Judge(dictionaries).of
        for batch in batches:
            yield batch.filter(pa.array([not of(text)[2] for text in texts_of(batch)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
