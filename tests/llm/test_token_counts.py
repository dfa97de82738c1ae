import random

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from merchlake.llm.token_counts import count_text, token_counts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)


def expected(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


HARD = [
    "",
    " ",
    "  a  b \n\n c\t",
    "don't we'll 's''s",
    "<|endoftext|>",
    "a<|endoftext|> b<|endoftext|>",
    "a\x1cb\x85c\xa0d e​f",
    "日本語のテキスト 12½ ٣٤",
    "é \U0001f600\U0001f469‍\U0001f680",
    "՘x \U000323b0\U000323b1 y",
    "a" * 5000,
    "ab" * 4000 + " " * 300 + "x",
]


def test_hard_texts_match_the_library():
    for text in HARD:
        assert count_text(text, VOCABULARY) == expected(text), text[:40]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_matches_the_library(text):
    assert count_text(text, VOCABULARY) == expected(text)


def test_documents_match_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {row.doc_id: row.text for row in docs.collect()}
    rows = token_counts(docs, VOCABULARY, 1024).collect()
    assert len(rows) == len(texts)
    for row in random.Random(1).sample(rows, 200):
        text = texts[row.doc_id]
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), expected(text))
        assert row.over_limit == (row.n_tokens > 1024)


def test_nulls_repeats_and_clashing_columns(spark):
    schema = "doc_id long, text string, n_tokens string, over_limit int"
    rows = [(1, None, "x", 1), (None, "two words", None, None), (3, "", "y", 2), (3, "", "y", 2)]
    found = token_counts(spark.createDataFrame(rows, schema), VOCABULARY, 1).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == [
        (0, 9, 2, True),
        (1, 0, 0, False),
        (3, 0, 0, False),
        (3, 0, 0, False),
    ]
    assert token_counts(spark.createDataFrame([], schema), VOCABULARY, 1).collect() == []
