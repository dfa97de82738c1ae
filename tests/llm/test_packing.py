import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from merchlake.llm.packing import BestFit, TokenIds, pack, piece_bounds

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)
IDS = TokenIds(VOCABULARY)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_fast_path_is_used_and_matches_the_library():
    assert IDS.fast is not None
    for text in ["", " ", "a  b\n\n c\t", "l'été 12½ don't\xa0x\x85y", "a<|endoftext|> b", "日本 x", "x" * 9000]:
        assert IDS.of(text) == library_ids(text), text[:40]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), max_size=60))
def test_latin_texts_match_the_library(text):
    assert IDS.of(text) == library_ids(text)


def test_bounds_leave_the_first_piece_short():
    assert piece_bounds(5, 4) == [0, 1, 5]
    assert piece_bounds(8, 4) == [0, 4, 8]
    assert piece_bounds(4, 4) == [0, 4]
    assert piece_bounds(1, 4) == [0, 1]


def brute_force(lengths, capacity, open_bins):
    """Best fit over a plain list of [free, bin], newest of equals first."""
    bins, places, used = [], [], 0
    for length in lengths:
        fitting = [b for b in bins if b[0] >= length]
        if fitting:
            tightest = min(b[0] for b in fitting)
            chosen = [b for b in bins if b[0] == tightest][-1]
            bins.remove(chosen)
        else:
            if len(bins) == open_bins:
                fullest = min(b[0] for b in bins)
                bins.remove([b for b in bins if b[0] == fullest][-1])
            chosen, used = [capacity, used], used + 1
        places.append((chosen[1], capacity - chosen[0]))
        if chosen[0] > length:
            bins.append([chosen[0] - length, chosen[1]])
    return places


def test_best_fit_matches_brute_force():
    rng = random.Random(3)
    for open_bins in (1, 2, 7, 1000):
        lengths = [rng.randint(1, 50) for _ in range(600)]
        bins = BestFit(50, open_bins)
        assert [bins.place(n) for n in lengths] == brute_force(lengths, 50, open_bins)


def test_documents_are_packed_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs, VOCABULARY, 1024, 2, with_ids=True).collect()
    texts, by_doc, by_sequence = {r.doc_id: r.text for r in docs.collect()}, {}, {}
    for row in rows:
        assert row.length == len(row.ids) and row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
        by_doc.setdefault(row.doc_id, []).append(row)
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    assert by_doc.keys() == texts.keys()
    for doc_id in random.Random(2).sample(sorted(texts), 150):
        pieces = sorted(by_doc[doc_id], key=lambda r: r.piece)
        ids = [i for p in pieces for i in p.ids]
        assert ids == [*library_ids(texts[doc_id]), 2]
        assert [p.start for p in pieces] == piece_bounds(len(ids), 1024)[:-1]
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    least = -(-sum(r.length for r in rows) // 1024)
    assert len(by_sequence) <= 1.03 * least


def test_nulls_repeats_and_clashing_columns(spark):
    schema = "doc_id long, text string, piece string, sequence_id string"
    rows = [(1, None, "x", None), (None, "a b", "y", None), (2, "", "z", None), (2, "", "z", None)]
    found = pack(spark.createDataFrame(rows, schema), VOCABULARY, 4, 2).collect()
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length) for r in found) == [
        (0, 0, 0, 3), (1, 0, 0, 1), (2, 0, 0, 1), (2, 0, 0, 1),
    ]
    assert len({(r.sequence_id, r.offset) for r in found}) == 4
    assert pack(spark.createDataFrame([], schema), VOCABULARY, 4, 2).collect() == []
