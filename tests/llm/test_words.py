import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from merchlake.llm.words import chunks, shingles, words_of


def spelled(texts, words):
    return [texts[t][s:e] for t, s, e in zip(words.text.tolist(), words.start.tolist(), words.end.tolist())]


def test_words_positions_and_case():
    texts = [s.encode() for s in ["The cat, the CAT!", "", "É é a—b “x” c\xa0d", "日本 x_1", "   "]]
    words = words_of(texts)
    assert [w.decode() for w in spelled(texts, words)] == "The cat the CAT É é a b x c d 日本 x_1".split()
    h = words.hashes.tolist()
    assert h[0] == h[2] and h[1] == h[3] and h[4] == h[5] and len(set(h)) == 10
    assert words.bounds.tolist() == [0, 4, 4, 11, 13, 13]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=6))
def test_hash_is_equal_just_where_the_word_is(texts):
    data = [t.encode() for t in texts]
    words = words_of(data)
    lower = [w.decode(errors="replace").lower() for w in spelled(data, words) if w.isascii()]
    ascii_hashes = [h for w, h in zip(spelled(data, words), words.hashes.tolist()) if w.isascii()]
    assert len(set(lower)) == len(set(zip(lower, ascii_hashes))) == len(set(ascii_hashes))


def test_shingles_stay_in_one_text_and_do_not_depend_on_neighbours():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))).encode() for _ in range(40)]
    words = words_of(texts)
    codes, whole = shingles(words, 3)
    for n, text in enumerate(texts):
        alone, inside = shingles(words_of([text]), 3)
        assert inside.all()
        low, high = words.bounds[n], words.bounds[n + 1] - 2
        assert np.array_equal(codes[low : max(low, high)], alone) and whole[low : max(low, high)].all()


def test_chunks_cover_everything():
    texts = [b"x" * n for n in (5, 0, 30, 1, 1, 1)]
    assert list(chunks(texts, 10)) == [(0, 3), (3, 6)] and list(chunks([], 10)) == []
