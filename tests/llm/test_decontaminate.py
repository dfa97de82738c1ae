import random
import re
from collections import Counter
from math import sqrt

import numpy as np

from merchlake.llm.decontaminate import RADIUS, Index, _blocks, find_leaks, without_leaks


def count(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(docs, items):
    """(doc, item) -> best similarity over all windows of the item's length, where it is 0.8 or more."""
    found = {}
    for doc_id, text in docs:
        words = re.findall(r"\w+", (text or "").lower())
        known = count(words)
        for item_id, item in items:
            wanted = re.findall(r"\w+", (item or "").lower())
            if len(wanted) < 5 or len(words) < 5 or not known.keys() & count(wanted).keys():
                continue
            a, size = count(wanted), min(len(wanted), len(words))
            best = 0
            for start in range(len(words) - size + 1):
                b = count(words[start : start + size])
                dot = sum(a[s] * b[s] for s in a)
                best = max(best, dot / sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values())))
            if best >= 0.8 - 1e-12:
                found[doc_id, item_id] = round(best, 9)
    return found


def as_map(frame):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in frame.collect()}


def test_documents_match_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    expected = brute_force([(r.doc_id, r.text) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert len(expected) > 10
    assert as_map(find_leaks(docs, items)) == expected
    assert as_map(find_leaks(docs, items, block_bytes=2_000)) == expected
    kept = without_leaks(docs, items, block_bytes=5_000)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in expected}


def test_edited_passages_are_found(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    items = [(n, " ".join(word() for _ in range(rng.randint(20, 60)))) for n in range(40)]
    docs = []
    for n in range(300):
        passage = items[n % 40][1].split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(passage))
            passage[at : at + 1] = rng.choice([[], [word()], [passage[at], word()]])
        docs.append((n, " ".join([word() for _ in range(50)] + passage + [word() for _ in range(30)])))
    expected = brute_force(docs, items)
    assert 100 < len(expected) < 300
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    found = as_map(find_leaks(rows, spark.createDataFrame(items, "item_id long, text string")))
    assert len(expected.keys() - found.keys()) <= 1 and not found.keys() - expected.keys()
    assert all(found[key] == expected[key] for key in found)


def test_multi_index_finds_everything_within_the_radius():
    rng = np.random.default_rng(3)
    index = Index([(0, "one two three four five six seven eight")])
    own = index.items[0].fingerprint
    for distance in (0, 1, 13, RADIUS, RADIUS + 1, 40):
        for _ in range(50):
            changed = own
            for bit in rng.choice(64, distance, replace=False):
                changed ^= 1 << int(bit)
            assert index.within_radius(changed, {0}) == ([(0, distance)] if distance <= RADIUS else [])
    assert sum(64 * (n + 1) // (RADIUS + 1) - 64 * n // (RADIUS + 1) for n in range(RADIUS + 1)) == 64
    assert len(_blocks(own)) == RADIUS + 1


def test_nulls_short_texts_repeats_and_clashes(spark):
    text = "the quick brown fox jumps over the lazy dog today"
    schema = "doc_id long, text string, item_id string, similarity int"
    rows = [(1, None, "", 1), (2, "", "", 1), (None, f"x {text} y", "", 1), (3, "the quick", "", 1), (4, text, "", 1), (4, text, "", 1)]
    docs = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([(7, text, "x"), (8, None, "x"), (9, "the quick", "x"), (None, text, "x")], "item_id long, text string, doc_id string")
    found = sorted(((r.doc_id, r.item_id, r.start_word) for r in find_leaks(docs, items).collect()), key=repr)
    assert found == [(4, 7, 0), (4, 7, 0), (4, None, 0), (4, None, 0), (None, 7, 1), (None, None, 1)]
    assert sorted(r.doc_id for r in without_leaks(docs, items).collect()) == [1, 2, 3]
    assert find_leaks(docs, items.where("false")).collect() == [] == find_leaks(docs.where("false"), items).collect()
    assert without_leaks(docs, items.where("false")).count() == 6
