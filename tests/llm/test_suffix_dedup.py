import hashlib
import random
from collections import Counter

import pytest

from merchlake.llm.queries import queries
from merchlake.llm.suffix_dedup import LENGTH, segments, strip_repeats


def brute_force(texts, length):
    """(bytes, removed, runs, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(hash(d[i : i + length]) for d in data for i in range(len(d) - length + 1))
    found = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[hash(d[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((len(d), sum(gone), runs, kept))
    return found


def test_equal_strings_lie_in_segments_of_one_gram():
    rng = random.Random(1)
    base = bytes(rng.choice(b"abcd ") for _ in range(900))
    texts = [base, b"q" + base[100:700] + b"z", b"a" * 6000, b"x" * 100, b"", b"ab" * 400]
    gram, content, text, start, count, recurs = segments(texts, 64)
    covered, groups = Counter(), {}
    for g, c, t, s, n in zip(gram.tolist(), content.tolist(), text.tolist(), start.tolist(), count.tolist()):
        for at in range(s, s + n):
            covered[t, at] += 1
            groups.setdefault(texts[t][at : at + 64], set()).add(g)
        groups.setdefault(("segment", g, n, texts[t][s : s + n + 63]), set()).add(c)
    assert covered == Counter((t, i) for t, d in enumerate(texts) for i in range(len(d) - 63))
    assert all(len(found) == 1 for found in groups.values())
    assert all(r for t, r in zip(text.tolist(), recurs.tolist()) if t in (2, 5))


@pytest.mark.parametrize("max_group_bytes", [1 << 20, 0])
def test_edits_runs_and_shards_match_brute_force(spark, max_group_bytes):
    rng = random.Random(2)
    prose = lambda n: "".join(rng.choice("abcdé fgh\n") for _ in range(n))
    passage, base = prose(150), prose(700)
    texts = [prose(rng.randint(0, 300)) + passage + prose(rng.randint(0, 300)) for _ in range(40)]
    for _ in range(30):
        at = rng.randrange(600)
        texts.append(base[:at] + rng.choice(["", "X", "YY"]) + base[at + 1 :])
    texts += [base, base, "a" * 5000, "ab" * 1500 + "c", "b" + "a" * 70, passage + prose(5) + passage, prose(63), "", None]
    docs = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string")
    found = strip_repeats(docs, 64, shard_bytes=5_000, max_group_bytes=max_group_bytes)
    rows = [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in sorted(found.collect(), key=lambda r: r.doc_id)]
    assert rows == brute_force(texts, 64)


def test_query_matches_brute_force_on_documents(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    expected = dict(zip(texts, brute_force(texts.values(), LENGTH)))
    rows = queries()["op3_suffix_array_dedup"](spark, folder).collect()
    assert len(rows) == len(texts) and sum(r.n_removed for r in rows)
    for r in rows:
        size, removed, runs, kept = expected[r.doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (size, removed, runs)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_nulls_repeats_and_clashes(spark):
    text = "".join(random.Random(3).choice("abcdefgh") for _ in range(100))
    schema = "doc_id long, text string, gram string, key_a int, runs int"
    rows = [(1, None, "", 1, 1), (None, text, "", 1, 1), (2, text, "", 1, 1), (3, "x" + text[:70], "", 1, 1), (4, "é" * 20, "", 1, 1)]
    rows += [(5, text[:63], "", 1, 1), (5, text[:63], "", 1, 1), (6, "", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in strip_repeats(docs, 64).collect()), key=repr)
    expected = [(r[0], *b) for r, b in zip(rows, brute_force([r[1] for r in rows], 64))]
    assert found == sorted(expected, key=repr)
    assert strip_repeats(docs.where("false"), 64).collect() == []
