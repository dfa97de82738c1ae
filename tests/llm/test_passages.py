import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from merchlake.llm import passages
from merchlake.llm.alignment import align
from merchlake.llm.passages import (
    MIN_WORDS,
    SEED_WORTH,
    chains,
    passages_of,
    repeated_passages,
    seeds_of,
    sliding,
    without_repeats,
)
from merchlake.llm.words import words_of

RNG = random.Random(11)


def word():
    return "".join(RNG.choice("abcdefghijklmnopqrst") for _ in range(6))


def prose(n):
    return [word() for _ in range(n)]


def test_sliding_matches_plain_windows():
    values = np.array([RNG.randrange(100) for _ in range(53)], np.uint64)
    for width in (1, 4, 53, 60):
        windows = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert sliding(values, width, np.minimum, 2**63).tolist() == windows


def test_shared_words_hold_two_common_seeds():
    for _ in range(30):
        shared = prose(MIN_WORDS)
        texts = [" ".join(prose(RNG.randint(0, 60)) + shared + prose(RNG.randint(0, 60))).encode() for _ in range(2)]
        hashes, text, _ = seeds_of(words_of([*texts, b"short"]))
        common = set(hashes[text == 0].tolist()) & set(hashes[text == 1].tolist())
        assert len(common) >= 2
    assert len(seeds_of(words_of([" ".join(prose(MIN_WORDS - 1)).encode()]))[0]) == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 60)), min_size=1, max_size=25))
def test_best_chain_matches_quadratic_search(anchors):
    ordered = sorted(set(anchors))
    best = []
    for n, (x, y) in enumerate(ordered):
        gains = [best[m] - (x - u) - (y - v) for m, (u, v) in enumerate(ordered[:n]) if u < x and v < y]
        best.append(SEED_WORTH + max([0, *gains]))
    found = chains(anchors)
    value = lambda c: SEED_WORTH * len(c) - (c[-1][0] - c[0][0]) - (c[-1][1] - c[0][1])
    if max(best) > SEED_WORTH:
        assert value(found[0]) == max(best)
    used = [a for chain in found for a in chain]
    assert len(used) == len(set(used))
    for chain in found:
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(chain, chain[1:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14), st.lists(st.integers(0, 4), max_size=14))
def test_alignment_has_fewest_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    distance = row[-1]
    runs = align(np.array(a), np.array(b), distance)
    assert runs is not None and (not distance or align(np.array(a), np.array(b), distance - 1) is None)
    edits = i = j = 0
    for x, y, n in [*runs, (len(a), len(b), 0)]:
        assert x >= i and y >= j and a[x : x + n] == b[y : y + n]
        edits += max(x - i, y - j)
        i, j = x + n, y + n
    assert edits == distance


def test_passage_is_found_to_its_ends():
    for edits in range(6):
        shared = prose(80)
        changed = list(shared)
        for at in RNG.sample(range(10, 70, 10), edits):
            changed[at : at + 1] = RNG.choice([[], [word()], [changed[at], word()]])
        a, b = prose(30) + shared + prose(30), prose(50) + changed + prose(9)
        words = words_of([" ".join(a).encode(), " ".join(b).encode()])
        left, right = words.hashes[: words.bounds[1]], words.hashes[words.bounds[1] :]
        hashes, text, at = seeds_of(words)
        place = dict(zip(hashes[text == 1].tolist(), at[text == 1].tolist()))
        anchors = [(x, place[h]) for h, x in zip(hashes[text == 0].tolist(), at[text == 0].tolist()) if h in place]
        found = [p for chain in chains(anchors) for p in passages_of(chain, left, right)]
        assert len(found) == 1 and found[0][:4] == (30, 110, 50, 50 + len(changed))


def test_documents_catch_every_long_repeat(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = repeated_passages(docs).collect()
    assert all(r.n_words >= 50 and r.similarity >= 0.8 for r in rows)
    split = {i: re.findall(r"\w+", t.lower()) for i, t in texts.items()}
    where = {}
    for i, w in split.items():
        for n in range(len(w) - 49):
            where.setdefault(tuple(w[n : n + 50]), set()).add(i)
    repeated = {i for ids in where.values() if len(ids) > 1 for i in ids}
    named = {r.doc_id for r in rows} | {r.source_doc_id for r in rows}
    assert len(repeated) > 50 and repeated <= named
    for r in rows:
        a = texts[r.doc_id].encode()[r.start : r.end].decode().lower()
        b = texts[r.source_doc_id].encode()[r.source_start : r.source_end].decode().lower()
        left, right = re.findall(r"\w+", a), re.findall(r"\w+", b)
        assert len(set(left) & set(right)) >= 0.6 * len(set(left))


def test_common_passage_is_cut_everywhere_but_once(spark):
    passage = " ".join(prose(70))
    rows = [(n, f"{' '.join(prose(40))}\n{passage}\n{' '.join(prose(20))}", n) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = repeated_passages(docs).collect()
    (source,) = {r.source_doc_id for r in found} - {r.doc_id for r in found}
    assert len(found) == 59 + 58 and all(r.n_words == 70 for r in found)
    assert {r.doc_id for r in found if r.source_doc_id == source} == set(range(60)) - {source}
    left = without_repeats(docs)
    assert left.columns == docs.columns
    after = {r.doc_id: r.text for r in left.collect()}
    assert sum(passage in t for t in after.values()) == 1
    for n, text, _ in rows:
        assert after[n] in (text, text.replace(passage, ""))


def test_nulls_copies_repeats_and_clashes(spark):
    text, own = " ".join(prose(60)), " ".join(prose(60))
    schema = "doc_id long, text string, key string, cuts int, start int"
    rows = [(1, None, "", 1, 1), (2, "", "", 1, 1), (3, text, "", 1, 1), (4, text, "", 1, 1), (4, text, "", 1, 1), (None, text, "", 1, 1)]
    rows += [(6, own, "", 1, 1), (7, "x y z", "", 1, 1), (8, "x y z", "", 1, 1), (9, "ha " * 500, "", 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    found = sorted(((r.doc_id, r.source_doc_id, r.start, r.end, r.n_words) for r in repeated_passages(docs).collect()), key=repr)
    size = len(text)
    assert found == [(4, 3, 0, size, 60), (4, 3, 0, size, 60), (None, 3, 0, size, 60)]
    assert sorted(map(repr, without_repeats(docs).collect())) == sorted(map(repr, docs.collect()))
    empty = docs.where("false")
    assert repeated_passages(empty).collect() == [] == without_repeats(empty).collect()


def pairs_of(spark, texts):
    rows = repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return {frozenset((r.doc_id, r.source_doc_id)) for r in rows}


def test_passages_edited_up_to_a_fifth_are_found(spark):
    rng, texts = random.Random(3), []
    for _ in range(60):
        shared = prose(60)
        changed = list(shared)
        for at in rng.sample(range(2, 58), 11):
            changed[at] = word()
        texts += [" ".join(prose(30) + x + prose(30)) for x in (shared, changed)]
    found = pairs_of(spark, texts)
    assert sum(frozenset((n, n + 1)) in found for n in range(0, 120, 2)) >= 57


def test_runs_of_common_lines_are_found(spark):
    rng, lines = random.Random(4), [" ".join(prose(12)) for _ in range(20)]
    texts = ["\n".join(" ".join([*prose(9), line, *prose(9)]) for line in rng.sample(lines, 10)) for _ in range(60)]
    for _ in range(20):
        run = "\n".join(rng.sample(lines, 6))
        texts += [" ".join([*prose(20), run, *prose(20)]) for _ in range(2)]
    found = pairs_of(spark, texts)
    assert all(frozenset((n, n + 1)) in found for n in range(60, 100, 2))


def test_each_place_of_a_passage_is_cut(spark):
    passage = " ".join(prose(70))
    twice = [" ".join([*prose(20), passage, *prose(20), passage, *prose(20)]) for _ in range(2)]
    left = [r.text for r in without_repeats(spark.createDataFrame(list(enumerate(twice)), "doc_id long, text string")).collect()]
    assert sorted(text.count(passage) for text in left) == [0, 2]


def test_passages_of_common_phrases_are_found(spark):
    """Each ten-word line stands in 24 texts; pairs share six of them in a row, with another word between two lines."""
    rng, lines = random.Random(7), [" ".join(prose(10)) for _ in range(100)]
    pairs, texts = 200, []
    deck = [line for line in range(100) for _ in range(12)]
    rng.shuffle(deck)
    for n in range(pairs):
        own = deck[6 * n : 6 * n + 6]
        for _ in range(2):
            texts.append(" ".join([*prose(30), *(x for line in own for x in (lines[line], word())), *prose(30)]))
    found = pairs_of(spark, texts)
    assert sum(frozenset((2 * n, 2 * n + 1)) in found for n in range(pairs)) >= 0.95 * pairs


def test_packed_seeds_come_back():
    rng = np.random.default_rng(8)
    for n in (1, 7, 3000):
        seed = np.sort(rng.integers(0, 2**64, n, np.uint64))
        rows = (seed, rng.integers(-(2**63), 2**63 - 1, n), rng.integers(0, 10**6, n).astype(np.int32), rng.integers(0, 2, n) > 0)
        assert all((a == b).all() for a, b in zip(rows, passages._unpacked(passages._packed(*rows))))


def test_seeds_meet_as_pairs_or_as_many(spark, monkeypatch):
    """Against a plain count of every seed, with small ranges and small parts."""
    monkeypatch.setattr(passages, "RANGE_BYTES", 4000)
    monkeypatch.setattr(passages, "PACKED_SEEDS", 900)
    rng, lines = random.Random(9), [" ".join(prose(8)) for _ in range(40)]
    texts = [" ".join([*prose(25), *rng.choices(lines, [1 / (n + 1) for n in range(40)], k=8), *prose(5)]) for _ in range(90)]
    texts += texts[:20]
    keyed = spark.createDataFrame([(t,) for t in texts], "text string").select(passages._key(passages.F.col("text")).alias("key"), "text")
    keys = {r.text: r.key for r in keyed.collect()}
    where = {}
    for text, key in keys.items():
        hashes, _, at = seeds_of(words_of([text.encode()]))
        for h, w in zip(hashes.view(np.int64).tolist(), at.tolist()):
            where.setdefault(h, {}).setdefault(key, []).append(w)
    anchors, many = set(), set()
    for h, texts_of in where.items():
        if len(texts_of) > passages.FEW_TEXTS:
            many |= {(h, k, w) for k, words in texts_of.items() for w in words}
        else:
            anchors |= {(h, k, w, o, min(texts_of[o])) for k, words in texts_of.items() for w in words for o in texts_of if o < k}
    met = passages._seed_meetings(keyed.repartition(5)).collect()
    assert {tuple(r) for r in met if r.source_key is not None} == anchors and len(anchors) > 100
    assert {tuple(r)[:3] for r in met if r.source_key is None} == many and len(many) > 100


def test_all_texts_of_frequent_seeds_are_compared(spark):
    """Thirty texts have one passage, each with edits of its own: every seed stands in many texts, and no two runs are alike."""
    rng, shared, texts = random.Random(12), prose(70), []
    for _ in range(30):
        changed = list(shared)
        for at in rng.sample(range(5, 65), 4):
            changed[at] = word()
        texts.append(" ".join([*prose(30), *changed, *prose(30)]))
    assert pairs_of(spark, texts) == {frozenset((a, b)) for a in range(30) for b in range(a)}


def test_copies_of_a_run_also_meet_texts_that_have_it_in_part(spark):
    """Twelve texts share a run of 120 words, of which twelve others have the last 60."""
    run = prose(120)
    whole = [" ".join([*prose(20), *run, *prose(20)]) for _ in range(12)]
    part = [" ".join([*prose(20), *run[60:], *prose(20)]) for _ in range(12)]
    found = pairs_of(spark, whole + part)
    assert found >= {frozenset((a, b)) for a in range(12) for b in range(12, 24)}
    for side in (range(12), range(12, 24)):  # copies are linked by their first one
        assert any(found >= {frozenset((a, b)) for b in side if a != b} for a in side)


def test_telling_places_lose_no_pair_with_seven_seeds():
    """Against all pairs: whatever two texts share seven frequent seeds within a passage's reach, one place tells of both."""
    rng = np.random.default_rng(5)
    texts = [np.sort(rng.choice(150, 40, replace=False)) for _ in range(40)]
    seeds = [rng.choice(60, 40, replace=False) for _ in texts]
    df = np.bincount(np.concatenate(seeds), minlength=60)
    kept = [set(s[passages._telling(s, df[s], np.zeros(40, int), w)].tolist()) for s, w in zip(seeds, texts)]
    pairs = 0
    for a in range(40):
        for b in range(a):
            common = np.intersect1d(seeds[a], seeds[b])
            for start in range(0, 300, 10):
                near = [s for s in common if all(start <= texts[n][seeds[n].tolist().index(s)] <= start + 68 for n in (a, b))]
                if len(near) >= passages.ENOUGH_SEEDS:
                    pairs += 1
                    assert kept[a] & kept[b]
    assert pairs > 2


def candidates(spark, texts):
    keyed = spark.createDataFrame([(t,) for t in texts], "text string").select(passages._key(passages.F.col("text")).alias("key"), "text")
    at = {r.key: texts.index(r.text) for r in keyed.collect()}
    return {frozenset((at[r.key], at[r.source_key])) for r in passages.anchored_pairs(keyed).collect()}


def test_a_common_line_alone_leads_to_no_pair(spark):
    """Sixty texts have a line of twelve words; two have a passage around it of which every fifth word differs."""
    line, texts = prose(12), []
    for _ in range(60):
        texts.append(" ".join([*prose(40), *line, *prose(40)]))
    before, after = prose(19), prose(19)
    for n in range(2):
        sides = ([word() if n and at % 5 == 2 else w for at, w in enumerate(side)] for side in (before, after))
        first, last = sides
        texts.append(" ".join([*prose(30), *first, *line, *last, *prose(30)]))
    assert candidates(spark, texts) == {frozenset((60, 61))}


def test_candidates_with_a_fifth_of_their_words_edited_are_kept(spark):
    """Passages of fifty words, every fifth of them replaced; the first twelve pairs' are all the same."""
    common, texts = prose(50), []
    for n in range(40):
        shared = common if n < 12 else prose(50)
        changed = [word() if at % 5 == 4 else w for at, w in enumerate(shared)]
        texts += [" ".join([*prose(30), *x, *prose(30)]) for x in (shared, changed)]
    found = candidates(spark, texts)
    assert all(frozenset((n, n + 1)) in found for n in range(0, 80, 2))


def test_repeated_words_are_found_in_either_text(spark):
    """A few words, each many times: most places of the source have a seed that stood there before."""
    words = prose(2)
    texts = [" ".join([*prose(20), *[words[0]] * 30, *[words[1]] * 30, *prose(20)]) for _ in range(2)]
    assert pairs_of(spark, texts) == {frozenset((0, 1))}


def test_least_seeds_of_three_words_in_reach():
    """Whatever fifth of a passage's words is replaced, ENOUGH_MEETINGS of its seeds lie within WITHIN_WORDS words."""
    rng = random.Random(13)
    for _ in range(3000):
        size = rng.randint(MIN_WORDS, 130)
        first, step = rng.randrange(size), rng.choice([2, 3, 3, 3, 4, 5])
        edited = set(range(first, size, step)[: size // 5])
        while len(edited) < size // 5:
            edited.add(rng.randrange(size))
        seeds = [at for at in range(size - passages.MEETING_WORDS + 1) if not edited & set(range(at, at + passages.MEETING_WORDS))]
        reach = passages.WITHIN_WORDS - passages.MEETING_WORDS
        assert max(sum(at <= other <= at + reach for other in seeds) for at in seeds) >= passages.ENOUGH_MEETINGS


def test_texts_travel_to_cells_not_to_pairs(spark, monkeypatch):
    """Forty texts, every two of them a pair: in rounds of few bytes no text travels once for each pair, and all pairs are found."""
    shared, texts = prose(70), []
    for _ in range(40):
        changed = list(shared)
        for at in RNG.sample(range(5, 65), 3):
            changed[at] = word()
        texts.append(" ".join([*prose(30), *changed, *prose(30)]))
    size, sent, whole = sum(map(len, texts)), [], passages._rounds
    monkeypatch.setattr(passages, "GROUP_BYTES", size // 4)
    monkeypatch.setattr(passages, "ROUND_SHARE", 1)

    def counted(pairs, packed):
        total = packed.agg(passages.F.sum(passages.F.octet_length("text"))).first()[0]
        for cells in whole(pairs, packed):
            row = cells.agg(passages.F.count("text"), passages.F.sum(passages.F.octet_length("text")), passages.F.count("source_key")).first()
            sent.append((row[0], row[1] / total, row[2]))
            yield cells

    monkeypatch.setattr(passages, "_rounds", counted)
    assert pairs_of(spark, texts) == {frozenset((a, b)) for a in range(40) for b in range(a)}
    assert len(sent) > 1 and sum(n for *_, n in sent) == 40 * 39 // 2
    assert sum(n for n, *_ in sent) < 40 * 39 / 4 and max(share for _, share, _ in sent) <= 3
