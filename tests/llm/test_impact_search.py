import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from merchlake.llm import impact_search
from merchlake.llm.impact_search import search, terms_of
from merchlake.llm.oracle import ORACLE
from merchlake.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, top=50):
    """(item_id, rank, doc_id, score) by the formula, one pair after the other."""
    counted = [(i, Counter(own), len(own)) for i, text in docs if (own := plain_terms(text))]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = Counter(term for _, own, _ in counted for term in own)
    rows = []
    for item_id, text in items:
        scored = []
        for doc_id, own, n in counted:
            m = 50 + (50 * n * n_docs) // total
            score = 0
            for term in set(plain_terms(text)):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                score += weight * (10**9 * own[term] // (1000 * own[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scored)[:top], 1):
            rows.append((item_id, rank, None if missing else doc_id, -score))
    return sorted(rows, key=str)


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def found(frame):
    return sorted((tuple(row) for row in frame.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("text", ["", "Ab c1-d2", "ÀÉ x́y", "日本。語 a_b", "\x7f~{z}|", "A" * 9, "ⅣÄ ÄⅣ", "a b c"])
def test_terms_are_those_of_the_pattern(text):
    assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def corpus(seed, n_docs, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{n}" for n in range(vocabulary)]
    weights = [1 / (n + 1) for n in range(vocabulary)]
    docs = [(n, " ".join(rng.choices(words, weights, k=rng.randint(0, 80)))) for n in range(n_docs)]
    items = [(n, " ".join(rng.choices(words + ["unknown"], k=rng.randint(1, 12)))) for n in range(12)]
    return docs, items


@pytest.mark.parametrize("seed, top, bucket", [(1, 5, 8), (2, 50, 512), (3, 1, 3)])
def test_every_pair_against_brute_force(spark, seed, top, bucket):
    docs, items = corpus(seed, 900)
    docs += docs[:150]  # repeated rows tie in score and id
    assert found(search(*tables(spark, docs, items), top=top, bucket=bucket)) == brute(docs, items, top)


def test_ties_go_by_id_across_tasks(spark):
    docs = [(n, "same words here") for n in random.Random(4).sample(range(10**6), 400)] + [(None, "same words here"), (7, "other")] * 3
    got = found(search(tables(spark, docs, [])[0].repartition(7), tables(spark, [], [(1, "words"), (1, "here")])[1], top=20))
    assert got == brute(docs, [(1, "words"), (1, "here")], 20)


def test_pruning_works_and_loses_nothing(monkeypatch, spark):
    """Most documents are never scored, and the result is as without bounds."""
    rng = random.Random(5)
    docs = [(n, " ".join(rng.choices("abcdefgh", k=30))) for n in range(3000)]
    docs += [(5000 + n, f"rare{n % 3} rare{n % 5} " * 3 + "a b") for n in range(100)]
    items = [(n, f"rare{n} a b c") for n in range(3)]
    scored = []
    exact = impact_search.Bucket._exact
    counted = impact_search.Queries.of(items)
    vectors = {}
    for doc_id, text in docs:
        own = Counter(counted.numbers[t] for t in terms_of(text) if t in counted.numbers)
        vectors[doc_id] = (list(own), [10**9 * c // (1000 * c + 2000) for c in own.values()])
    monkeypatch.setattr(impact_search.Bucket, "_exact", lambda self, q, d: scored.append(len(d)) or exact(self, q, d))
    weights = np.array([9000, 50, 40, 30, 9000, 9000])[: len(counted.numbers)]
    order = sorted(vectors, key=lambda d: -sum(x * x for x in vectors[d][1]))
    queries_ = [impact_search.Query(t, weights, 20, 0) for t in counted.terms]
    for first in range(0, len(order), 64):
        part = order[first : first + 64]
        lists = [vectors[d] for d in part]
        bucket = impact_search.Bucket(
            np.array(part), np.zeros(len(part), bool), np.cumsum([0, *(len(t) for t, _ in lists)]),
            np.array([x for t, _ in lists for x in t], np.int64), np.array([x for _, v in lists for x in v], np.int64),
            np.array([float(sum(x * x for x in v)) for _, v in lists]),
        )
        for query in queries_:
            bucket.search(query)
    for query, terms in zip(queries_, counted.terms):
        wanted = dict(zip(terms, weights[terms].tolist()))
        best = sorted((-sum(wanted.get(t, 0) * x for t, x in zip(*vectors[d])), d) for d in vectors)[:20]
        assert [(-s, i) for s, i in zip(query.scores.tolist(), query.ids.tolist())] == best
    assert sum(scored) < len(docs)  # three queries, and not even a third of the pairs


def test_the_tables_against_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    name = "op12_ranked_lexical_search"
    frame = queries()[name](spark, SMALL)
    expected = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({ORACLE[name]})").fetchall()
    assert found(frame) == sorted(expected, key=str) and len(expected) > 1000


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "- -"), (None, "word"), (4, "word " * 200_000), (4, "Word"), (5, "wOrd Ä"), (6, "ä")]
    items = [(1, None), (None, "WORD"), (2, ""), (3, "ä Ä nowhere"), (3, "ä Ä nowhere"), (4, "?")]
    frames = [f.selectExpr("*", "1 AS n", "2 AS terms", "'x' AS item") for f in tables(spark, docs, items)]
    assert found(search(*frames)) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = tables(spark, [(1, "a b")], [(1, "a")])
    assert found(search(docs.limit(0), items)) == found(search(docs, items.limit(0))) == []
    assert found(search(docs, items.selectExpr("item_id", "CAST(NULL AS STRING) AS text"))) == []


def test_blocks_of_items_change_nothing(spark):
    docs, items = corpus(6, 200)
    frames = tables(spark, docs, items)
    assert found(search(*frames, top=7, block_bytes=60)) == found(search(*frames, top=7))
