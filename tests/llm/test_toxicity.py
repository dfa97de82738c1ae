import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from merchlake.llm import toxicity
from merchlake.llm.queries import id_remainder, queries


def test_held_out_precision_and_recall(spark):
    folder = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries()["op4_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    hits = sum(r.predicted and toxic[r.doc_id] for r in held)
    assert hits / sum(r.predicted for r in held) > 0.95
    assert hits / sum(toxic[r.doc_id] for r in held) > 0.9


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    fire = lambda yes, no: np.where(truth, rng.random(4000) < yes, rng.random(4000) < no).astype(float)
    good, weak = [fire(0.8, 0.02) for _ in range(3)], fire(0.3, 0.25)
    labels = np.where(rng.random(4000) < 0.05, ~truth, truth).astype(float)
    posterior = toxicity.label_model(np.stack([*good, weak], axis=1), labels)
    assert ((posterior > 0.5) == truth).mean() > 0.98 > (labels == truth).mean()
    copied = toxicity.label_model(np.stack([*good, weak, weak, weak, weak, weak], axis=1), labels)
    assert ((copied > 0.5) == truth).mean() > 0.98


def test_newton_finds_the_minimum():
    rng = np.random.default_rng(2)
    inputs, targets = rng.normal(size=(300, 3)), rng.random(300)
    weights = toxicity.train(inputs, targets)

    def loss(w):
        odds = inputs @ w[:-1] + w[-1]
        return (np.log1p(np.exp(odds)) - targets * odds).sum() + 0.5 * (w[:-1] ** 2).sum()

    assert all(loss(weights) <= loss(weights + d) for d in 0.01 * rng.normal(size=(50, 4)))


def test_nulls_repeats_unlabelled_and_empty(spark):
    rng = random.Random(4)
    clean = [" ".join(rng.choice("alpha beta gamma delta epsilon".split()) for _ in range(20)) for _ in range(60)]
    rows = [(n, f"{text} grobian" if n % 3 == 0 else text, 1.0) for n, text in enumerate(clean)]
    rows += [(None, "grobian alpha", 0.0), (99, None, None), (98, "", 0.5), (98, "", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    marks = [(n, int(n % 3 == 0)) for n in range(60)] + [(0, 0), (7, None), (None, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.where(id_remainder(4) != 2))
    found = [(r.doc_id, r.predicted, r.score) for r in toxicity.score(docs, model, F.lit(False), 0.3).collect()]
    assert len(found) == len(rows)
    assert {i for i, predicted, _ in found if predicted} == {None, *range(0, 60, 3)}
    empty = labels.where("false")
    assert toxicity.score(docs, toxicity.fit(docs, empty), F.lit(False), 0.3).agg(F.max("score")).first()[0] == 0
    assert toxicity.score(docs.where("false"), model, F.lit(False), 0.3).collect() == []
