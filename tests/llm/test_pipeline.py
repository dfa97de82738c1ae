import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from merchlake.llm import language_id
from merchlake.llm.near_dedup import classes, one_of_each
from merchlake.llm.passages import repeated_passages
from merchlake.llm.queries import language_dictionaries

from .test_decontaminate import brute_force as leaks

FOLDER = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        found = stage(spark, docs, FOLDER)
        assert found.columns == docs.columns, name
        after = {r.doc_id: r for r in found.collect()}
        if name == "language_id":
            judge = language_id.Judge(language_dictionaries(docs))
            assert after.keys() == {i for i, r in before.items() if not judge.of(r.text or "")[2]}
        if name == "minhash_near_dedup":
            assert after.keys() == {r.doc_id for r in classes(docs).collect() if r.kept}
        if name == "substring_dedup":
            cut = {r.doc_id for r in repeated_passages(docs).collect()}
            changed = {i for i, r in before.items() if i not in after or after[i].text != r.text}
            assert changed == cut
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "benchmark_decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            assert after.keys() == before.keys() - {d for d, _ in leaks([(i, r.text) for i, r in before.items()], items)}
        docs = spark.createDataFrame([tuple(r) for r in after.values()], docs.schema)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        ids.setdefault(r.doc_id, []).extend(r.ids)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert ids == {i: [*library.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}


def test_run_keeps_most_documents(spark):
    result = corpus_pipeline.run(spark, FOLDER)
    kept = result.select("doc_id").distinct().count()
    total = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert 0.75 * total < kept <= total


def test_one_of_each_with_nulls_repeats_and_clashes(spark):
    rng = random.Random(9)
    base = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    text, near, other = " ".join(base), " ".join([*base[:-1], "changed"]), " ".join(base[::-1])
    schema = "doc_id long, text string, key string, first int, low int"
    rows = [(5, text, "", 1, 1), (4, near, "", 1, 1), (4, near, "", 1, 1), (None, text, "", 1, 1), (6, other, "", 1, 1)]
    rows += [(1, None, "", 1, 1), (1, None, "", 1, 1), (None, "alone", "", 1, 1), (7, "", "", 1, 1), (8, "", "", 1, 1)]
    docs = spark.createDataFrame(rows, schema)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert found == sorted([(4, near), (6, other), (1, None), (1, None), (None, "alone"), (7, "")], key=repr)
    assert one_of_each(docs.where("false")).collect() == []
