import zlib

from pyspark.sql import functions as F

from merchlake.llm import language_id
from merchlake.llm.queries import id_remainder, language_dictionaries, queries


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries()["op8_language_id"](spark, folder).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert held and all(r.held_out for r in held) and sum(r.held_out for r in rows) == len(held)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert sum(r.rejected for r in rows) / len(rows) < 0.02
    assert all(0 <= r.score <= 1 for r in rows)


def test_label_and_source_of_a_row_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language_dictionaries(docs)
    changed = docs.withColumn("lang", F.when(id_remainder(3) == 1, "xx").otherwise(F.col("lang")))
    assert language_dictionaries(changed) == found and "xx" not in found
    held_out = F.lit(False)
    first = language_id.identify(docs, found, held_out).collect()
    second = language_id.identify(changed.withColumn("source", F.lit("s")), found, held_out).collect()
    assert sorted(first) == sorted(second)


def test_nulls_ties_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, score int, rejected string"
    english, german = "the of and that with this have from " * 30, "der die und nicht mit dem eine auf " * 30
    rows = [(n, english if n % 2 else german, "en" if n % 2 else "de", n, None) for n in range(40)]
    rows += [(90, None, None, 0, ""), (91, "", "en", 0, ""), (92, "123 ... ²", "en", 0, ""), (None, english, None, 0, "")]
    rows += [(93, english + german, None, 0, ""), (94, "the of and that with this", None, 0, "")] * 2
    docs = spark.createDataFrame(rows, schema)
    found = language_dictionaries(docs)
    assert sorted(found) == ["de", "en"]
    result = {r.doc_id: r for r in language_id.identify(docs, found, F.lit(True)).collect()}
    assert [result[n].lang_pred for n in (1, 2, None, 94)] == ["en", "de", "en", "en"]
    for n in (90, 91, 92):
        assert (result[n].lang_pred, result[n].score, result[n].rejected) == ("und", 0.0, True)
    kept = language_id.accepted(docs, found)
    assert kept.columns == docs.columns and {90, 91, 92}.isdisjoint(r.doc_id for r in kept.collect())
    empty = spark.createDataFrame([], schema)
    assert language_dictionaries(empty) == {} and language_id.identify(empty, {}, F.lit(True)).collect() == []
    assert {r.lang_pred for r in language_id.identify(docs, {}, F.lit(True)).collect()} == {"und"}


def test_long_text_is_judged_whole(spark):
    english, german = "the of and that with this have from ", "der die und nicht mit dem eine auf "
    judge = language_id.Judge({"de": german.encode() * 50, "en": english.encode() * 50})
    words = [f"{w}{n}" for n in range(9000) for w in english.split()]
    assert judge.of(" ".join(words))[0] == "en"
    assert judge.of("und " + english * 20_000)[0] == "en"
