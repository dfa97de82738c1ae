"""The operators as queries over the tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.llm import (
    decontaminate,
    impact_search,
    language_id,
    line_quality,
    near_dedup,
    packing,
    passages,
    sharding,
    suffix_dedup,
    token_counts,
    toxicity,
    url_rules,
    whitening,
)
from merchlake.llm.shipping import ship_package
from merchlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MAX_TOKENS = 1024
END_ID = 2
SHARDS = 24
# The site rules of the query on URLs.
SITE_RULES = (
    url_rules.SiteRule("block", "net", "/"),
    url_rules.SiteRule("allow", "example.net", "/en/"),
    url_rules.SiteRule("block", "example.com", "/de/"),
    url_rules.SiteRule("allow", "org", "/fr/"),
)


def _register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship_package(configure(spark)), sf_dir)

    _QUERIES[query.__name__] = run
    return query


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


@_register
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text under the public byte-level vocabulary."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), BYTE_BPE, MAX_TOKENS)


@_register
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the best window for each item."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_register
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the 400-byte strings that start at another place too."""
    kept = suffix_dedup.strip_repeats(_table(spark, sf_dir, "documents"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", digest, (F.col("n_removed") > 0).alias("has_repeats"))


@_register
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text; a quarter of the ids is held out from learning."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(id_remainder(4) == 2, F.lit(False))
    model = toxicity.fit(docs, labels.where(id_remainder(4) != 2))
    return toxicity.score(docs, model, held_out, threshold=0.3)


@_register
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to 24 shards in random order; where each one went."""
    return sharding.shard_digest(_table(spark, sf_dir, "documents"), SHARDS)


@_register
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 1024 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), BYTE_BPE, MAX_TOKENS, END_ID)


@_register
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the line frequency rules on every document."""
    return line_quality.quality(_table(spark, sf_dir, "documents"))


def language_dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries learned from the rows whose id is not held out, the languages being those of ``lang``."""
    learned = docs.where(id_remainder(3) != 1)
    return language_id.fit(learned.select("text", "lang", F.xxhash64("doc_id").alias("rank")))


@_register
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; a third of the ids is held out from learning."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(3) == 1, F.lit(False))
    return language_id.identify(docs, language_dictionaries(docs), held_out)


@_register
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near and exact copies that every document belongs to."""
    return near_dedup.classes(_table(spark, sf_dir, "documents"))


@_register
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuzzy passages of 50 words and more that documents share."""
    return passages.repeated_passages(_table(spark, sf_dir, "documents"))


@_register
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL, by site rules and by token rules mined from the labels."""
    pages = _table(spark, sf_dir, "pages")
    mined = url_rules.mine(url_rules.labelled_urls(pages, _table(spark, sf_dir, "labels")))
    return url_rules.judge(pages, SITE_RULES, mined)


@_register
def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of all for each benchmark item."""
    return impact_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_register
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 32 whitened components of every usable vector."""
    return whitening.whitened_components(_table(spark, sf_dir, "embeddings"))
