"""Two-pass external shuffle of documents into shards.

Pass one scatters the rows by seeded hashes: the shard is the one whose hash with the document's id
is the highest, so that one shard more takes rows only into itself, and within a shard another hash
deals the rows evenly to buckets small enough for a task's memory. Pass two puts each bucket into a
random order by Fisher-Yates (Spark's ``shuffle`` of an array) and writes it once, below its shard's
folder. A row's slot is its bucket's offset in the shard plus its place in the bucket.

Only DataFrame functions are used. The texts are shuffled once and written once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlake.session import fresh_path

# Bytes of documents in a bucket: what a task may hold as one array, with room for copies of it.
BUCKET_BYTES = 32 << 20
SEED = 20_260


def document_size() -> Column:
    """UTF-8 bytes of the text (a null has none) plus 8 for the id."""
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8


def key_shard(doc_id: Column, shards: int, seed: int) -> Column:
    """The shard with the highest seeded hash; a null id hashes as its shard number alone."""
    ranked = [F.struct(F.xxhash64(F.lit(seed), F.lit(n), doc_id).alias("h"), F.lit(n).alias("n")) for n in range(shards)]
    return (F.greatest(*ranked) if shards > 1 else ranked[0])["n"]


def write_shards(
    docs: DataFrame, shards: int, path: str, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Writes all rows, with all columns, to shards 0 to ``shards`` - 1 below ``path`` and reads them back.

    Result: shard, bucket, place (from 0 in the bucket) and ``doc``, the row as it was given, so that no
    column can clash. A null text has size 8; repeated rows are rows like any others, and those of one id
    are dealt to the buckets of their shard by text and input partition. An empty table gives no rows.
    """
    total = docs.agg(F.sum(document_size())).first()[0] or 0
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    spread = F.xxhash64(F.lit(seed + 1), "doc_id", "text", F.spark_partition_id())
    keyed = docs.select(
        key_shard(F.col("doc_id"), shards, seed).alias("shard"),
        F.pmod(spread, F.lit(per_shard)).cast("int").alias("bucket"),
        spread.alias("spread"),
        F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("doc"),
    )
    # The sort makes the order before Fisher-Yates, and so the result, independent of arrival.
    scattered = keyed.repartition(shards * per_shard, "shard", "bucket").sortWithinPartitions(
        "shard", "bucket", "spread", "doc.doc_id"
    )
    shuffled = (
        scattered.groupBy("shard", "bucket")
        .agg(F.collect_list("doc").alias("docs"))
        .select("shard", "bucket", F.posexplode(F.shuffle("docs", F.lit(seed))).alias("place", "doc"))
        .sortWithinPartitions("shard", "bucket", "place")
    )
    shuffled.write.partitionBy("shard").parquet(path)
    schema = T.StructType([field for field in shuffled.schema if field.name != "shard"]).add("shard", T.IntegerType())
    return docs.sparkSession.read.schema(schema).parquet(path)


def slots(written: DataFrame) -> DataFrame:
    """The written rows with ``slot``, gapless from 0 in each shard."""
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return written.join(offsets, ["shard", "bucket"]).withColumn("slot", F.col("offset") + F.col("place"))


def shard_digest(docs: DataFrame, shards: int) -> DataFrame:
    """Shards all documents and describes each: size, checksum, shard, slot, and its shard if there were one more."""
    written = write_shards(docs, shards, fresh_path(docs.sparkSession, "shards"))
    narrow = written.select(
        "shard",
        "bucket",
        "place",
        F.col("doc.doc_id").cast("bigint").alias("doc_id"),
        F.col("doc.text").alias("text"),
    ).select(
        "shard",
        "bucket",
        "place",
        "doc_id",
        document_size().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        key_shard(F.col("doc_id"), shards + 1, SEED).alias("grown_shard"),
    )
    return slots(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
