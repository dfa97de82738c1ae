"""Catalog tables in hash buckets of their key, so that a merge moves the delta alone.

A table is stored by Spark's ``bucketBy`` and ``sortBy``: a join on the key reads it bucket by bucket, without an
exchange. Choose as many buckets as the cluster has tasks for a shuffle (``spark.sql.shuffle.partitions``) or
more; with fewer, Spark prefers to shuffle the table as well. A merge writes the next generation to a folder of
its own, each task the bucket it joined, and then points the table to it; readers and a lost driver see the
generation before or the one after. The catalog decides how long a table's name lives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.operators import cdc
from merchlake.session import delete, fresh_path


def _write(rows: DataFrame, name: str, key: str, buckets: int) -> str:
    path = fresh_path(rows.sparkSession, name)
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return path


def store(rows: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Store rows, one per key, as a new table of one sorted file a bucket, and return it."""
    _write(rows.repartition(buckets, F.col(key)), name, key, buckets)
    return rows.sparkSession.table(name)


def drop(spark: SparkSession, name: str) -> None:
    """Delete a table and its files."""
    path = _detail(spark, name, "Location")
    spark.sql(f"DROP TABLE {name}")
    delete(spark, path)


def _detail(spark: SparkSession, name: str, what: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return details.filter(F.col("col_name") == what).first()["data_type"]


def merge(
    spark: SparkSession, name: str, delta: DataFrame, key: str, sequence: str | None = None, keep_old: bool = False
) -> DataFrame:
    """Merge a delta into a stored table and return the table; rows without a key change nothing.

    The generation before is deleted unless ``keep_old``, which lets its readers end.
    """
    current = spark.table(name)
    buckets, before = int(_detail(spark, name, "Num Buckets")), _detail(spark, name, "Location")
    following = f"{name}_next"
    spark.sql(f"DROP TABLE IF EXISTS {following}")
    # The join's tasks hold a bucket each, so that nothing is shuffled on the way to the files.
    path = _write(cdc.merge(current, delta, key, sequence), following, key, buckets)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.sql(f"DROP TABLE {following}")
    spark.catalog.refreshTable(name)
    if not keep_old:
        delete(spark, before)
    return spark.table(name)
