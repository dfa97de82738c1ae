"""Parquet tables with insert-or-update by primary key, stored by Spark.

The rows are a Parquet table partitioned by hash buckets of their key. A merge reads the buckets its delta falls
into, writes their new rows to ``next`` and has Spark replace just these partitions. A driver lost before ``next``
is whole leaves the table as it was; one lost later leaves ``next``, with which the following call ends the merge.
A table has one writer at a time, and a reader looks before or after a merge, not during one. Choose the bucket
count so that a bucket holds about a gigabyte.

Rows without a key are kept in a partition of their own (``rejects``). With a ``sequence`` column, the last value
applied to a row is stored with it, and a delta row with a lower one changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from merchlake.operators import cdc
from merchlake.session import delete, fresh_path
from merchlake.sources import files

_BUCKET, _SEQUENCE, _NO_KEY = "__bucket", "__sequence", -1
_ACTIONS = (cdc.INSERT, cdc.UPDATE, cdc.NO_CHANGE, cdc.STALE, cdc.REJECT)
_BATCHES = "number bigint, result map<string,bigint>, source string"


def is_written(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/layout")


def _layout(spark: SparkSession, path: str) -> tuple[int, StructType]:
    """Buckets and columns; the longest entry is the last, as columns are only ever added."""
    stored = json.loads(max((row[0] for row in spark.read.text(f"{path}/layout").collect()), key=len))
    return stored["buckets"], StructType.fromJson(stored["schema"])


def _add_layout(spark: SparkSession, path: str, buckets: int, schema: StructType) -> None:
    text = json.dumps({"buckets": buckets, "schema": schema.jsonValue()})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(f"{path}/layout")


def _rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All stored rows with their bucket."""
    schema = StructType([*schema.fields, StructField(_BUCKET, IntegerType())])
    if not files.exists(spark, f"{path}/rows"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/rows")


def _stored(spark: SparkSession, path: str, which: Column) -> DataFrame:
    if not is_written(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    _, schema = _layout(spark, path)
    return _rows(spark, path, schema).filter(which).drop(_BUCKET, _SEQUENCE)


def read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table's rows; with a schema given, a table never written to reads as empty."""
    if schema is not None and not is_written(spark, path):
        return spark.createDataFrame([], schema)
    return _stored(spark, path, F.col(_BUCKET) != _NO_KEY)


def rejects(spark: SparkSession, path: str) -> DataFrame:
    """All rows that came without a key."""
    return _stored(spark, path, F.col(_BUCKET) == _NO_KEY)


def batches(spark: SparkSession, path: str) -> dict[str, tuple[int, dict[str, int]]]:
    """The last batch applied from each source, with its summary."""
    if not files.exists(spark, f"{path}/batches"):
        return {}
    kept = spark.read.schema(_BATCHES).parquet(f"{path}/batches").collect()
    return {row["source"]: (row["number"], row["result"]) for row in kept}


def recover(spark: SparkSession, path: str) -> None:
    """End a merge whose driver was lost after it had written all new rows; drop one that was lost before."""
    if files.exists(spark, f"{path}/next/_SUCCESS"):
        _, schema = _layout(spark, path)
        _replace(spark.read.schema(StructType([*schema.fields, StructField(_BUCKET, IntegerType())])).parquet(f"{path}/next"), path)
    delete(spark, f"{path}/next")


def _replace(rows: DataFrame, path: str, part: str = "rows", by: str = _BUCKET) -> None:
    """Replace the partitions that the given rows fall into."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**files.PARQUET)
    writer.partitionBy(by).parquet(f"{path}/{part}")


def _bucket_of(key: str, buckets: int) -> Column:
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
    return F.when(cdc.has_key(key), bucket).otherwise(_NO_KEY).alias(_BUCKET)


def _result(counts: dict[str, int]) -> dict[str, int]:
    result = {action: counts.get(action, 0) for action in _ACTIONS}
    result["total_delta_records"] = sum(result.values())
    return result


def _counting(tagged: DataFrame) -> tuple[DataFrame, Observation]:
    """Tagged rows by bucket without the tag, counted by it after the last exchange, where each task counts once."""
    seen = Observation()
    counted = tagged.hint("rebalance", _BUCKET).observe(
        seen, *[F.count_if(F.col(cdc.ACTION) == action).alias(action) for action in _ACTIONS]
    )
    return counted.drop(cdc.ACTION), seen


def upsert(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    key: str,
    sequence: str | None = None,
    buckets: int = 64,
    batch: tuple[str, int] | None = None,
    ignore: Sequence[str] = (),
    unique: bool = False,
    written: bool = False,
) -> dict[str, int]:
    """Insert or update the delta's rows and return the change summary.

    ``buckets`` is for a new table. A ``batch`` (its source and number) that is not above the last one
    recorded from its source makes the call a no-op. ``ignore`` names columns whose change alone is no
    update. ``unique`` says that no key repeats, which spares the check; rows without a key are rejected
    either way. ``written`` says that the delta is read from files that stay as they are until the call ends, so
    that it isn't written down once more. A batch delivered again after its driver was lost between merging and recording it finds its
    rows merged, and lists those without a key once more.
    """
    path = path.rstrip("/")
    recover(spark, path)
    if batch and (last := batches(spark, path).get(batch[0])) and batch[1] <= last[0]:
        return last[1] if batch[1] == last[0] else _result({})
    if is_written(spark, path):
        result = _merge(spark, path, delta, key, sequence, ignore, unique, written)
    else:
        result = _first_load(spark, path, delta, key, sequence, buckets, unique)
    if batch:
        record = spark.createDataFrame([(batch[1], result, batch[0])], _BATCHES)
        _replace(record.coalesce(1), path, "batches", "source")
    return result


def _ready(delta: DataFrame, key: str, sequence: str | None, columns: Sequence[str], unique: bool) -> DataFrame:
    """One row per key, with the sequence under its stored name; the column itself stays only if the table has it."""
    ready = delta if unique else cdc.last_per_key(delta, key, sequence)
    if not sequence:
        return ready
    return ready.withColumn(_SEQUENCE, F.col(sequence)).select(*[c for c in delta.columns if c in columns], _SEQUENCE)


def _first_load(
    spark: SparkSession, path: str, delta: DataFrame, key: str, sequence: str | None, buckets: int, unique: bool
) -> dict[str, int]:
    ready = _ready(delta, key, sequence, delta.columns, unique)
    action = F.when(cdc.has_key(key), cdc.INSERT).otherwise(cdc.REJECT).alias(cdc.ACTION)
    rows, seen = _counting(ready.select("*", _bucket_of(key, buckets), action))
    _replace(rows, path)
    schema = StructType([StructField(f.name, f.dataType, True) for f in ready.schema.fields])
    _add_layout(spark, path, buckets, schema)
    return _result(seen.get)


def _merge(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    key: str,
    sequence: str | None,
    ignore: Sequence[str],
    unique: bool,
    written: bool,
) -> dict[str, int]:
    """Write the delta down, unless it is already, so that it is computed once, and merge it in one join.

    It is brought down to one row per key when it is read again: the join on the key then goes on from that
    shuffle, where rows written down after it would have to be shuffled once more.
    """
    buckets, schema = _layout(spark, path)
    columns = [name for name in schema.fieldNames() if name != _SEQUENCE]
    given = cdc.aligned(delta, spark.createDataFrame([], schema).select(columns), sequence)
    ready = _ready(given, key, sequence, columns, unique)
    if sequence and _SEQUENCE not in schema.fieldNames():
        schema = StructType([*schema.fields, StructField(_SEQUENCE, ready.schema[_SEQUENCE].dataType, True)])
        _add_layout(spark, path, buckets, schema)
    staged = fresh_path(spark, "delta")
    try:
        given = given.select("*", _bucket_of(key, buckets))
        if not written:
            given.write.options(**files.PARQUET).parquet(staged)
            given = spark.read.parquet(staged)
        # As many numbers as the table has buckets at most; by them Spark prunes the partitions read.
        hit = F.broadcast(given.select(_BUCKET).distinct())
        current = _rows(spark, path, schema).join(hit, _BUCKET, "left_semi")
        keyed = F.col(_BUCKET) != _NO_KEY
        given = given.drop(_BUCKET)
        new = _ready(given, key, sequence, columns, unique).filter(cdc.has_key(key))
        lacking = _ready(cdc.rejects(given, key), key, sequence, columns, unique=True)
        merged = _merged(current.filter(keyed).select(schema.fieldNames()), new, schema, key, ignore).unionByName(
            _without_key(current.filter(~keyed), lacking, schema)
        )
        rows, seen = _counting(merged.select("*", _bucket_of(key, buckets)))
        rows.write.options(**files.PARQUET).partitionBy(_BUCKET).parquet(f"{path}/next")
    finally:
        delete(spark, staged)
    result = _result(seen.get)
    if not any(result[a] for a in (cdc.INSERT, cdc.UPDATE, cdc.REJECT)) and not sequence and not ignore:
        delete(spark, f"{path}/next")
    recover(spark, path)
    return result


def _without_key(current: DataFrame, delta: DataFrame, schema: StructType) -> DataFrame:
    """Stored and delta rows that have no key and so meet nothing, tagged; joined, they would all be one task's."""
    given = [
        (F.col(f.name) if f.name in delta.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    kept = current.select(*schema.fieldNames(), F.lit(None).cast("string").alias(cdc.ACTION))
    return kept.unionByName(delta.select(*given, F.lit(cdc.REJECT).alias(cdc.ACTION)))


def _merged(current: DataFrame, delta: DataFrame, schema: StructType, key: str, ignore: Sequence[str]) -> DataFrame:
    """Every row with a key, of the buckets and of the delta, tagged, from one full outer join on the key."""
    given = delta.columns
    new = delta.select(*[F.col(c).alias(f"_new_{c}") for c in given], F.lit(True).alias("_new"))
    joined = current.withColumn("_old", F.lit(True)).join(new, F.col(key) == F.col(f"_new_{key}"), "full")
    is_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    stale = F.lit(False)
    if _SEQUENCE in given:
        lower = F.col(f"_new_{_SEQUENCE}").cast(schema[_SEQUENCE].dataType) < F.col(_SEQUENCE)
        stale = F.coalesce(is_old & lower, F.lit(False))
    compared = [c for c in given if c in schema.fieldNames() and c not in (key, _SEQUENCE) and c not in ignore]
    differs = F.lit(False)
    for column in compared:
        differs = differs | ~F.col(column).eqNullSafe(F.col(f"_new_{column}"))
    action = (
        F.when(~has_new, None)
        .when(~is_old, cdc.INSERT)
        .when(stale, cdc.STALE)
        .when(differs, cdc.UPDATE)
        .otherwise(cdc.NO_CHANGE)
    )
    taken = ~is_old | (has_new & ~stale)

    def value(field: StructField) -> Column:
        name = field.name
        if name not in given:
            return F.col(name)
        fresh = F.col(f"_new_{name}").cast(field.dataType)
        if name == _SEQUENCE:  # a row without one keeps the last known
            fresh = F.coalesce(fresh, F.col(name))
        return F.when(taken, fresh).otherwise(F.col(name)).alias(name)

    return joined.select(*[value(field) for field in schema.fields], action.alias(cdc.ACTION))
