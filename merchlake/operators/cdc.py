"""Change classification and key-based merge.

Columns are compared as typed values after casting the delta to the current table's types. Both operators
are one join on the key; for a delta known to be small they first reduce the current table to its keys,
which broadcasts the delta and leaves the current table unshuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSERT, UPDATE, NO_CHANGE, REJECT = "INSERT", "UPDATE", "NO_CHANGE", "REJECT"
STALE = "STALE"  # a delta row older than the stored one; only stored tables know it
ACTION, CHANGED = "_cdc_action", "_changed_columns"


def has_key(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string") != "", F.lit(False))


def aligned(delta: DataFrame, current: DataFrame, sequence: str | None = None) -> DataFrame:
    """The delta's columns in the current table's types; an unknown column raises."""
    types = {f.name: f.dataType for f in current.schema.fields}
    unknown = [c for c in delta.columns if c not in types and c != sequence]
    if unknown:
        raise ValueError(f"delta has columns the table lacks: {unknown}")
    return delta.select(*[F.col(c).cast(types[c]) if c in types else F.col(c) for c in delta.columns])


def last_per_key(delta: DataFrame, key: str, sequence: str | None = None) -> DataFrame:
    """One row per key: the last by ``sequence``, or a failure on repeated keys without it.

    Rows with a key are shuffled once, by it, so that a join on the key goes on from there, and sorted once, behind
    the shuffle: a limit on a row number would sort every task's rows before it too, which spills where few keys
    repeat. Rows without a key all stay, where they are.
    """
    if sequence:
        rest = [c for c in delta.columns if c not in (key, sequence)]
        last = Window.partitionBy(key).orderBy(F.desc(sequence), *[F.desc(c) for c in rest])
        keyed = delta.filter(has_key(key)).withColumn("_behind", F.lag(F.lit(True)).over(last))
        keyed = keyed.filter("_behind IS NULL")
    else:
        last = Window.partitionBy(key).orderBy(key)
        message = F.concat(F.lit("key repeated in delta, give a sequence column: "), F.col(key).cast("string"))
        one = F.when(F.col("_nth") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        keyed = delta.filter(has_key(key)).withColumn("_nth", F.row_number().over(last)).filter(one)
    return keyed.select(delta.columns).unionByName(rejects(delta, key))


def rejects(delta: DataFrame, key: str) -> DataFrame:
    """Delta rows without a key; they can be neither inserted nor merged."""
    return delta.filter(~has_key(key))


def _touched(current: DataFrame, delta: DataFrame, key: str, small_delta: bool) -> DataFrame:
    """The current rows that the delta may meet: all, or for a small delta those with its keys."""
    if not small_delta:
        return current
    return current.join(delta.select(F.col(key).alias("_delta_key")), F.col(key) == F.col("_delta_key"), "left_semi")


def _differing(columns: Sequence[str], current: DataFrame, key: str, ignore: Sequence[str]) -> Column:
    """Names of the shared columns that differ between a delta row and its current row, ``_old``."""
    compared = [c for c in columns if c in current.columns and c != key and c not in ignore]
    none = F.array().cast("array<string>")
    if not compared:
        return none
    differing = F.array_compact(
        F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_old.{c}")), F.lit(c)) for c in compared])
    )
    return F.when(F.col("_old").isNull(), none).otherwise(differing)


def _action(key: str) -> Column:
    return (
        F.when(~has_key(key), REJECT)
        .when(F.col("_old").isNull(), INSERT)
        .when(F.size(CHANGED) > 0, UPDATE)
        .otherwise(NO_CHANGE)
    )


def _old(current: DataFrame, key: str) -> DataFrame:
    return current.select(F.col(key).alias("_old_key"), F.struct(*current.columns).alias("_old"))


def _prepared(
    current: DataFrame, delta: DataFrame, key: str, sequence: str | None, unique: bool = False
) -> DataFrame:
    ready = aligned(delta, current, sequence)
    if not unique:
        ready = last_per_key(ready, key, sequence)
    return ready.drop(sequence) if sequence and sequence not in current.columns else ready


def classify(
    current: DataFrame,
    delta: DataFrame,
    key: str,
    sequence: str | None = None,
    ignore: Sequence[str] = (),
    small_delta: bool = False,
) -> DataFrame:
    """Delta rows tagged with ``_cdc_action`` and the array ``_changed_columns``.

    A row is an INSERT if its key is new, an UPDATE if a shared column differs, else a
    NO_CHANGE; rows without a key are tagged REJECT. ``small_delta`` reduces the current table to the
    delta's keys first, so that it need not be shuffled while the delta can be broadcast.
    """
    ready = _prepared(current, delta, key, sequence)
    # Rows without a key meet nothing; left out of the join, they leave both sides partitioned by key.
    keyed = ready.filter(has_key(key))
    old = _old(_touched(current.filter(has_key(key)), keyed, key, small_delta), key)
    tagged = (
        keyed.join(old, F.col(key) == F.col("_old_key"), "left")
        .drop("_old_key")
        .withColumn(CHANGED, _differing(ready.columns, current, key, ignore))
        .withColumn(ACTION, _action(key))
        .drop("_old")
    )
    none = F.array().cast("array<string>")
    return tagged.unionByName(rejects(ready, key).withColumn(CHANGED, none).withColumn(ACTION, F.lit(REJECT)))


def summary(classified: DataFrame) -> DataFrame:
    """One row: delta rows by action, and in all."""

    def rows(action: str) -> Column:
        return F.count_if(F.col(ACTION) == action).alias(action)

    return classified.agg(
        rows(INSERT), rows(UPDATE), rows(NO_CHANGE), rows(REJECT),
        F.count(F.lit(1)).alias("total_delta_records"),
    )


def merge(
    current: DataFrame, delta: DataFrame, key: str, sequence: str | None = None, small_delta: bool = False
) -> DataFrame:
    """Current rows overlaid by the delta; columns the delta lacks keep their value.

    One full outer join. For a ``small_delta`` the rows it meets and the rows it does not are found by
    its keys instead, which leaves the current table unshuffled while the delta can be broadcast.
    """
    ready = _prepared(current, delta, key, sequence).filter(has_key(key))
    kept = [c for c in current.columns if c not in ready.columns]
    if small_delta:
        old = _old(_touched(current, ready, key, True), key)
        met = ready.join(old, F.col(key) == F.col("_old_key"), "left").select(
            *[F.col(f"_old.{c}").alias(c) if c in kept else F.col(c) for c in current.columns]
        )
        keys = ready.select(F.col(key).alias("_delta_key"))
        untouched = current.join(keys, F.col(key) == F.col("_delta_key"), "left_anti")
        return untouched.unionByName(met)
    new = ready.select(*[F.col(c).alias(f"_new_{c}") for c in ready.columns], F.lit(True).alias("_new"))
    given = F.col("_new").isNotNull()
    return current.join(new, F.col(key) == F.col(f"_new_{key}"), "full").select(
        *[
            F.col(c) if c in kept else F.when(given, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            for c in current.columns
        ]
    )


def without_tags(table: DataFrame) -> DataFrame:
    return table.drop(ACTION, CHANGED)
