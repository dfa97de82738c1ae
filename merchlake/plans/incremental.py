"""One incremental run: merge a delta, record the run, look for drift and lost references."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.operators import drift, quality, run_metrics
from merchlake.sources import keyed_table

TASK = "cdc_incremental_upsert"


def run_incremental(
    spark: SparkSession,
    table: str,
    delta: DataFrame,
    key: str,
    metrics: str,
    expected: Mapping[str, str] | None = None,
    baseline: DataFrame | None = None,
    sequence: str | None = None,
    threshold: float = 0.20,
    parents: Mapping[str, tuple[DataFrame, str]] | None = None,
) -> dict:
    """Merge ``delta`` into the stored table and return what was found.

    The drift reports come back as DataFrames: the delta's schema against ``expected`` and
    the merged table's column metrics against ``baseline``. ``parents`` names, by referring column, the
    table and key that the merged rows refer to; rows whose reference is lost come back with its column.
    """
    summary = run_metrics.timed_merge(
        spark, metrics, TASK, lambda: keyed_table.upsert(spark, table, delta, key, sequence)
    )
    result: dict = {"summary": summary}
    if expected is not None:
        result["schema_drift"] = drift.schema_drift(expected, drift.declared_types(delta))
    if baseline is not None:
        result["metric_drift"] = drift.metric_drift(baseline, keyed_table.read(spark, table), threshold)
    if parents:
        merged = keyed_table.read(spark, table)
        lost = [
            quality.dangling_rows(merged, column, parent, parent_key).select(key, F.lit(column).alias("lost"))
            for column, (parent, parent_key) in parents.items()
        ]
        result["lost_references"] = reduce(DataFrame.unionByName, lost)
    return result
