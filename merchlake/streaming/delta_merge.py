"""Continuous merge: a stream of delta files applied to a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from merchlake.sources import keyed_table


def merge_stream(
    spark: SparkSession,
    deltas: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    key: str,
    sequence: str | None = None,
    buckets: int = 64,
    files_per_batch: int = 1000,
    file_format: str = "parquet",
    continuous: str | None = None,
) -> StreamingQuery:
    """Start merging the delta files of a folder into a keyed table.

    The table itself is the state. A batch is recorded under its number and the id that the
    checkpoint gives the query, so one that is delivered again after a failure changes
    nothing, while a new query on the same table starts its own count. Without ``continuous`` (a trigger
    interval) all files present are merged and the query ends.
    """

    def apply(delta: DataFrame, number: int) -> None:
        metadata = delta.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata")
        batch = (metadata.first()["id"], number)
        keyed_table.upsert(delta.sparkSession, target, delta, key, sequence, buckets, batch)

    reader = spark.readStream.format(file_format).schema(schema)
    if file_format == "csv":
        reader = reader.option("header", True)
    stream = reader.option("maxFilesPerTrigger", files_per_batch).load(deltas)
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()
