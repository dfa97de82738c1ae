"""Connected components by alternating large and small stars, as joins and aggregates.

A round hangs every node's larger neighbours, then its smaller ones, on the smallest node it knows;
the number of rounds grows with the logarithm of the longest path. A node's smallest neighbour is an
aggregate and is joined back, so no neighbourhood is ever gathered in one place; a node with very many
neighbours is a skewed join key, which adaptive execution splits. Each round is written to the shared
folder, which also ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.session import fresh_path

MAX_ROUNDS = 60


def _hang_larger(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    return (
        both.where(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
        .distinct()
    )


def _hang_smaller(edges: DataFrame) -> DataFrame:
    """Takes edges with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    siblings = edges.join(least, "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), "least")
    return siblings.unionByName(least).select("a", F.col("least").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not itself the least of its component.

    Loops, repeated edges and nulls are passed over. No edges give no rows.
    """
    spark = edges.sparkSession
    proper = edges.where(F.col("a") != F.col("b"))
    current = proper.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    before = None
    for _ in range(MAX_ROUNDS):
        path = fresh_path(spark, "components")
        _hang_smaller(_hang_larger(current)).write.parquet(path)
        current = spark.read.parquet(path)
        # Two sums that no round leaves equal unless the edges are.
        state = current.agg(
            F.count("*"), F.sum(F.crc32(F.concat("a", "b"))), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
