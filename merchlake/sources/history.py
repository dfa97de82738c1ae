"""Earlier states of the canonical relations, to classify, merge and load the present ones against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.sources import canonical

CUTOVER = "2000-07-01"
SMALLEST_LISTED = 6


def orders_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders placed before the cut-over, as they stood then.

    Returns had not come in yet, and the totals of pending orders were provisional, in whole
    units. Against this state the present orders are inserts (placed later), updates of the
    status, the total or both, and unchanged rows.
    """
    lines = canonical.table(spark, sf_dir, "lineitem")
    headers = canonical.table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit(CUTOVER))
    status = F.lit(None).cast("string")
    for header, name in canonical.STATUS_OF_HEADER.items():
        status = F.when(F.col("o_orderstatus") == header, name).otherwise(status)
    price = F.col("l_extendedprice")
    total = F.when(F.col("o_orderstatus") == "O", F.floor(price).cast("double")).otherwise(price)
    return lines.join(headers, lines.l_orderkey == headers.o_orderkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        total.alias("total_price"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        status.alias("status"),
    )


def customers_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as a first load found them: only those not in debt, all created on the first day."""
    return canonical.accounts(spark, sf_dir).join(
        canonical.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0).select("c_custkey"),
        F.col("customer_id") == F.col("c_custkey"),
        "left_semi",
    ).withColumn("created_at", F.lit(canonical.FIRST_DAY).cast("timestamp"))


def products_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog before its smallest parts were listed."""
    return canonical.products(spark, sf_dir).filter(F.col("stock") >= SMALLEST_LISTED)
