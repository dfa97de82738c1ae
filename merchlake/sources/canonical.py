"""The five relations as views over the TPC-H-like tables of a scale-factor folder.

``orders`` is one row per order line: the line table LEFT JOINed to its order header, whose
key is unique. A report that needs line columns only can therefore use ``order_lines`` and
skip that join without changing its result; ``accounts`` does the same for customers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Order status by header status, for lines that were not returned.
STATUS_OF_HEADER = {"F": "Completed", "O": "Pending", "P": "Shipped"}
RETURNED = "R"
NO_METHOD_PRIORITY = "5-LOW"
FIRST_DAY = "1995-01-01 00:00:00"


# Schemas found so far, by session and path: finding one is a job of its own.
_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    found = (spark.sparkContext.applicationId, path)
    if found not in _SCHEMAS:
        _SCHEMAS[found] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[found]).parquet(path)


def _line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _not_returned() -> Column:
    return (F.col("l_returnflag") != RETURNED) | F.col("l_returnflag").isNull()


def _status() -> Column:
    known = F.when(F.col("l_returnflag") == RETURNED, "Cancelled")
    for header, status in STATUS_OF_HEADER.items():
        known = known.when(F.col("o_orderstatus") == header, status)
    return known


def _order_columns(status: Column) -> list[Column]:
    return [
        _line_id().alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_price"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        status.alias("status"),
    ]


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, headers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(headers, lines.l_orderkey == headers.o_orderkey, "left")
    return joined.select(*_order_columns(_status()))


def orders_with_status(spark: SparkSession, sf_dir: str, status: str) -> DataFrame:
    """The rows of ``orders`` having one of the header statuses.

    The status spans both tables, so a filter on it stays above their join. Stated on the
    source columns it reaches both scans and cuts what the join has to shuffle.
    """
    header = next(h for h, s in STATUS_OF_HEADER.items() if s == status)
    lines = table(spark, sf_dir, "lineitem").filter(_not_returned())
    headers = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == header)
    joined = lines.join(headers, lines.l_orderkey == headers.o_orderkey)
    return joined.select(*_order_columns(F.lit(status)))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``orders`` that come from the line table alone."""
    return table(spark, sf_dir, "lineitem").select(
        _line_id().alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_price"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per order line, priced after its discount."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("I-"), _line_id()).alias("item_id"),
        _line_id().alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        (F.floor(net * 100 + 0.5) / 100).alias("total_price"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order line; of orders of the lowest priority the method is not known."""
    lines, headers = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    method = F.when(F.col("o_orderpriority") != NO_METHOD_PRIORITY, F.col("o_orderpriority"))
    status = (
        F.when(F.col("l_returnflag") == RETURNED, "Refunded")
        .when(F.col("o_orderstatus") == "O", "Pending")
        .otherwise("Completed")
    )
    return lines.join(headers, lines.l_orderkey == headers.o_orderkey, "left").select(
        _line_id().alias("payment_id"),
        _line_id().alias("order_id"),
        method.alias("payment_method"),
        F.col("l_extendedprice").alias("amount"),
        status.alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("payment_date"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without their first order date. E-mail texts are raw: padded, upper case."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit("@EXAMPLE.COM ")).alias("email"),
        F.col("c_mktsegment").alias("signup_channel"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_orders = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(F.min("o_orderdate").cast("timestamp").alias("first_order"))
    )
    return accounts(spark, sf_dir).join(first_orders, "customer_id", "left").select(
        "customer_id",
        "name",
        "email",
        F.coalesce("first_order", F.lit(FIRST_DAY).cast("timestamp")).alias("created_at"),
        "signup_channel",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        F.col("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        (1 + F.col("event_id") % 5).cast("int").alias("rating"),
        F.col("event_type").alias("review_text"),
        F.col("ts").cast("timestamp").alias("review_date"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews without their JSON-held product, for reports on the rating alone."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("review_id"),
        (1 + F.col("event_id") % 5).cast("int").alias("rating"),
    )


def relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir),
        "products": products(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "payments": payments(spark, sf_dir),
        "reviews": reviews(spark, sf_dir),
    }
