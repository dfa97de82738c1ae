"""The five relations as an uncleaned, all-text delivery over a scale-factor folder.

The audit, the load rejects and the reference checks need faulty input. Every fault here
follows from the data: line numbers repeat within an order, returns are booked as negative
amounts, customers in debt and small parts are listed under another key than the one that
orders use, one country writes its dates the other way round, and so on. No row is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.functions.text import MOMENT_FORMAT
from merchlake.sources import canonical

# Fixed values of the delivery's faults.
DAY_FIRST_NATION = 24
NO_EMAIL_SEGMENT = "MACHINERY"
GIVEAWAY_CATEGORY = "PROMO"
SMALLEST_LISTED_SIZE = 6
OTHER_KEY = "X-"
RESERVED_STOCK = 10
URGENT = "1-URGENT"
VALUE_PER_STAR = 30
LARGEST_SIZE = 50


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _moment(column: str) -> Column:
    return F.date_format(column, MOMENT_FORMAT)


def _line_key() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def _rekeyed(column: str, unless: Column) -> Column:
    """A key as text, marked so that references to it dangle."""
    return F.when(unless, _text(column)).otherwise(F.concat(F.lit(OTHER_KEY), _text(column)))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = canonical.table(spark, sf_dir, "customer")
    opened = F.when(
        F.col("c_nationkey") == DAY_FIRST_NATION, F.lit("31/01/1995 00:00:00")
    ).otherwise(F.lit(canonical.FIRST_DAY))
    email = F.when(F.col("c_mktsegment") == NO_EMAIL_SEGMENT, F.lit("N/A")).otherwise(
        F.concat("c_name", F.lit("@example.com"))
    )
    return source.select(
        _rekeyed("c_custkey", F.col("c_acctbal") >= 0).alias("customer_id"),
        F.col("c_name").alias("name"),
        email.alias("email"),
        opened.alias("created_at"),
        F.col("c_mktsegment").alias("signup_channel"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = canonical.table(spark, sf_dir, "part")
    price = F.when(F.col("p_type") == GIVEAWAY_CATEGORY, F.lit("0.0")).otherwise(_text("p_retailprice"))
    return source.select(
        _rekeyed("p_partkey", F.col("p_size") >= SMALLEST_LISTED_SIZE).alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        price.alias("price"),
        (F.col("p_size") - RESERVED_STOCK).cast("string").alias("stock"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = canonical.table(spark, sf_dir, "lineitem")
    headers = canonical.table(spark, sf_dir, "orders")
    returned = F.col("l_returnflag") == canonical.RETURNED
    sign = F.when(returned, F.lit("-")).otherwise(F.lit(""))
    day = F.when(
        F.col("o_orderpriority") == URGENT, F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(_moment("o_orderdate"))
    status = F.when(returned, "Returned")
    for header, name in canonical.STATUS_OF_HEADER.items():
        status = status.when(F.col("o_orderstatus") == header, name)
    return lines.join(headers, lines.l_orderkey == headers.o_orderkey, "left").select(
        _line_key().alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        _text("l_partkey").alias("product_id"),
        F.concat(sign, F.col("l_quantity").cast("int").cast("string")).alias("quantity"),
        F.concat(sign, _text("l_extendedprice")).alias("total_price"),
        day.alias("order_date"),
        status.alias("status"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = canonical.table(spark, sf_dir, "lineitem")
    headers = canonical.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    method = F.when(
        F.col("o_orderpriority") == canonical.NO_METHOD_PRIORITY, F.lit("None")
    ).otherwise(F.col("o_orderpriority"))
    status = F.when(F.col("l_linestatus") == "F", "Completed").otherwise("Open")
    return lines.join(headers, lines.l_orderkey == headers.o_orderkey, "left").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("payment_id"),
        _line_key().alias("order_id"),
        method.alias("payment_method"),
        _text("l_discount").alias("amount"),
        status.alias("status"),
        _moment("l_shipdate").alias("payment_date"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = canonical.table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") != "error", F.col("event_type")).otherwise(F.lit(""))
    return source.select(
        _text("event_id").alias("review_id"),
        _text("user_id").alias("customer_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        F.floor(F.col("value") / VALUE_PER_STAR).cast("string").alias("rating"),
        text.alias("review_text"),
        _moment("ts").alias("review_date"),
    )


def lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw lines (line) of products and reviews, as they came over a bad connection.

    Products of the largest size have a field too many and those of the next one end in an open quote; errors
    among the reviews lack their date.
    """
    parts = canonical.table(spark, sf_dir, "part")
    fields = ("p_partkey", "p_name", "p_type", "p_retailprice", "p_size")
    product = F.concat_ws(",", *[_text(c) for c in fields])
    product = (
        F.when(F.col("p_size") == LARGEST_SIZE, F.concat(product, F.lit(",surplus")))
        .when(F.col("p_size") == LARGEST_SIZE - 1, F.concat_ws(",", _text("p_partkey"), F.concat(F.lit('"'), "p_name"), "p_type"))
        .otherwise(product)
    )
    events = canonical.table(spark, sf_dir, "events")
    review = (_text("event_id"), _text("user_id"), F.get_json_object("props", "$.k"), F.lit("5"), F.col("event_type"))
    review = F.when(F.col("event_type") == "error", F.concat_ws(",", *review)).otherwise(F.concat_ws(",", *review, _moment("ts")))
    return {
        "products": parts.select(product.alias("line")),
        "reviews": events.select(review.alias("line")),
    }


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir),
        "products": products(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "payments": payments(spark, sf_dir),
        "reviews": reviews(spark, sf_dir),
    }
