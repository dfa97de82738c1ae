"""Star schema: calendar, customer and product dimensions, sales facts and their reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlake.functions import money
from merchlake.functions.text import date_key
from merchlake.session import delete, fresh_path
from merchlake.sources.files import PARQUET

CUSTOMER_ATTRIBUTES = ("name", "email", "signup_channel", "created_at")
PRODUCT_ATTRIBUTES = ("name", "category", "price")
UNKNOWN_METHOD = "Unknown"

# Keys of up to so many rows may go through the driver to every task.
MOST_BROADCAST = 200_000

# monotonically_increasing_id() holds the row's position within its partition in these bits.
_POSITION = (1 << 33) - 1


# --- calendar ---------------------------------------------------------------------------


def calendar(spark: SparkSession, start_year: int = 2024, end_year: int = 2026) -> DataFrame:
    """One row per day of the given years.

    Built on ``range``, whose size Spark knows, so that it decides itself on broadcasting it.
    """
    first = dt.date(start_year, 1, 1)
    days = (dt.date(end_year, 12, 31) - first).days + 1
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    weekday = F.weekday("full_date")
    return spark.range(days).select(day.alias("full_date")).select(
        date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.when(weekday >= 5, 1).otherwise(0).alias("is_weekend"),
    )


def calendar_of(dates: DataFrame, column: str = "order_date") -> DataFrame:
    """The calendar of all years the dates fall into, so that no fact falls outside it."""
    years = dates.agg(F.min(F.year(column)), F.max(F.year(column))).first()
    today = dt.date.today().year
    first, last = (today, today) if years[0] is None else years
    return calendar(dates.sparkSession, first, last)


# --- dimensions -------------------------------------------------------------------------


def _keys(dimension: DataFrame, natural_key: str, surrogate: str) -> DataFrame:
    """Both keys of a dimension, to be joined by sorting if they have many rows.

    Spark goes by the size of the files, which is a small part of what keys in order take in memory.
    """
    keys = dimension.select(natural_key, surrogate)
    return keys if keys.count() <= MOST_BROADCAST else keys.hint("merge")


def number_rows(rows: DataFrame, key: str, name: str, after: Column | None = None) -> DataFrame:
    """Add dense numbers in key order, following ``after``, without sorting in one task.

    The rows are range-partitioned, sorted by key and written down with their partition and their
    position in it. A row's number is then the size of the partitions before its own plus its
    position; only one row count per partition is brought together. Rows that already have a number in the
    column ``name`` keep it: they are sorted behind the others of their partition and aren't counted.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, "numbered")
    known = F.col(name) if name in rows.columns else F.lit(None).cast("bigint")
    part, position = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))
    ordered = rows.withColumn("_known", known).repartitionByRange(F.col(key))
    ordered = ordered.sortWithinPartitions(F.col("_known").isNotNull(), key)
    ordered.select("*", part.alias("_part"), position.alias("_position")).write.options(**PARQUET).parquet(path)
    placed = spark.read.parquet(path)
    sizes = placed.groupBy("_part").agg(F.count_if(F.col("_known").isNull()).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    offsets = sizes.select("_part", before.alias("_before"))
    start = F.lit(0).cast("bigint") if after is None else after
    number = F.coalesce("_known", (start + F.col("_before") + F.col("_position") + 1).cast("bigint"))
    rest = [c for c in rows.columns if c != name]
    # One row per partition written: bounded by the partition count.
    return placed.join(F.broadcast(offsets), "_part").select(number.alias(name), *rest)


def load_dimension(
    incoming: DataFrame,
    natural_key: str,
    surrogate: str,
    attributes: Sequence[str],
    current: DataFrame | None = None,
) -> DataFrame:
    """Incoming rows with their surrogate key: the one they have, or the next free one.

    One left join finds the known keys; a current table stored in buckets of the natural key isn't shuffled.
    """
    rows = incoming.select(natural_key, *attributes)
    if current is None:
        return number_rows(rows, natural_key, surrogate)
    known = _keys(current, natural_key, surrogate)
    highest = known.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    return number_rows(rows.join(known, natural_key, "left"), natural_key, surrogate, highest)


def overlay_dimension(current: DataFrame, loaded: DataFrame, surrogate: str) -> DataFrame:
    """The dimension after a load: its other rows stay, loaded ones replace theirs."""
    return current.join(loaded.select(surrogate), surrogate, "left_anti").unionByName(loaded)


def dim_customer(customers: DataFrame, current: DataFrame | None = None) -> DataFrame:
    return load_dimension(customers, "customer_id", "customer_key", CUSTOMER_ATTRIBUTES, current)


def dim_product(products: DataFrame, current: DataFrame | None = None) -> DataFrame:
    return load_dimension(products, "product_id", "product_key", PRODUCT_ATTRIBUTES, current)


# --- facts ------------------------------------------------------------------------------


def _resolved(
    orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    days: DataFrame,
) -> DataFrame:
    """Orders with their dimension keys (NULL where unknown) and one payment method.

    Payments are brought down to the latest per order before the join, so that a second
    payment cannot repeat its order; they are joined first, where both sides may already be
    partitioned by order. A hot customer or product is split by the adaptive
    skew join; the calendar is matched on a key computed from the date. The payments, and the orders after
    each join that shuffles them, are written down: what a step shuffles goes before the next one, and so
    does the step before.
    """
    spark, last = orders.sparkSession, None

    def written(rows: DataFrame, name: str) -> DataFrame:
        nonlocal last
        path = fresh_path(spark, name)
        rows.write.options(**PARQUET).parquet(path)
        if last:
            delete(spark, last)
        last = path
        return spark.read.schema(rows.schema).parquet(path)

    newest = Window.partitionBy("order_id").orderBy(F.desc("payment_date"), F.desc("payment_id"), F.desc("payment_method"))
    latest = (
        payments.select("order_id", "payment_date", "payment_id", "payment_method")
        # No limit on a row number, which would sort every task's payments before the shuffle as well.
        .withColumn("_behind", F.lag(F.lit(True)).over(newest))
        .filter("_behind IS NULL")
        .select("order_id", "payment_method")
    )
    sold = orders.select("order_id", "customer_id", "product_id", "quantity", "total_price", "order_date", "status")
    paid = written(sold.join(written(latest, "latest-payments"), "order_id", "left"), "paid-orders")
    bought = written(paid.join(_keys(customers, "customer_id", "customer_key"), "customer_id", "left"), "bought")
    return (
        bought.withColumn("_day", date_key(F.col("order_date").cast("timestamp")))
        .join(days.select("date_key"), F.col("_day") == F.col("date_key"), "left")
        .join(_keys(products, "product_id", "product_key"), "product_id", "left")
    )


def fact_sales(
    orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    days: DataFrame,
) -> DataFrame:
    """One fact per order whose three dimension rows exist."""
    known = F.col("customer_key").isNotNull() & F.col("product_key").isNotNull() & F.col("date_key").isNotNull()
    return _resolved(orders, payments, customers, products, days).filter(known).select(
        "order_id",
        "customer_key",
        "product_key",
        "date_key",
        "quantity",
        money.per_unit(F.col("total_price"), F.col("quantity")).alias("unit_price"),
        "total_price",
        F.col("status").alias("order_status"),
        F.coalesce("payment_method", F.lit(UNKNOWN_METHOD)).alias("payment_method"),
    )


def fact_rejects(
    orders: DataFrame, customers: DataFrame, products: DataFrame, days: DataFrame
) -> DataFrame:
    """Orders that give no fact, with every dimension that lacks their row."""
    lacking = F.array_compact(
        F.array(
            F.when(F.col("customer_key").isNull(), "customer"),
            F.when(F.col("product_key").isNull(), "product"),
            F.when(F.col("date_key").isNull(), "date"),
        )
    )
    return (
        orders.withColumn("_day", date_key(F.col("order_date").cast("timestamp")))
        .join(days.select("date_key"), F.col("_day") == F.col("date_key"), "left")
        .join(_keys(customers, "customer_id", "customer_key"), "customer_id", "left")
        .join(_keys(products, "product_id", "product_key"), "product_id", "left")
        .withColumn("lacking", lacking)
        .filter(F.size("lacking") > 0)
        .select("order_id", "customer_id", "product_id", "order_date", "lacking")
    )


# --- reports ----------------------------------------------------------------------------
# A fact table holds one row per order_id, so counting distinct orders is counting rows.


def category_drilldown(fact: DataFrame, products: DataFrame, days: DataFrame) -> DataFrame:
    """Orders, items and revenue by year, quarter and category.

    Facts are brought down to one row per quarter and product before they meet the products.
    """
    per_product = (
        fact.join(days.select("date_key", "year", "quarter"), "date_key")
        .groupBy("year", "quarter", "product_key")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("quantity").alias("items"),
            money.exact(F.col("total_price")).alias("revenue"),
        )
    )
    return (
        per_product.join(products.select("product_key", "category"), "product_key")
        .groupBy("year", "quarter", "category")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("items").alias("total_items_sold"),
            money.rounded(F.sum("revenue")).alias("category_revenue"),
        )
        .orderBy("year", "quarter", F.desc("category_revenue"), "category")
    )


def weekend_performance(fact: DataFrame, days: DataFrame) -> DataFrame:
    """Weekend against weekday sales; facts are brought down to one row per day first."""
    per_day = fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("quantity").alias("items"),
        money.exact(F.col("total_price")).alias("revenue"),
        money.counted(F.col("total_price")).alias("priced"),
    )
    day_type = F.when(F.col("is_weekend") == 1, "Weekend").otherwise("Weekday")
    revenue = F.sum("revenue")
    return (
        per_day.join(days.select("date_key", "is_weekend"), "date_key")
        .groupBy(day_type.alias("day_type"))
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("items").alias("total_items_sold"),
            money.rounded(revenue).alias("total_revenue"),
            money.average(revenue, F.sum("priced")).alias("avg_order_value"),
        )
    )


def top_customers(fact: DataFrame, customers: DataFrame, limit: int = 5) -> DataFrame:
    """The customers with the highest spend; names are looked up for those few alone."""
    best = (
        fact.groupBy("customer_key")
        .agg(
            F.count(F.lit(1)).alias("total_orders"),
            money.total(F.col("total_price")).alias("total_spend"),
        )
        .orderBy(F.desc("total_spend"), "customer_key")
        .limit(limit)
    )
    return (
        customers.select("customer_key", "name", "email")
        .join(best, "customer_key")
        .orderBy(F.desc("total_spend"), "customer_key")
        .select("name", "email", "total_orders", "total_spend")
    )
