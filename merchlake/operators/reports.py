"""Sales, product, customer, payment, review and time reports.

Facts are aggregated to one row per key below every join: a hot key is reduced where it is
read, only one row per key and task is shuffled, and fan-out cannot arise. Money is summed
exactly and rounded once, in the result. Two definitions
of revenue live side by side: the catalog reports count every order status, while
``product_sales_summary`` and ``category_revenue`` count completed orders only. Orders and
payments are keyed relations, so a count of their ids is a count of rows. Every ranking
ends with the entity's key, which makes ties come out the same each time.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.functions import money

# The labels of the rating classes.
SENTIMENTS = (
    "Positive (4-5 Stars)",
    "Neutral (3 Stars)",
    "Negative (1-2 Stars)",
)


def _rows() -> Column:
    return F.count(F.lit(1))


def _units() -> Column:
    return F.coalesce(F.sum("quantity"), F.lit(0))


def _or_zero(column: str, zero: int | float = 0) -> Column:
    return F.coalesce(F.col(column), F.lit(zero)).alias(column)


# --- headline figures -------------------------------------------------------------------


def executive_kpis(
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
) -> DataFrame:
    """One row of headline figures; one aggregate per table, zeros over empty tables."""
    spark = orders.sparkSession
    sales = orders.agg(
        F.struct(
            _rows().alias("total_orders"),
            money.exact(F.col("total_price")).alias("revenue"),
            money.counted(F.col("total_price")).alias("priced_orders"),
            _units().alias("total_quantity_sold"),
        )
    )
    stars = reviews.agg(F.struct(F.sum("rating").alias("stars"), F.count("rating").alias("rated")))
    figures = spark.range(1).select(
        customers.agg(_rows()).scalar().alias("total_customers"),
        products.agg(_rows()).scalar().alias("total_products"),
        sales.scalar().alias("sales"),
        payments.agg(F.count_if(F.col("status") == "Completed")).scalar().alias("successful_payments"),
        stars.scalar().alias("reviews"),
    )
    return figures.select(
        "total_customers",
        "total_products",
        "sales.total_orders",
        money.rounded(F.col("sales.revenue")).alias("total_revenue"),
        money.average(F.col("sales.revenue"), F.col("sales.priced_orders")).alias(
            "average_order_value"
        ),
        "sales.total_quantity_sold",
        "successful_payments",
        money.average(F.col("reviews.stars"), F.col("reviews.rated")).alias("average_product_rating"),
    )


def overall_sales_summary(orders: DataFrame) -> DataFrame:
    price = F.col("total_price")
    return orders.agg(
        _rows().alias("total_orders"),
        _units().alias("total_units_sold"),
        money.total(price).alias("total_revenue"),
        money.average(money.exact(price), money.counted(price)).alias("avg_order_value"),
        F.coalesce(F.round(F.min(price), 2), F.lit(0.0)).alias("min_order_value"),
        F.coalesce(F.round(F.max(price), 2), F.lit(0.0)).alias("max_order_value"),
    )


def orders_by_status(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(F.col("status").alias("order_status"))
        .agg(_rows().alias("order_count"), money.total(F.col("total_price")).alias("total_revenue"))
        .orderBy(F.desc("order_count"), "order_status")
    )


def reconcile_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders whose total is not quantity times catalog price, to the cent."""
    expected = money.to_cent(F.col("quantity") * F.col("price"))
    return (
        orders.join(products.select("product_id", "price"), "product_id")
        .filter(money.to_cent(F.col("total_price")) != expected)
        .select(
            "order_id",
            "customer_id",
            "product_id",
            "quantity",
            F.col("price").alias("unit_price"),
            F.col("total_price").alias("order_total_price"),
            expected.alias("calculated_revenue"),
            money.to_cent(F.col("total_price") - F.col("quantity") * F.col("price")).alias(
                "discrepancy_amount"
            ),
        )
    )


# --- products ---------------------------------------------------------------------------


def _sales_per(orders: DataFrame, key: str) -> DataFrame:
    return orders.groupBy(key).agg(
        _rows().alias("orders"),
        _units().alias("units"),
        money.exact(F.col("total_price")).alias("revenue"),
        money.counted(F.col("total_price")).alias("priced"),
    )


def top_selling_products(orders: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Products by revenue, unsold ones included with zeros."""
    return (
        products.join(_sales_per(orders, "product_id"), "product_id", "left")
        .select(
            "product_id",
            F.col("name").alias("product_name"),
            "category",
            F.col("price").alias("unit_price"),
            F.coalesce("units", F.lit(0)).alias("total_quantity_sold"),
            money.rounded(F.col("revenue")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "product_id")
        .limit(limit)
    )


# Of 2^14 registers the standard error is 0.8 %; a sketch takes 16 kB.
_LOG_REGISTERS = 14


def distinct_sketches(table: DataFrame, keys: list[str], column: str) -> DataFrame:
    """A HyperLogLog sketch of a column's values for each group; those of stored groups can be merged later."""
    return table.groupBy(*keys).agg(F.hll_sketch_agg(column, F.lit(_LOG_REGISTERS)).alias("sketch"))


def distinct_of(sketch: Column) -> Column:
    """Aggregate: about how many values the sketches of several groups have seen together."""
    return F.hll_sketch_estimate(F.hll_union_agg(sketch))


def revenue_by_category(orders: DataFrame, products: DataFrame, approximate: bool = False) -> DataFrame:
    """Products, units and revenue by category; ``approximate`` estimates the number of products by a sketch.

    An exact count shuffles every distinct product of a category, a sketch 16 kB for each task and category.
    """
    products_of = (
        F.hll_sketch_estimate(F.hll_sketch_agg("product_id", F.lit(_LOG_REGISTERS)))
        if approximate
        else F.count_distinct("product_id")
    )
    return (
        products.join(_sales_per(orders, "product_id"), "product_id", "left")
        .groupBy("category")
        .agg(
            products_of.alias("product_count"),
            F.coalesce(F.sum("units"), F.lit(0)).alias("total_quantity_sold"),
            money.rounded(F.sum("revenue")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def completed_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("status") == "Completed").withColumn(
        "net_price", F.round("total_price", 2)
    )


def exact_product_sales(
    products: DataFrame, orders: DataFrame, order_items: DataFrame | None = None
) -> DataFrame:
    """Units and unrounded revenue (decimal) per product sold in completed orders."""
    sales = orders.filter(F.col("status") == "Completed")
    if order_items is not None:
        items = order_items.select("order_id", "product_id", "quantity", "total_price")
        sales = sales.select("order_id").join(items, "order_id")
    per_product = sales.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), money.exact(F.col("total_price")).alias("revenue")
    )
    # The second grouping keeps to the join's partitioning and merges catalog rows that
    # repeat a product.
    return (
        products.select("product_id", "name", "category")
        .join(per_product, "product_id")
        .groupBy("product_id", "name", "category")
        .agg(
            F.sum("units").alias("total_quantity_sold"),
            F.sum("revenue").cast("decimal(38,8)").alias("total_revenue"),
        )
    )


def summary_of(product_sales: DataFrame) -> DataFrame:
    """Exact product sales with their revenue to the cent, best first."""
    revenue = money.rounded(F.col("total_revenue"))
    return product_sales.withColumn("total_revenue", revenue).orderBy(F.desc("total_revenue"), "product_id")


def product_sales_summary(
    products: DataFrame, orders: DataFrame, order_items: DataFrame | None = None
) -> DataFrame:
    """Units and revenue per product sold in completed orders.

    With ``order_items`` given, quantities and prices come from the items of those orders.
    """
    return summary_of(exact_product_sales(products, orders, order_items))


def category_revenue(
    products: DataFrame, orders: DataFrame, order_items: DataFrame | None = None
) -> DataFrame:
    return category_revenue_of(exact_product_sales(products, orders, order_items))


def category_revenue_of(product_sales: DataFrame) -> DataFrame:
    """Roll exact product sales up to their categories."""
    return (
        product_sales.groupBy("category")
        .agg(
            F.sum("total_quantity_sold").alias("total_items_sold"),
            money.rounded(F.sum("total_revenue")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


# --- customers --------------------------------------------------------------------------


def customer_analytics(customers: DataFrame, orders: DataFrame, limit: int | None = None) -> DataFrame:
    """Ordering pattern per customer, those without orders included with zeros."""
    ranked = (
        customers.join(_sales_per(orders, "customer_id"), "customer_id", "left")
        .select(
            "customer_id",
            F.col("name").alias("customer_name"),
            "email",
            "signup_channel",
            F.coalesce("orders", F.lit(0)).alias("total_orders"),
            F.coalesce("units", F.lit(0)).alias("total_items_purchased"),
            money.rounded(F.col("revenue")).alias("total_spend"),
            money.average(F.col("revenue"), F.col("priced")).alias("avg_order_spend"),
        )
        .orderBy(F.desc("total_spend"), "customer_id")
    )
    return ranked.limit(limit) if limit else ranked


# --- payments ---------------------------------------------------------------------------


def _payments_per(payments: DataFrame, column: str, name: str) -> DataFrame:
    return (
        payments.groupBy(F.col(column).alias(name))
        .agg(_rows().alias("payment_count"), money.total(F.col("amount")).alias("total_amount"))
        .orderBy(F.desc("payment_count"), name)
    )


def payment_method_distribution(payments: DataFrame) -> DataFrame:
    return _payments_per(payments, "payment_method", "payment_method")


def payment_status_breakdown(payments: DataFrame) -> DataFrame:
    return _payments_per(payments, "status", "payment_status")


# --- reviews ----------------------------------------------------------------------------


def product_review_ratings(reviews: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Products by average rating, then by number of reviews; unreviewed ones rate 0.0."""
    per_product = reviews.groupBy("product_id").agg(
        _rows().alias("review_count"),
        money.average(F.sum("rating"), F.count("rating")).alias("average_rating"),
    )
    return (
        products.join(per_product, "product_id", "left")
        .select(
            "product_id",
            F.col("name").alias("product_name"),
            "category",
            _or_zero("review_count"),
            _or_zero("average_rating", 0.0),
        )
        .orderBy(F.desc("average_rating"), F.desc("review_count"), "product_id")
        .limit(limit)
    )


def rating_distribution(reviews: DataFrame) -> DataFrame:
    """Reviews per sentiment and their share; one pass, the total included."""
    rating = F.col("rating")
    counts = reviews.agg(
        F.count_if(rating >= 4).alias("positive"),
        F.count_if(rating == 3).alias("neutral"),
        _rows().alias("total"),
    )
    negative = F.col("total") - F.col("positive") - F.col("neutral")
    found = (F.col("positive"), F.col("neutral"), negative)
    lines = F.array(
        *[
            F.struct(F.lit(label).alias("sentiment_category"), count.alias("review_count"))
            for label, count in zip(SENTIMENTS, found)
        ]
    )
    return (
        counts.select("total", F.inline(lines))
        .filter(F.col("review_count") > 0)
        .select(
            "sentiment_category",
            "review_count",
            F.round(F.col("review_count") * 100.0 / F.col("total"), 2).alias("percentage"),
        )
        .orderBy(F.desc("review_count"), "sentiment_category")
    )


# --- time -------------------------------------------------------------------------------


def monthly_trends(orders: DataFrame) -> DataFrame:
    """Sales per calendar month; the month is formatted once per result row."""
    month = F.trunc("order_date", "month").alias("month")
    return (
        orders.groupBy(month)
        .agg(
            _rows().alias("total_orders"),
            _units().alias("total_units_sold"),
            money.exact(F.col("total_price")).alias("revenue"),
            money.counted(F.col("total_price")).alias("priced"),
        )
        .select(
            F.date_format("month", "yyyy-MM").alias("order_month"),
            "total_orders",
            "total_units_sold",
            money.rounded(F.col("revenue")).alias("monthly_revenue"),
            money.average(F.col("revenue"), F.col("priced")).alias("avg_order_value"),
        )
        .orderBy("order_month")
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        table.agg(_rows().alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    combined = counts[0]
    for more in counts[1:]:
        combined = combined.unionByName(more)
    return combined


_OWN_LIMIT = re.compile(r"\blimit\b", re.IGNORECASE)
_READS = re.compile(r"(select|with|explain)\b", re.IGNORECASE)


def capped_sql(spark: SparkSession, query: str, cap: int = 100) -> DataFrame:
    """Run one ad-hoc SELECT, WITH or EXPLAIN; a query without a LIMIT of its own returns at most ``cap`` rows.

    Anything but a query is refused: a SELECT or WITH is run as a subquery, where DDL, DML and
    stacked statements do not parse.
    """
    inner = query.strip().removesuffix(";").strip()
    found = _READS.match(inner)
    if not found:
        raise ValueError("only SELECT, WITH and EXPLAIN are allowed")
    if found[1].lower() == "explain":
        rest = re.sub(r"^(extended|codegen|cost|formatted)\s+", "", inner[found.end() :].strip(), flags=re.IGNORECASE)
        capped_sql(spark, rest, cap)  # refuses what may not be run
        return spark.sql(inner)
    limit = "" if _OWN_LIMIT.search(inner) else f" LIMIT {int(cap)}"
    return spark.sql(f"SELECT * FROM (\n{inner}\n) adhoc{limit}")
