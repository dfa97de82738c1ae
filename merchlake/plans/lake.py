"""Raw CSV tables to two Parquet summaries of completed sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from merchlake.operators import reports
from merchlake.session import scratch
from merchlake.sources import files

PRODUCT_SALES, CATEGORY_REVENUE = "product_sales_summary", "category_revenue"


def read_raw(spark: SparkSession, source: str) -> dict[str, DataFrame]:
    return {
        "customers": files.read_customers(spark, f"{source}/customers.csv"),
        "products": files.read_products(spark, f"{source}/products.csv"),
        "orders": files.read_orders(spark, f"{source}/orders.csv"),
        "payments": files.read_payments(spark, f"{source}/payments.csv"),
        "reviews": files.read_reviews(spark, f"{source}/reviews.csv"),
    }


def run_lake(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """Write both summaries and return the row counts of the raw tables.

    Exact product sales are computed once and written aside; both summaries are made of them.
    """
    raw = read_raw(spark, source)
    items = files.read_order_items(spark, f"{source}/order_items.csv")
    sales = reports.exact_product_sales(raw["products"], raw["orders"], items)
    with scratch(spark, "product-sales") as folder:
        exact = spark.read.parquet(files.export_to_parquet(sales, f"{folder}/exact"))
        files.export_to_parquet(reports.summary_of(exact), f"{target}/{PRODUCT_SALES}")
        files.export_to_parquet(reports.category_revenue_of(exact), f"{target}/{CATEGORY_REVENUE}")
    return {r["table_name"]: r["row_count"] for r in reports.table_row_counts(raw).collect()}
