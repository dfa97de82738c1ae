"""The report catalog as JSON files and as one long table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from merchlake.operators import reports
from merchlake.sources.files import write_json


class ReconciliationError(RuntimeError):
    """Order totals do not agree with the catalog prices."""


def catalog(tables: dict[str, DataFrame], top: int = 5) -> dict[str, DataFrame]:
    """Every report by name."""
    customers, products, orders, payments, reviews = (
        tables[n] for n in ("customers", "products", "orders", "payments", "reviews")
    )
    return {
        "executive_kpis": reports.executive_kpis(customers, products, orders, payments, reviews),
        "revenue_reconciliation": reports.reconcile_revenue(orders, products),
        "orders_by_status": reports.orders_by_status(orders),
        "category_revenue": reports.revenue_by_category(orders, products),
        "top_selling_products": reports.top_selling_products(orders, products, top),
        "customer_analytics": reports.customer_analytics(customers, orders, top),
        "payment_methods": reports.payment_method_distribution(payments),
        "sentiment": reports.rating_distribution(reviews),
        "monthly_trends": reports.monthly_trends(orders),
    }


def write_reports(
    tables: dict[str, DataFrame], target: str, top: int = 5, strict: bool = False
) -> dict[str, str]:
    """Write every report as JSON lines; ``strict`` fails on any revenue discrepancy."""
    found = catalog(tables, top)
    if strict and not found["revenue_reconciliation"].isEmpty():
        raise ReconciliationError("orders differ from quantity times catalog price")
    return {name: write_json(report, f"{target}/{name}") for name, report in found.items()}


def _long(section: str, report: DataFrame, item: str | None) -> DataFrame:
    metrics = [c for c in report.columns if c != item]
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in metrics
        ]
    )
    name = F.col(item).cast("string") if item else F.lit("all")
    return report.select(F.lit(section).alias("section"), name.alias("item"), F.inline(lines))


# Report, what names its rows, and its section in the summary document.
_SUMMARY = (
    ("kpis", "executive_kpis", None),
    ("category_revenue", "category_revenue", "category"),
    ("sentiment", "sentiment", "sentiment_category"),
)
_ITEMS = {
    "executive_kpis": None,
    "revenue_reconciliation": "order_id",
    "orders_by_status": "order_status",
    "category_revenue": "category",
    "top_selling_products": "product_id",
    "customer_analytics": "customer_id",
    "payment_methods": "payment_method",
    "sentiment": "sentiment_category",
    "monthly_trends": "order_month",
}


def analytics_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Headline figures, category revenue and sentiment as (section, item, metric, value)."""
    found = catalog(tables)
    return reduce(
        DataFrame.unionByName, [_long(name, found[report], item) for name, report, item in _SUMMARY]
    )


def read_reports(spark: SparkSession, tables: dict[str, DataFrame], paths: dict[str, str], top: int = 5) -> DataFrame:
    """All figures of written reports as (section, item, metric, value)."""
    lines = []
    for name, report in catalog(tables, top).items():
        stored, item = spark.read.schema(report.schema).json(paths[name]), _ITEMS[name]
        figures = [f.name for f in report.schema.fields if isinstance(f.dataType, NumericType) and not f.name.endswith("_id")]
        lines.append(_long(name, stored.select(*([item] if item else []), *figures), item))
    return reduce(DataFrame.unionByName, lines)


def _document(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: the headline figures as an object, category revenue and sentiment as lists of objects."""
    spark, found = tables["orders"].sparkSession, catalog(tables)
    figures, *lists = _SUMMARY
    # One object for each category of the catalog and for each rating class.
    sections = [found[figures[1]].select(F.struct("*")).scalar().alias(figures[0])]
    sections += [found[r].agg(F.collect_list(F.struct("*"))).scalar().alias(name) for name, r, _ in lists]
    return spark.range(1).select(*sections)


def write_document(tables: dict[str, DataFrame], path: str) -> str:
    """The analytics summary as one nested JSON document."""
    return write_json(_document(tables).coalesce(1), path)


def read_document(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> DataFrame:
    """A written summary document as (section, item, metric, value)."""
    document = spark.read.schema(_document(tables).schema).json(path)
    figures, *lists = _SUMMARY
    lines = [_long(figures[0], document.select(f"{figures[0]}.*"), None)]
    lines += [_long(name, document.select(F.inline(name)), item) for name, _, item in lists]
    return reduce(DataFrame.unionByName, lines)
