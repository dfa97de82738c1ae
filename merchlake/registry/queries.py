"""Every operator as a query over the tables of a scale-factor folder.

Operators that read or write files get their input from the same tables: it is written to
the shared folder first, each time to a new path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, TimestampType

from merchlake import model
from merchlake.functions.text import standard_moment
from merchlake.operators import cdc, drift, quality, reports, run_metrics, transform, warehouse
from merchlake.plans import etl, incremental, lake, report_files, warehouse_build
from merchlake.session import configure, delete, fresh_path
from merchlake.sources import bucketed, canonical, files, history, keyed_table, raw_feed
from merchlake.streaming import delta_merge

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

# Buckets of the tables written by queries; a stored table of 100 TB takes about 100,000.
BUCKETS = 8


def _register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(configure(spark), sf_dir)

    _QUERIES[query.__name__] = run
    return query


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Column whose highest value marks the row that is kept where a key repeats.
_SEQUENCE = {"orders": "total_price", "payments": "amount"}


def _keyed(name: str, table: DataFrame) -> DataFrame:
    """A relation as a keyed store holds it: one row per key."""
    return cdc.last_per_key(table, model.RELATIONS[name].key, _SEQUENCE[name])


@contextmanager
def _sold_relations(spark: SparkSession, sf_dir: str) -> Iterator[dict[str, DataFrame]]:
    """The keyed relations for as long as facts are made of them.

    The orders are written down, so that what was shuffled for them goes before the facts are joined.
    """
    tables, path = _keyed_relations(spark, sf_dir), fresh_path(spark, "keyed-orders")
    schema = tables["orders"].schema
    files.export_to_parquet(tables["orders"], path)
    try:
        yield {**tables, "orders": spark.read.schema(schema).parquet(path)}
    finally:
        delete(spark, path)


def _keyed_relations(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        name: _keyed(name, table) if name in _SEQUENCE else table
        for name, table in canonical.relations(spark, sf_dir).items()
    }


# --- sources and sinks ------------------------------------------------------------------


def _csv_of(table: DataFrame, name: str) -> str:
    return files.write_csv(table, f"{fresh_path(table.sparkSession, 'raw')}/{name}.csv")


@_register
def scan_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_products(spark, _csv_of(canonical.products(spark, sf_dir), "products"))


@_register
def scan_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_customers(spark, _csv_of(canonical.customers(spark, sf_dir), "customers"))


@_register
def scan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_orders(spark, _csv_of(canonical.orders(spark, sf_dir), "orders"))


@_register
def scan_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _csv_of(canonical.order_items(spark, sf_dir), "order_items")
    return files.read_order_items_or_empty(spark, path)


@_register
def scan_optional_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the optional items file, sales are taken from the orders themselves."""
    items = files.read_order_items(spark, f"{fresh_path(spark, 'raw')}/order_items.csv")
    sold = canonical.orders_with_status(spark, sf_dir, "Completed")
    return reports.product_sales_summary(canonical.products(spark, sf_dir), sold, items)


@_register
def scan_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_payments(spark, _csv_of(canonical.payments(spark, sf_dir), "payments"))


@_register
def scan_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_reviews(spark, _csv_of(canonical.reviews(spark, sf_dir), "reviews"))


@_register
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json")
    files.write_json(canonical.reviews(spark, sf_dir), path)
    return files.read_json(spark, path, model.REVIEWS)


@_register
def scan_json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_json_arrays(canonical.reviews(spark, sf_dir), fresh_path(spark, "json"), BUCKETS)
    return files.read_json(spark, path, model.REVIEWS, array=True)


def _as_text(field: StructField) -> Column:
    """A cell as both engines write it: amounts in cents, missing values as a tilde."""
    value = F.col(field.name)
    if isinstance(field.dataType, DoubleType):
        value = F.rint(value * 100).cast("bigint")
    if isinstance(field.dataType, TimestampType):
        value = standard_moment(value)
    return F.coalesce(value.cast("string"), F.lit("~"))


@_register
def typed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five tables written as CSV and loaded into their types, every row as one text."""
    folder = fresh_path(spark, "processed")
    files.write_tables_csv(canonical.relations(spark, sf_dir), folder)
    rows = [
        table.select(
            F.lit(name).alias("dataset"), F.concat_ws("|", *[_as_text(f) for f in table.schema.fields]).alias("cells")
        )
        for name, table in files.load_processed(spark, folder).items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _raw_lines(spark: SparkSession, sf_dir: str) -> str:
    """A folder of the five raw files, of which products and reviews hold lines that lost or gained fields on the way."""
    folder = fresh_path(spark, "raw")
    tables = raw_feed.tables(spark, sf_dir)
    for name in ("customers", "orders", "payments"):
        files.write_csv(tables[name], f"{folder}/{name}.csv")
    for name, lines in raw_feed.lines(spark, sf_dir).items():
        files.write_lines(lines, model.RELATIONS[name].columns, f"{folder}/{name}.csv")
    return folder


@_register
def scan_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw line that doesn't have the fields of its table, as it stands in the file."""
    return files.malformed_lines(spark, _raw_lines(spark, sf_dir))


@_register
def dq_audit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of raw files, malformed lines counted."""
    folder = _raw_lines(spark, sf_dir)
    tables = quality.mark_missing(files.read_text_tables(spark, folder))
    report = quality.audit_report(quality.audit_findings(tables, files.malformed_lines(spark, folder)))
    return report.select("dataset", "rows_checked", "malformed_lines", "passed")


@_register
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.export_to_parquet(product_sales_summary(spark, sf_dir), fresh_path(spark, "export"))
    return spark.read.parquet(path)


@_register
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.table_row_counts(
        {
            "customers": canonical.accounts(spark, sf_dir),
            "products": canonical.products(spark, sf_dir),
            "orders": canonical.order_lines(spark, sf_dir),
            "payments": canonical.payments(spark, sf_dir),
            "reviews": canonical.reviews(spark, sf_dir),
        }
    )


# --- cleaning and derived columns -------------------------------------------------------


@_register
def completed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.completed_orders(canonical.orders_with_status(spark, sf_dir, "Completed"))


@_register
def clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.clean_customers(canonical.accounts(spark, sf_dir))


@_register
def standardize_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    moments = []
    for name, table in canonical.relations(spark, sf_dir).items():
        relation = model.RELATIONS[name]
        if relation.moment:
            moments.append(
                table.select(
                    F.lit(name).alias("dataset"),
                    F.col(relation.key).cast("string").alias("row_id"),
                    standard_moment(F.col(relation.moment).cast("string")).alias("moment"),
                )
            )
    return reduce(DataFrame.unionByName, moments)


@_register
def recalc_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = canonical.order_lines(spark, sf_dir)
    return transform.recalculate_revenue(orders, canonical.products(spark, sf_dir))


@_register
def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.order_features(canonical.orders(spark, sf_dir)).select(
        "order_id", "order_year", "order_month", "order_dayofweek"
    )


@_register
def customer_tenure(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenure = transform.customer_tenure(
        canonical.customers(spark, sf_dir), canonical.orders(spark, sf_dir)
    )
    return tenure.select("customer_id", "customer_tenure_days")


@_register
def rating_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform.review_categories(canonical.ratings(spark, sf_dir))


# --- reports ----------------------------------------------------------------------------


@_register
def executive_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.executive_kpis(
        canonical.accounts(spark, sf_dir),
        canonical.products(spark, sf_dir),
        canonical.order_lines(spark, sf_dir),
        canonical.payments(spark, sf_dir),
        canonical.ratings(spark, sf_dir),
    )


@_register
def overall_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overall_sales_summary(canonical.order_lines(spark, sf_dir))


@_register
def orders_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.orders_by_status(canonical.orders(spark, sf_dir))


@_register
def reconcile_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, products = canonical.orders(spark, sf_dir), canonical.products(spark, sf_dir)
    return reports.reconcile_revenue(orders, products)


@_register
def top_selling_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_selling_products(
        canonical.order_lines(spark, sf_dir), canonical.products(spark, sf_dir)
    )


@_register
def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.revenue_by_category(
        canonical.order_lines(spark, sf_dir), canonical.products(spark, sf_dir)
    )


@_register
def product_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_sales_summary(
        canonical.products(spark, sf_dir), canonical.orders_with_status(spark, sf_dir, "Completed")
    )


@_register
def product_sales_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_sales_summary(
        canonical.products(spark, sf_dir),
        canonical.orders_with_status(spark, sf_dir, "Completed"),
        canonical.order_items(spark, sf_dir),
    )


@_register
def category_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.category_revenue(
        canonical.products(spark, sf_dir), canonical.orders_with_status(spark, sf_dir, "Completed")
    )


@_register
def customer_analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_analytics(
        canonical.accounts(spark, sf_dir), canonical.orders(spark, sf_dir)
    )


@_register
def payment_method_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.payment_method_distribution(canonical.payments(spark, sf_dir))


@_register
def payment_status_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.payment_status_breakdown(canonical.payments(spark, sf_dir))


@_register
def product_review_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_review_ratings(
        canonical.reviews(spark, sf_dir), canonical.products(spark, sf_dir)
    )


@_register
def rating_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rating_distribution(canonical.ratings(spark, sf_dir))


@_register
def monthly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.monthly_trends(canonical.orders(spark, sf_dir))


@_register
def analytics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_files.analytics_summary(_report_tables(spark, sf_dir))


def _report_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": canonical.accounts(spark, sf_dir),
        "products": canonical.products(spark, sf_dir),
        "orders": canonical.orders(spark, sf_dir),
        "payments": canonical.payments(spark, sf_dir),
        "reviews": canonical.ratings(spark, sf_dir),
    }


@_register
def analytics_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine reports written as JSON and read back, every figure a row."""
    tables = _report_tables(spark, sf_dir)
    paths = report_files.write_reports(tables, fresh_path(spark, "reports"))
    return report_files.read_reports(spark, tables, paths)


@_register
def report_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary written as one nested JSON document and read back."""
    tables = _report_tables(spark, sf_dir)
    path = report_files.write_document(tables, fresh_path(spark, "summary"))
    return report_files.read_document(spark, tables, path)


_ADHOC = """
    SELECT customer_id, COUNT(*) AS order_count, SUM(quantity) AS units
    FROM merch_orders
    GROUP BY customer_id
    ORDER BY units DESC, customer_id
"""


@_register
def adhoc_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query without a LIMIT gets the default cap; the cap is the feature."""
    canonical.orders(spark, sf_dir).createOrReplaceTempView("merch_orders")
    return reports.capped_sql(spark, f"{_ADHOC};")


@_register
def adhoc_own_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query's own LIMIT holds, above the default cap too."""
    canonical.orders(spark, sf_dir).createOrReplaceTempView("merch_orders")
    return reports.capped_sql(spark, f"{_ADHOC} LIMIT 500;")


# --- warehouse --------------------------------------------------------------------------

_BUILT: dict[tuple[str, str], tuple[str, dict]] = {}


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar over the order headers, whose dates are those of the order lines."""
    headers = canonical.table(spark, sf_dir, "orders")
    return warehouse.calendar_of(headers.select(F.col("o_orderdate").alias("order_date")))


def built_warehouse(spark: SparkSession, sf_dir: str) -> tuple[str, dict]:
    """Path and counts of the star schema, built once per session from the given tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        target = fresh_path(spark, "warehouse")
        days = _order_days(spark, sf_dir)
        with _sold_relations(spark, sf_dir) as tables:
            counts = warehouse_build.build_warehouse(spark, tables, target, days, BUCKETS)
        _BUILT[key] = (target, counts)
    return _BUILT[key]


def _star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return warehouse_build.read_warehouse(spark, built_warehouse(spark, sf_dir)[0])


@_register
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with its dates as text, YYYY-MM-DD."""
    return _order_days(spark, sf_dir).withColumn("full_date", F.col("full_date").cast("string"))


@_register
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_customer(canonical.customers(spark, sf_dir))


@_register
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.dim_product(canonical.products(spark, sf_dir))


@_register
def dim_customer_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load keeps the keys of the first and numbers the new customers after them."""
    early = history.customers_before(spark, sf_dir)
    current = warehouse.dim_customer(early)
    loaded = warehouse.dim_customer(canonical.customers(spark, sf_dir), current)
    return warehouse.overlay_dimension(current, loaded, "customer_key")


@_register
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _sold_relations(spark, sf_dir) as tables:
        return warehouse.fact_sales(
            tables["orders"],
            tables["payments"],
            warehouse.dim_customer(tables["customers"]),
            warehouse.dim_product(tables["products"]),
            _order_days(spark, sf_dir),
        )


@_register
def fact_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that the dimensions of an earlier load, with a calendar up to 1999, do not know."""
    found = warehouse.fact_rejects(
        canonical.orders(spark, sf_dir),
        warehouse.dim_customer(history.customers_before(spark, sf_dir)),
        warehouse.dim_product(history.products_before(spark, sf_dir)),
        warehouse.calendar(spark, 1995, 1999),
    )
    return found.withColumn("lacking", F.array_join("lacking", ","))


@_register
def warehouse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return reports.table_row_counts({name: star[name] for name in warehouse_build.TABLES})


@_register
def warehouse_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts after a second build of the same tables, which changes nothing."""
    target, _ = built_warehouse(spark, sf_dir)
    days = _order_days(spark, sf_dir)
    with _sold_relations(spark, sf_dir) as tables:
        warehouse_build.build_warehouse(spark, tables, target, days, BUCKETS)
    facts = warehouse_build.read_warehouse(spark, target)["fact_sales"]
    dense = facts.agg(
        ((F.count_distinct("sales_fact_id") == F.count(F.lit(1))) & (F.max("sales_fact_id") == F.count(F.lit(1)))).alias("d")
    )
    return facts.drop("sales_fact_id").withColumn("ids_are_dense", dense.scalar())


@_register
def dw_category_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return warehouse.category_drilldown(star["fact_sales"], star["dim_product"], star["dim_date"])


@_register
def dw_weekend_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return warehouse.weekend_performance(star["fact_sales"], star["dim_date"])


@_register
def dw_top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _star(spark, sf_dir)
    return warehouse.top_customers(star["fact_sales"], star["dim_customer"])


# --- data quality -----------------------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return quality.mark_missing(raw_feed.tables(spark, sf_dir))


def _parsed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        name: quality.parse_table(table, model.RELATIONS[name])
        for name, table in _raw(spark, sf_dir).items()
    }


@_register
def dq_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit_report(quality.audit_findings(_raw(spark, sf_dir))).drop("invalid_value_counts", "malformed_lines")


@_register
def dq_audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit_summary(quality.audit_report(quality.audit_findings(_raw(spark, sf_dir))))


@_register
def dq_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing_counts(_raw(spark, sf_dir))


@_register
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_counts(_raw(spark, sf_dir))


@_register
def dq_invalid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.invalid_value_counts(_raw(spark, sf_dir))


@_register
def dq_date_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.date_errors(_raw(spark, sf_dir))


@_register
def dq_status_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.status_errors(_raw(spark, sf_dir))


@_register
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reference_violations(_raw(spark, sf_dir))


@_register
def fk_violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reference_violation_rows(_raw(spark, sf_dir))


@_register
def dq_violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors found; those of a whole table have neither row id nor value."""
    return quality.violations(_parsed(spark, sf_dir))


@_register
def constraint_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = []
    for name, table in _parsed(spark, sf_dir).items():
        relation = model.RELATIONS[name]
        found.append(
            quality.rejected(table, relation).select(
                F.lit(name).alias("dataset"),
                F.col(relation.key).alias("row_id"),
                F.array_join("violated_rules", ",").alias("violated_rules"),
            )
        )
    return reduce(DataFrame.unionByName, found)


@_register
def load_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every relation stored by key, then counted on both sides; a repeated key shows."""
    source, stored = canonical.relations(spark, sf_dir), {}
    target = fresh_path(spark, "stored")
    for name, table in source.items():
        key, sequence = model.RELATIONS[name].key, _SEQUENCE.get(name)
        keyed_table.upsert(spark, f"{target}/{name}", table, key, sequence, BUCKETS)
        stored[name] = keyed_table.read(spark, f"{target}/{name}")
    return quality.load_verification(source, stored)


# --- change data capture ----------------------------------------------------------------


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored earlier orders, and the present ones as a delta."""
    return (
        _keyed("orders", history.orders_before(spark, sf_dir)),
        canonical.orders(spark, sf_dir),
    )


@_register
def cdc_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = cdc.classify(*_states(spark, sf_dir), "order_id", "total_price")
    return tagged.select(
        "order_id",
        F.col(cdc.ACTION).alias("cdc_action"),
        F.array_join(cdc.CHANGED, ",").alias("changed_columns"),
    )


@_register
def cdc_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.summary(cdc.classify(*_states(spark, sf_dir), "order_id", "total_price"))


@_register
def cdc_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.merge(*_states(spark, sf_dir), "order_id", "total_price")


@_register
def cdc_merge_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a catalog table in buckets of the key, which isn't shuffled."""
    name = f"orders_{uuid.uuid4().hex}"
    earlier, present = _states(spark, sf_dir)
    bucketed.store(earlier, name, "order_id", BUCKETS)
    return bucketed.merge(spark, name, present, "order_id", "total_price")


@_register
def dim_customer_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load of customers against a dimension stored in buckets of the natural key."""
    name = f"dim_customer_{uuid.uuid4().hex}"
    first = warehouse.dim_customer(history.customers_before(spark, sf_dir))
    current = bucketed.store(first, name, "customer_id", BUCKETS)
    return warehouse.dim_customer(canonical.customers(spark, sf_dir), current)


@_register
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier orders stored by key, then the present ones upserted into them."""
    path = f"{fresh_path(spark, 'stored')}/orders"
    earlier, present = _states(spark, sf_dir)
    keyed_table.upsert(spark, path, earlier, "order_id", buckets=BUCKETS, unique=True)
    keyed_table.upsert(spark, path, present, "order_id", "total_price")
    return keyed_table.read(spark, path)


@_register
def upsert_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows kept aside because they came without a key: here the cancelled orders lose theirs."""
    path = f"{fresh_path(spark, 'stored')}/orders"
    earlier, present = _states(spark, sf_dir)
    keyed_table.upsert(spark, path, earlier, "order_id", buckets=BUCKETS, unique=True)
    lost = F.when(F.col("status") != "Cancelled", F.col("order_id"))
    keyed_table.upsert(spark, path, present.withColumn("order_id", lost), "order_id", "total_price")
    return keyed_table.rejects(spark, path)


@_register
def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders after an incremental run, with the references an earlier load of the parents lacks."""
    work = fresh_path(spark, "incremental")
    earlier, present = _states(spark, sf_dir)
    keyed_table.upsert(spark, f"{work}/orders", earlier, "order_id", buckets=BUCKETS, unique=True)
    parents = {
        "customer_id": (history.customers_before(spark, sf_dir), "customer_id"),
        "product_id": (history.products_before(spark, sf_dir), "product_id"),
    }
    found = incremental.run_incremental(
        spark, f"{work}/orders", present, "order_id", f"{work}/runs", sequence="total_price", parents=parents
    )
    lost = found["lost_references"].groupBy("order_id").agg(
        F.array_join(F.sort_array(F.collect_set("lost")), ",").alias("lost")
    )
    merged = keyed_table.read(spark, f"{work}/orders").join(lost, "order_id", "left")
    recorded = spark.read.parquet(f"{work}/runs").agg(F.max("row_count")).scalar()
    return merged.withColumn("lost", F.coalesce("lost", F.lit(""))).withColumn("run_rows", recorded)


@_register
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of an observed write: rows written and, of its details, the missing methods."""
    work = fresh_path(spark, "observed")
    payments = canonical.payments(spark, sf_dir)
    run_metrics.observed_write(
        payments, f"{work}/runs", "write_payments", lambda table: files.export_to_parquet(table, f"{work}/payments")
    )
    return spark.read.parquet(f"{work}/runs").select(
        "task_name",
        "status",
        "row_count",
        F.get_json_object("details", "$.nulls_payment_method").cast("bigint").alias("missing_methods"),
    )


@_register
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The present orders delivered as delta files and merged by a stream."""
    work = fresh_path(spark, "stream")
    earlier, present = _states(spark, sf_dir)
    keyed_table.upsert(spark, f"{work}/orders", earlier, "order_id", buckets=BUCKETS, unique=True)
    files.export_to_parquet(present, f"{work}/deltas")
    query = delta_merge.merge_stream(
        spark,
        f"{work}/deltas",
        present.schema,
        f"{work}/orders",
        f"{work}/checkpoint",
        "order_id",
        "total_price",
    )
    query.awaitTermination()
    return keyed_table.read(spark, f"{work}/orders")


# --- drift ------------------------------------------------------------------------------


@_register
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys found in the events' JSON against an expected record."""
    expected = {"k": "double", "source": "string"}
    events = canonical.table(spark, sf_dir, "events")
    return drift.schema_drift(expected, drift.observed_json_types(events, "props")).fillna("")


@_register
def json_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a JSON column and the unreadable ones: error events lose their opening brace."""
    events = canonical.table(spark, sf_dir, "events")
    broken = F.when(F.col("event_type") == "error", F.expr("substring(props, 2)")).otherwise(F.col("props"))
    return drift.unreadable_json(events.withColumn("props", broken), "props")


@_register
def schema_drift_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the raw payments hold against the types payments should have."""
    expected = {f.name: f.dataType.simpleString() for f in model.PAYMENTS.fields if f.name != "status"}
    payments = quality.mark_missing({"payments": raw_feed.payments(spark, sf_dir)})["payments"]
    return drift.schema_drift(expected, drift.observed_types(payments)).fillna("")


@_register
def metric_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.metric_drift(*_states(spark, sf_dir))


@_register
def metric_drift_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kept metrics of the earlier orders against theirs with a batch of later orders; only the batch is read then."""
    kept = f"{fresh_path(spark, 'kept')}/states"
    earlier, present = _states(spark, sf_dir)
    later = present.filter(F.col("order_date") >= F.lit(history.CUTOVER).cast("timestamp"))
    run_metrics.keep_states(drift.metric_states(earlier), kept, "orders", "before")
    run_metrics.keep_states(drift.metric_states(later), kept, "orders", "later")
    states = run_metrics.kept_states(spark, kept, "orders")
    before, both = drift.combined_states(states.filter("batch = 'before'")), drift.combined_states(states)
    return drift.compared(drift.metrics_of(before), drift.metrics_of(both))


def _event_documents(events: DataFrame) -> DataFrame:
    """Events as nested JSON; errors give the user's number as text, and only purchases have a line."""
    user = F.col("user_id").cast("string")
    return events.select(
        F.format_string(
            '{"kind": "%s", "user": {"account": {"id": %s}, "props": %s}, "lines": [%s]}',
            F.col("event_type"),
            F.when(F.col("event_type") == "error", F.concat(F.lit('"'), user, F.lit('"'))).otherwise(user),
            F.col("props"),
            F.when(F.col("event_type") == "purchase", F.concat(F.lit('{"amount": '), F.col("value").cast("string"), F.lit("}")))
            .otherwise(""),
        ).alias("document")
    )


@_register
def schema_drift_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types by path in nested documents against the expected ones, down to the third level."""
    expected = {
        "kind": "string", "user": "object", "user.account": "object", "user.account.id": "bigint",
        "user.props": "object", "user.props.k": "double", "user.props.source": "string",
        "lines": "array", "lines[]": "object", "lines[].amount": "double",
    }
    documents = _event_documents(canonical.table(spark, sf_dir, "events"))
    return drift.schema_drift(expected, drift.nested_types(documents, "document")).fillna("")


# --- jobs -------------------------------------------------------------------------------


_ETL: dict[tuple[str, str], str] = {}


def _etl_done(spark: SparkSession, sf_dir: str) -> str:
    """Folder of an ETL run over the given tables, done once per session.

    An audit halts on missing values, so payments of unknown method say so in words.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ETL:
        work = fresh_path(spark, "etl")
        tables = _keyed_relations(spark, sf_dir)
        method = F.coalesce("payment_method", F.lit(warehouse.UNKNOWN_METHOD))
        tables["payments"] = tables["payments"].withColumn("payment_method", method)
        files.write_tables_csv(tables, f"{work}/raw", compression="gzip")
        etl.run_etl(spark, f"{work}/raw", work, BUCKETS)
        _ETL[key] = work
    return _ETL[key]


@_register
def etl_run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of the loads of one ETL run."""
    runs = spark.read.parquet(etl.runs_path(_etl_done(spark, sf_dir)))
    return runs.select("task_name", "status", "row_count", F.get_json_object("details", "$.INSERT").cast("bigint").alias("inserted"))


@_register
def etl_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.etl_row_counts(spark, _etl_done(spark, sf_dir))


@_register
def etl_stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as the ETL run stored them, dates as text."""
    stored = etl.stored_tables(spark, _etl_done(spark, sf_dir))["orders"]
    return stored.withColumn("order_date", standard_moment(F.col("order_date")))


@_register
def lake_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both Parquet summaries, written from CSV and read back."""
    work = fresh_path(spark, "lake")
    files.write_tables_csv(canonical.relations(spark, sf_dir), f"{work}/raw")
    lake.run_lake(spark, f"{work}/raw", work)
    sales = spark.read.parquet(f"{work}/{lake.PRODUCT_SALES}")
    categories = spark.read.parquet(f"{work}/{lake.CATEGORY_REVENUE}")
    return sales.select(
        F.lit(lake.PRODUCT_SALES).alias("output"),
        F.col("product_id").alias("item"),
        F.col("total_quantity_sold").alias("units"),
        "total_revenue",
    ).unionByName(
        categories.select(
            F.lit(lake.CATEGORY_REVENUE).alias("output"),
            F.col("category").alias("item"),
            F.col("total_items_sold").alias("units"),
            "total_revenue",
        )
    )
