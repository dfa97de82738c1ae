import datetime as dt
import os

from conftest import at
from pyspark.sql import functions as F

from merchlake import model
from merchlake.operators import warehouse
from merchlake.plans import warehouse_build
from merchlake.session import scratch
from merchlake.sources import keyed_table


def test_calendar_of_one_year(spark):
    days = warehouse.calendar(spark, 2025, 2025)
    assert days.count() == 365
    first = days.orderBy("date_key").first()
    assert (first.date_key, first.full_date, first.day_name) == (20250101, dt.date(2025, 1, 1), "Wednesday")
    assert (first.day_of_week, first.is_weekend, first.quarter, first.month_name) == (2, 0, 1, "January")
    assert days.filter("is_weekend = 1").count() == 104


def test_numbers_are_dense_over_many_partitions(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5000).select(F.concat(F.lit("K"), F.col("id")).alias("k"), "id")
        numbered = warehouse.number_rows(rows.repartition(13), "k", "number")
        found = {r.k: r.number for r in numbered.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert found == {k: i + 1 for i, k in enumerate(sorted(f"K{i}" for i in range(5000)))}


def test_keys_survive_a_second_load(spark, tables):
    early = tables["customers"].filter("customer_id = 'CUST-2'")
    current = warehouse.dim_customer(early)
    renamed = tables["customers"].withColumn("name", F.concat("name", F.lit("!")))
    loaded = warehouse.dim_customer(renamed, current)
    rows = {r.customer_id: (r.customer_key, r.name) for r in loaded.collect()}
    assert rows == {"CUST-2": (1, "Bob Jones!"), "CUST-1": (2, "Alice Smith!")}
    partial = warehouse.dim_customer(tables["customers"].filter("customer_id = 'CUST-1'"), current)
    assert warehouse.overlay_dimension(current, partial, "customer_key").count() == 2


def _star(tables, orders, payments):
    days = warehouse.calendar(orders.sparkSession, 2025, 2025)
    return (
        orders, payments, warehouse.dim_customer(tables["customers"]),
        warehouse.dim_product(tables["products"]), days,
    )


def test_facts(spark, tables):
    orders = tables["orders"].unionByName(
        spark.createDataFrame(
            [
                ("ORD-3", "CUST-X", "PROD-X", 1, 1.0, at("2025-01-01 00:00:00"), "Pending"),
                ("ORD-4", "CUST-2", "PROD-2", 3, 10.0, at("2031-01-01 00:00:00"), "Pending"),
                ("ORD-5", "CUST-2", "PROD-2", 3, 10.0, at("2025-12-31 23:59:59"), "Pending"),
            ],
            model.ORDERS,
        )
    )
    second = spark.createDataFrame(
        [("PAY-9", "ORD-1", "Apple Pay", 20.0, "Completed", at("2025-02-02 00:00:00"))], model.PAYMENTS
    )
    star = _star(tables, orders, tables["payments"].unionByName(second))
    facts = {r.order_id: r for r in warehouse.fact_sales(*star).collect()}
    assert sorted(facts) == ["ORD-1", "ORD-2", "ORD-5"]
    assert facts["ORD-1"].payment_method == "Apple Pay"
    assert (facts["ORD-5"].payment_method, facts["ORD-5"].unit_price) == ("Unknown", 3.33)
    assert facts["ORD-5"].date_key == 20251231
    rejects = {r.order_id: r.lacking for r in warehouse.fact_rejects(star[0], *star[2:]).collect()}
    assert rejects == {"ORD-3": ["customer", "product"], "ORD-4": ["date"]}


def test_build_is_idempotent(spark, work, tables):
    first = warehouse_build.build_warehouse(spark, tables, work, buckets=4)
    assert first == {
        "dim_date_records": 365, "dim_customer_records": 2, "dim_product_records": 2,
        "fact_sales_records": 2, "status": "SUCCESS",
    }
    before = warehouse_build.read_warehouse(spark, work)
    facts = sorted(before["fact_sales"].collect())
    assert sorted(r.sales_fact_id for r in facts) == [1, 2]
    second = warehouse_build.build_warehouse(spark, tables, work, buckets=4)
    assert second["dim_date_records"] == 0
    after = warehouse_build.read_warehouse(spark, work)
    assert sorted(after["fact_sales"].select(before["fact_sales"].columns).collect()) == facts
    more = tables["orders"].withColumn("order_id", F.lit("ORD-9")).limit(1).unionByName(tables["orders"])
    warehouse_build.build_warehouse(spark, {**tables, "orders": more}, work, buckets=4)
    grown = warehouse_build.read_warehouse(spark, work)
    assert {r.order_id: r.sales_fact_id for r in grown["fact_sales"].collect()} == {
        "ORD-1": 1, "ORD-2": 2, "ORD-9": 3
    }
    assert grown["dim_customer"].count() == 2


def test_reports(spark, work, tables):
    warehouse_build.build_warehouse(spark, tables, work, buckets=2, number_facts=False)
    star = warehouse_build.read_warehouse(spark, work)
    drill = warehouse.category_drilldown(star["fact_sales"], star["dim_product"], star["dim_date"])
    assert [tuple(r) for r in drill.collect()] == [(2025, 1, "Home", 2, 3, 30.0)]
    split = {r.day_type: tuple(r)[1:] for r in
             warehouse.weekend_performance(star["fact_sales"], star["dim_date"]).collect()}
    assert split == {"Weekend": (2, 3, 30.0, 15.0)}
    best = warehouse.top_customers(star["fact_sales"], star["dim_customer"]).collect()
    assert [tuple(r) for r in best] == [("Alice Smith", "alice@example.com", 2, 30.0)]


def test_a_dimension_of_many_rows_is_not_broadcast(spark, tables):
    """Its file is a few bytes a row: by that alone 14 MB of keys here would go through the driver."""
    customers = spark.range(600_000).select(
        F.col("id").cast("string").alias("customer_id"), *[F.lit("x").alias(c) for c in warehouse.CUSTOMER_ATTRIBUTES]
    )
    days = warehouse.calendar(spark, 2025, 2025)
    known, products = warehouse.dim_customer(customers), warehouse.dim_product(tables["products"])
    rejects = warehouse.fact_rejects(tables["orders"], known, products, days)
    plan = rejects._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [customer_id" in plan and "BroadcastHashJoin [customer_id" not in plan
    assert "BroadcastHashJoin [product_id" in plan  # two products


def test_steps_towards_the_facts_go_one_by_one(spark, tables):
    star = _star(tables, tables["orders"], tables["payments"])
    with scratch(spark, "facts") as folder:
        facts = warehouse.fact_sales(*star)
        assert len(os.listdir(folder)) == 1
        plan = facts._jdf.queryExecution().sparkPlan().toString()
        assert "order_id" not in "".join(line for line in plan.splitlines() if "Join" in line)
        assert sorted(r.order_id for r in facts.collect()) == ["ORD-1", "ORD-2"]


def test_written_facts_are_not_written_down_again(spark, work, tables, monkeypatch):
    """Facts are on disk once with their numbers when they are merged, and no delta beside them."""
    seen, delete = [], keyed_table.delete
    monkeypatch.setattr(keyed_table, "delete", lambda spark, path: (seen.append((path, os.path.exists(path))), delete(spark, path)))
    for _ in range(2):
        warehouse_build.build_warehouse(spark, tables, work, buckets=2)
    staged = [there for path, there in seen if "/delta-" in path]
    assert sum(staged) == len(staged) - 1 > 0  # of the second build's merges only that of the facts has none
    rows = keyed_table.read(spark, f"{work}/fact_sales").collect()
    assert sorted(r.order_id for r in rows) == ["ORD-1", "ORD-2"]
