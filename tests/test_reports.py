import pytest
from conftest import SMALL
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from merchlake.functions import money
from merchlake.operators import quality, reports, transform
from merchlake.sources import canonical, files


def _five(tables):
    return [tables[n] for n in ("customers", "products", "orders", "payments", "reviews")]


def test_kpis(tables):
    row = reports.executive_kpis(*_five(tables)).first().asDict()
    assert row == {
        "total_customers": 2, "total_products": 2, "total_orders": 2, "total_revenue": 30.0,
        "average_order_value": 15.0, "total_quantity_sold": 3, "successful_payments": 1,
        "average_product_rating": 3.5,
    }


def test_empty_tables(empty_tables):
    customers, products, orders, payments, reviews = _five(empty_tables)
    assert list(reports.executive_kpis(*_five(empty_tables)).first()) == [0, 0, 0, 0.0, 0.0, 0, 0, 0.0]
    assert list(reports.overall_sales_summary(orders).first()) == [0, 0, 0.0, 0.0, 0.0, 0.0]
    for report in (
        reports.orders_by_status(orders),
        reports.top_selling_products(orders, products),
        reports.revenue_by_category(orders, products),
        reports.customer_analytics(customers, orders),
        reports.payment_method_distribution(payments),
        reports.payment_status_breakdown(payments),
        reports.product_review_ratings(reviews, products),
        reports.rating_distribution(reviews),
        reports.monthly_trends(orders),
        reports.reconcile_revenue(orders, products),
        reports.product_sales_summary(products, orders),
        reports.category_revenue(products, orders),
    ):
        assert report.isEmpty()


def test_customer_without_orders_is_kept(tables):
    rows = reports.customer_analytics(tables["customers"], tables["orders"]).collect()
    assert [(r.customer_id, r.total_orders, r.total_spend) for r in rows] == [
        ("CUST-1", 2, 30.0),
        ("CUST-2", 0, 0.0),
    ]
    assert reports.customer_analytics(tables["customers"], tables["orders"], limit=1).count() == 1


def test_unsold_and_unreviewed_products_are_kept(tables):
    sold = reports.top_selling_products(tables["orders"], tables["products"]).collect()
    assert [(r.product_id, r.total_quantity_sold) for r in sold] == [("PROD-1", 3), ("PROD-2", 0)]
    rated = reports.product_review_ratings(tables["reviews"], tables["products"]).collect()
    assert [(r.product_id, r.average_rating) for r in rated] == [("PROD-1", 3.5), ("PROD-2", 0.0)]


def test_two_definitions_of_revenue(tables):
    every = reports.revenue_by_category(tables["orders"], tables["products"]).first()
    completed = reports.category_revenue(tables["products"], tables["orders"]).first()
    assert (every.total_revenue, completed.total_revenue) == (30.0, 20.0)


def test_order_items_take_precedence(spark, tables):
    items = spark.createDataFrame(
        [("I1", "ORD-1", "PROD-2", 4, 25.5, 102.0), ("I2", "ORD-2", "PROD-1", 9, 1.0, 9.0)],
        "item_id string, order_id string, product_id string, quantity int, unit_price double, total_price double",
    )
    rows = reports.product_sales_summary(tables["products"], tables["orders"], items).collect()
    assert [(r.product_id, r.total_quantity_sold, r.total_revenue) for r in rows] == [("PROD-2", 4, 102.0)]


def test_repeated_catalog_rows_are_merged(tables):
    twice = tables["products"].unionByName(tables["products"])
    row = reports.product_sales_summary(twice, tables["orders"]).collect()
    assert [(r.total_quantity_sold, r.total_revenue) for r in row] == [(4, 40.0)]


def test_reconciliation_ignores_unknown_products_and_missing_values(spark, tables):
    orders = tables["orders"].withColumn(
        "total_price", F.when(F.col("order_id") == "ORD-1", 21.0).otherwise(F.lit(None))
    )
    row = reports.reconcile_revenue(orders, tables["products"]).collect()
    assert [(r.order_id, r.calculated_revenue, r.discrepancy_amount) for r in row] == [("ORD-1", 20.0, 1.0)]


def test_sentiment_and_months(tables):
    shares = reports.rating_distribution(tables["reviews"]).collect()
    assert [(r.sentiment_category, r.review_count, r.percentage) for r in shares] == [
        ("Negative (1-2 Stars)", 1, 50.0),
        ("Positive (4-5 Stars)", 1, 50.0),
    ]
    months = reports.monthly_trends(tables["orders"]).collect()
    assert [(r.order_month, r.monthly_revenue) for r in months] == [("2025-02", 20.0), ("2025-03", 10.0)]


def test_money_is_exact_in_any_order_and_beyond_64_bits(spark):
    table = spark.range(0, 3000, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, 0.1).when(F.col("id") % 3 == 1, -0.3).otherwise(0.7).alias("x")
    )
    assert table.agg(money.total(F.col("x"))).first()[0] == 500.0
    small = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert small.agg(money.total(F.col("x"))).first()[0] == 4.0
    odd = spark.createDataFrame([(float("nan"),), (1.5,), (None,)], "x double")
    row = odd.agg(money.total(F.col("x")).alias("t"), money.counted(F.col("x")).alias("n")).first()
    assert tuple(row) == (1.5, 1)
    huge = spark.range(4).select(F.lit(5e16).alias("x"))
    assert huge.agg(money.total(F.col("x"))).first()[0] == 2e17
    assert spark.range(0).select(F.lit(1.0).alias("x")).agg(money.total(F.col("x"))).first()[0] == 0.0


def test_per_unit_rounds_ties_away_from_zero(spark):
    row = spark.range(1).select(
        money.per_unit(F.lit(2.01), F.lit(2)),
        money.per_unit(F.lit(-2.01), F.lit(2)),
        money.per_unit(F.lit(413773.55), F.lit(10)),
        money.per_unit(F.lit(5.0), F.lit(0)),
    ).first()
    assert list(row) == [1.01, -1.01, 41377.36, None]


@pytest.mark.parametrize("amount", [1e19, -9.1e18, float("inf"), float("-inf")])
def test_amounts_that_cannot_be_summed_fail(spark, amount):
    table = spark.createDataFrame([(amount,), (5.0,)], "x double")
    for measure in (money.total(F.col("x")), money.counted(F.col("x"))):
        with pytest.raises(Exception, match="can't be summed"):
            table.agg(measure).collect()
    fine = spark.createDataFrame([(float("nan"),), (None,), (8.9e18,), (5.0,)], "x double")
    assert tuple(fine.agg(money.counted(F.col("x")), money.total(F.col("x"))).first()) == (2, 8.9e18)


def test_approximate_distinct_counts(spark):
    n = 40_000
    products = spark.range(n).select(F.col("id").alias("product_id"), F.lit(1.0).alias("price"), F.lit("n").alias("name"), (F.col("id") % 4).cast("string").alias("category"))
    products = products.unionByName(products.where("product_id % 3 = 0"))
    orders = spark.range(100).select(F.col("id").alias("product_id"), F.lit(1).alias("quantity"), F.lit(2.0).alias("total_price"))
    exact = {r.category: r for r in reports.revenue_by_category(orders, products).collect()}
    near = {r.category: r for r in reports.revenue_by_category(orders, products, approximate=True).collect()}
    for category, row in exact.items():
        assert row.product_count == n / 4
        assert abs(near[category].product_count / row.product_count - 1) < 0.02
        assert near[category].total_revenue == row.total_revenue
    sketches = reports.distinct_sketches(products, ["category"], "product_id")
    whole = sketches.agg(reports.distinct_of(F.col("sketch")).alias("n")).first()["n"]
    assert abs(whole / n - 1) < 0.02  # sketches of parts add up to that of the whole


def test_capped_sql(spark):
    spark.range(300).createOrReplaceTempView("numbers")
    assert reports.capped_sql(spark, "SELECT id FROM numbers").count() == 100
    assert reports.capped_sql(spark, "SELECT id FROM numbers LIMIT 10;").count() == 10
    assert reports.capped_sql(spark, "SELECT id FROM numbers LIMIT 250").count() == 250
    assert reports.capped_sql(spark, "WITH n AS (SELECT * FROM numbers) SELECT id FROM n").count() == 100
    assert "Range" in reports.capped_sql(spark, "EXPLAIN SELECT id FROM numbers").first()[0]
    for refused in ("DROP VIEW numbers", "EXPLAIN DROP VIEW numbers", "SELECT 1; SELECT 2", ""):
        with pytest.raises((ValueError, ParseException)):
            reports.capped_sql(spark, refused).count()
    assert reports.capped_sql(spark, "WITH n AS (SELECT 'UPDATE' AS word) SELECT * FROM n").count() == 1
    for text in ("DROP VIEW numbers", "SELECT 1; SELECT 2", "INSERT INTO numbers VALUES (1)"):
        with pytest.raises((ValueError, ParseException)):
            reports.capped_sql(spark, text)


def _plan(table):
    return table._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    orders, products = canonical.order_lines(spark, SMALL), canonical.products(spark, SMALL)
    top = _plan(reports.top_selling_products(orders, products))
    assert "TakeOrderedAndProject" in top and "o_orderkey" not in top
    flagship = _plan(
        reports.product_sales_summary(products, canonical.orders_with_status(spark, SMALL, "Completed"))
    )
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in flagship
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in flagship
    for plan in (top, flagship):
        assert "Python" not in plan and "Cartesian" not in plan and "Window" not in plan


def test_hot_key_is_split_by_the_adaptive_join(spark, work):
    """One product holds a third of all orders; the row-level join must not go to one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        orders = spark.range(0, 300_000, numPartitions=8).select(
            F.col("id").alias("order_id"),
            F.lit(1).alias("customer_id"),
            F.when(F.col("id") < 100_000, 7).otherwise(F.col("id")).alias("product_id"),
            F.lit(2).alias("quantity"),
            F.rand(1).alias("total_price"),
        )
        products = spark.range(300_000).select(F.col("id").alias("product_id"), F.lit(1.0).alias("price"))
        report = reports.reconcile_revenue(orders, products)
        assert len(report.collect()) == 300_000
        assert "skew=true" in _plan(report)
        stored = spark.read.parquet(files.export_to_parquet(products, f"{work}/products"))
        priced = transform.recalculate_revenue(orders, stored)
        assert priced.filter("calculated_total_price = 2.0").count() == 300_000
        priced.write.mode("overwrite").parquet(f"{work}/priced")
        known = products.filter("product_id <> 7 AND product_id % 1000 <> 3")
        lost = quality.dangling_rows(orders, "product_id", known, "product_id")
        assert lost.count() == 100_000 + 200
        for frame in (priced, lost):
            frame.collect()
            plan = _plan(frame)
            assert "skew=true" in plan or "_salt" in plan
            assert "SortMergeJoin" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
