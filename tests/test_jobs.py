import json
from pathlib import Path

import pytest
from conftest import CLEAN, frames
from pyspark.sql import functions as F

from merchlake import model
from merchlake.plans import etl, incremental, lake, report_files
from merchlake.session import fresh_path, scratch
from merchlake.sources import files, keyed_table


@pytest.fixture
def raw(spark, work, tables):
    files.write_tables_csv(tables, f"{work}/raw")
    return f"{work}/raw"


def _bytes(folder):
    return {p: p.read_bytes() for p in Path(folder).rglob("*.csv") if p.is_file()}


def test_etl(spark, work, raw):
    before = _bytes(raw)
    first = etl.run_etl(spark, raw, work, buckets=2, csv_copy=True)
    assert first["status"] == "SUCCESS" and first["fk_violations"] == 0
    assert first["row_counts"] == {name: 2 for name in model.RELATIONS}
    assert first["quality_report_summary"] == {
        "total_datasets": 5, "overall_passed": True, "total_issues_found": 0
    }
    stored = sorted(etl.stored_tables(spark, work)["orders"].collect())
    assert etl.run_etl(spark, raw, work) == first
    runs = spark.read.parquet(etl.runs_path(work))
    assert runs.count() == 10 and runs.filter("status = 'SUCCESS' AND row_count = 2").count() == 10
    assert sorted(etl.stored_tables(spark, work)["orders"].collect()) == stored
    assert _bytes(raw) == before
    loaded = files.load_processed(spark, f"{work}/processed_csv")
    assert {n: t.count() for n, t in loaded.items()} == first["row_counts"]


def test_etl_halts_on_bad_data(spark, work):
    bad = frames(spark, {**CLEAN, "reviews": [("REV-1", "CUST-1", "PROD-1", 99, "t", CLEAN["reviews"][0][5])]})
    files.write_tables_csv(bad, f"{work}/raw")
    with pytest.raises(etl.EtlError, match="1 data quality issues"):
        etl.run_etl(spark, f"{work}/raw", work)
    lines = [json.loads(x) for p in Path(etl.report_path(work)).glob("*.json") for x in p.read_text().splitlines()]
    assert {x["dataset"]: x["passed"] for x in lines}["reviews"] is False
    assert {x["dataset"]: x for x in lines}["reviews"]["invalid_value_counts"] == {"invalid_ratings": 1}
    assert not Path(f"{work}/processed").exists() and not Path(f"{work}/tables").exists()


def test_lake(spark, work, raw):
    counts = lake.run_lake(spark, raw, work)
    assert counts == {name: 2 for name in model.RELATIONS}
    sales = spark.read.parquet(f"{work}/{lake.PRODUCT_SALES}").collect()
    assert [tuple(r) for r in sales] == [("PROD-1", "Desk Lamp", "Home", 2, 20.0)]
    categories = spark.read.parquet(f"{work}/{lake.CATEGORY_REVENUE}").collect()
    assert [tuple(r) for r in categories] == [("Home", 2, 20.0)]


def test_incremental(spark, work, tables):
    path, orders = f"{work}/orders", tables["orders"]
    keyed_table.upsert(spark, path, orders, "order_id", buckets=2)
    delta = orders.limit(1).withColumn("quantity", F.lit(50)).unionByName(
        orders.limit(1).withColumn("order_id", F.lit("ORD-9"))
    )
    expected = {f.name: f.dataType.simpleString() for f in orders.schema.fields}
    done = incremental.run_incremental(
        spark, path, delta, "order_id", f"{work}/runs", {**expected, "coupon": "string"}, orders
    )
    assert (done["summary"]["INSERT"], done["summary"]["UPDATE"]) == (1, 1)
    assert [r.column_name for r in done["schema_drift"].collect()] == ["coupon"]
    drifted = {(r.column_name, r.metric) for r in done["metric_drift"].filter("has_drift").collect()}
    assert ("quantity", "max") in drifted and ("total_price", "min") not in drifted
    assert spark.read.parquet(f"{work}/runs").first().row_count == 2


def test_report_files(spark, work, tables):
    paths = report_files.write_reports(tables, work, strict=True)
    assert spark.read.json(paths["executive_kpis"]).first().total_revenue == 30.0
    assert spark.read.json(paths["category_revenue"]).count() == 2
    wrong = {**tables, "orders": tables["orders"].withColumn("total_price", F.lit(1.0))}
    with pytest.raises(report_files.ReconciliationError):
        report_files.write_reports(wrong, work, strict=True)
    summary = {(r.section, r.item, r.metric): r.value for r in report_files.analytics_summary(tables).collect()}
    assert summary["kpis", "all", "total_orders"] == 2.0
    assert summary["category_revenue", "Home", "total_revenue"] == 30.0


def test_report_document_is_one_nested_record(spark, work, tables):
    path = report_files.write_document(tables, f"{work}/summary")
    (line,) = [x for p in Path(path).glob("*.json") for x in p.read_text().splitlines()]
    document = json.loads(line)
    assert document["kpis"]["total_revenue"] == 30.0
    assert {c["category"] for c in document["category_revenue"]} == {"Home", "Sports"}
    assert len(document["sentiment"]) == 2
    found = sorted(report_files.read_document(spark, tables, path).collect(), key=repr)
    assert found == sorted(report_files.analytics_summary(tables).collect(), key=repr)


def test_lost_references_after_a_merge(spark, work, tables):
    path = f"{work}/orders"
    keyed_table.upsert(spark, path, tables["orders"], "order_id", buckets=2)
    delta = tables["orders"].limit(1).withColumn("order_id", F.lit("ORD-9")).withColumn("customer_id", F.lit("CUST-X"))
    done = incremental.run_incremental(
        spark, path, delta, "order_id", f"{work}/runs", parents={"customer_id": (tables["customers"], "customer_id")}
    )
    assert [tuple(r) for r in done["lost_references"].collect()] == [("ORD-9", "customer_id")]


def test_scratch_goes_with_its_job(spark):
    with scratch(spark, "job") as folder:
        path = files.export_to_parquet(spark.range(3), fresh_path(spark, "inner"))
        assert path.startswith(folder) and files.exists(spark, path)
    assert not files.exists(spark, folder)
    assert not fresh_path(spark, "after").startswith(folder)


def test_registered_queries_have_sql():
    from merchlake.registry.oracle import ORACLE
    from merchlake.registry.queries import queries

    assert set(queries()) == set(ORACLE)


def test_padded_keys_end_as_one_row(spark, work):
    first = CLEAN["orders"][0]
    padded = ("ORD-1 ", *first[1:5], first[5].replace(hour=10), "Shipped")
    files.write_tables_csv(frames(spark, {**CLEAN, "orders": [*CLEAN["orders"], padded]}), f"{work}/raw")
    done = etl.run_etl(spark, f"{work}/raw", work, buckets=2)
    assert done["row_counts"]["orders"] == 2
    stored = {r.order_id: r.status for r in etl.stored_tables(spark, work)["orders"].collect()}
    assert stored == {"ORD-1": "Shipped", "ORD-2": "Cancelled"}


def test_halt_lists_every_row_at_fault(spark, work):
    when = CLEAN["reviews"][0][5]
    bad = [(f"REV-{n}", "CUST-1", "PROD-1", 99, "t", when) for n in range(60)]
    files.write_tables_csv(frames(spark, {**CLEAN, "reviews": bad}), f"{work}/raw")
    with pytest.raises(etl.EtlError, match="60 data quality issues"):
        etl.run_etl(spark, f"{work}/raw", work)
    listed = spark.read.parquet(etl.violations_path(work)).filter("error = 'invalid rating'")
    assert listed.count() == 60


def test_etl_finds_the_rows_to_load_once(spark, work, raw, monkeypatch):
    written = []
    export = files.export_to_parquet
    monkeypatch.setattr(files, "export_to_parquet", lambda table, path, *rest: written.append(path) or export(table, path, *rest))
    etl.run_etl(spark, raw, work, buckets=2)
    ready = [path for path in written if "etl-ready" in path]
    assert len(ready) == len(model.RELATIONS) and not any(files.exists(spark, path) for path in ready)
