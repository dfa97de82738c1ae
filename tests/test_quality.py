import pytest
from conftest import CLEAN, at, frames
from pyspark.sql import functions as F

from merchlake import model
from merchlake.operators import quality

CORRUPT = {
    "customers": [
        ("CUST-0001", "A", "a@x", "2025-01-01 00:00:00", "Web"),
        ("CUST-0001", "B", "", "2025-01-01 00:00:00", "Web"),
    ],
    "products": [("PROD-0001", "P", "C", "-10.0", "-5")],
    "orders": [("ORD-1", "CUST-BAD", "PROD-0001", "-2", "0.0", "INVALID_DATE", "UNKNOWN_STATUS")],
    "payments": [("PAY-1", "ORD-BAD", "UPI", "-50", "INVALID_PAY_STATUS", "2026-02-30 00:00:00")],
    "reviews": [("REV-1", "CUST-BAD", "PROD-BAD", "6", "text", "2025-01-01 00:00:00")],
}


def text_tables(spark, rows):
    return {
        name: spark.createDataFrame(
            [tuple(None if v is None else str(v) for v in row) for row in rows[name]],
            ", ".join(f"{c} string" for c in relation.columns),
        )
        for name, relation in model.RELATIONS.items()
    }


def audit(spark, rows):
    found = quality.audit_findings(quality.mark_missing(text_tables(spark, rows)))
    return {r.dataset: r.asDict() for r in quality.audit_report(found).collect()}


def test_clean_data_passes(spark):
    report = audit(spark, CLEAN)
    assert all(r["passed"] and r["rows_checked"] == 2 for r in report.values())


def test_corrupt_data_is_counted(spark):
    report = audit(spark, CORRUPT)
    assert report["customers"]["duplicate_id_count"] == 1
    assert report["customers"]["missing_value_count"] == 1
    assert report["products"]["invalid_value_counts"] == {"invalid_prices": 1, "invalid_stock": 1}
    orders = report["orders"]
    assert (orders["foreign_key_violations"], orders["date_errors"], orders["status_errors"]) == (1, 1, 1)
    assert orders["invalid_value_counts"] == {"invalid_quantities": 1, "invalid_total_prices": 1}
    payments = report["payments"]
    assert (payments["foreign_key_violations"], payments["status_errors"], payments["date_errors"]) == (1, 1, 1)
    assert payments["invalid_value_counts"] == {"invalid_amounts": 1}
    assert report["reviews"]["invalid_value_counts"] == {"invalid_ratings": 1}
    assert report["reviews"]["foreign_key_violations"] == 2
    assert not any(r["passed"] for r in report.values())


def test_null_rules(spark):
    """Missing numbers are no value errors, but missing ratings, statuses, dates and references are."""
    rows = {
        "customers": [("C1", "A", "a", "2025-01-01 00:00:00", "Web"), (None, "A", "a", None, "Web"),
                      (None, "A", "a", "2025-01-01 0:00:00", "NA")],
        "products": [("P1", "P", "C", "abc", None)],
        "orders": [("O1", None, "P1", None, "x", "2025-01-01 00:00:00", None)],
        "payments": [("Y1", "O1", "None", "null", "Failed", "0000-01-01 00:00:00")],
        "reviews": [("R1", "C1", "P1", None, "text", "2024-02-29 23:59:59")],
    }
    report = audit(spark, rows)
    assert report["customers"]["duplicate_id_count"] == 1
    assert (report["customers"]["missing_value_count"], report["customers"]["date_errors"]) == (4, 2)
    assert report["products"]["invalid_value_counts"] == {"invalid_prices": 0, "invalid_stock": 0}
    assert report["orders"]["invalid_value_counts"] == {"invalid_quantities": 0, "invalid_total_prices": 0}
    assert (report["orders"]["foreign_key_violations"], report["orders"]["status_errors"]) == (1, 1)
    assert report["payments"]["missing_value_count"] == 2
    assert report["payments"]["date_errors"] == 1
    assert report["reviews"]["invalid_value_counts"] == {"invalid_ratings": 1}
    assert report["reviews"]["date_errors"] == 0


def test_ledger_agrees_with_brute_force(spark):
    """A third of the orders refer to one missing customer; another key is held many times."""
    rows = {
        "customers": [(f"C{i}", "n", "e", "2025-01-01 00:00:00", "w") for i in range(20)],
        "products": [("P1", "p", "c", "1", "1")] * 5,
        "orders": [
            (f"O{i // 2}", "LOST" if i % 3 == 0 else f"C{i % 25}", "P1", "1", "1", "d", "s")
            for i in range(600)
        ],
        "payments": [("Y1", None if i % 4 == 0 else f"O{i}", "m", "1", "s", "d") for i in range(400)],
        "reviews": [(f"R{i}", f"C{i}", "P2", "1", "t", "d") for i in range(30)],
    }
    tables = text_tables(spark, rows)
    names = {n: r.columns for n, r in model.RELATIONS.items()}
    wanted = {}
    for name, relation in model.RELATIONS.items():
        for column, parent in relation.references.items():
            held = {row[0] for row in rows[parent]}
            at_ = names[name].index(column)
            wanted[name, column] = sum(row[at_] not in held or row[at_] is None for row in rows[name])
    found = {(r.dataset, r.column_name): r.violations for r in quality.reference_violations(tables).collect()}
    assert found == wanted
    repeats = {r.dataset: r.duplicate_id_count for r in quality.duplicate_counts(tables).collect()}
    assert repeats == {n: len(rows[n]) - len({row[0] for row in rows[n]}) for n in rows}
    ledger = quality.key_ledger(tables).filter("relation = 'customers' AND key = 'LOST'").first()
    assert (ledger.holds, ledger.orders_customer_id) == (0, 200)
    plan = quality.reference_violations(tables)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_stored_reference_check_skips_nulls(spark, tables):
    orders = tables["orders"].withColumn(
        "customer_id", F.when(F.col("order_id") == "ORD-1", "CUST-X")
    )
    rows = quality.reference_violation_rows({**tables, "orders": orders}).collect()
    assert [(r.dataset, r.row_id, r.missing_key) for r in rows] == [("orders", "ORD-1", "CUST-X")]


def test_fail_fast(spark, tables, work):
    quality.require_valid(tables, f"{work}/errors")
    broken = frames(
        spark,
        {**CLEAN, "orders": [("ORD-1", "CUST-NONEXISTENT", "PROD-1", 0, 20.0, at("2025-02-01 09:00:00"), "")] * 2},
    )
    with pytest.raises(quality.DataQualityError, match="Broken FK"):
        quality.require_valid(broken, f"{work}/errors")
    assert spark.read.parquet(f"{work}/errors").count() == quality.violations(broken).count()
    errors = {(r.dataset, r.error): r["count"] for r in
              quality.violations(broken).groupBy("dataset", "error").count().collect()}
    assert errors == {
        ("orders", "duplicate primary ids"): 1,
        ("orders", "missing value"): 1,
        ("orders", "invalid quantity"): 2,
        ("orders", "Broken FK: customer_id"): 2,
        ("payments", "Broken FK: order_id"): 1,
    }


def test_load_constraints_split_rows(spark):
    relation = model.RELATIONS["products"]
    table = spark.createDataFrame(
        [("P1", "a", "c", 1.0, 0), ("P2", None, "c", 0.0, -1), ("P3", "a", "c", None, 1)], relation.schema
    )
    assert [r.product_id for r in quality.accepted(table, relation).collect()] == ["P1"]
    rejected = {r.product_id: r.violated_rules for r in quality.rejected(table, relation).collect()}
    assert rejected == {
        "P2": ["name is missing", "invalid_prices", "invalid_stock"],
        "P3": ["price is missing"],
    }


def test_load_verification(tables):
    stored = {**tables, "orders": tables["orders"].limit(1)}
    rows = {r.table_name: r for r in quality.load_verification(tables, stored).collect()}
    assert not rows["orders"].matched and rows["orders"].stored_count == 1
    assert rows["payments"].matched


def test_lost_references_are_found_alike_with_and_without_hashes(spark, tables, monkeypatch):
    tables["orders"] = tables["orders"].withColumn("customer_id", F.concat(F.lit("X-"), "customer_id"))
    tables["reviews"] = tables["reviews"].withColumn("rating", F.lit(9)).withColumn("product_id", F.lit(None).cast("string"))
    found = []
    for most in (quality.MOST_HASHES, 0):
        monkeypatch.setattr(quality, "MOST_HASHES", most)
        errors, rows = quality.violations(tables), quality.reference_violation_rows(tables)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert ("_may" in plan) == (most > 0)
        found.append((sorted(map(str, errors.collect())), sorted(map(str, rows.collect()))))
    assert found[0] == found[1]
    assert len(found[0][1]) == 2 and len(found[0][0]) == 7


def test_row_level_checks_shuffle_only_keys_that_may_be_in_trouble(spark):
    """Own keys of relations that none refers to stay out of the reference check; what is found is counted once, then stored."""
    rows = {
        "customers": [("C1", "n", "e", "2024-01-01 00:00:00", "web"), ("C1", "n", "e", "2024-01-01 00:00:00", "web"), (None, "n", "e", "2024-01-01 00:00:00", "web"), (None, "n", "e", "2024-01-01 00:00:00", "web")],
        "products": [("P1", "n", "c", "1", "1")],
        "orders": [("O1", "C1", "P9", "1", "1", "2024-01-01 00:00:00", "Pending"), ("O2", None, "P9", "1", "1", "2024-01-01 00:00:00", "Pending")],
        "payments": [("Y1", "O9", "m", "1", "Failed", "2024-01-01 00:00:00"), ("Y1", "O1", "m", "1", "Failed", "2024-01-01 00:00:00")],
        "reviews": [("R1", "C9", None, "1", "t", "2024-01-01 00:00:00")],
    }
    tables = text_tables(spark, rows)
    lost = {("products", "P9", 0, 2), ("orders", "O9", 0, 1), ("customers", "C9", 0, 1)}
    assert set(map(tuple, quality._troubled_keys(tables).collect())) == lost
    gaps = {"orders": [quality._issue("orders", "missing value", "", F.col("customer_id").isNull().cast("int"))]}
    noted = {("customers", "C1", 2, 1), ("customers", None, 2, 0), ("payments", "Y1", 2, 0), ("#issues", "orders/missing value/", 1, 0)}
    assert set(map(tuple, quality._troubled_keys(tables, gaps).collect())) == lost | noted
    errors = quality.violations(tables).where("row_id IS NULL").select("dataset", "error").collect()
    repeated = {(name, "duplicate primary ids") for name in ("customers", "payments")}
    assert {tuple(r) for r in errors} >= repeated and len(errors) == len(set(errors))
