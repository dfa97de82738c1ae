import pytest
from pyspark.sql import functions as F

from merchlake.operators import drift, run_metrics


def test_declared_schema_drift(spark):
    table = spark.createDataFrame([], "order_id string, total_price int, discount double")
    expected = {"order_id": "string", "total_price": "double", "status": "string"}
    found = drift.schema_drift(expected, drift.declared_types(table))
    assert [tuple(r) for r in found.collect()] == [
        ("discount", "added", None, "double"),
        ("status", "missing", "string", None),
        ("total_price", "type_mismatch", "double", "int"),
    ]
    assert drift.any_drift(found)
    same = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    assert not drift.any_drift(drift.schema_drift(same, drift.declared_types(table)))


def test_observed_types(spark):
    rows = [("1", "1", "x", "2025-01-01", None, "2025-02-30"), ("-22", "2.5e3", "1", "2025-01-01 10:00:00", None, "2025-01-01")]
    table = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    found = {r.column_name: r.type for r in drift.observed_types(table).collect()}
    assert found == {"a": "bigint", "b": "double", "c": "string", "d": "timestamp", "e": "void", "f": "string"}


def test_observed_json_types(spark):
    table = spark.createDataFrame([('{"k": 1, "t": "x"}',), ('{"k": 2.5}',), ("{}",)], "props string")
    found = {r.column_name: r.type for r in drift.observed_json_types(table, "props").collect()}
    assert found == {"k": "double", "t": "string"}


@pytest.mark.parametrize(
    ("baseline", "current", "change", "drifted"),
    [(100.0, 110.0, 0.1, False), (100.0, 130.0, 0.3, True), (100.0, 120.0, 0.2, False),
     (100.0, 120.001, 0.2, True), (0.0, 0.5, 0.5, True), (0.0, 0.1, 0.1, False), (-10.0, -13.0, 0.3, True)],
)
def test_metric_drift(spark, baseline, current, change, drifted):
    old = spark.createDataFrame([(baseline,)], "x double")
    new = spark.createDataFrame([(current,)], "x double")
    row = drift.metric_drift(old, new).filter("metric = 'mean'").first()
    assert (row.relative_change, row.has_drift) == (change, drifted)


def test_metrics_of_columns(spark):
    table = spark.createDataFrame([(1, 2**62), (None, 2**62), (4, None)], "a int, b bigint")
    found = {(r.column_name, r.metric): r.value for r in drift.column_metrics(table).collect()}
    assert found["a", "count"] == 3 and found["a", "nulls"] == 1 and found["a", "mean"] == 2.5
    assert found["b", "sum"] == 2.0**63 and found["a", "max"] == 4.0


def test_columns_on_one_side_only_are_drift(spark):
    old = spark.createDataFrame([(1.0,)], "x double")
    new = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert drift.metric_drift(old, new).filter("column_name = 'y' AND has_drift").count() == 6


def test_run_metrics(spark, work):
    runs = f"{work}/runs"
    table = spark.range(10).withColumn("x", F.when(F.col("id") < 4, F.col("id")))
    run = run_metrics.observed_write(table, runs, "copy", lambda t: t.write.parquet(f"{work}/copy"))
    assert (run["task_name"], run["row_count"], run["status"]) == ("copy", 10, "SUCCESS")
    assert '"nulls_x": 6' in run["details"]
    with pytest.raises(ValueError):
        run_metrics.observed_write(table, runs, "broken", lambda t: (_ for _ in ()).throw(ValueError()))
    stored = {r.task_name: r.status for r in spark.read.parquet(runs).collect()}
    assert stored == {"copy": "SUCCESS", "broken": "FAILED"}


def test_small_prices_drift_and_broken_json_is_counted(spark):
    old, new = (spark.range(1000).select(F.lit(x).alias("price")) for x in (0.004, 0.001))
    found = {r.metric: (r.baseline, r.current, r.has_drift) for r in drift.metric_drift(old, new).collect()}
    assert found["sum"] == (4.0, 1.0, True) and found["mean"] == (0.004, 0.001, True)
    cells = spark.createDataFrame([('{"a": 1}',), ("{bad",), (None,), ('{"a": 2}',)], "props string")
    assert tuple(drift.unreadable_json(cells, "props").first()) == (3, 1)
    types = {r.column_name: r.type for r in drift.observed_json_types(cells, "props").collect()}
    assert types == {"a": "bigint", drift.UNREADABLE: "string"}


def test_types_by_path(spark):
    rows = [
        ('{"a": {"b": 1, "c d": [{"x": 1}, {"x": 2.5}]}, "z": null}',), ('{"a": {"b": "q"}, "OBJECT<": true}',),
        ("{bad",), (None,), ('{"n": [], "a": {"t": 3}}',),
    ]
    table = spark.createDataFrame(rows, "doc string")
    assert {tuple(r) for r in drift.nested_types(table, "doc").collect()} == {
        ("a", "object"), ("a.b", "mixed"), ("a.c d", "array"), ("a.c d[]", "object"), ("a.c d[].x", "double"),
        ("a.t", "bigint"), ("z", "void"), ("OBJECT<", "boolean"), ("n", "array"), ("n[]", "void"),
        (drift.UNREADABLE, "string"),
    }
    changed = drift.schema_drift({"a": "object", "a.b": "bigint"}, drift.nested_types(table.limit(2), "doc"))
    assert ("a.b", "type_mismatch", "bigint", "mixed") in [tuple(r) for r in changed.collect()]


@pytest.mark.parametrize(
    ("cells", "found"),
    [([], set()), ([None], set()), (["5"], {("$", "bigint")}), (["[1]"], {("$", "array"), ("$[]", "bigint")}), (["{}"], set())],
)
def test_types_of_roots(spark, cells, found):
    table = spark.createDataFrame([(c,) for c in cells], "doc string")
    assert {tuple(r) for r in drift.nested_types(table, "doc").collect()} == found


def test_kept_states_merge_to_those_of_all_rows(spark, work):
    table = spark.range(20_000).selectExpr(
        "id", "(id * 7919 % 20000) / 20.0D AS x", "if(id % 3 = 0, int(id), null) AS y", "cast(null AS double) AS nothing"
    )
    kept = f"{work}/states"
    parts = {"a": table.filter("id < 500"), "b": table.filter("id >= 500 AND id < 9000"), "c": table.filter("id >= 9000")}
    for batch, rows in parts.items():
        run_metrics.keep_states(drift.metric_states(rows), kept, "load", batch)
    run_metrics.keep_states(drift.metric_states(parts["b"]), kept, "load", "b")  # given again after a failure
    run_metrics.keep_states(drift.metric_states(parts["a"]), kept, "other", "a")
    states = run_metrics.kept_states(spark, kept, "load")
    assert states.count() == 3 * 4
    merged = drift.combined_states(states)

    def listed(metrics):
        return {(r.column_name, r.metric): r.value for r in metrics.collect()}

    assert listed(drift.metrics_of(merged)) == listed(drift.column_metrics(table))
    estimates = listed(drift.quantiles_of(merged))
    for q, metric in ((0.05, "p5"), (0.5, "p50"), (0.95, "p95")):
        assert abs(estimates["x", metric] / 1000 - q) < 0.03  # a KLL sketch of default size ranks within 1.65 %
        assert estimates["nothing", metric] is None
    found = drift.compared(drift.metrics_of(merged), drift.column_metrics(table.filter("id < 9000")))
    assert found.filter("metric = 'count' AND has_drift").count() == 4


def test_states_of_a_table_without_numbers(spark):
    table = spark.createDataFrame([("x",)], "a string")
    assert drift.metric_states(table).count() == 0 and drift.column_metrics(table).count() == 0


def test_merges_are_recorded_when_they_fail_too(spark, work):
    runs = f"{work}/runs"
    done = run_metrics.timed_merge(spark, runs, "load", lambda: {"INSERT": 2, "total_delta_records": 3})
    assert done == {"INSERT": 2, "total_delta_records": 3}
    with pytest.raises(KeyError):
        run_metrics.timed_merge(spark, runs, "broken", lambda: {}["x"])
    stored = {r.task_name: (r.status, r.row_count) for r in spark.read.parquet(runs).collect()}
    assert stored == {"load": ("SUCCESS", 3), "broken": ("FAILED", 0)}
