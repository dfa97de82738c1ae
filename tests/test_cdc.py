import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from merchlake.operators import cdc
from merchlake.sources import canonical, files, history, keyed_table
from merchlake.streaming import delta_merge

SCHEMA = "order_id string, customer_id string, total_price double, status string"
CURRENT = [("ORD001", "CUST01", 100.0, "Completed"), ("ORD002", "CUST02", 250.0, "Pending")]
DELTA = [
    ("ORD001", "CUST01", 100.0, "Completed"),
    ("ORD002", "CUST02", 275.0, "Completed"),
    ("ORD003", "CUST03", 300.0, "Completed"),
]


@pytest.fixture
def current(spark):
    return spark.createDataFrame(CURRENT, SCHEMA)


@pytest.fixture
def delta(spark):
    return spark.createDataFrame(DELTA, SCHEMA)


def _actions(tagged):
    return {r.order_id: (r[cdc.ACTION], r[cdc.CHANGED]) for r in tagged.collect()}


def test_classification(current, delta):
    assert _actions(cdc.classify(current, delta, "order_id")) == {
        "ORD001": ("NO_CHANGE", []),
        "ORD002": ("UPDATE", ["total_price", "status"]),
        "ORD003": ("INSERT", []),
    }


def test_summary(current, delta):
    row = cdc.summary(cdc.classify(current, delta, "order_id")).first()
    assert list(row) == [1, 1, 1, 0, 3]


def test_values_are_compared_by_type(spark, current):
    delta = spark.createDataFrame([("ORD001", "100")], "order_id string, total_price string")
    assert _actions(cdc.classify(current, delta, "order_id")) == {"ORD001": ("NO_CHANGE", [])}


def test_nulls_are_values(spark, current):
    blank = current.withColumn("status", F.lit(None).cast("string"))
    tagged = _actions(cdc.classify(blank, current, "order_id"))
    assert tagged["ORD001"] == ("UPDATE", ["status"])
    assert _actions(cdc.classify(blank, blank, "order_id"))["ORD001"] == ("NO_CHANGE", [])


def test_merge_twice(current, delta):
    merged = cdc.merge(current, delta, "order_id")
    assert sorted(tuple(r) for r in merged.collect()) == DELTA
    assert merged.columns == current.columns
    again = cdc.summary(cdc.classify(merged, delta, "order_id")).first()
    assert list(again) == [0, 0, 3, 0, 3]


def test_keyless_rows_are_rejected(spark, current):
    delta = spark.createDataFrame([(None, "C", 1.0, "s"), ("", "C", 1.0, "s")], SCHEMA)
    row = cdc.summary(cdc.classify(current, delta, "order_id")).first()
    assert (row.REJECT, row.total_delta_records) == (2, 2)
    assert cdc.rejects(delta, "order_id").count() == 2
    assert cdc.merge(current, delta, "order_id").count() == 2


def test_repeated_keys_need_a_sequence(spark, current):
    rows = [("ORD002", 1.0, 1), ("ORD002", 3.0, 3), ("ORD002", 2.0, 2)] + [("HOT", float(i), i) for i in range(500)]
    delta = spark.createDataFrame(rows, "order_id string, total_price double, seq int")
    merged = {r.order_id: r.total_price for r in cdc.merge(current, delta, "order_id", "seq").collect()}
    assert merged == {"ORD001": 100.0, "ORD002": 3.0, "HOT": 499.0}
    with pytest.raises(Exception, match="key repeated in delta"):
        cdc.merge(current, delta.drop("seq"), "order_id").collect()


def test_unknown_columns_are_refused(spark, current):
    with pytest.raises(ValueError, match="discount"):
        cdc.classify(current, spark.createDataFrame([("A", 1)], "order_id string, discount int"), "order_id")


def test_small_delta_leaves_the_current_table_unshuffled(spark):
    current, present = history.orders_before(spark, SMALL), canonical.orders(spark, SMALL)
    path = files.export_to_parquet(present, f"{spark.conf.get('spark.checkpoint.dir', '/tmp')}/present-{id(present)}")
    delta = spark.createDataFrame([("1-1-1-1", "Shipped")], "order_id string, status string")
    merged = cdc.merge(spark.read.parquet(path), delta, "order_id", small_delta=True)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin [order_id" in final and "SortMergeJoin" not in final
    assert current.columns == present.columns


def _write_delta(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA + ", seq int").coalesce(1).write.mode("append").parquet(folder)


def test_stream_of_deltas(spark, work, current):
    deltas, target = f"{work}/deltas", f"{work}/orders"
    keyed_table.upsert(spark, target, current, "order_id", buckets=4)
    schema = spark.createDataFrame([], SCHEMA + ", seq int").schema

    def run(checkpoint=f"{work}/checkpoint"):
        query = delta_merge.merge_stream(
            spark, deltas, schema, target, checkpoint, "order_id", "seq", files_per_batch=1
        )
        query.awaitTermination()
        return sorted(tuple(r) for r in keyed_table.read(spark, target).collect())

    _write_delta(spark, deltas, [(*DELTA[1], 1), (*DELTA[2], 1)])
    assert run() == sorted([CURRENT[0], *DELTA[1:]])
    _write_delta(spark, deltas, [("ORD003", "CUST03", 1.0, "Shipped", 5), ("ORD003", "CUST03", 2.0, "Shipped", 4)])
    expected = [CURRENT[0], DELTA[1], ("ORD003", "CUST03", 1.0, "Shipped")]
    assert run() == expected
    (number, last), = keyed_table.batches(spark, target).values()
    assert (number, last["INSERT"], last["UPDATE"]) == (1, 0, 1)
    assert run() == expected and len(keyed_table.batches(spark, target)) == 1
    # A delta that comes late does not overwrite what is newer.
    _write_delta(spark, deltas, [("ORD003", "CUST03", 7.0, "Pending", 2), ("ORD002", "CUST02", 8.0, "Shipped", 3)])
    expected = [CURRENT[0], ("ORD002", "CUST02", 8.0, "Shipped"), expected[2]]
    assert run() == expected
    (number, last), = keyed_table.batches(spark, target).values()
    assert (number, last["UPDATE"], last["STALE"]) == (2, 1, 1)
    # A new query on the same table is not taken for a repeated one.
    _write_delta(spark, deltas, [("ORD009", "CUST09", 9.0, "Shipped", 9)])
    assert run(f"{work}/checkpoint2") == [*expected, ("ORD009", "CUST09", 9.0, "Shipped")]


def test_plans_sort_no_aggregate(spark):
    earlier, present = history.orders_before(spark, SMALL), canonical.orders(spark, SMALL)
    for frame in (
        cdc.classify(earlier, present, "order_id", "total_price"),
        cdc.merge(earlier, present, "order_id", "total_price"),
    ):
        assert "SortAggregate" not in frame._jdf.queryExecution().executedPlan().toString()


def test_small_and_large_deltas_merge_alike(spark, current, delta):
    more = delta.unionByName(spark.createDataFrame([("", "C", 1.0, "s"), (None, "C", 1.0, "s")], SCHEMA)).drop("customer_id")
    one, other = (cdc.merge(current, more, "order_id", small_delta=small) for small in (False, True))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, other.collect()))
    tags = [_actions(cdc.classify(current, more, "order_id", small_delta=small)) for small in (False, True)]
    assert tags[0] == tags[1] and tags[0][None] == ("REJECT", [])


def test_the_last_rows_are_shuffled_once(spark):
    """Finding the last row of each key and joining by it takes one exchange of each side beyond its sources'."""
    schema = "order_id string, total_price double, status string"
    earlier, present = (spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, s), (None, 3.0, s), ("", 4.0, s)], schema) for s in "xy")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = cdc.last_per_key(earlier, "order_id", "total_price")
        tagged = cdc.classify(stored, present, "order_id", "total_price")
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        found = sorted((r.order_id or "", r[cdc.ACTION], r[cdc.CHANGED]) for r in tagged.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found == [("", "REJECT", []), ("", "REJECT", []), ("a", "UPDATE", ["status"])]
    assert sorted(r.total_price for r in stored.collect()) == [2.0, 3.0, 4.0]


def test_rows_without_a_key_stay_out_of_a_stored_merge(spark, work, current):
    target = f"{work}/orders"
    keyless = spark.createDataFrame([(None, "C", 1.0, "s")] * 3 + [("", "C", 2.0, "s")], SCHEMA)
    assert keyed_table.upsert(spark, target, current.unionByName(keyless), "order_id", buckets=4)["REJECT"] == 4
    more = current.limit(1).unionByName(keyless)
    result = keyed_table.upsert(spark, target, more, "order_id")
    assert (result["REJECT"], result["NO_CHANGE"], result["INSERT"]) == (4, 1, 0)
    assert keyed_table.rejects(spark, target).count() == 8
    assert sorted(tuple(r) for r in keyed_table.read(spark, target).collect()) == CURRENT


def test_rows_are_not_sorted_before_the_shuffle_to_find_the_last_of_a_key(spark, work):
    rows = [("A", 1.0, "x"), ("A", 2.0, "y"), ("B", 1.0, None), ("B", None, "z"), (None, 1.0, "k"), (None, 1.0, "k")]
    spark.createDataFrame(rows, "order_id string, total_price double, status string").write.parquet(f"{work}/delta")
    last = cdc.last_per_key(spark.read.parquet(f"{work}/delta"), "order_id", "total_price")
    found = sorted((tuple(r) for r in last.collect()), key=str)
    assert found == sorted([("A", 2.0, "y"), ("B", 1.0, None), (None, 1.0, "k"), (None, 1.0, "k")], key=str)
    plan = last._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Sort [") == 1 and "WindowGroupLimit" not in plan


def test_a_staged_delta_is_shuffled_by_its_key_once(spark, work, current, monkeypatch):
    keyed_table.upsert(spark, f"{work}/orders", current, "order_id", buckets=2)
    plans = []
    counting = keyed_table._counting

    def spied(tagged):
        plans.append(tagged._jdf.queryExecution().executedPlan().toString())
        return counting(tagged)

    monkeypatch.setattr(keyed_table, "_counting", spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [("ORD002", "C", 1.0, "Pending", 1), ("ORD002", "C", 2.0, "Shipped", 2), (None, "C", 1.0, "s", 3)]
        delta = spark.createDataFrame(rows, SCHEMA + ", seq int")
        result = keyed_table.upsert(spark, f"{work}/orders", delta, "order_id", "seq")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (result["UPDATE"], result["REJECT"]) == (1, 1)
    stored = {r.order_id: (r.total_price, r.status) for r in keyed_table.read(spark, f"{work}/orders").collect()}
    assert stored == {"ORD001": (100.0, "Completed"), "ORD002": (2.0, "Shipped")}
    # The key's rows are found in the plan of the join, on the shuffle that the join needs.
    assert "Window [lag" in plans[0] and plans[0].count("Exchange hashpartitioning(order_id") == 2


def test_repeated_keys_without_a_sequence_leave_the_stored_table_as_it_was(spark, work, current, delta):
    path = f"{work}/orders"
    keyed_table.upsert(spark, path, current, "order_id", buckets=2)
    with pytest.raises(Exception, match="key repeated in delta"):
        keyed_table.upsert(spark, path, delta.union(delta), "order_id")
    assert sorted(tuple(r) for r in keyed_table.read(spark, path).collect()) == sorted(CURRENT)
    assert keyed_table.upsert(spark, path, delta, "order_id")["INSERT"] == 1
