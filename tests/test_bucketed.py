import re

import pytest

from merchlake.operators import cdc, warehouse
from merchlake.sources import bucketed


@pytest.fixture
def name(spark):
    name = "stored_items"
    yield name
    for table in (name, f"{name}_next"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def items(spark, rows):
    return spark.createDataFrame(rows, "id string, place string, amount int")


def stored_is_unshuffled(table, name):
    """Whether no exchange stands above a scan of the stored table in the physical plan."""
    plan = table._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scans = [n for n, line in enumerate(lines) if "FileScan" in line and name in line]
    assert scans
    for scan in scans:
        depth = lines[scan].index("FileScan")
        for line in reversed(lines[:scan]):
            start = re.search(r"[A-Za-z]", line)
            if start and start.start() < depth:
                depth = start.start()
                if "Exchange" in line and "Broadcast" not in line:
                    return False
    return True


@pytest.fixture
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merges_follow_each_other(spark, name):
    first = items(spark, [(f"i{n}", "here", n) for n in range(50)])
    bucketed.store(first, name, "id", 8)
    once = bucketed.merge(spark, name, items(spark, [("i1", "there", 7), ("new", "there", 8), (None, "lost", 9)]), "id")
    rows = {r.id: (r.place, r.amount) for r in once.collect()}
    assert len(rows) == 51 and rows["i1"] == ("there", 7) and rows["new"] == ("there", 8) and rows["i2"] == ("here", 2)
    delta = spark.createDataFrame([("i1", 70), ("i1", 71)], "id string, amount int")
    twice = bucketed.merge(spark, name, delta, "id", "amount", keep_old=True)
    rows = {r.id: (r.place, r.amount) for r in twice.collect()}
    assert len(rows) == 51 and rows["i1"] == ("there", 71)
    assert bucketed._detail(spark, name, "Num Buckets") == "8"


def test_a_merge_that_fails_leaves_the_table(spark, name):
    bucketed.store(items(spark, [("a", "x", 1)]), name, "id", 8)
    with pytest.raises(Exception, match="key repeated"):
        bucketed.merge(spark, name, items(spark, [("a", "y", 2), ("a", "z", 3)]), "id")
    assert [tuple(r) for r in spark.table(name).collect()] == [("a", "x", 1)]
    after = bucketed.merge(spark, name, items(spark, [("a", "y", 2)]), "id")
    assert [tuple(r) for r in after.collect()] == [("a", "y", 2)]


def test_drop_deletes_the_files(spark, name, tmp_path):
    bucketed.store(items(spark, [("a", "x", 1)]), name, "id", 8)
    bucketed.drop(spark, name)
    assert not spark.catalog.tableExists(name)


def test_the_stored_side_is_not_shuffled(spark, name, unbroadcast):
    rows = items(spark, [(f"i{n}", "here", n) for n in range(100)])
    current = bucketed.store(rows, name, "id", 8)
    assert stored_is_unshuffled(cdc.merge(current, rows, "id"), name)
    assert stored_is_unshuffled(cdc.classify(current, rows, "id"), name)
    assert not stored_is_unshuffled(current.groupBy("place").count(), name)


def test_a_second_load_does_not_shuffle_the_stored_dimension(spark, name, unbroadcast):
    rows = spark.createDataFrame([(f"i{n}", n) for n in range(100)], "id string, amount int")
    current = bucketed.store(warehouse.load_dimension(rows, "id", "key", ["amount"]), name, "id", 8)
    more = spark.createDataFrame([(f"i{n}", -n) for n in range(50, 150)], "id string, amount int")
    joined = more.join(current.select("id", "key"), "id", "left")
    assert stored_is_unshuffled(joined, name)
    loaded = {r.id: (r.key, r.amount) for r in warehouse.load_dimension(more, "id", "key", ["amount"], current).collect()}
    first = {r.id: r.key for r in current.collect()}
    assert all(loaded[i][0] == first[i] for i in loaded if i in first)
    assert sorted(k for i, (k, _) in loaded.items() if i not in first) == list(range(101, 151))
    assert {i: a for i, (_, a) in loaded.items()} == {f"i{n}": -n for n in range(50, 150)}
