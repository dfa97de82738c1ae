import json
import time
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from merchlake import model
from merchlake.sources import canonical, files, keyed_table


def test_csv_round_trip_keeps_blanks_quotes_and_nulls(spark, work):
    rows = [("R1", None, "P1", 4, ' padded, "quoted" ', None)]
    table = spark.createDataFrame(rows, model.REVIEWS)
    path = files.write_csv(table, f"{work}/reviews.csv")
    assert files.read_reviews(spark, path).collect() == table.collect()


def test_every_reader_returns_its_schema(spark, work, tables):
    files.write_tables_csv(tables, work)
    for name, relation in model.RELATIONS.items():
        read = getattr(files, f"read_{name}")(spark, f"{work}/{name}.csv")
        assert read.schema == relation.schema
        assert sorted(read.collect()) == sorted(tables[name].collect())


def test_optional_order_items(spark, work):
    path = f"{work}/order_items.csv"
    assert files.read_order_items(spark, path) is None
    empty = files.read_order_items_or_empty(spark, path)
    assert empty.schema == model.ORDER_ITEMS and empty.isEmpty()


def test_missing_raw_table_raises(spark, work):
    with pytest.raises(FileNotFoundError):
        files.read_text_tables(spark, work)
    with pytest.raises(FileNotFoundError):
        files.load_processed(spark, work)


def test_strict_load_raises_on_a_bad_number(spark, work, tables):
    files.write_tables_csv(tables, work)
    bad = tables["products"].withColumn("price", F.lit("cheap"))
    files.write_csv(bad, f"{work}/products.csv")
    loaded = files.load_processed(spark, work)
    assert loaded["orders"].count() == 2
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        loaded["products"].collect()


def test_json_array_and_lines(spark, tmp_path):
    record = {
        "order_id": "O1", "customer_id": "C1", "product_id": "P1", "quantity": 1,
        "total_price": 19.99, "order_date": "2026-07-27 16:03:10", "status": "Completed",
    }
    (tmp_path / "array.json").write_text(json.dumps([record, {**record, "order_id": "O2"}], indent=2))
    read = files.read_json(spark, str(tmp_path / "array.json"), model.ORDERS, array=True)
    assert [r.order_id for r in read.orderBy("order_id").collect()] == ["O1", "O2"]
    lines = files.write_json(read, str(tmp_path / "lines"))
    assert sorted(files.read_json(spark, lines, model.ORDERS).collect()) == sorted(read.collect())


def test_json_arrays_hold_every_record_once(spark, work):
    table = spark.range(500).select(F.col("id").cast("string").alias("review_id"), F.lit(3).alias("rating"))
    path = files.write_json_arrays(table, f"{work}/arrays", 7)
    assert len(list(Path(path).rglob("part-*"))) == 7
    read = files.read_json(spark, path, table.schema, array=True)
    assert read.columns == table.columns and sorted(read.collect()) == sorted(table.collect())


def test_parquet_append_and_failure(spark, work, tables):
    path = files.export_to_parquet(tables["orders"], f"{work}/orders")
    files.export_to_parquet(tables["orders"], path, "append")
    assert spark.read.parquet(path).count() == 4
    with pytest.raises(AnalysisException):
        files.export_to_parquet(tables["orders"], path, "errorifexists")


def test_status_filter_equals_filtered_view(spark):
    wanted = canonical.orders(spark, SMALL).filter("status = 'Completed'")
    pushed = canonical.orders_with_status(spark, SMALL, "Completed")
    assert wanted.exceptAll(pushed).isEmpty() and pushed.exceptAll(wanted).isEmpty()


def test_order_lines_are_the_orders_without_their_header(spark):
    lines = canonical.order_lines(spark, SMALL)
    view = canonical.orders(spark, SMALL).select(lines.columns)
    assert lines.exceptAll(view).isEmpty() and view.exceptAll(lines).isEmpty()


def test_upsert_is_idempotent_and_touches_only_its_buckets(spark, work, tables):
    path = f"{work}/orders"
    first = keyed_table.upsert(spark, path, tables["orders"], "order_id", buckets=16)
    assert first["INSERT"] == 2
    before = {f: f.read_bytes() for f in Path(path).rglob("*.parquet")}
    delta = tables["orders"].filter("order_id = 'ORD-2'").withColumn("status", F.lit("Shipped"))
    second = keyed_table.upsert(spark, path, delta, "order_id")
    assert (second["INSERT"], second["UPDATE"], second["NO_CHANGE"]) == (0, 1, 0)
    after = {f: f.read_bytes() for f in Path(path).rglob("*.parquet")}
    assert len(after) == len(before) == 2 and len(before.items() & after.items()) == 1
    third = keyed_table.upsert(spark, path, delta, "order_id")
    assert (third["INSERT"], third["UPDATE"], third["NO_CHANGE"]) == (0, 0, 1)
    stored = {r.order_id: r.status for r in keyed_table.read(spark, path).collect()}
    assert stored == {"ORD-1": "Completed", "ORD-2": "Shipped"}


def test_upsert_keeps_columns_the_delta_lacks(spark, work, tables):
    path = f"{work}/orders"
    keyed_table.upsert(spark, path, tables["orders"], "order_id", buckets=2)
    delta = spark.createDataFrame([("ORD-1", "Shipped")], "order_id string, status string")
    keyed_table.upsert(spark, path, delta, "order_id")
    row = keyed_table.read(spark, path).filter("order_id = 'ORD-1'").first()
    assert (row.status, row.total_price, row.customer_id) == ("Shipped", 20.0, "CUST-1")


def test_upsert_of_nothing_and_of_rows_without_key(spark, work, tables):
    path = f"{work}/orders"
    assert keyed_table.upsert(spark, path, tables["orders"].limit(0), "order_id")["INSERT"] == 0
    assert keyed_table.read(spark, path, model.ORDERS).isEmpty()
    keyless = tables["orders"].withColumn("order_id", F.lit(None).cast("string"))
    done = keyed_table.upsert(spark, path, keyless.unionByName(tables["orders"]), "order_id")
    assert (done["INSERT"], done["REJECT"], done["total_delta_records"]) == (2, 2, 4)
    assert keyed_table.read(spark, path).count() == 2


def _files(path):
    return {f: f.stat().st_mtime_ns for f in Path(path).rglob("*") if f.is_file()}


def _die(*args):
    raise RuntimeError("driver lost")


def test_driver_lost_before_the_new_rows_are_whole(spark, work, tables, monkeypatch):
    path = f"{work}/orders"
    keyed_table.upsert(spark, path, tables["orders"], "order_id", buckets=4)
    before = sorted(keyed_table.read(spark, path).collect())
    delta = tables["orders"].withColumn("status", F.lit("Shipped"))
    with monkeypatch.context() as broken:
        broken.setattr(keyed_table, "_merged", _die)
        with pytest.raises(RuntimeError):
            keyed_table.upsert(spark, path, delta, "order_id")
    Path(f"{path}/next/__bucket=0").mkdir(parents=True)
    Path(f"{path}/next/__bucket=0/part-0.parquet").write_bytes(b"cut off")
    assert sorted(keyed_table.read(spark, path).collect()) == before
    keyed_table.recover(spark, path)
    assert sorted(keyed_table.read(spark, path).collect()) == before and not Path(f"{path}/next").exists()
    keyed_table.upsert(spark, path, delta, "order_id")
    assert {r.status for r in keyed_table.read(spark, path).collect()} == {"Shipped"}


def test_driver_lost_while_partitions_are_replaced(spark, work, tables, monkeypatch):
    path = f"{work}/orders"
    keyed_table.upsert(spark, path, tables["orders"], "order_id", buckets=16)
    delta = tables["orders"].withColumn("status", F.lit("Shipped"))
    with monkeypatch.context() as broken:
        broken.setattr(keyed_table, "_replace", _die)
        with pytest.raises(RuntimeError):
            keyed_table.upsert(spark, path, delta, "order_id")
    assert {r.status for r in keyed_table.read(spark, path).collect()} == {"Completed", "Cancelled"}
    # One of the two partitions was deleted already, its successor not yet put in place.
    part = next(f for f in Path(f"{path}/rows").rglob("*.parquet"))
    part.unlink()
    again = keyed_table.upsert(spark, path, delta, "order_id")
    assert (again["NO_CHANGE"], again["INSERT"]) == (2, 0)
    assert sorted((r.order_id, r.status) for r in keyed_table.read(spark, path).collect()) == [
        ("ORD-1", "Shipped"), ("ORD-2", "Shipped")
    ]


def test_reads_change_nothing_and_old_rows_are_gone(spark, work, tables):
    path = f"{work}/orders"
    for status in ("Pending", "Shipped", "Completed", "Cancelled"):
        keyed_table.upsert(spark, path, tables["orders"].withColumn("status", F.lit(status)), "order_id", buckets=4)
    before = _files(path)
    rows = keyed_table.read(spark, path).collect()
    keyed_table.rejects(spark, path).collect()
    assert _files(path) == before and {r.status for r in rows} == {"Cancelled"}
    assert spark.read.parquet(f"{path}/rows").count() == 2


def test_a_merge_reads_only_the_partitions_it_hits(spark, work):
    path = f"{work}/t"
    keyed_table.upsert(spark, path, spark.range(1000).withColumn("v", F.lit(0)), "id", buckets=32)
    before = _files(f"{path}/rows")
    keyed_table.upsert(spark, path, spark.createDataFrame([(5, 1)], "id bigint, v int"), "id")
    parts = [f for f in before if f.suffix == ".parquet"]
    after = _files(f"{path}/rows")
    assert sum(after.get(f) == before[f] for f in parts) == len(parts) - 1
    assert keyed_table.read(spark, path).agg(F.count("v"), F.sum("v")).first()[:] == (1000, 1)


@pytest.mark.parametrize("unique", [False, True])
def test_rows_without_a_key_are_kept_aside_on_every_path(spark, work, tables, unique):
    path, orders = f"{work}/orders", tables["orders"]
    keyless = orders.limit(1).withColumn("order_id", F.lit(None).cast("string"))
    blank = orders.limit(1).withColumn("order_id", F.lit(""))
    for turn in (1, 2):
        done = keyed_table.upsert(spark, path, orders.unionByName(keyless).unionByName(blank), "order_id", buckets=2, unique=unique)
        assert (done["REJECT"], done["total_delta_records"]) == (2, 4)
        assert sorted(r.order_id for r in keyed_table.read(spark, path).collect()) == ["ORD-1", "ORD-2"]
        assert keyed_table.rejects(spark, path).count() == 2 * turn
    assert keyed_table.rejects(spark, path).columns == orders.columns


def test_an_older_sequence_never_wins(spark, work):
    path, schema = f"{work}/t", "k string, v int, seq int"
    load = lambda *rows: keyed_table.upsert(spark, path, spark.createDataFrame(rows, schema), "k", "seq", buckets=2)
    load(("a", 1, 5), ("b", 1, 1))
    done = load(("a", 2, 1), ("b", 2, 2), ("c", 2, None))
    assert (done["STALE"], done["UPDATE"], done["INSERT"]) == (1, 1, 1)
    load(("a", 3, 5), ("c", 3, 0))
    found = {r.k: (r.v, r.seq) for r in keyed_table.read(spark, path).collect()}
    assert found == {"a": (3, 5), "b": (2, 2), "c": (3, 0)}


def test_recorded_batch_is_not_applied_again(spark, work, tables):
    path = f"{work}/orders"
    first = keyed_table.upsert(spark, path, tables["orders"], "order_id", buckets=2, batch=("q", 7))
    other = tables["orders"].withColumn("status", F.lit("Shipped"))
    again = keyed_table.upsert(spark, path, other, "order_id", batch=("q", 7))
    assert again == first
    assert "Shipped" not in {r.status for r in keyed_table.read(spark, path).collect()}
    keyed_table.upsert(spark, path, other, "order_id", batch=("another query", 7))
    assert {r.status for r in keyed_table.read(spark, path).collect()} == {"Shipped"}


def _raw_folder(tables, work, lines):
    """The clean tables as CSV, with more lines at the end of reviews."""
    files.write_tables_csv(tables, work)
    part = next(Path(f"{work}/reviews.csv").glob("part-*.csv"))
    part.write_text(part.read_text() + "".join(f"{line}\n" for line in lines))
    for crc in Path(f"{work}/reviews.csv").glob(".*.crc"):
        crc.unlink()


WHOLE = "R9,C1,P1,5,fine,2025-04-01 00:00:00"
MALFORMED = [
    "R1,C1,P1,5,text,2025-04-01 00:00:00,more,and more",
    "R2,C1,P1",
    'R3,C1,P1,5,"open quote,2025-04-01 00:00:00',
    ",,,,,,",
]


def test_malformed_lines_are_kept_whole(spark, work, tables):
    _raw_folder(tables, work, [*MALFORMED, WHOLE, "", 'R5,C1,P1,5,"a ""quoted, text""",2025-04-01 00:00:00'])
    found = files.malformed_lines(spark, work)
    assert sorted(tuple(r) for r in found.collect()) == sorted(("reviews", line) for line in MALFORMED)
    with pytest.raises(files.MalformedLinesError, match="4 malformed lines"):
        files.require_whole_lines(spark, work, f"{work}/malformed")
    assert spark.read.parquet(f"{work}/malformed").count() == 4


def test_whole_files_have_no_malformed_lines(spark, work, tables):
    _raw_folder(tables, work, [WHOLE])
    assert files.malformed_lines(spark, work).isEmpty()
    files.require_whole_lines(spark, work, f"{work}/malformed")


@pytest.mark.parametrize("line", MALFORMED)
def test_a_strict_load_raises_on_a_malformed_line(spark, work, tables, line):
    _raw_folder(tables, work, [line])
    with pytest.raises(Exception, match="MALFORMED"):
        files.load_processed(spark, work)["reviews"].select("review_id").collect()


def test_lines_are_written_as_they_are(spark, work):
    lines = ['a,"b', " padded ,x", "é,", '""', "back\\slash,y"]
    files.write_lines(spark.createDataFrame([(line,) for line in lines], "line string"), ["p", "q"], f"{work}/raw.csv")
    read = [r.value for r in spark.read.text(f"{work}/raw.csv").collect()]
    assert sorted(line for line in read if line != "p,q") == sorted(lines) and "p,q" in read


def test_json_arrays_become_more_with_the_records(spark, work):
    table = spark.range(100).select(F.col("id").alias("review_id"), F.lit(1.50).alias("rating"))
    path = files.write_json_arrays(table, f"{work}/arrays", 2, records=10)
    assert len(list(Path(path).glob("array=*"))) > 2
    schema = StructType([StructField("review_id", StringType()), StructField("rating", StringType())])
    read = files.read_json(spark, path, schema, array=True)
    assert sorted((int(r.review_id), r.rating) for r in read.collect()) == [(n, "1.5") for n in range(100)]


@pytest.mark.parametrize("text", ['[{"a": 1, "b": 2.50}, {"a": "x"}]', '{"a": {"c":  1}}', "[]", " ", "{", '[{"a": 1}, {"b": "x"}]', "null"])
def test_json_arrays_read_as_the_reader_of_files_does(spark, work, text):
    (Path(work) / "one.json").write_text(text)
    schema = StructType([StructField("a", StringType()), StructField("b", DoubleType())])
    plain = spark.read.schema(schema).option("multiLine", True).json(work)
    assert files.read_json(spark, work, schema, array=True).collect() == plain.collect()


def test_compressed_csv_reads_as_the_plain_one(spark, work, tables):
    files.write_tables_csv(tables, f"{work}/plain")
    files.write_tables_csv(tables, f"{work}/small", compression="gzip")
    for name, relation in model.RELATIONS.items():
        read = [
            sorted(map(tuple, files.read_text_tables(spark, f"{work}/{folder}")[name].collect()))
            for folder in ("plain", "small")
        ]
        assert read[0] == read[1] and len(read[0]) == tables[name].count()
    assert files.malformed_lines(spark, f"{work}/small").count() == 0


def test_shuffle_files_go_when_their_query_ends(spark, work):
    from merchlake.session import configure

    def kept():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(blocks.apply(n).getName().startswith("shuffle_") for n in range(blocks.size()))

    configure(spark)
    before = kept()
    spark.range(10_000).repartition(7, "id").write.parquet(f"{work}/rows")
    for _ in range(50):  # the files are deleted in the background
        if kept() <= before:
            break
        time.sleep(0.1)
    assert kept() <= before
    assert spark.read.parquet(f"{work}/rows").count() == 10_000
