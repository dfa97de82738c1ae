"""Readers and writers for CSV, JSON and Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from merchlake import model
from merchlake.functions.text import MOMENT_FORMAT


# Quotes are escaped by doubling them, and white space around a cell is part of it.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": MOMENT_FORMAT,
}


# What is written down in Parquet on the way, and stored: a fifth to a third smaller than by default.
PARQUET = {"compression": "zstd"}

# The column that takes a line which does not have its table's fields.
MALFORMED = "_malformed"


class MalformedLinesError(ValueError):
    """A raw file holds lines that don't have the fields of its table."""


def _as_text(schema: StructType) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in schema.fieldNames()])


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whatever store it lies on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, store = hadoop_path(spark, path)
    return store.exists(target)


def _read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.options(**_CSV).csv(path, schema=schema)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, model.PRODUCTS)


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, model.CUSTOMERS)


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, model.ORDERS)


def read_payments(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, model.PAYMENTS)


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, model.REVIEWS)


def read_order_items(spark: SparkSession, path: str) -> DataFrame | None:
    """Order items, or None where the optional file is absent."""
    return _read_csv(spark, path, model.ORDER_ITEMS) if exists(spark, path) else None


def read_order_items_or_empty(spark: SparkSession, path: str) -> DataFrame:
    found = read_order_items(spark, path)
    return found if found is not None else spark.createDataFrame([], model.ORDER_ITEMS)


def read_text_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All five raw tables with every column as text; a missing file raises.

    A typed read turns bad numbers and dates into NULL, which would hide them from the audit.
    """
    tables = {}
    for name, relation in model.RELATIONS.items():
        path = f"{folder}/{name}.csv"
        if not exists(spark, path):
            raise FileNotFoundError(f"raw table missing: {path}")
        tables[name] = _read_csv(spark, path, _as_text(relation.schema))
    return tables


def malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset, line) of the raw lines with too few or too many fields, an unclosed quote among the causes.

    The reader keeps such lines whole in a column of their own; read as rows, their missing fields would be NULL
    and those beyond the last one lost. Blank lines are no rows.
    """
    found = []
    for name, relation in model.RELATIONS.items():
        schema = _as_text(relation.schema).add(MALFORMED, StringType())
        # Without pruning every line is parsed whole, whatever columns are asked for.
        options = {**_CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "columnPruning": False}
        table = spark.read.options(**options).csv(f"{folder}/{name}.csv", schema=schema)
        # The reader refuses to give out this column alone; a condition that always holds asks for another one.
        asked = F.octet_length(F.coalesce(F.col(relation.key), F.lit(""))) >= 0
        found.append(table.where(F.col(MALFORMED).isNotNull() & asked).select(F.lit(name).alias("dataset"), F.col(MALFORMED).alias("line")))
    return reduce(DataFrame.unionByName, found)


def require_whole_lines(spark: SparkSession, folder: str, path: str) -> None:
    """Write the malformed lines of a folder's raw tables to ``path`` and raise if there are any."""
    seen = Observation()
    malformed_lines(spark, folder).observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(path)
    if seen.get["n"]:
        raise MalformedLinesError(f"{seen.get['n']} malformed lines, all listed in {path}")


def typed(table: DataFrame, schema: StructType) -> DataFrame:
    """Cast a text table to its schema; a bad value raises (ANSI casts)."""
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_processed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Processed CSV tables, strictly cast to the base schemas; extra columns are left out.

    A value that can't be cast raises, and so does a line with more or fewer fields than the header.
    """
    tables = {}
    for name, relation in model.RELATIONS.items():
        path = f"{folder}/{name}.csv"
        if not exists(spark, path):
            raise FileNotFoundError(f"processed table missing: {path}")
        # Without pruning every line is parsed whole, whatever columns are asked for.
        text = spark.read.options(**_CSV, mode="FAILFAST", columnPruning=False).csv(path)
        tables[name] = typed(text, relation.schema)
    return tables


def read_json(spark: SparkSession, path: str, schema: StructType, array: bool = False) -> DataFrame:
    """JSON records: one per line, or ``array`` files holding one JSON array each.

    An array file cannot be split, so one task reads each file; JSON lines have no such limit. An array file is
    read as one line, ended by a character that JSON doesn't have: the reader of several lines goes back to its
    file for every number that is to be text.
    """
    reader = spark.read.schema(schema).option("timestampFormat", MOMENT_FORMAT)
    if array:
        reader = reader.option("lineSep", "\u0000").option("recursiveFileLookup", True)
    return reader.json(path)


def write_csv(table: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> str:
    """CSV with a header row in every part file; timestamps as YYYY-MM-DD HH:MM:SS.

    A compressed file can't be split, so that a reader has as many tasks as the writer had.
    """
    table.write.mode(mode).options(**_CSV, compression=compression).csv(path)
    return path


def write_lines(table: DataFrame, columns: list[str], path: str) -> str:
    """The column ``line`` as it is, line by line, under a header in every part file."""
    plain = {"header": True, "sep": "\u0001", "quote": "\u0000", "escapeQuotes": False}
    plain |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    table.select(F.col("line").alias(",".join(columns))).write.mode("overwrite").options(**plain).csv(path)
    return path


def write_tables_csv(tables: dict[str, DataFrame], folder: str, compression: str = "none") -> dict[str, str]:
    return {name: write_csv(table, f"{folder}/{name}.csv", compression=compression) for name, table in tables.items()}


def export_to_parquet(table: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write Parquet and return the path; a failed write raises."""
    table.write.mode(mode).options(**PARQUET).parquet(path)
    return path


def write_json(table: DataFrame, path: str, mode: str = "overwrite") -> str:
    table.write.mode(mode).option("timestampFormat", MOMENT_FORMAT).json(path)
    return path


def write_json_arrays(table: DataFrame, path: str, arrays: int = 64, records: int = 20_000) -> str:
    """JSON files that each hold one array: ``arrays`` of them, or as many more as arrays of about ``records`` each take."""
    arrays = max(arrays, -(-table.count() // records))
    record = F.to_json(F.struct("*"), {"timestampFormat": MOMENT_FORMAT}).alias("record")
    part = F.pmod(F.xxhash64("record"), F.lit(arrays)).alias("array")
    grouped = table.select(record).groupBy(part).agg(F.collect_list("record").alias("records"))
    text = F.concat(F.lit("["), F.array_join("records", ",\n"), F.lit("]")).alias("value")
    # A folder for each array, so that no file holds two.
    grouped.select("array", text).write.mode("overwrite").partitionBy("array").text(path)
    return path
