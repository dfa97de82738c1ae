"""Schema drift and drift of column metrics."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DecimalType, DoubleType, FloatType, LongType, NullType, NumericType, StructType, VariantType
)

from merchlake.functions import money

MISSING, ADDED, RETYPED = "missing", "added", "type_mismatch"
UNREADABLE = "(unreadable)"
ROOT, MIXED = "$", "mixed"
METRICS = ("count", "nulls", "mean", "sum", "min", "max")
QUANTILES = (0.05, 0.5, 0.95)

# What a cell must look like before it is read as a type; a failed cast is far dearer.
_SHAPES = {
    "bigint": r"^[+-]?\d+$",
    "double": r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$",
    "timestamp": r"^\d{4}-\d{2}-\d{2}([ T]|$)",
}


# --- schema -----------------------------------------------------------------------------


def declared_types(table: DataFrame) -> DataFrame:
    """(column_name, type) of a typed table."""
    types = [(f.name, f.dataType.simpleString()) for f in table.schema.fields]
    return table.sparkSession.createDataFrame(types, "column_name string, type string")


def _cell_type(value: Column) -> Column:
    kinds = F.when(value.isNull(), None)
    for kind, shape in _SHAPES.items():
        kinds = kinds.when(value.rlike(shape) & value.try_cast(kind).isNotNull(), kind)
    return kinds.otherwise("string")


def _column_type() -> Column:
    """The narrowest type that holds every cell seen; whole numbers are doubles too."""
    seen, whole, number = F.col("seen"), F.col("n_bigint"), F.col("n_double")
    return (
        F.when(seen == 0, "void")
        .when(whole == seen, "bigint")
        .when(whole + number == seen, "double")
        .when(F.col("n_timestamp") == seen, "timestamp")
        .otherwise("string")
    )


def observed_types(table: DataFrame) -> DataFrame:
    """(column_name, type) of an all-text table, by what its cells can be read as.

    Cells are counted per column on each task before anything is shuffled.
    """
    cells = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in table.columns]
    )
    return _observe(table.select(F.inline(cells)))


def observed_json_types(table: DataFrame, column: str) -> DataFrame:
    """(column_name, type) of the keys of a JSON object column.

    A cell that is no JSON object shows as a key ``UNREADABLE`` of type string, so that none is lost.
    """
    parsed = F.from_json(F.col(column), "map<string,string>")
    unreadable = F.when(F.col(column).isNotNull(), F.create_map(F.lit(UNREADABLE), F.lit("?")))
    return _observe(table.select(F.explode(F.coalesce(parsed, unreadable)).alias("column_name", "value")))


def unreadable_json(table: DataFrame, column: str) -> DataFrame:
    """One row: cells that hold something, and those of them that are no JSON object."""
    filled = F.col(column).isNotNull()
    lost = filled & F.from_json(F.col(column), "map<string,string>").isNull()
    return table.agg(F.count_if(filled).alias("cells"), F.count_if(lost).alias("unreadable"))


def _observe(cells: DataFrame) -> DataFrame:
    typed = cells.select("column_name", _cell_type(F.col("value")).alias("kind"))
    counts = [F.count_if(F.col("kind") == kind).alias(f"n_{kind}") for kind in _SHAPES]
    return (
        typed.groupBy("column_name")
        .agg(F.count("kind").alias("seen"), *counts)
        .select("column_name", _column_type().alias("type"))
    )


# Names in quotes are passed over, so that a key called "OBJECT<" stays as it is.
_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")


def _paths(kind: DataType, path: str) -> Iterator[tuple[str, str]]:
    if isinstance(kind, StructType):
        if path:
            yield path, "object"
        for field in kind.fields:
            yield from _paths(field.dataType, f"{path}.{field.name}" if path else field.name)
        return
    if isinstance(kind, ArrayType):
        yield path or ROOT, "array"
        yield from _paths(kind.elementType, f"{path or ROOT}[]")
        return
    if isinstance(kind, VariantType):
        name = MIXED
    elif isinstance(kind, DecimalType):
        name = "double" if kind.scale else "decimal"
    else:
        name = kind.simpleString()
    yield path or ROOT, name


def nested_types(table: DataFrame, column: str) -> DataFrame:
    """(column_name, type) of every path in a JSON column: ``a.b`` within objects, ``a[]`` for the entries of a list.

    Types are those of the JSON values, merged over all rows in one aggregate: whole numbers and fractions
    together are ``double``, other different types are ``mixed``, and a path that only holds null is ``void``.
    A value that is no object stands at the path ``$``; cells that are no JSON show as ``UNREADABLE``. One schema
    text reaches the driver, which is as long as there are different paths.
    """
    parsed = F.try_parse_json(column)
    unreadable = F.col(column).isNotNull() & parsed.isNull()
    found = table.agg(F.schema_of_variant_agg(parsed).alias("kind"), F.count_if(unreadable).alias("unreadable")).first()
    text = _OBJECT.sub(lambda match: "STRUCT<" if match[0] == "OBJECT<" else match[0], found.kind)
    kind = DataType.fromDDL(text)
    paths = [] if isinstance(kind, NullType) else list(_paths(kind, ""))
    if found.unreadable:
        paths.append((UNREADABLE, "string"))
    return table.sparkSession.createDataFrame(paths, "column_name string, type string")


def schema_drift(expected: Mapping[str, str], actual: DataFrame) -> DataFrame:
    """(column_name, kind, expected, actual) of every column that differs; none, no drift."""
    spark: SparkSession = actual.sparkSession
    wanted = spark.createDataFrame(list(expected.items()), "column_name string, expected string")
    found = actual.select("column_name", F.col("type").alias("actual"))
    kind = F.when(F.col("actual").isNull(), MISSING).when(F.col("expected").isNull(), ADDED)
    return (
        wanted.join(found, "column_name", "full")
        .filter(~F.col("expected").eqNullSafe(F.col("actual")))
        .select("column_name", kind.otherwise(RETYPED).alias("kind"), "expected", "actual")
        .orderBy("kind", "column_name")
    )


# --- metrics ----------------------------------------------------------------------------


_FIGURES = (
    "column_name string, rows bigint, nulls bigint, filled bigint, total decimal(38,8), low double, high double"
)
STATE = f"{_FIGURES}, sketch binary"


def _column_state(name: str, kind: NumericType, sketch: bool) -> Column:
    value = F.col(name)
    filled = F.count(value)
    if isinstance(kind, (DoubleType, FloatType)):
        total, filled = money.exact(value.cast("double")), money.counted(value)
    else:
        # 64-bit integers may overflow their own type when summed.
        total = F.sum(value.cast("decimal(20,0)") if isinstance(kind, LongType) else value)
    figures = [
        F.lit(name).alias("column_name"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(value.isNull()).alias("nulls"),
        filled.alias("filled"),
        total.cast("decimal(38,8)").alias("total"),
        F.min(value).cast("double").alias("low"),
        F.max(value).cast("double").alias("high"),
    ]
    if sketch:
        figures.append(F.kll_sketch_agg_double(value.cast("double")).alias("sketch"))
    return F.struct(*figures)


def metric_states(table: DataFrame, sketches: bool = True) -> DataFrame:
    """One row per numeric column, from one aggregate, that can be kept and merged with those of other batches.

    Sums are exact to 8 digits. ``sketch`` is a KLL sketch of the values, of bounded size, for quantiles.
    """
    numeric = [f for f in table.schema.fields if isinstance(f.dataType, NumericType)]
    if not numeric:
        return table.sparkSession.createDataFrame([], STATE if sketches else _FIGURES)
    states = [_column_state(f.name, f.dataType, sketches).alias(f"_{n}") for n, f in enumerate(numeric)]
    return table.agg(*states).select(F.inline(F.array(*[F.col(f"_{n}") for n in range(len(states))])))


def combined_states(states: DataFrame) -> DataFrame:
    """The states of several batches as those of all their rows; the batches themselves aren't read."""
    return states.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.sum("filled").alias("filled"),
        F.sum("total").cast("decimal(38,8)").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def metrics_of(states: DataFrame) -> DataFrame:
    """(column_name, metric, value) of kept states."""
    figures = {
        "count": F.col("rows"),
        "nulls": F.col("nulls"),
        "mean": F.try_divide(F.col("total").cast("double"), F.col("filled")),
        "sum": F.col("total"),
        "min": F.col("low"),
        "max": F.col("high"),
    }
    return _listed(states, figures)


def quantiles_of(states: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """(column_name, metric, value) with the metrics ``p5``, ``p50``, ...; estimates, NULL for a column without values."""
    n = F.kll_sketch_get_n_double("sketch")
    figures = {
        f"p{q * 100:g}": F.when(n > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))) for q in quantiles
    }
    return _listed(states, figures)


def _listed(states: DataFrame, figures: Mapping[str, Column]) -> DataFrame:
    lines = [F.struct(F.lit(m).alias("metric"), f.cast("double").alias("value")) for m, f in figures.items()]
    return states.select("column_name", F.inline(F.array(*lines)))


def column_metrics(table: DataFrame) -> DataFrame:
    """(column_name, metric, value) of every numeric column, from one aggregate."""
    return metrics_of(metric_states(table, sketches=False))


def metric_drift(baseline: DataFrame, current: DataFrame, threshold: float = 0.20) -> DataFrame:
    """Relative change per metric; drift if it is strictly above the threshold.

    Over a baseline of zero the change is the current value itself.
    """
    return compared(column_metrics(baseline), column_metrics(current), threshold)


def compared(baseline: DataFrame, current: DataFrame, threshold: float = 0.20) -> DataFrame:
    """Drift between two lists of metrics, measured now or taken from kept states."""
    old, new = baseline.withColumnRenamed("value", "baseline"), current.withColumnRenamed("value", "current")
    change = F.when(F.col("baseline") == 0, F.abs("current")).otherwise(
        F.abs(F.col("current") - F.col("baseline")) / F.abs("baseline")
    )
    return old.join(new, ["column_name", "metric"], "full").select(
        "column_name",
        "metric",
        "baseline",
        "current",
        F.round(change, 4).alias("relative_change"),
        F.lit(float(threshold)).alias("threshold"),
        F.coalesce(change > threshold, ~F.col("baseline").eqNullSafe(F.col("current"))).alias("has_drift"),
    )


def any_drift(drift: DataFrame) -> bool:
    """Whether a drift report (of either kind) holds a finding."""
    rows = drift.filter("has_drift") if "has_drift" in drift.columns else drift
    return not rows.isEmpty()
