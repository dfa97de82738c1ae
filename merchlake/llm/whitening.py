"""Whitening of embeddings with an exact scatter matrix from bit planes.

Entries become integers. The integers of a batch, less the table's smallest one, are cut into bit planes: for
each dimension and bit, one bit a row, packed into 64-bit words along the rows. A sum of products over rows is
then a sum of weighted bit counts, ``sum of 2^(a+b) * popcount(plane_a AND plane_b)``, without any rounding.
A dimension that is 1 throughout gives the sums and the number of rows in the same way. Each task sends its
counts, gathered by weight, as plain 64-bit integers, which Spark adds up; they can't overflow, whatever the
entries are. The driver sees one number for each pair of dimensions and group of weights.

Cross-products are centred as integers of any size, divided once, and only then decomposed, so that a large
common offset or very many rows cost no precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An entry c counts as floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
# Weights 2^0 to 2^15 are added up in one 64-bit number, 2^16 to 2^31 in the next, and so on.
LIMB_BITS = 16
WORD_ROWS = 64
# Words that an AND of two planes may take at once.
TILE_WORDS = 1 << 20
# Entries beyond this, times SCALE, aren't 64-bit integers any more.
LARGEST = 2.0**55


@dataclass(frozen=True)
class Scatter:
    """Exact sums over ``n`` integer vectors that were lessened by ``low``: of each dimension, and of all products."""

    n: int
    low: int
    sums: list[int]
    products: list[list[int]]

    def centred(self) -> list[list[int]]:
        """n^2 times the covariance, as integers."""
        sums, n = self.sums, self.n
        return [[n * value - sums[i] * sums[j] for j, value in enumerate(row)] for i, row in enumerate(self.products)]


@dataclass(frozen=True)
class Whitening:
    """What maps a vector to its whitened components: one column of ``weights`` for each component."""

    scatter: Scatter
    weights: np.ndarray
    explained: list[float]
    identity_error: float


def planes(values: np.ndarray, bits: int) -> np.ndarray:
    """values (rows, dimensions), 0 <= value < 2^bits, as (bits, dimensions, words) of 64 rows each."""
    rows, width = values.shape
    padded = np.zeros((-(-rows // WORD_ROWS) * WORD_ROWS, width), np.int64)
    padded[:rows] = values
    columns = np.ascontiguousarray(padded.T)
    return np.stack([np.packbits((columns >> bit).astype(np.uint8) & 1, axis=1).view(np.uint64) for bit in range(bits)])


def add_products(into: np.ndarray, sliced: np.ndarray) -> None:
    """Adds the sums of products of the dimensions of ``sliced`` to ``into`` (limbs, dimensions, dimensions)."""
    bits, width, words = sliced.shape
    step = max(1, TILE_WORDS // max(1, width * words))
    for a in range(bits):
        for b in range(a, bits):
            limb, shift = divmod(a + b, LIMB_BITS)
            for first in range(0, width, step):
                tile = slice(first, first + step)
                both = sliced[a, tile, None, :] & sliced[b, None, :, :]
                counts = np.bitwise_count(both).sum(axis=2, dtype=np.int64) << shift
                into[limb, tile] += counts
                if a != b:
                    into[limb, :, tile] += counts.T


def _finite(vector: Column) -> Column:
    broken = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & ~broken


def usable(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """vec_id and vector of the rows that can be used, and the length of their vectors.

    Vectors are used that hold only finite numbers and have the table's most frequent length, of equally
    frequent ones the greatest.
    """
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col(f"`{column}`").cast("array<double>").alias("vector")
    ).where(_finite(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    common = sizes.agg(F.max(F.struct("n", "width")).alias("most")).first()["most"]
    width = common["width"] if common else 0
    return rows.where(F.size("vector") == width), width


def _matrix(batch: pa.RecordBatch, width: int, low: int) -> np.ndarray:
    """The batch's vectors as integers that count from the table's smallest one."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(-1, width) * SCALE).astype(np.int64) - low


def scatter(rows: DataFrame, width: int) -> Scatter | None:
    """Exact sums over the vectors of ``rows`` (all of length ``width``); None without rows."""
    ends = rows.agg(F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high")).first()
    if ends["low"] is None:
        return None
    if max(-ends["low"], ends["high"]) > LARGEST:
        raise ValueError("an entry of a vector is beyond the range of 64-bit integers once scaled")
    low, high = math.floor(SCALE * ends["low"]), math.floor(SCALE * ends["high"])
    bits = max(1, (high - low).bit_length())
    limbs = (2 * bits - 2) // LIMB_BITS + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((limbs, width + 1, width + 1), np.int64)
        for batch in batches:
            values = _matrix(batch, width, low)
            add_products(sums, planes(np.hstack([values, np.ones((len(values), 1), np.int64)]), bits))
        if sums[0, width, width]:
            left, right = np.triu_indices(width + 1)
            for limb in range(limbs):
                columns = [left.astype("i4"), right.astype("i4"), np.full(len(left), limb, "i4"), sums[limb, left, right]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "limb", "value"])

    parts = rows.select("vector").mapInArrow(count, "i int, j int, limb int, value bigint")
    # One row for each pair of dimensions and limb.
    found = parts.groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect()
    whole = [[0] * (width + 1) for _ in range(width + 1)]
    for i, j, limb, value in found:
        whole[i][j] += value << (LIMB_BITS * limb)
    for i in range(width + 1):
        for j in range(i):
            whole[i][j] = whole[j][i]
    products = [row[:width] for row in whole[:width]]
    return Scatter(whole[width][width], low, whole[width][:width], products)


def decompose(sums: Scatter, components: int = COMPONENTS) -> Whitening:
    """The leading components of the covariance, each scaled to variance 1.

    Directions without variance (beyond the rank of the covariance) have no component.
    """
    centred, square = sums.centred(), sums.n**2
    trace = sum(centred[i][i] for i in range(len(centred)))
    # Integers are divided as such: each entry is the covariance rounded once.
    covariance = np.array([[value / square for value in row] for row in centred])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    least = values[0] * len(values) * np.finfo(np.float64).eps
    kept = min(components, int((values > max(least, 0.0)).sum())) if trace else 0
    weights = vectors[:, :kept] / np.sqrt(values[:kept])
    # Whitened vectors are weights' linear map of the vectors, so their covariance follows from that of the vectors.
    wide = weights.astype(np.longdouble)
    identity = wide.T @ covariance.astype(np.longdouble) @ wide - np.eye(kept)
    explained = [float(value) * square / trace for value in values[:kept]]
    return Whitening(sums, weights, explained, float(np.abs(identity).max(initial=0.0)))


def _deviations(values: np.ndarray, sums: Scatter) -> tuple[np.ndarray, list[int]]:
    """n * value - sum of each entry as doubles, and the exact sum of their squares for each row."""
    reach = sums.n * max(1, int(values.max(initial=0))) + max(sums.sums, default=0)
    if reach**2 * values.shape[1] < 2**62:
        exact = values * sums.n - np.array(sums.sums)
        return exact.astype(np.float64), (exact * exact).sum(axis=1).tolist()
    exact = values.astype(object) * sums.n - np.array(sums.sums, dtype=object)
    return exact.astype(np.float64), (exact * exact).sum(axis=1).tolist()


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> tuple[DataFrame, Whitening | None]:
    """vec_id, deviation (decimal) and whitened (an array of up to ``components``) of each usable vector, and the fit.

    Vectors that are null, empty, of another than the table's most frequent length, or hold a null, NaN or
    infinite entry are left out of the fit and of the rows. Repeated rows and ids count and are returned each; a
    null id stays null; other columns are ignored; a vector may be of any length. Without usable rows the result
    is empty and there is no fit; where vectors have no variance, ``whitened`` is empty. A deviation beyond
    38 digits, and an entry beyond 2^55, fail.
    """
    rows, width = usable(vectors, column)
    sums = scatter(rows, width) if width else None
    schema = "vec_id bigint, deviation decimal(38,0), whitened array<double>"
    if sums is None:
        return vectors.sparkSession.createDataFrame([], schema), None
    fit = decompose(sums, components)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            from_mean, squares = _deviations(_matrix(batch, width, sums.low), sums)
            found = from_mean / sums.n @ fit.weights
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(found) + 1, dtype="i4") * found.shape[1]), pa.array(found.reshape(-1))
            )
            squares = pa.array([Decimal(square) for square in squares], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), squares, lists], ["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(project, schema), fit


def whitened_components(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component; see ``whiten``.

    A deviation that is no 64-bit integer fails, as a wrong one would go unseen.
    """
    rows, fit = whiten(vectors, components)
    explained = F.array(*[F.lit(share) for share in fit.explained]) if fit and fit.explained else F.array().cast("array<double>")
    return (
        rows.select("vec_id", F.col("deviation").cast("bigint").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).cast("int").alias("component"),
            F.lit(fit.scatter.n if fit else 0).cast("bigint").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("at")).alias("explained"),
            F.lit(fit.identity_error if fit else 0.0).alias("identity_error"),
        )
    )
