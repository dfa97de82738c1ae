from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from merchlake.llm import whitening
from merchlake.llm.whitening import Scatter, add_products, decompose, planes, scatter, usable, whiten, whitened_components

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_sums(vectors):
    """Sums and products of floor(64 * c) as Python integers."""
    rows = [[int(np.floor(64 * float(c))) for c in vector] for vector in vectors]
    width = len(rows[0])
    sums = [sum(row[i] for row in rows) for i in range(width)]
    return rows, sums, [[sum(row[i] * row[j] for row in rows) for j in range(width)] for i in range(width)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(1, 5), st.integers(1, 45), st.integers(0, 2**30))
def test_bit_planes_give_exact_products(rows, width, bits, seed):
    values = np.random.default_rng(seed).integers(0, 1 << bits, (rows, width))
    limbs = np.zeros(((2 * bits - 2) // whitening.LIMB_BITS + 1, width, width), np.int64)
    add_products(limbs, planes(values, bits))
    found = sum(limb.astype(object) << (whitening.LIMB_BITS * n) for n, limb in enumerate(limbs))
    wide = values.astype(object)
    assert (found == wide.T @ wide).all()


def test_tiles_change_nothing(monkeypatch):
    values = np.random.default_rng(1).integers(0, 1 << 9, (300, 17))
    found = []
    for tile in (1, 50, 1 << 20):
        monkeypatch.setattr(whitening, "TILE_WORDS", tile)
        limbs = np.zeros((2, 17, 17), np.int64)
        add_products(limbs, planes(values, 9))
        found.append(limbs)
    assert (found[0] == found[1]).all() and (found[0] == found[2]).all()


def test_a_huge_offset_costs_no_precision():
    rng = np.random.default_rng(2)
    near = rng.integers(0, 50, (400, 6))
    for offset in (0, 10**17):
        rows = near.astype(object) + offset
        fit = decompose(Scatter(400, 0, list(rows.sum(axis=0)), (rows.T @ rows).tolist()))
        exact = np.cov(near.T, bias=True)
        assert np.allclose(sorted(fit.explained), sorted(np.linalg.eigvalsh(exact) / np.trace(exact)), rtol=1e-12)


def test_the_whole_table_against_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = whitened_components(table).toPandas()
    raw = pq.read_table(f"{SMALL}/embeddings.parquet").to_pydict()
    good = [(i, v) for i, v in zip(raw["vec_id"], raw["embedding"]) if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    ints, sums, products = brute_sums([v for _, v in good])
    n = len(good)
    assert set(rows["n"]) == {n} and sorted(set(rows["component"])) == list(range(1, 33))
    assert len(rows) == 32 * n
    deviation = {i: sum((n * x - s) ** 2 for x, s in zip(row, sums)) for (i, _), row in zip(good, ints)}
    assert all(deviation[i] == d for i, d in zip(rows["vec_id"], rows["deviation"]))
    exact = np.array([[float(Fraction(n * p - sums[i] * sums[j], n * n)) for j, p in enumerate(row)] for i, row in enumerate(products)])
    values, vectors = np.linalg.eigh(exact)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    table = rows.pivot_table(index="vec_id", columns="component", values="whitened").to_numpy()
    by_id = np.array([row for _, row in sorted(zip([i for i, _ in good], ints))], float)
    expected = (by_id - np.array(sums) / n) @ vectors / np.sqrt(values)
    signs = np.sign((table * expected).sum(axis=0))
    assert np.abs(table * signs - expected).max() < 1e-8
    assert np.abs(table.T @ table / n - np.eye(32)).max() < 1e-9
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"][0] < 1e-9
    shares = rows.groupby("component")["explained"].agg(["min", "max"])
    assert (shares["min"] == shares["max"]).all()
    assert np.allclose(shares["min"], values / np.trace(exact), rtol=1e-12)


def test_unusable_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, [1.5, -1.0]), (2, [1.5, -1.0]), (None, [0.25, 3.0]), (4, None), (5, []), (6, [1.0]), (7, [nan, 1.0])]
    rows += [(8, [1.0, inf]), (9, [-inf, 1.0]), (10, [None, 1.0])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 AS n", "2 AS vector", "3 AS deviation")
    found, fit = whiten(frame)
    assert sorted((r.vec_id or 0, r.deviation) for r in found.collect()) == sorted(
        (i or 0, sum((4 * x - s) ** 2 for x, s in zip(v, (240, 128)))) for i, v in ((1, (32, 64)), (2, (96, -64)), (2, (96, -64)), (None, (16, 192)))
    )
    assert fit.scatter.n == 4
    out = whitened_components(frame).collect()
    assert len(out) == 8 and {r.component for r in out} == {1, 2}


@pytest.mark.parametrize("vectors", [[], [None, []], [[float("nan")]]])
def test_tables_without_usable_vectors(spark, vectors):
    frame = spark.createDataFrame([(n, v, 0) for n, v in enumerate(vectors)], SCHEMA)
    assert whitened_components(frame).collect() == []


def test_vectors_without_variance_have_no_components(spark):
    frame = spark.createDataFrame([(n, [1.0, 2.0, 3.0], 0) for n in range(5)], SCHEMA)
    assert whitened_components(frame).collect() == []
    assert [r.deviation for r in whiten(frame)[0].collect()] == [0] * 5
    flat = spark.createDataFrame([(n, [1.0, float(n), float(-n)], 0) for n in range(5)], SCHEMA)
    assert {r.component for r in whitened_components(flat).collect()} == {1}  # the rank is one


def test_deviations_beyond_doubles_are_exact(spark):
    rng = np.random.default_rng(4)
    vectors = [[float(c) for c in rng.integers(-(2**33), 2**33, 3)] for _ in range(20)]
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    ints, sums, products = brute_sums(vectors)
    found, fit = whiten(frame)
    for row in found.collect():
        assert int(row.deviation) == sum((20 * x - s) ** 2 for x, s in zip(ints[row.vec_id], sums))
    low = fit.scatter.low
    assert fit.scatter.sums == [s - 20 * low for s in sums]
    assert fit.scatter.products[0][1] == products[0][1] - low * (sums[0] + sums[1]) + 20 * low * low


def test_sums_don_t_depend_on_partitions(spark):
    rng = np.random.default_rng(5)
    frame = spark.createDataFrame([(n, rng.normal(size=9).tolist()) for n in range(700)], "vec_id bigint, embedding array<double>")
    found = [scatter(*usable(frame.repartition(parts))) for parts in (1, 13)]
    assert found[0] == found[1]


def test_entries_beyond_integers_fail(spark):
    frame = spark.createDataFrame([(1, [1e30, 1.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(ValueError, match="64-bit"):
        whiten(frame)
