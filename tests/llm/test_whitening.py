"""Operator 11 against NumPy and exact integers."""

import random

import numpy as np
import pytest
from llm_fixtures import SF, result
from pyspark.sql import functions as F

from farelens.llm import whitening


@pytest.mark.parametrize("rows, low, high", [(1, -5, 5), (63, 0, 2), (130, -500, 500), (300, 99_000, 101_000), (70, -2**61, 2**61)])
def test_cross_products_are_exact(rows, low, high):
    x = np.random.default_rng(rows).integers(low, high, (rows, 5))
    x[:, 2] = x[0, 2]  # a dimension without a bit plane
    sums, products = whitening.cross_products(x)
    y = x.astype(object)
    assert (sums == y.sum(axis=0)).all() and (products == y.T @ y).all()


def test_limbs_of_any_size_and_sign():
    rng = random.Random(4)
    for bits in range(1, 150):
        v = rng.getrandbits(bits) * rng.choice((-1, 1))
        assert sum(limb << (whitening.LIMB * k) for k, limb in enumerate(whitening._limbs(v))) == v


def test_whitening_query(spark):
    rows = sorted(result(spark, "op11_embedding_whitening"), key=lambda r: (r.vec_id, r.component))
    held = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([np.floor(1024 * np.array(r.embedding, "f8")) + 100_000 for r in held]).astype("i8")
    n = len(x)
    assert [r.vec_id for r in rows[::8]] == [r.vec_id for r in held] and [r.component for r in rows[:8]] == list(range(1, 9)) and rows[0].n == n
    exact = x.astype(object)
    deviation = ((n * exact - exact.sum(axis=0)) ** 2).sum(axis=1)
    assert [r.deviation for r in rows[::8]] == list(deviation)
    centred = x - x.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    mine = np.array([r.whitened for r in rows]).reshape(n, 8)
    theirs = centred @ vectors / np.sqrt(values)
    assert np.allclose(np.abs(mine), np.abs(theirs), atol=1e-8)
    assert np.allclose([r.explained for r in rows[:8]], values / np.trace(covariance), rtol=1e-9)
    assert np.abs(mine.T @ mine / n - np.eye(8)).max() < 1e-9 and max(r.identity_error for r in rows) < 1e-9


def test_whitening_edges(spark):
    rng = random.Random(1)
    good = [(k, [rng.gauss(0, 1) for _ in range(3)]) for k in range(40)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [1.0, 2.0])]
    rows = good + bad + [good[0], (None, good[1][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    clashing = df.withColumns({c: F.lit("x") for c in ("n", "whitened", "component", "i", "l0", "fl_at", "fl_value", "fl_size", "label")})
    out = whitening.whiten(clashing).collect()
    assert len(out) == 42 * 3 and all(r.n == "x" and r.n_ == 42 and r.whitened == "x" for r in out)
    assert sorted({r.vec_id for r in out if r.vec_id is not None}) == list(range(40)) and sum(r.vec_id is None for r in out) == 3
    assert max(r.identity_error for r in out) < 1e-9 and abs(sum({r.component_: r.explained for r in out}.values()) - 1) < 1e-9
    # A constant and a doubled dimension leave one component less each.
    flat = [(k, [v[0], 7.0, v[0], v[1]]) for k, v in good]
    assert {r.component for r in whitening.whiten(spark.createDataFrame(flat, "vec_id long, embedding array<double>")).collect()} == {1, 2}
    for none in ([], [(1, [0.5, 0.5])], [(1, [0.5, 2.0]), (2, [0.5, 2.0])], [(1, None)], [(1, [])]):
        empty = whitening.whiten(spark.createDataFrame(none, "vec_id long, embedding array<float>"))
        assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    huge = [(k, [1e300 * (-1) ** k, float(k)]) for k in range(5)]
    out = whitening.whiten(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()
    assert [(r.component, r.deviation) for r in out] == [(1, None)] * 5  # the other dimension is nothing beside it
