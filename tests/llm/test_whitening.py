"""Operator 12 against whole-number arithmetic in plain Python and numpy's eigenvectors."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """vec_id -> deviation, and the covariance, by the contract."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = {k: [math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for k, (i, v) in enumerate(kept)}
    n, width = len(kept), max((len(v) for _, v in kept), default=0)
    x = {k: v + [100000] * (width - len(v)) for k, v in x.items()}
    sums = [sum(v[j] for v in x.values()) for j in range(width)]
    deviations = [(kept[k][0], sum((n * a - s) ** 2 for a, s in zip(v, sums))) for k, v in x.items()]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x.values()]).reshape(n, width)
    return n, deviations, centred, centred.T @ centred / max(n, 1)


def check(out, rows, components=8):
    n, deviations, centred, covariance = brute(rows)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, len(values))
    assert len(out) == n * k and {r["n"] for r in out} == ({n} if n * k else set())
    if k:
        assert sorted({(r["vec_id"] is None, r["vec_id"], r["deviation"]) for r in out}, key=str) == sorted({(i is None, i, d) for i, d in deviations}, key=str)
    for r in out:
        assert r["explained"] == (pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9, abs=1e-12) if values.sum() > 0 else None)
    return values, centred @ vectors[:, :k] / np.sqrt(np.maximum(values[:k], 1e-300))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    mixed = rng.standard_normal((400, 12)) @ rng.standard_normal((12, 12)) * 0.1
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(mixed)]
    return rows + [(500, None), (501, [1.0, None] + [0.0] * 10), (502, [float("nan")] * 12), (503, [float("inf")] * 12), (0, rows[0][1]), (None, rows[1][1])]


def test_against_plain_arithmetic(spark, vectors):
    table = spark.createDataFrame(vectors, SCHEMA).repartition(5).withColumns({c: F.lit("x") for c in ("v", "n", "component", "whitened")})
    out = whitening.whiten(table, whitening.fit(table)).collect()
    _, white = check(out, vectors)
    ids = [i for i, v in vectors if v is not None and i not in (501, 502, 503)]
    found = {(r["vec_id"], r["component"]): r["whitened"] for r in out}
    for c in range(8):
        mine, theirs = np.array([found[i, c + 1] for i in ids]), white[:, c]
        assert np.allclose(mine, theirs, atol=1e-8) or np.allclose(mine, -theirs, atol=1e-8)
    assert max(r["identity_error"] for r in out) < 1e-9 and len({r["identity_error"] for r in out}) == 1


@pytest.mark.parametrize(("rows", "varies"), [
    ([(1, [0.5, 0.25])], 0),
    ([(1, [0.5, 0.25]), (2, [0.5, 0.25])], 0),
    ([(1, [0.5, 0.25]), (2, [0.75, 0.25]), (3, [0.25, 0.25])], 1),
    ([(1, [0.5, 0.25, 1.0]), (2, [0.75]), (3, []), (3, [-0.5, 2.0])], 3),
    ([(1, []), (2, [])], 0),
    ([(1, [1e30, -1e30]), (2, [3.0, -1e30]), (3, [0.0, 0.0])], 2),
    ([], 0),
])
def test_few_odd_and_no_rows(spark, rows, varies):
    table = spark.createDataFrame(rows, SCHEMA)
    out = whitening.whiten(table, whitening.fit(table)).collect()
    if not any(v and max(map(abs, v)) > 1e20 for _, v in rows):
        check(out, rows)
    assert {r["component"] for r in out if r["whitened"] is not None} == set(range(1, varies + 1))
    assert {r["identity_error"] is None for r in out} <= {not varies}


@pytest.mark.parametrize("size", [1, 2, 5, 40])
@pytest.mark.parametrize("kind", ["spread", "equal", "pairs", "one large", "falling", "zero"])
def test_divide_and_conquer(size, kind):
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.standard_normal((size, size)))[0]
    e = {"spread": rng.random(size) * 1e5, "equal": np.ones(size) * 3, "pairs": np.repeat(rng.random(size), 2)[:size],
         "one large": np.r_[1e9, rng.random(size - 1)], "falling": 10.0 ** -np.arange(size), "zero": np.zeros(size)}[kind]
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    values, vectors = whitening.leading(a, 8)
    k, norm = min(8, size), max(np.linalg.norm(a), 1e-300)
    assert vectors.shape == (size, k) and np.abs(values - np.sort(e)[::-1][:k]).max() <= 1e-14 * norm * size
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * norm and np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13


def test_deviations_beyond_a_long_are_null():
    model = whitening.Whitening(3, [300_000 + 3], np.zeros(0), np.zeros((1, 0)), 0.0)
    assert model.deviations(np.array([[2], [2**40]])) == [9, None]
    assert model.deviations(np.array([[2**29]])) == [(3 * 2**29 - 3) ** 2]
