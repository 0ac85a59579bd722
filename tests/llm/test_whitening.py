"""Singular values and whitening against numpy, on hand-made and given vectors."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from lotwise.llm import whitening
from lotwise.llm.bidiagonal import bidiagonalise, right_singular, singular_values_squared
from lotwise.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def solved(a, most=16):
    squares, v = right_singular(a, most)
    want = np.linalg.svd(a, compute_uv=False)[: len(squares)]
    top = max(want.max(initial=0.0), 1e-300)
    assert np.allclose(np.sqrt(np.maximum(squares, 0)), want, rtol=1e-9, atol=1e-13 * top)
    some = want > 1e-7 * top
    w = v[:, some]
    assert np.abs(w.T @ w - np.eye(w.shape[1])).max(initial=0) < 1e-9
    assert np.abs(a.T @ (a @ w) - w * squares[some]).max(initial=0) <= 1e-12 * top**2


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 20), st.integers(0, 10**6), st.integers(0, 8))
def test_directions_and_values_equal_numpy(n, seed, spread):
    rng = np.random.default_rng(seed)
    solved(np.linalg.qr(rng.standard_normal((40, n)) * 10.0 ** rng.uniform(-spread, spread, n) / 10.0**spread, "r"))


def test_clusters_blocks_and_missing_ranks():
    rng = np.random.default_rng(2)
    turn = lambda n: np.linalg.qr(rng.standard_normal((n, n)))[0]
    solved(np.eye(20))
    solved(np.zeros((5, 5)))
    solved(np.linalg.qr(turn(64), "r"))
    solved(turn(40) * np.r_[5, 5, 5, 4, 4 + 1e-9, 4 + 1e-13, np.linspace(3, 1, 34)] @ turn(40))
    solved(np.linalg.qr(rng.standard_normal((300, 5)) @ rng.standard_normal((5, 30)), "r"))
    middle = np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)
    solved(np.linalg.cholesky(middle + 15 * np.eye(21)).T, 21)


def test_small_singular_values_are_as_accurate_as_large_ones():
    diagonal, above = 10.0 ** -np.arange(0, 30, 2.0), 10.0 ** -np.arange(1, 29, 2.0)
    found = singular_values_squared(diagonal, above)
    # The product of all singular values is that of the diagonal: a relative check down to 1e-28.
    assert np.log(found).sum() == pytest.approx(2 * np.log(diagonal).sum(), rel=1e-14)
    a = np.random.default_rng(3).standard_normal((9, 9))
    d, e, v = bidiagonalise(a)
    b = np.diag(d) + np.diag(e, 1)
    assert np.allclose(v.T @ a.T @ a @ v, b.T @ b)


def plain(vectors):
    """The contract's result with exact integers and numpy's eigenvectors."""
    x = {i: tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v) for i, v in vectors.items()}
    fit = np.array(sorted(set(x.values())), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((fit * n - sums) / n).astype(float)
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:16]
    dev = {i: int(((np.array(v, dtype=object) * n - sums) ** 2).sum()) for i, v in x.items()}
    white = {i: ((np.array(v, dtype=object) * n - sums) / n).astype(float) @ directions[:, order] / np.sqrt(values[order]) for i, v in x.items()}
    return n, dev, white, values[order] / values.sum()


def compare(found, vectors, shown=16):
    n, dev, white, explained = plain(vectors)
    got = {}
    for r in found:
        assert r["n"] == n and r["deviation"] == dev[r["vec_id"]] and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        got.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    assert set(got) == set(vectors)
    table = np.array([[got[i][c] for c in range(1, shown + 1)] for i in sorted(got)])
    want = np.array([white[i][:shown] for i in sorted(got)])
    signs = np.sign((table * want).sum(axis=0))
    assert np.allclose(table, want * signs, atol=1e-7)


def test_whitening_equals_the_plain_version(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 20)) * np.linspace(3, 0.2, 20)
    vectors = {i: base[i % 120].tolist() if i % 5 else base[0].tolist() for i in range(260)}
    rows = [(i, v, 0) for i, v in vectors.items()]
    df = spark.createDataFrame(rows, SCHEMA)
    compare(whitening.whiten(df.repartition(7)).collect(), vectors)
    compare(whitening.whiten(df.coalesce(1)).collect(), vectors)


def test_many_triangles_reduce_to_the_same(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vectors = {i: v.tolist() for i, v in enumerate(rng.standard_normal((90, 6)) * np.arange(6, 0, -1))}
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors.items()], SCHEMA)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 3)
    compare(whitening.whiten(df.repartition(8)).collect(), vectors, 6)


def test_odd_rows(spark):
    good = {i: [float(i % 7), float(i * i % 11), -1.5 * i] for i in range(40)}
    rows = [(i, v, 0) for i, v in good.items()] + [
        (100, None, 0), (101, [], 0), (102, [1.0, None, 2.0], 0), (103, [float("nan"), 1.0, 1.0], 0),
        (104, [float("inf"), 1.0, 1.0], 0), (105, [1.0, 2.0], 0), (106, [3e38, 1.0, 1.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'a' AS x", "1 AS component", "2 AS n")
    compare(whitening.whiten(df).collect(), good, 3)
    twice = whitening.whiten(df.unionByName(df)).collect()
    assert len(twice) == 2 * 3 * len(good)
    none = whitening.whiten(df.limit(0))
    assert none.count() == 0 and none.schema == whitening.whiten(df).schema
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], SCHEMA)).count() == 0
    flat = spark.createDataFrame([(i, [float(i), 5.0, 2.0 * i], 0) for i in range(9)], SCHEMA)
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}


def test_given_embeddings(spark):
    folder = "/root/testdata/sf0.01"
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    compare(QUERIES["op12_whitening"](spark, folder).collect(), vectors)
