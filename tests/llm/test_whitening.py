"""Whitening: eigenvectors against a direct solver, rows against numpy, odd inputs."""

import math

import numpy as np
import pytest

from conftest import SF_SMALL
from emberline.llm import queries as q
from emberline.llm import whitening as W


def planted(values, seed=1):
    """A symmetric matrix with the given eigenvalues."""
    x, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return (x * np.array(values)) @ x.T


@pytest.mark.parametrize("values", [
    [9.0, 4.0, 1.0, 0.25], [1e8, 1.0, 1e-4, 1e-9], [3.0, 3.0, 3.0, 1.0], [2.0, 2.0 + 1e-9, 2.0 - 3e-9, 1.0, 0.5],
    [1.0 + 1e-6 * i for i in range(12)], [5.0] * 6, [0.0, 0.0, 1.0]])
def test_eigenvectors_reach_double_precision(values):
    a = planted(values)
    a = (a + a.T) / 2
    e, x = W.eigenvectors(a)
    top = max(values)
    assert np.all(np.diff(e) <= 1e-13 * top)
    assert np.abs(e - np.sort(values)[::-1]).max() <= 1e-13 * top
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ x - x * e).max() <= 1e-13 * top


def test_one_float32_solve_would_not_do():
    a = planted([9.0, 4.0, 1.0, 0.25])
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    exact = W.refine(a, rough.copy())
    off = lambda x: np.abs(np.triu(x.T @ a @ x, 1)).max()
    assert off(exact) < 1e-14 < 1e-9 < off(rough)


def brute(vectors, components=8):
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [sum((n * r[j] - s[j]) ** 2 for j in range(d)) for r in x]
    z = np.array([[r[j] - s[j] / n for j in range(d)] for r in x])
    e, v = np.linalg.eigh(z.T @ z / n)
    e, v = e[::-1], v[:, ::-1]
    return n, dev, z @ v[:, :components] / np.sqrt(e[:components]), e[:components] / e.sum()


def test_query_matches_numpy(spark):
    got = q.queries()["op13_whitening"](spark, SF_SMALL).toPandas()
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    n, dev, white, explained = brute([r.embedding for r in rows])
    assert len(got) == len(rows) * 8 and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    by_id = {r.vec_id: i for i, r in enumerate(rows)}
    at = got.vec_id.map(by_id).to_numpy()
    assert got.deviation.tolist() == [dev[i] for i in at]
    want = white[at, got.component.to_numpy() - 1]
    for c in range(1, 9):
        own = (got.component == c).to_numpy()
        sign = np.sign((got.whitened[own] * want[own]).sum())
        assert np.abs(got.whitened[own] - sign * want[own]).max() < 1e-8
        assert np.abs(got.explained[own] - explained[c - 1]).max() < 1e-9


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.0], "x"), (2, [2.0, 1.0, 0.0], "y"), (2, [2.0, 1.0, 0.0], "y"), (None, [0.5, -1.0, 0.0], None),
            (4, None, "z"), (5, [1.0, None, 0.0], "z"), (6, [nan, 1.0, 0.0], "z"), (7, [inf, 1.0, 0.0], "z"), (8, [1.0, 2.0], "z"),
            (9, [-inf, 1.0, 0.0], "z"), (10, [], "z")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string")
    got = W.whiten(df).collect()
    # the third dimension and one direction have no variance to divide by beyond two components
    assert sorted({r.component for r in got}) == [1, 2]
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got if r.component == 1) == [(False, 1), (False, 2), (False, 2), (True, 0)]
    assert {r.n for r in got} == {4}
    assert got[0].identity_error < 1e-12
    assert W.whiten(df.where("vec_id = 1")).count() == 0
    assert W.whiten(df.where("vec_id > 99")).count() == 0
    assert W.whiten(df.where("vec_id = 10")).count() == 0


def test_wide_values(spark):
    big = 2.0 ** 38
    df = spark.createDataFrame([(i, [big * i, float(i % 3)]) for i in range(8)], "vec_id long, embedding array<double>")
    got = W.whiten(df).collect()
    n, dev, _, _ = brute([[big * i, float(i % 3)] for i in range(8)])
    at = {r.vec_id: r.deviation for r in got}
    assert [at[i] for i in range(8)] == [d if d < 2 ** 63 else None for d in dev]
    worst = spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="2\\^52"):
        W.whiten(worst).count()


def test_partitioning_does_not_matter(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    a, b = ({(r.vec_id, r.component): abs(r.whitened) for r in W.whiten(df.repartition(k)).collect()} for k in (1, 7))
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-8
