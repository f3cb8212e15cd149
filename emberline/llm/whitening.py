"""Whitening of embeddings by mixed-precision eigenvectors of their covariance.

The covariance is summed over the rows on Spark, after centring.  Its
eigenvectors are first found in float32 and then corrected in float64 by
Ogita-Aishima iterations, which are matrix products only: each takes the
error of a well separated eigenvector to about its square.  Eigenvalues closer
than the present error cannot be told apart by that formula; such a cluster is
solved on its own, in the small space that its vectors span.

Every row is then projected on the leading components.  Per-dimension sums are
exact integers; what reaches the driver is width and width squared numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

LOW_BITS = 26  # of the integers whose high and low parts are summed apart
LARGEST = 2.0 ** 52  # entries at or beyond it, scaled, are no exact integers
LONG = 2 ** 63


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def remaining(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) rows that take part: usable vectors of the commonest length (ties: the longer)."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(usable(F.col("v")))
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).take(1)
    return rows.where(F.size("v") == (width[0].w if width else 0))


def integers(vectors: pa.Array, scale: float, shift: int) -> np.ndarray:
    """floor(scale * c) + shift of every entry, a row for each vector."""
    v = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False)).reshape(len(vectors), -1)
    if v.size and np.abs(v).max() >= LARGEST:
        raise ValueError("a scaled entry is beyond 2^52 and has no exact integer here")
    return v.astype(np.int64) + shift


def sums(rows: DataFrame, scale: float, shift: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension."""
    def run(batches):
        n, low, high = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column(0), scale, shift)
                n += len(x)
                low = low + (x & (2 ** LOW_BITS - 1)).sum(axis=0)
                high = high + (x >> LOW_BITS).sum(axis=0)
        if n:
            d = len(low)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                                              pa.array(low), pa.array(high)], names=["i", "n", "low", "high"])

    total = rows.select("v").mapInArrow(run, "i int, n long, low long, high long").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high")).orderBy("i").collect()
    return (total[0].n, [(r.high << LOW_BITS) + r.low for r in total]) if total else (0, [])


class Centre:
    """The mean S / n, held as whole part and rest so that centring loses nothing."""

    def __init__(self, n: int, s: list[int]):
        self.n = n
        self.whole = np.array([a // n for a in s], np.int64)
        self.over = [a % n for a in s]
        self.rest = np.array([a / n for a in self.over])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest

    def deviation(self, x: np.ndarray) -> list:
        """Sum of (n * x - S)^2 of each row, exact; None where it does not fit a long."""
        y = x - self.whole
        top = int(np.abs(y).max(initial=0) + 1) * self.n
        kind = np.int64 if top * top * max(1, y.shape[1]) < LONG else object
        z = y.astype(kind) * self.n - np.array(self.over, kind)
        return [int(t) if t < LONG else None for t in (z * z).sum(axis=1)]


def products(rows: DataFrame, make, d: int) -> np.ndarray:
    """Sum of z z^T over the rows z that ``make`` gives for a batch."""
    i, j = np.triu_indices(d)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                z = make(batch)
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         names=["i", "j", "t"])

    out = np.zeros((d, d))
    for r in rows.mapInArrow(run, "i int, j int, t double").groupBy("i", "j").agg(F.sum("t").alias("t")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.t
    return out


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Indices of ``values`` in runs whose neighbours lie at most ``gap`` apart."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return np.split(order, cuts)


def refine(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Eigenvectors of the symmetric ``a`` from the rough ones in the columns of ``x``.

    Steps are made while the correction still halves; the last ones are at the
    rounding of float64.
    """
    eye, norm, last = np.eye(len(a)), np.linalg.norm(a, 2), np.inf
    while True:
        r, s = eye - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        error = 2 * (np.linalg.norm(s - np.diag(values), 2) + norm * np.linalg.norm(r, 2))
        groups = clusters(values, error)
        for own in (g for g in groups if len(g) > 1):
            q, _ = np.linalg.qr(x[:, own])
            middle = values[own].mean()
            t = q.T @ (a @ q - middle * q)  # shifted, so that close values keep their digits
            x[:, own] = q @ np.linalg.eigh((t + t.T) / 2)[1]
        r, s = eye - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        group = np.empty(len(a), int)
        for k, own in enumerate(groups):
            group[own] = k
        apart = values[None, :] - values[:, None]
        same = (group[None, :] == group[:, None]) | (apart == 0)
        e = np.where(same, r / 2, (s + values[None, :] * r) / np.where(same, 1.0, apart))
        size = np.linalg.norm(e, 2)
        if not size < last / 2:
            return x
        x, last = x + x @ e, size


def eigenvectors(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    scale = np.abs(a).max(initial=0) or 1.0  # float32 holds no very large or small numbers
    _, rough = np.linalg.eigh((a / scale).astype(np.float32))
    x = refine(a / scale, rough.astype(np.float64))
    x = x / np.linalg.norm(x, axis=0)
    values = scale * np.einsum("ij,ij->j", x, (a / scale) @ x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def whiten(df: DataFrame, components: int = 8, scale: float = 1024, shift: int = 100000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every
    remaining row and each of its first ``components`` components, numbered from 1.

    Rows whose vector is NULL or holds NULL or non-finite entries are dropped, and so
    are vectors of another length than the commonest one.  Scaled entries beyond
    2^52 raise an error.  Repeated rows count and come back each; a NULL id stays
    NULL.  Components without variance (all rows equal along them) are not
    returned, so one row alone, or an empty table, gives an empty result.
    ``deviation`` is NULL where it does not fit a long.  Other columns are not read.
    """
    small_batches(df.sparkSession)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    rows = remaining(df, id_col, vector_col)
    n, s = sums(rows, scale, shift)
    d = len(s)
    if not d:
        return df.sparkSession.createDataFrame([], schema)
    centre = Centre(n, s)
    cov = products(rows.select("v"), lambda b: centre.centred(integers(b.column(0), scale, shift)), d) / n
    values, vectors = eigenvectors(cov)
    trace = float(np.trace(cov))
    k = int((values[:components] > d * np.finfo(float).eps * trace).sum())
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    onto = vectors[:, :k] / np.sqrt(values[:k])
    explained = values[:k] / trace

    def project(x):
        return centre.centred(x) @ onto

    # the whitened rows are centred already
    found = products(rows.select("v"), lambda b: project(integers(b.column(0), scale, shift)), k) / n
    off = float(np.abs(found - np.eye(k)).max())

    def run(batches):
        for batch in batches:
            x = integers(batch.column(1), scale, shift)
            m = len(x)
            if m:
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(np.arange(m), k)).cast(pa.int64()), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, n), pa.int64()), pa.array([t for t in centre.deviation(x) for _ in range(k)], pa.int64()),
                    pa.array(project(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, off))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                ).set_column(0, "vec_id", batch.column(0).take(pa.array(np.repeat(np.arange(m), k))))

    return rows.mapInArrow(run, schema)
