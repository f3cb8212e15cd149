"""Moments of numeric columns and level counts of categorical ones in one scan.

Each task folds its rows into one state: count, mean and sum of squared
deviations of every numeric column, merged batch by batch, and a count for
every level it meets, handed on whenever ``HELD_LEVELS`` have gathered.  The
states are stored as rows and merged by Spark; levels are never gathered.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .model import number

HELD_LEVELS = 100_000


def _merged(a: tuple, b: tuple) -> tuple:
    """Count, mean and squared deviations of two sets of rows together."""
    n = a[0] + b[0]
    if not n:
        return a
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + d * d * (a[0] * b[0] / n)


@dataclass
class TableStats:
    """``state``: (feature, level, n, mean, m2); level is NULL in the rows of numeric columns."""

    state: DataFrame
    numeric: list[str]
    categorical: list[str]

    def moments(self) -> DataFrame:
        """``(feature, mean, std)``: NULL mean without values, NULL std (sample) below two."""
        own = self.state.where(F.col("level").isNull())
        mean = own.groupBy("feature").agg((F.sum(F.col("n") * F.col("mean")) / F.nullif(F.sum("n"), F.lit(0))).alias("mean"))
        # the second pass is over the states: one row for each task and column
        off = own.withColumnRenamed("mean", "own").join(F.broadcast(mean), "feature").groupBy("feature", "mean").agg(
            F.sum("n").alias("n"), F.sum(F.col("m2") + F.col("n") * F.pow(F.col("own") - F.col("mean"), 2)).alias("m2"))
        return off.select("feature", "mean", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"))

    def levels(self) -> DataFrame:
        """``(feature, level, n)``."""
        return self.state.where(F.col("level").isNotNull()).groupBy("feature", "level").agg(F.sum("n").alias("n"))

    def means_and_stds(self) -> tuple[list[float], list[float]]:
        """As a scorer uses them: mean 0 without values, deviation 1 where there is none."""
        row = {r.feature: r for r in self.moments().collect()} if self.numeric else {}
        return ([float(row[c].mean or 0.0) if c in row else 0.0 for c in self.numeric],
                [float(row[c].std) if c in row and row[c].std and row[c].std > 0 else 1.0 for c in self.numeric])


def statistics(df: DataFrame, numeric: list[str], categorical: list[str]) -> TableStats:
    """One scan of ``df``.  NULL and NaN do not count in moments, NULL is no level."""
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        moments = [(0, 0.0, 0.0)] * len(numeric)
        counts: Counter = Counter()

        def rows(features, levels, n, mean, m2):
            return pa.RecordBatch.from_arrays([pa.array(features, pa.string()), pa.array(levels, pa.string()), pa.array(n, pa.int64()),
                                               pa.array(mean, pa.float64()), pa.array(m2, pa.float64())],
                                              names=["feature", "level", "n", "mean", "m2"])

        def flushed():
            keys = list(counts)
            out = rows([k[0] for k in keys], [k[1] for k in keys], [counts[k] for k in keys], [None] * len(keys), [None] * len(keys))
            counts.clear()
            return out

        for batch in batches:
            for i in range(len(numeric)):
                x = batch.column(i).drop_null().to_numpy()
                if len(x):
                    mean = float(x.mean())
                    moments[i] = _merged(moments[i], (len(x), mean, float(np.square(x - mean).sum())))
            for i, c in enumerate(categorical, len(numeric)):
                found = pc.value_counts(batch.column(i).drop_null())
                for level, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                    counts[c, level] += n
            if len(counts) >= HELD_LEVELS:
                yield flushed()
        yield flushed()
        yield rows(numeric, [None] * len(numeric), *zip(*moments)) if numeric else rows([], [], [], [], [])

    # unnamed aliases, so that a column may be read twice or have any name
    columns = [number(c).alias(f"_x{i}") for i, c in enumerate(numeric)]
    columns += [F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(categorical)]
    state = df.select(*columns).mapInArrow(run, "feature string, level string, n long, mean double, m2 double")
    return TableStats(stored(state, "statistics"), list(numeric), list(categorical))
