"""The linear model with any number of levels: coefficients in a table.

Levels are numbered in a table, rows get level numbers by joins, and the design
matrix is stored as blocks of rows: numeric inputs dense, and for categoricals
the block's own distinct level numbers with one place in them per row and
column.  The blocks are a table bucketed by block, so in a step they stay where
they are.  Each block is sent the weights of its own levels, answers
with gradients keyed by level number, and Spark sums and updates them by that
number; the driver holds the classes, the numeric weights and the intercepts.
A lost executor costs no more than the present step, as every step's weights
are stored.

Scoring joins each categorical with the coefficient table (``join_levels``); the
plan does not grow with it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

import numpy as np
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from .. import reference_values as RV
from ..session import default_parallelism, discard, scratch_path, shuffle_partitions, stored
from .model import LinearModel, logit_sql, number, probability_columns, standardised_sql
from .row_id import with_row_id
from .stats import TableStats, statistics

BLOCK_ROWS = 4096
PART_ROWS = 64 * BLOCK_ROWS   # a task's Python worker holds the blocks of its part
HELD_LEVELS = 4096            # levels whose entries every task may hold
GROUP_BYTES = 8 << 20         # of blocks in a Parquet row group, which a reader decodes whole


@dataclass
class TableModel:
    """``coefficients``: (feature, level, w), w holding a weight for each class in order."""

    classes: list[str]
    numeric: list[str]
    means: list[float]
    stds: list[float]
    categorical: list[str]
    weights: list[list[float]]     # numeric ones, a row for each class
    intercepts: list[float]
    coefficients: DataFrame
    name: str = RV.DEFAULT_MODEL_NAME
    model_type: str = RV.MODEL_TYPE
    label: str = RV.LABEL_COLUMN
    history: list[float] = field(default_factory=list)
    created: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    def coefficient_table(self) -> DataFrame:
        """``(class, feature, weight)`` like ``LinearModel.coefficient_rows``, as a table."""
        spark = self.coefficients.sparkSession
        small = [(c, f, float(w)) for c, b, own in zip(self.classes, self.intercepts, self.weights)
                 for f, w in zip(["(intercept)", *self.numeric], [b, *own])]
        long = self.coefficients.select(F.concat_ws("=", "feature", "level").alias("feature"), F.posexplode("w").alias("k", "weight")).select(
            F.get(F.array(*[F.lit(c) for c in self.classes]), F.col("k")).alias("class"), "feature", "weight")
        return spark.createDataFrame(small, "class string, feature string, weight double").unionByName(long)


def as_table_model(spark: SparkSession, model: LinearModel) -> TableModel:
    """The same model with its coefficients in a table."""
    m = len(model.pre.numeric)
    rows, at = [], m
    for c in model.pre.categorical:
        for v in model.pre.vocab[c]:
            rows.append((c, v, [float(w[at]) for w in model.weights]))
            at += 1
    return TableModel(list(model.classes), list(model.pre.numeric), list(model.pre.means), list(model.pre.stds),
                      list(model.pre.categorical), [list(w[:m]) for w in model.weights], list(model.intercepts),
                      spark.createDataFrame(rows, "feature string, level string, w array<double>"),
                      model.name, model.model_type, model.label, list(model.history), model.created)


def predict_table(model: TableModel, df: DataFrame, label_col: str | None = None, probs_col: str | None = None,
                  prob_columns: bool = False) -> DataFrame:
    """Like ``model.predict``: each categorical is joined with its coefficients; a level that
    has none, or NULL, adds nothing."""
    joined = join_levels(df, model.coefficients, "w", [F.col(f"`{c}`").cast("string") for c in model.categorical],
                         model.categorical, "__w")
    logits = [logit_sql(k, model.intercepts[k], model.weights[k], range(len(model.categorical))) for k in range(len(model.classes))]
    return probability_columns(joined, df.columns, model.classes, standardised_sql(model.numeric, model.means, model.stds), logits, label_col or f"predicted_{model.label}",
                               probs_col or f"predicted_{model.label}_probs", prob_columns)


def join_levels(df: DataFrame, table: DataFrame, value: str, keys: list, features: list[str], name: str) -> DataFrame:
    """``df`` with ``<name>0``, ...: for each key the ``value`` of its level in ``table`` (feature,
    level, value), NULL if it has none.

    Up to ``HELD_LEVELS`` levels of a feature are broadcast, and no row moves.  Beyond, those that
    most rows have are broadcast; rows of the others, no level of which has more than one row in
    ``HELD_LEVELS``, are joined by level, and all further rows are spread evenly.
    """
    sizes = {r.feature: r.n for r in table.where(F.col("feature").isin(list(features))).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n")).collect()}     # one row for each feature
    out = df
    for i, (key, feature) in enumerate(zip(keys, features)):
        own = table.where(F.col("feature") == F.lit(feature)).select(F.col("level").alias(f"{name}_v"), F.col(value).alias(f"{name}{i}"))
        if sizes.get(feature, 0) <= HELD_LEVELS:
            out = out.join(F.broadcast(own), key == F.col(f"{name}_v"), "left").drop(f"{name}_v")
        elif df.isStreaming:
            out = out.join(own, key == F.col(f"{name}_v"), "left").drop(f"{name}_v")
        else:
            counts = df.where(key.isNotNull()).groupBy(key.alias(f"{name}_k")).agg(F.count(F.lit(1)).alias(f"{name}_n"))
            often = counts.orderBy(F.desc(f"{name}_n"), f"{name}_k").limit(HELD_LEVELS)
            held = own.join(F.broadcast(often), F.col(f"{name}_v") == F.col(f"{name}_k")).select(
                F.col(f"{name}_k"), F.col(f"{name}{i}").alias(f"{name}_h"))
            hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (MapType, VariantType))]
            settled = key.isNull() | F.col(f"{name}_k").isNotNull()
            out = out.join(F.broadcast(held), key == F.col(f"{name}_k"), "left").withColumn(
                f"{name}_s", F.when(settled, F.pmod(F.xxhash64(*hashed), F.lit(1 << 20))).otherwise(F.lit(-1).cast("long")))
            out = out.join(own.withColumn(f"{name}_t", F.lit(-1).cast("long")),
                           (key == F.col(f"{name}_v")) & (F.col(f"{name}_s") == F.col(f"{name}_t")), "left")
            out = out.withColumn(f"{name}{i}", F.coalesce(f"{name}{i}", f"{name}_h")).drop(
                *[f"{name}_{x}" for x in "vkhst"])
    return out


def level_numbers(stats: TableStats) -> DataFrame:
    """``(feature, level, idx)``: a dense number for every level of every categorical."""
    levels = stats.levels().where(F.col("feature").isin(stats.categorical)).select("feature", "level")
    return with_row_id(levels, ["feature", "level"], name="_n").select("feature", "level", (F.col("_n") - 1).alias("idx"))


def sparse_blocks(df: DataFrame, cfg, numbers: DataFrame, means: list[float], stds: list[float], weights: dict[str, float]) -> DataFrame:
    """``(block, n, x, at, y, w, ids)``: ``ids`` are the block's distinct level numbers, ``at``
    the place of each row's levels in them (-1: none)."""
    import pyarrow as pa

    classes = sorted(weights)
    y = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(cfg.label).cast("string")).cast("int") - 1
    x = [F.coalesce((number(c) - F.lit(mu)) / F.lit(sd), F.lit(0.0)) for c, mu, sd in zip(cfg.numeric, means, stds)]
    rows = df.where(F.col(cfg.label).isNotNull()).select(
        F.array(*x).cast("array<double>").alias("x"), y.alias("y"),
        *[F.col(c).cast("string").alias(f"_c{i}") for i, c in enumerate(cfg.categorical)])
    rows = join_levels(rows, numbers, "idx", [F.col(f"_c{i}") for i in range(len(cfg.categorical))], cfg.categorical, "_i")
    rows = rows.select("x", F.array(*[F.coalesce(f"_i{i}", F.lit(-1)) for i in range(len(cfg.categorical))]).cast("array<bigint>").alias("c"), "y")
    per_class = np.array([weights[c] for c in classes])
    names = ["block", "n", "x", "at", "y", "w", "wsum", "ids"]

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(begin, BLOCK_ROWS)
                c = b.column("c").flatten().to_numpy(zero_copy_only=False)
                ids, at = np.unique(c, return_inverse=True)
                if len(ids) and ids[0] < 0:
                    ids, at = ids[1:], at - 1
                own = b.column("y").to_numpy(zero_copy_only=False)
                w = per_class[own]
                values = (uuid.uuid4().hex, b.num_rows, b.column("x").flatten().to_numpy(zero_copy_only=False).tobytes(),
                          at.astype(np.int32).tobytes(), own.astype(np.int32).tobytes(), w.tobytes(), float(w.sum()), ids)
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names=names)

    return rows.mapInArrow(run, "block string, n long, x binary, at binary, y binary, w binary, wsum double, ids array<bigint>")


def _block_gradients(W: np.ndarray, b: np.ndarray, n_categorical: int):
    """Gradient sums of each block: (idx, g), g a sum for each class.

    Numeric input j answers under -1 - j, the intercepts under -1 - m and the loss under -2 - m.
    """
    import pyarrow as pa

    k, m = W.shape

    def run(batches):
        for batch in batches:
            # one block at a time, read where the batch lies: a batch may hold all blocks of a part
            for n, x, at, y, w, ids, sent in zip(*(batch.column(i) for i in range(7))):
                n, x, at, y, w = n.as_py(), *(v.as_buffer() for v in (x, at, y, w))
                ids, sent = ids.values.to_numpy(zero_copy_only=False), sent.as_py()
                x = np.frombuffer(x, np.float64).reshape(n, m)
                at = np.frombuffer(at, np.int32).reshape(n, n_categorical)
                y, w = np.frombuffer(y, np.int32), np.frombuffer(w, np.float64)
                table = np.zeros((len(ids) + 1, k))     # the last row, place -1: no level
                for s in sent or ():
                    table[s["at"]] = s["w"]
                logits = x @ W.T + b
                for i in range(n_categorical):
                    logits += table[at[:, i]]
                logits -= logits.max(axis=1, keepdims=True)
                e = np.exp(logits)
                p = e / e.sum(axis=1, keepdims=True)
                hit = p[np.arange(n), y]
                p[np.arange(n), y] -= 1.0
                r = w[:, None] * p
                g = np.zeros((len(ids) + 1, k))
                for i in range(n_categorical):
                    np.add.at(g, at[:, i], r)
                keys = np.concatenate([ids, -1 - np.arange(m + 2)])
                loss = np.zeros((1, k))
                loss[0, 0] = float(np.sum(w * -np.log(np.maximum(hit, 1e-15))))
                sums = np.concatenate([g[:-1], r.T.dot(x).T, r.sum(axis=0)[None, :], loss])
                yield pa.RecordBatch.from_arrays([pa.array(keys), *[pa.array(sums[:, i]) for i in range(k)]],
                                                 names=["idx", *[f"g{i}" for i in range(k)]])
    return run


def parts_for(rows: int, at_least: int) -> int:
    """Over how many parts blocks are dealt, so that none holds much more than ``PART_ROWS`` rows."""
    return min(max(at_least, -(-rows // PART_ROWS)), 100_000)


def labelled_rows(stats: TableStats, cfg) -> int:
    return stats.levels().where(F.col("feature") == F.lit(cfg.label)).agg(F.sum("n")).first()[0] or 0


def block_writer(blocks: DataFrame, cfg) -> DataFrameWriter:
    """Writes some ``GROUP_BYTES`` of blocks to a row group.  Spark decodes up to 4,096 rows of a group
    at once, whatever their size, and rows of this table are blocks."""
    each = BLOCK_ROWS * (8 * len(cfg.numeric) + 12 * len(cfg.categorical) + 12)
    return blocks.write.option("compression", "zstd").option("parquet.block.row.count.limit", max(1, GROUP_BYTES // each))


def train_gd_table(df: DataFrame, cfg, stats: TableStats | None = None) -> TableModel:
    """``train_gd`` with the level weights in a table: the same steps, for any number of levels."""
    spark = df.sparkSession
    needed = list(dict.fromkeys(cfg.numeric + cfg.categorical + [cfg.label]))
    stats = stats or statistics(df.select(*needed), cfg.numeric, [*cfg.categorical, cfg.label])
    means, stds = stats.means_and_stds()
    weights = balanced_weights(stats, cfg)
    classes = sorted(weights)
    numbers = stored(level_numbers(TableStats(stats.state, stats.numeric, list(cfg.categorical))), "levels")
    # stored before they are dealt out: which rows share a block may differ when a task runs again
    first = scratch_path(spark, "blocks")
    found = sparse_blocks(df, cfg, numbers, means, stds, weights)
    block_writer(found, cfg).parquet(first)
    parts = parts_for(labelled_rows(stats, cfg), max(default_parallelism(spark), shuffle_partitions(spark)))
    name, path = f"gd_blocks_{uuid.uuid4().hex}", scratch_path(spark, "blocks")
    block_writer(spark.read.schema(found.schema).parquet(first).repartition(parts, "block"), cfg).format("parquet").bucketBy(
        parts, "block").option("path", path).saveAsTable(name)
    discard(spark, first)
    try:
        return _descend(spark.table(name), parts, numbers, classes, means, stds, cfg)
    finally:
        spark.sql(f"DROP TABLE {name}")
        discard(spark, path)


def with_weights(blocks: DataFrame, asked: DataFrame, now: DataFrame, n_parts: int) -> DataFrame:
    """The blocks with ``sent``, the weights of their levels.  Only those move: they are dealt out
    like the buckets and hashed there, and the blocks are read as they lie."""
    sent = asked.join(now, "idx").repartition(n_parts, "block").groupBy("block").agg(
        F.collect_list(F.struct("at", "w")).alias("sent"))
    return blocks.join(sent.hint("shuffle_hash"), "block", "left")


def _descend(blocks: DataFrame, n_parts: int, numbers: DataFrame, classes: list[str], means: list[float], stds: list[float],
             cfg) -> TableModel:
    """The steps over stored blocks, which are bucketed into ``n_parts`` by ``block``."""
    from .train import proximal_step

    spark, k, m = blocks.sparkSession, len(classes), len(cfg.numeric)
    wsum = blocks.agg(F.sum("wsum").alias("w")).first()["w"] or 1.0
    asked = blocks.select("block", F.posexplode("ids").alias("at", "idx"))
    W, b, history = np.zeros((k, m)), np.zeros(k), []
    # zeros for all levels: with no weights sent, AQE drops the join and with it the buckets, and tasks read more than a part
    now, paths = numbers.select("idx", F.array(*[F.lit(0.0)] * k).alias("w")), []
    for _ in range(cfg.iterations):
        parts = with_weights(blocks, asked, now, n_parts).select("n", "x", "at", "y", "w", "ids", "sent").mapInArrow(
            _block_gradients(W, b, len(cfg.categorical)), "idx long, " + ", ".join(f"g{i} double" for i in range(k)))
        sums = parts.groupBy("idx").agg(*[F.sum(f"g{i}").alias(f"g{i}") for i in range(k)]).join(
            now.select("idx", F.col("w").alias("old")), "idx", "left")
        step = F.array(*[_proximal(F.col(f"g{i}"), F.coalesce(F.get("old", F.lit(i)), F.lit(0.0)), wsum, cfg) for i in range(k)])
        # updated weights of the levels, plain sums of the rest
        after = sums.select("idx", F.when(F.col("idx") >= 0, step).otherwise(F.array(*[F.col(f"g{i}") for i in range(k)])).alias("w"))
        paths.append(scratch_path(spark, "weights"))
        after.write.parquet(paths[-1])
        after = spark.read.schema("idx long, w array<double>").parquet(paths[-1])
        small = {r.idx: r.w for r in after.where("idx < 0").collect()}   # numeric inputs, intercepts, loss
        loss = small[-2 - m][0] if small else 0.0
        if not np.isfinite(loss):
            raise ValueError("the training loss is not finite")
        history.append(loss / wsum)
        if cfg.early_stop and len(history) >= 2 and history[-2] > 0 and \
                (history[-2] - history[-1]) / history[-2] < cfg.min_rel_progress:
            break
        now = after.where("idx >= 0")
        G = np.array([small.get(-1 - j, [0.0] * k) for j in range(m)]).reshape(m, k).T
        W, b = proximal_step(W, b, G, np.array(small.get(-1 - m, [0.0] * k)), wsum, cfg)
        for old in paths[:-2]:
            discard(spark, old)
        paths = paths[-2:]
    coefficients = stored(numbers.join(now, "idx", "left").select(
        "feature", "level", F.coalesce("w", F.array(*[F.lit(0.0)] * k)).alias("w")), "coefficients")
    return TableModel(classes, list(cfg.numeric), means, stds, list(cfg.categorical), W.tolist(), b.tolist(), coefficients,
                      name=cfg.name, label=cfg.label, history=history)


def _proximal(g, w, wsum: float, cfg):
    """One weight's step: gradient and L2 term, then the L1 soft threshold."""
    v = w - F.lit(cfg.rate) * (g / F.lit(float(wsum)) + F.lit(cfg.l2) * w)
    t = F.lit(cfg.rate * cfg.l1)
    return F.when(F.abs(v) > t, F.signum(v) * (F.abs(v) - t)).otherwise(F.lit(0.0))


def balanced_weights(stats: TableStats, cfg) -> dict[str, float]:
    """N / (k * n_c) of each class, the same formula as ``class_weights``; 1 if not balanced."""
    rows = stats.levels().where(F.col("feature") == F.lit(cfg.label)).collect()   # the classes
    total = sum(r.n for r in rows)
    return {r.level: (total / (len(rows) * r.n) if cfg.balanced else 1.0) for r in rows}
