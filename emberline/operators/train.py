"""Training: class weights, random split, preprocessing fit, gradient descent.

The trainer is the classic Spark iterative pattern: the design matrix is
built once and persisted, then each step is ONE pass over it that produces
``k*(d+1)`` gradient sums plus the loss.  By default every partition computes
its partial sums as numpy matrix products over Arrow batches and Spark adds
them up per coefficient (map-side combined); the alternative engine is a
single SQL aggregate.  Only those numbers reach the driver, which applies the
``k x d`` update (gradient step, L2 term, L1 soft-threshold).  Nothing per
row ever leaves the executors.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import reference_values as RV
from ..functions.rng import split_flag
from ..functions.sqltext import num, text
from ..session import default_parallelism
from .model import LinearModel, Preprocess
from .row_id import with_row_id
from .stats import TableStats, statistics
from .table_model import TableModel, balanced_weights, labelled_rows, parts_for, train_gd_table


@dataclass
class TrainConfig:
    label: str = RV.LABEL_COLUMN
    numeric: list[str] = field(default_factory=lambda: RV.NUMERIC_FEATURES + RV.ORDINAL_FEATURES)
    categorical: list[str] = field(default_factory=lambda: list(RV.CATEGORICAL_FEATURES))
    balanced: bool = RV.AUTO_CLASS_WEIGHTS
    iterations: int = RV.MAX_ITERATIONS
    rate: float = RV.LEARN_RATE
    l1: float = RV.L1_REG
    l2: float = RV.L2_REG
    penalize_intercept: bool = False
    name: str = RV.DEFAULT_MODEL_NAME
    # "arrow": per-partition numpy matrix products on Arrow batches (default);
    # "sql": one SQL aggregate of k*(d+1) sums, fully JVM-side
    engine: str = "arrow"
    # optional: stop once the relative improvement of the data loss between
    # two steps falls below min_rel_progress (off: all iterations run)
    early_stop: bool = False
    min_rel_progress: float = 0.01


# ---------------------------------------------------------------- weights --

def class_weights(df: DataFrame, label: str = RV.LABEL_COLUMN) -> DataFrame:
    """``(label, n, weight)`` with ``weight = N / (k * n_label)`` (balanced)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # the totals are one row, attached by a broadcast
    totals = counts.agg(F.sum("n").alias("_tot"), F.count(F.lit(1)).alias("_k"))
    weight = F.col("_tot") / (F.col("_k") * F.col("n")).cast("double")
    return counts.crossJoin(F.broadcast(totals)).select(label, "n", weight.alias("weight"))


# ------------------------------------------------------------------ split --

def split(df: DataFrame, id_col: str = "row_id", seed: int = 42,
          eval_fraction: float = RV.EVAL_FRACTION) -> tuple[DataFrame, DataFrame]:
    """(train, eval) by a hash draw of the row id: stable under repartitioning."""
    flag = split_flag(seed, F.col(id_col), eval_fraction)
    return df.where(~flag), df.where(flag)


# ------------------------------------------------------------- preprocess --

def design(df: DataFrame, pre: Preprocess, label: str, weights: dict[str, float]) -> DataFrame:
    """``_x0.._x{d-1}`` (double), ``_y`` (label), ``_w`` (sample weight)."""
    wmap = F.create_map(*[x for c, w in weights.items() for x in (F.lit(c), F.lit(float(w)))])
    imap = F.create_map(*[x for i, c in enumerate(sorted(weights)) for x in (F.lit(c), F.lit(i))])
    cols = [c.alias(f"_x{j}") for j, c in enumerate(pre.feature_columns())]
    y = F.col(label).cast("string")
    return (df.where(F.col(label).isNotNull())
            .select(*cols, y.alias("_y"),
                    F.coalesce(F.try_element_at(imap, y), F.lit(-1)).alias("_yi"),
                    F.coalesce(F.try_element_at(wmap, y), F.lit(0.0)).alias("_w")))


# --------------------------------------------------------------- gradient --

def gradient_sql(view: str, classes: list[str], W, b, d: int) -> str:
    """One aggregate query: weighted residual sums per (class, feature) and the loss.

    Written as a single SQL string so that each step costs one parse instead
    of hundreds of client-side column calls; Catalyst sees the same plan.
    """
    k = len(classes)
    logits = []
    for i in range(k):
        terms = [num(b[i])] + [f"{num(W[i][j])} * _x{j}" for j in range(d) if W[i][j] != 0.0]
        logits.append(" + ".join(terms) + f" AS _l{i}")
    m = f"greatest({', '.join(f'_l{i}' for i in range(k))})" if k > 1 else "_l0"
    exps = ", ".join(f"exp(_l{i} - _m) AS _e{i}" for i in range(k))
    z = " + ".join(f"_e{i}" for i in range(k))
    probs = ", ".join(f"_e{i} / _z AS _p{i}" for i in range(k))
    res = ", ".join(f"_w * (_p{i} - CASE WHEN _y = {text(c)} THEN 1.0D ELSE 0.0D END) AS _r{i}"
                    for i, c in enumerate(classes))
    pt = "CASE " + " ".join(f"WHEN _y = {text(c)} THEN _p{i}" for i, c in enumerate(classes)) + " ELSE 0.0D END"
    aggs = [f"sum(_w * -ln(greatest(_pt, 1.0E-15D))) AS loss"]
    for i in range(k):
        aggs.append(f"sum(_r{i}) AS g_{i}")
        aggs += [f"sum(_r{i} * _x{j}) AS g_{i}_{j}" for j in range(d)]
    return (f"SELECT {', '.join(aggs)} FROM ("
            f"SELECT *, {res}, {pt} AS _pt FROM ("
            f"SELECT *, {probs} FROM ("
            f"SELECT *, {z} AS _z FROM ("
            f"SELECT *, {exps} FROM ("
            f"SELECT *, {m} AS _m FROM ("
            f"SELECT *, {', '.join(logits)} FROM {view}))))))")


def gradient_sums(X: DataFrame | str, classes: list[str], W, b, d: int, spark=None) -> dict:
    """One pass via SQL aggregates: residual sums per (class, feature), per class, loss."""
    k = len(classes)
    if isinstance(X, DataFrame):
        spark = X.sparkSession
        view = f"_design_{uuid.uuid4().hex}"
        X.createOrReplaceTempView(view)
    else:
        view = X
    try:
        row = spark.sql(gradient_sql(view, classes, W, b, d)).first().asDict()
    finally:
        if isinstance(X, DataFrame):
            spark.catalog.dropTempView(view)
    G = np.array([[row[f"g_{i}_{j}"] or 0.0 for j in range(d)] for i in range(k)])
    gb = np.array([row[f"g_{i}"] or 0.0 for i in range(k)])
    return {"G": G, "gb": gb, "loss": row["loss"] or 0.0}


BLOCK_ROWS = 4096


def design_blocks(df: DataFrame, pre: Preprocess, label: str, weights: dict[str, float]) -> DataFrame:
    """The design matrix as binary blocks of ``BLOCK_ROWS`` rows, for the cache.

    A row holds its numeric inputs as doubles and ONE index per categorical
    (-1: a level not seen), so width does not grow with the vocabulary, and a
    step reads the cached blocks without converting rows again.
    """
    import pyarrow as pa

    wmap = F.create_map(*[x for c, w in weights.items() for x in (F.lit(c), F.lit(float(w)))])
    imap = F.create_map(*[x for i, c in enumerate(sorted(weights)) for x in (F.lit(c), F.lit(i))])
    y = F.col(label).cast("string")
    nums = [pre.numeric_column(i) for i in range(len(pre.numeric))]
    cats = []
    for c in pre.categorical:
        levels = F.array(*[F.lit(v) for v in pre.vocab[c]]) if pre.vocab[c] else F.array().cast("array<string>")
        spots = F.map_from_arrays(levels, F.sequence(F.lit(0), F.lit(len(pre.vocab[c]) - 1))) if pre.vocab[c] else None
        at = F.try_element_at(spots, F.col(c).cast("string")) if spots is not None else F.lit(None)
        cats.append(F.coalesce(at.cast("int"), F.lit(-1)))
    rows = df.where(F.col(label).isNotNull()).select(
        F.array(*nums).cast("array<double>").alias("x"), F.array(*cats).cast("array<int>").alias("c"),
        F.coalesce(F.try_element_at(imap, y), F.lit(-1)).alias("y"),
        F.coalesce(F.try_element_at(wmap, y), F.lit(0.0)).alias("w"))
    names = ["n", "x", "c", "y", "w", "wsum"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(at, BLOCK_ROWS)
                w = b.column("w").to_numpy(zero_copy_only=False)
                parts = [b.column(k).flatten().to_numpy(zero_copy_only=False) for k in ("x", "c")]
                parts += [b.column("y").to_numpy(zero_copy_only=False), w]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v]) for v in (b.num_rows, *(p.tobytes() for p in parts), float(w.sum()))], names=names)

    return rows.mapInArrow(run, "n long, x binary, c binary, y binary, w binary, wsum double")


def _partial_gradient(classes, W, b, pre: Preprocess):
    """Per-partition gradient sums and loss, with ``R = w * (softmax(XW^T + b) - Y)``.

    Numeric inputs are a matrix product, categoricals a lookup of one weight
    per row and a count per level; the output is ``k*(d+1)+1`` numbers per
    partition, never per row.
    """
    import pyarrow as pa

    W = np.asarray(W, dtype=np.float64)
    b = np.asarray(b, dtype=np.float64)
    k, m = len(classes), len(pre.numeric)
    sizes = [len(pre.vocab[c]) for c in pre.categorical]
    starts = m + np.cumsum([0, *sizes])
    d = int(starts[-1])
    onehot = np.vstack([np.eye(k), np.zeros((1, k))])   # index -1 (unknown) -> zeros
    # one more weight, 0, for levels not seen (index -1)
    tables = [np.hstack([W[:, s:s + n], np.zeros((k, 1))]) for s, n in zip(starts, sizes)]

    def run(batches):
        G, gb, loss, seen = np.zeros((k, d)), np.zeros(k), 0.0, False
        for batch in batches:
            for n, x, c, y, w in zip(*(batch.column(i).to_pylist() for i in range(5))):
                seen = True
                x = np.frombuffer(x, np.float64).reshape(n, m)
                c = np.frombuffer(c, np.int32).reshape(n, len(sizes))
                w = np.frombuffer(w, np.float64)
                L = x @ W[:, :m].T + b
                for i, t in enumerate(tables):
                    L += t[:, c[:, i]].T
                L -= L.max(axis=1, keepdims=True)
                E = np.exp(L)
                P = E / E.sum(axis=1, keepdims=True)
                Y = onehot[np.frombuffer(y, np.int32)]
                R = w[:, None] * (P - Y)
                G[:, :m] += R.T @ x
                for i, (s, size) in enumerate(zip(starts, sizes)):
                    for j in range(k):
                        G[j, s:s + size] += np.bincount(c[:, i] + 1, R[:, j], size + 1)[1:]
                gb += R.sum(axis=0)
                pt = np.where(Y.any(axis=1), (P * Y).sum(axis=1), 0.0)
                loss += float(np.sum(w * -np.log(np.maximum(pt, 1e-15))))
        if seen:
            acc = np.concatenate([G.ravel(), gb, [loss]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(acc.size, dtype=np.int32)), pa.array(acc)], names=["i", "v"])
    return run


def gradient_sums_arrow(X: DataFrame, classes: list[str], W, b, pre: Preprocess) -> dict:
    """One pass over the packed design matrix: partial gradients per partition,
    summed per coefficient index by Spark (map-side combined, ``k*(d+1)+1`` rows)."""
    k, d = len(classes), len(pre.feature_names())
    parts = X.select("n", "x", "c", "y", "w").mapInArrow(_partial_gradient(classes, W, b, pre), "i int, v double")
    rows = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()
    acc = np.zeros(k * (d + 1) + 1)
    for r in rows:
        acc[r["i"]] = r["v"]
    return {"G": acc[: k * d].reshape(k, d), "gb": acc[k * d: k * d + k], "loss": acc[-1]}


def proximal_step(W, b, G, gb, wsum: float, cfg: TrainConfig):
    """Mean-loss gradient + ``l2*w``, step ``rate``, then L1 soft-threshold."""
    W = np.asarray(W, dtype=float)
    b = np.asarray(b, dtype=float)
    gW = G / wsum + cfg.l2 * W
    gB = gb / wsum + (cfg.l2 * b if cfg.penalize_intercept else 0.0)
    W = W - cfg.rate * gW
    b = b - cfg.rate * gB
    t = cfg.rate * cfg.l1
    W = soft_threshold(W, t)
    if cfg.penalize_intercept:
        b = soft_threshold(b, t)
    return W, b


def soft_threshold(x, t: float):
    """``sign(x) * max(|x| - t, 0)`` with an exact +0.0 inside the dead zone."""
    return np.where(np.abs(x) > t, np.sign(x) * (np.abs(x) - t), 0.0)


def prepare(df: DataFrame, cfg: TrainConfig, packed: bool = False, stats: TableStats | None = None):
    """Statistics, vocabulary and class weights in one scan, then the persisted design matrix.

    The vocabulary becomes part of the model on the driver, so its size is checked:
    beyond ``LITERAL_LEVELS`` this raises, and ``train_gd`` goes on with a table.
    """
    needed = list(dict.fromkeys(cfg.numeric + cfg.categorical + [cfg.label]))
    src = df.select(*needed)
    stats = stats or statistics(src, cfg.numeric, [*cfg.categorical, cfg.label])
    if n_levels(stats, cfg) > LITERAL_LEVELS:
        raise ValueError(f"more than {LITERAL_LEVELS} levels: train with train_gd, which keeps them in a table")
    means, stds = stats.means_and_stds()
    vocab: dict[str, list[str]] = {c: [] for c in cfg.categorical}
    for r in stats.levels().where(F.col("feature").isin(list(vocab))).collect():
        vocab[r.feature].append(r.level)
    pre = Preprocess(list(cfg.numeric), means, stds, list(cfg.categorical), {c: sorted(v) for c, v in vocab.items()})
    weights = balanced_weights(stats, cfg)
    classes = sorted(weights)
    if packed:
        # blocks are few; dealt out once, every step runs on all cores however the scan was split,
        # over parts that a Python worker can hold whole, as one Arrow batch may take all blocks of a part
        X = design_blocks(src, pre, cfg.label, weights).repartition(
            parts_for(labelled_rows(stats, cfg), default_parallelism(df.sparkSession)))
    else:
        X = design(src, pre, cfg.label, weights)
    # The design matrix is a deterministic function of the input, so lost
    # cached blocks are recomputed exactly from lineage.
    X = X.persist(StorageLevel.MEMORY_AND_DISK)
    wsum = X.agg(F.sum("_w" if not packed else "wsum").alias("w")).first()["w"] or 1.0
    return pre, weights, classes, X, wsum


LITERAL_LEVELS = 4096   # categorical levels that a model may hold on the driver and in a plan


def n_levels(stats: TableStats, cfg: TrainConfig) -> int:
    return stats.levels().where(F.col("feature").isin(list(cfg.categorical))).count()


def train_gd(df: DataFrame, cfg: TrainConfig | None = None) -> LinearModel | TableModel:
    """Multinomial logistic regression by constant-rate proximal gradient descent.

    The levels are counted first.  Up to ``LITERAL_LEVELS`` the weights live on the
    driver; beyond, in a table (``table_model``), with the same steps.
    """
    cfg = cfg or TrainConfig()
    needed = list(dict.fromkeys(cfg.numeric + cfg.categorical + [cfg.label]))
    stats = statistics(df.select(*needed), cfg.numeric, [*cfg.categorical, cfg.label])
    if n_levels(stats, cfg) > LITERAL_LEVELS:
        return train_gd_table(df, cfg, stats)
    pre, weights, classes, X, wsum = prepare(df, cfg, packed=(cfg.engine != "sql"), stats=stats)
    spark = X.sparkSession
    view = f"_design_{uuid.uuid4().hex}"
    try:
        d = len(pre.feature_names())
        k = len(classes)
        W = np.zeros((k, d))
        b = np.zeros(k)
        history = []
        if cfg.engine == "sql":
            X.createOrReplaceTempView(view)
        for _ in range(cfg.iterations):
            if cfg.engine == "sql":
                s = gradient_sums(view, classes, W, b, d, spark=spark)
            else:
                s = gradient_sums_arrow(X, classes, W, b, pre)
            if not np.isfinite(s["loss"]):
                raise ValueError("the training loss is not finite")
            history.append(s["loss"] / wsum)
            if cfg.early_stop and len(history) >= 2 and history[-2] > 0 and \
                    (history[-2] - history[-1]) / history[-2] < cfg.min_rel_progress:
                break
            W, b = proximal_step(W, b, s["G"], s["gb"], wsum, cfg)
    finally:
        spark.catalog.dropTempView(view)
        X.unpersist()
    return LinearModel(classes, pre, W.tolist(), b.tolist(), name=cfg.name,
                       label=cfg.label, history=history)


def first_step(df: DataFrame, cfg: TrainConfig | None = None) -> DataFrame:
    """Coefficients after one step from zero, as ``(class, feature, weight)`` rows.

    At W = 0 every probability is ``1/k``, so the step is a pure weighted-sum
    aggregate; returned as a DataFrame built from that aggregate's one row.
    """
    cfg = cfg or TrainConfig()
    pre, weights, classes, X, wsum = prepare(df, cfg)
    d = len(pre.feature_names())
    k = len(classes)
    try:
        s = gradient_sums(X, classes, np.zeros((k, d)), np.zeros(k), d)
    finally:
        X.unpersist()
    W, b = proximal_step(np.zeros((k, d)), np.zeros(k), s["G"], s["gb"], wsum, cfg)
    model = LinearModel(classes, pre, W.tolist(), b.tolist(), name=cfg.name, label=cfg.label)
    return df.sparkSession.createDataFrame(
        model.coefficient_rows(), "class string, feature string, weight double")


# ------------------------------------------------------ converged variant --

def train_lr(df: DataFrame, cfg: TrainConfig | None = None) -> LinearModel:
    """Same objective solved to convergence by the Spark ML pipeline (OWL-QN); see ``pipeline``."""
    from .pipeline import fit_pipeline, linear_model

    cfg = cfg or TrainConfig()
    needed = list(dict.fromkeys(cfg.numeric + cfg.categorical + [cfg.label]))
    stats = statistics(df.select(*needed), cfg.numeric, [*cfg.categorical, cfg.label])
    fitted, classes = fit_pipeline(df, cfg, stats)
    return linear_model(fitted, cfg, classes, *stats.means_and_stds())


def optimality(df: DataFrame, model: LinearModel, cfg: TrainConfig | None = None, tolerance: float = 1e-3) -> DataFrame:
    """``(class, feature, optimal)``: whether each coefficient meets the optimality
    condition of the objective - a subgradient of at most ``tolerance`` - computed
    over the table: loss gradient + l2 w, within l1 of 0 where w = 0 and cancelled
    by l1 sign(w) elsewhere; intercepts are not penalised."""
    cfg = cfg or TrainConfig()
    pre, weights, classes, X, wsum = prepare(df, cfg, packed=True)
    try:
        s = gradient_sums_arrow(X, classes, model.weights, model.intercepts, pre)
    finally:
        X.unpersist()
    W = np.asarray(model.weights, dtype=float)
    g = s["G"] / wsum + cfg.l2 * W
    off = np.where(np.abs(W) > 1e-12, np.abs(g + cfg.l1 * np.sign(W)), np.maximum(np.abs(g) - cfg.l1, 0.0))
    names = pre.feature_names()
    rows = [(c, "(intercept)", bool(abs(s["gb"][i] / wsum) <= tolerance)) for i, c in enumerate(classes)]
    rows += [(c, f, bool(off[i, j] <= tolerance)) for i, c in enumerate(classes) for j, f in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "class string, feature string, optimal boolean")


# ------------------------------------------------- statistics as DataFrames --

def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, mean, std)`` from one scan."""
    return statistics(df, columns, []).moments()


def vocabulary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(feature, level, level_index)``: sorted distinct levels per categorical.

    The counting runs distributed, and so does the numbering: a global dense
    row number over ``(feature, level)`` (range-partitioned, see
    ``with_row_id``) minus each feature's first number.  No task ever holds
    all levels of a feature, whatever its cardinality.
    """
    levels = statistics(df, [], columns).levels().select("feature", "level")
    numbered = with_row_id(levels, ["feature", "level"], name="_n")
    # one row per requested column: a bound known before anything runs
    first = numbered.groupBy("feature").agg(F.min("_n").alias("_first"))
    return (numbered.join(F.broadcast(first), "feature")
            .select("feature", "level", (F.col("_n") - F.col("_first")).cast("bigint").alias("level_index")))
