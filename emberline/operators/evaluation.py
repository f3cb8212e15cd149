"""Model evaluation: confusion matrix, macro metrics, log loss, ROC AUC.

Confusion counts and log loss come from ONE grouped aggregate (k*k rows,
combined map-side).  Macro precision / recall / F1 average the per-class
values (0 when a denominator is 0), as the published numbers require.

ROC AUC is exact one-vs-rest with mid-ranks for ties, averaged over classes.
The rank sums need a running count over scores sorted per class, which a
plain window would compute in a single task per class.  Instead:

1. each Arrow batch is unpivoted to (class, score) and its ties collapsed, so a
   value shared by a third of the rows leaves a batch as one row;
2. the pairs are range-partitioned on ``(class, score)``, the only exchange of
   them -- Spark samples the boundaries, so partitions are balanced whatever the
   score distribution, and equal pairs meet in one partition;
3. each partition, sorted, makes one streaming pass that merges what is left of
   the ties, also over the borders of batches, and emits per class its own pair
   count with running negatives local to the partition, and its totals -- one
   row per (partition, class);
4. those few rows (bounded by partitions x classes) give every partition the
   count of negatives in all earlier partitions, which completes the sum.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions

EPS = 1e-15


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(actual, predicted, n)`` for every observed pair."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def per_class(cm: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Per class: support, predicted count, correct count, precision, recall, f1.

    Classes are those seen as actual or predicted, or exactly ``labels``;
    a NULL label forms no class.
    """
    rows = cm.select(F.explode(F.array(
        F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n"))
                 .otherwise(F.lit(0)).alias("correct"),
                 F.lit(0).cast("bigint").alias("pred")),
        F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                 F.lit(0).cast("bigint").alias("correct"), F.col("n").alias("pred")),
    )).alias("r")).select("r.*")
    rows = rows.where(F.col("cls").isNotNull())   # a NULL label is no class
    if labels is not None:
        # exactly the requested classes: a class with no rows at all still
        # counts in the macro means (with precision = recall = 0)
        rows = rows.where(F.col("cls").isin(list(labels)))
        zeros = cm.sparkSession.createDataFrame(
            [(c, 0, 0, 0) for c in labels], "cls string, support long, correct long, pred long")
        rows = rows.select(F.col("cls").cast("string"), F.col("support").cast("long"),
                           F.col("correct").cast("long"), F.col("pred").cast("long")).unionByName(zeros)
    agg = rows.groupBy("cls").agg(F.sum("support").alias("support"),
                                  F.sum("correct").alias("correct"),
                                  F.sum("pred").alias("pred"))
    p = F.when(F.col("pred") > 0, F.col("correct") / F.col("pred")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("correct") / F.col("support")).otherwise(F.lit(0.0))
    out = agg.withColumns({"precision": p, "recall": r})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall")
                / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return out.withColumn("f1", f1)


def macro_metrics(cm: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """One row: accuracy, macro precision, macro recall, macro f1 (from k*k counts)."""
    pc = per_class(cm, labels)
    return pc.agg(
        (F.sum("correct") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1_score"),
    )


def true_prob(actual: str, probs: str | dict[str, str]):
    """Probability given to the actual label, from a (label, prob) array or from one
    plain column for each class."""
    from .model import prob_of
    if isinstance(probs, str):
        return prob_of(probs, F.col(actual))
    return F.coalesce(*[F.when(F.col(actual) == F.lit(c), F.col(p)) for c, p in probs.items()], F.lit(0.0))


def log_loss(df: DataFrame, actual: str, probs: str | dict[str, str]) -> DataFrame:
    """One row: mean of ``-ln(max(p_actual, 1e-15))``."""
    ll = -F.log(F.greatest(true_prob(actual, probs), F.lit(EPS)))
    return df.where(F.col(actual).isNotNull()).agg(F.avg(ll).alias("log_loss"))


def confusion_with_loss(df: DataFrame, actual: str, predicted: str, probs_col: str) -> DataFrame:
    """Confusion counts and summed log loss in the same single aggregate."""
    ll = -F.log(F.greatest(true_prob(actual, probs_col), F.lit(EPS)))
    return df.where(F.col(actual).isNotNull()).groupBy(
        F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(ll).alias("ll"))


# -------------------------------------------------------------------- AUC --

_PARTIAL_SCHEMA = "pid int, cls int, local_num double, n_pos long, n_neg long"


def _tie_starts(cls: np.ndarray, score: np.ndarray) -> np.ndarray:
    """Where a new (class, score) begins in sorted rows; NaN equals NaN."""
    differs = (score[1:] != score[:-1]) & ~(np.isnan(score[1:]) & np.isnan(score[:-1]))
    return np.flatnonzero(np.append(True, (cls[1:] != cls[:-1]) | differs))


def _partition_rank_sums(batches):
    """Per (partition, class): pairs won locally, positives, negatives.

    Input rows are sorted by (cls, score) within the partition and carry counts of
    positives and negatives.  A pair (positive at s, negative at t) counts 1 when
    t < s and 1/2 when t == s.  The batches are processed in order with a running
    count per class; the last score of a batch is held back, as the next batch may
    go on with it, so memory stays at one Arrow batch.
    """
    import pyarrow as pa

    state: dict[int, list] = {}
    pid, held = None, None

    def add(cls, pos, neg):
        starts = np.flatnonzero(np.append(True, cls[1:] != cls[:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(cls))):
            st = state.setdefault(int(cls[a]), [0.0, 0, 0])   # local_num, n_pos, n_neg
            p, q = pos[a:b], neg[a:b]
            below = st[2] + np.cumsum(q) - q              # negatives strictly below, this partition
            st[0] += float(np.dot(p, below + 0.5 * q))
            st[1] += int(p.sum())
            st[2] += int(q.sum())

    for batch in batches:
        if batch.num_rows == 0:
            continue
        pid = int(batch.column("pid")[0].as_py())
        rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cls", "score", "n_pos", "n_neg")]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        starts = _tie_starts(*rows[:2])
        cls, score = rows[0][starts], rows[1][starts]
        pos, neg = (np.add.reduceat(x, starts).astype(np.float64) for x in rows[2:])
        if len(starts) > 1:
            add(cls[:-1], pos[:-1], neg[:-1])
        held = [x[-1:] for x in (cls, score, pos, neg)]
    if held is not None:
        add(held[0], held[2], held[3])
        yield pa.RecordBatch.from_arrays([
            pa.array([pid] * len(state), pa.int32()),
            pa.array(list(state.keys()), pa.int32()),
            pa.array([v[0] for v in state.values()], pa.float64()),
            pa.array([v[1] for v in state.values()], pa.int64()),
            pa.array([v[2] for v in state.values()], pa.int64()),
        ], names=["pid", "cls", "local_num", "n_pos", "n_neg"])


def score_pairs(df: DataFrame, actual: str, prob_cols: dict[str, str]) -> DataFrame:
    """``(cls, score, n_pos, n_neg)``: the scores of each class (by its place in ``prob_cols``)
    with how many rows of the class and of others have them; ties inside an Arrow batch
    are one row.  A missing score counts as the lowest."""
    names = list(prob_cols)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows == 0:
                continue
            own = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for i in range(len(names)):
                score = batch.column(i + 1).fill_null(float("-inf")).to_numpy(zero_copy_only=False)
                keys, which = np.unique(score, return_inverse=True)
                pos = np.bincount(which, own == i, len(keys))
                parts.append((np.full(len(keys), i, np.int32), keys, pos, np.bincount(which, minlength=len(keys)) - pos))
            cls, score, pos, neg = (np.concatenate(x) for x in zip(*parts))
            yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(score), pa.array(pos.astype(np.int64)), pa.array(neg.astype(np.int64))],
                                             names=["cls", "score", "n_pos", "n_neg"])

    place = F.array_position(F.array(*[F.lit(c) for c in names]), F.col(actual).cast("string")).cast("int") - 1
    return df.where(F.col(actual).isNotNull()).select(
        place.alias("_own"), *[F.col(c).cast("double").alias(f"_p{i}") for i, c in enumerate(prob_cols.values())]).mapInArrow(
        run, "cls int, score double, n_pos long, n_neg long")


def auc_by_class(df: DataFrame, actual: str, prob_cols: dict[str, str],
                 num_partitions: int | None = None) -> DataFrame:
    """``(cls, n_pos, n_neg, auc)`` for every class; auc NULL without both sides."""
    n = num_partitions or shuffle_partitions(df.sparkSession)
    pairs = score_pairs(df, actual, prob_cols)
    ranged = (pairs.repartitionByRange(n, "cls", "score")
              .sortWithinPartitions("cls", "score")
              .select(F.spark_partition_id().alias("pid"), "cls", "score", "n_pos", "n_neg"))
    partial = ranged.mapInArrow(_partition_rank_sums, _PARTIAL_SCHEMA)
    # at most (partitions x classes) rows from here on
    earlier = Window.partitionBy("cls").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    with_off = partial.withColumn("neg_before", F.coalesce(F.sum("n_neg").over(earlier), F.lit(0)))
    per = with_off.groupBy("cls").agg(
        F.sum(F.col("local_num") + F.col("n_pos") * F.col("neg_before")).alias("num"),
        F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("num") / (F.col("n_pos").cast("double") * F.col("n_neg")))
    name = F.get(F.array(*[F.lit(c) for c in prob_cols]), F.col("cls"))
    return per.select(name.alias("cls"), "n_pos", "n_neg", auc.alias("auc"))


def roc_auc(df: DataFrame, actual: str, prob_cols: dict[str, str],
            num_partitions: int | None = None) -> DataFrame:
    """One row: macro mean of the one-vs-rest AUCs that are defined."""
    return auc_by_class(df, actual, prob_cols, num_partitions).agg(F.avg("auc").alias("roc_auc"))


def evaluate(df: DataFrame, actual: str, predicted: str, probs_col: str,
             classes: Sequence[str], labels: Sequence[str] | None = None) -> dict:
    """accuracy, f1_score, log_loss, precision, recall, roc_auc as floats.

    Two distributed passes (grouped counts + loss, AUC); the rest is
    arithmetic on k*k and k rows.
    """
    from pyspark import StorageLevel

    from .model import prob_of

    # the scored input feeds both passes; an expensive source runs once
    src = df.select(actual, predicted, probs_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cl = confusion_with_loss(src, actual, predicted, probs_col).persist()
        try:
            tot = cl.agg(F.sum("n").alias("n"), F.sum("ll").alias("ll")).first()
            m = macro_metrics(cl.select("actual", "predicted", "n"), labels).first()
        finally:
            cl.unpersist()
        scored = src.select(actual, *[prob_of(probs_col, c).alias(f"__p_{i}")
                                      for i, c in enumerate(classes)])
        auc = roc_auc(scored, actual, {c: f"__p_{i}" for i, c in enumerate(classes)}).first()
    finally:
        src.unpersist()
    n = tot["n"] or 0
    return {
        "accuracy": m["accuracy"],
        "f1_score": m["f1_score"],
        "log_loss": (tot["ll"] / n) if n else None,
        "precision": m["precision"],
        "recall": m["recall"],
        "roc_auc": auc["roc_auc"],
    }
