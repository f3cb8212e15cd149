"""Mixing sources to target weights over a domain -> language -> source tree.

Capacities (tokens times allowed epochs) are summed up the tree.  The budget
then flows down: each node deals its share to its children by weight, a child
that cannot use its share keeps its capacity, and what it leaves over goes to
its siblings; only what a whole subtree cannot use reaches the next branch of
an ancestor, because the subtree's capacity already limits its share there.
A leaf takes whole epochs while its budget lasts and, of the next epoch, the
longest prefix of a seeded order that fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Tables

SALTS = 64  # parts of a leaf in the join with its budget
SUB_DIGITS = 3  # a leaf's order is cut into 16 ** SUB_DIGITS ranges of the order key


def order_key(doc_id: Column, seed: int, epoch: Column) -> Column:
    """Position of a document in a seeded epoch: 32 hex digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"),
                          F.coalesce(doc_id.cast("string"), F.lit("null"))))


def weight_of(level: Column, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for value, w in weights.items():
        out = F.when(level == value, F.lit(w)).otherwise(out)
    return out.cast("long")


def deal(children: DataFrame, parent: list[str], node: str) -> DataFrame:
    """Adds ``alloc``: the share of each child of ``parent`` (columns cap, w, given).

    With children in the order of cap / w, the level at which all unsaturated
    children meet is the largest of (given - caps before) / (weights from here).
    """
    by = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("w"), node)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    onward = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("given") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(onward)
    return (children.where("w > 0").withColumn("_lv", level)
            .withColumn("_lv", F.max("_lv").over(Window.partitionBy(*parent)))
            .withColumn("alloc", F.least("cap", F.floor(F.col("w") * F.col("_lv"))).cast("long"))
            .drop("_lv"))


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[dict], defaults: list[int],
                 share: tuple[int, int], max_epochs: int) -> DataFrame:
    """``leaves`` (one row each: ``levels``, tokens) with their ``budget`` in tokens.

    The total budget is ``share`` (a fraction) of all tokens.  Weights are
    integers; a value not named has its level's default, a weight of 0 takes no part.
    ``leaves`` is read once for each level and once for the result.
    """
    caps = leaves.withColumn("cap", F.col("tokens") * max_epochs).withColumn("_root", F.lit(0))
    joined = ["_root"]
    for depth, level in enumerate(levels):
        path = levels[:depth + 1]
        nodes = caps if path == levels else caps.groupBy("_root", *path).agg(
            F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("w", weight_of(F.col(level), weights[depth], defaults[depth]))
        if depth:
            nodes = nodes.join(above, joined)
        else:
            nodes = nodes.withColumn("given", F.sum("tokens").over(Window.partitionBy("_root"))).withColumn(
                "given", F.expr(f"given * {share[0]} div {share[1]}"))
        joined = ["_root", *path]
        above = deal(nodes, joined[:-1], level).select(*joined, F.col("alloc").alias("given"))
    return leaves.join(above.drop("_root"), levels, "left").withColumn(
        "budget", F.coalesce("given", F.lit(0).cast("long"))).drop("given")


def mix(docs: DataFrame, levels: list[str], weights: list[dict], defaults: list[int],
        share: tuple[int, int] = (1, 1), max_epochs: int = 1, seed: int = 0,
        doc_id: str = "doc_id", tokens: str = "n_tokens") -> DataFrame:
    """``docs`` plus ``leaf_budget`` and ``copies``: how often a document enters the mix.

    All rows come back, those left out with 0 copies.  Columns of ``docs`` named
    ``leaf_budget`` or ``copies`` are replaced, unless they are levels, the tokens or
    the id, which raises an error.  NULL in a level column
    is the branch named ''.  NULL or missing tokens count 0; repeated rows each
    count; an empty table gives an empty result.  Leaves and budgets, one row a leaf,
    are written while the plan is built.  Only the running sum inside
    one of 4,096 hash ranges of a leaf needs its rows together, so a leaf
    with a third of all rows is still spread over the cluster.
    """
    if {"leaf_budget", "copies"} & {*levels, doc_id, tokens}:
        raise ValueError("leaf_budget and copies are names of results")
    docs = docs.drop("leaf_budget", "copies")
    lv = [f"_mx_{c}" for c in levels]
    t = (docs.withColumns({k: F.coalesce(F.col(c).cast("string"), F.lit("")) for k, c in zip(lv, levels)})
         .withColumn("_mx_t", F.coalesce(F.col(tokens).cast("long"), F.lit(0).cast("long"))))
    # tables, not subplans: the budgets are read twice below and the leaves once a level, and each use
    # would repeat all that is under it in one plan, which the driver plans, compiles and reports as a whole
    tables = Tables(docs.sparkSession)
    leaves = tables.written(t.groupBy(*lv).agg(F.sum("_mx_t").alias("tokens")), "leaves")
    budgets = tables.written(leaf_budgets(leaves, lv, weights, defaults, share, max_epochs).select(
        *lv, F.col("budget").alias("leaf_budget"),
        F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("_mx_full"),
        F.when(F.col("tokens") > 0, F.expr("budget % tokens")).otherwise(0).alias("_mx_left")), "budgets")
    tables.delete(but_last=1)
    # the salt keeps the rows of a hot leaf apart here, and the running sums on shuffles of their own
    t = t.withColumn("_mx_z", F.pmod(F.xxhash64(doc_id), F.lit(SALTS)))
    budgets = budgets.withColumn("_mx_z", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    t = t.join(budgets, [*lv, "_mx_z"]).drop("_mx_z")
    t = t.withColumn("_mx_k", order_key(F.col(doc_id), seed, F.col("_mx_full")))
    t = t.withColumn("_mx_s", F.substring("_mx_k", 1, SUB_DIGITS))
    part = [*lv, "_mx_s"]
    upto = Window.partitionBy(*lv).orderBy("_mx_s").rowsBetween(Window.unboundedPreceding, -1)
    starts = t.groupBy(*part).agg(F.sum("_mx_t").alias("_mx_b")).select(
        *part, F.coalesce(F.sum("_mx_b").over(upto), F.lit(0)).alias("_mx_b"))
    inside = Window.partitionBy(*part).orderBy("_mx_k", "_mx_t").rowsBetween(Window.unboundedPreceding, 0)
    t = t.join(starts, part).withColumn("_mx_c", F.col("_mx_b") + F.sum("_mx_t").over(inside))
    extra = ((F.col("_mx_left") > 0) & (F.col("_mx_c") <= F.col("_mx_left"))).cast("long")
    return t.withColumn("copies", F.col("_mx_full") + extra).drop(
        *lv, "_mx_t", "_mx_full", "_mx_left", "_mx_k", "_mx_s", "_mx_b", "_mx_c")
