"""Connected components of a link table, by alternating star contractions.

Large star: every node hands its larger neighbours to its smallest one.  Small
star: every node hands its smaller neighbours, and itself, to its smallest one.
Both keep the components and shrink every one of them to a star around its
smallest node in O(log^2 n) rounds.  Each round is two joins on the node, whose
hot keys Spark may split, and a written table; no component is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of ``links`` (u > v)."""
    if large:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = links
    low = near.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    moved = near.join(low, "u")
    if large:
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) links with u > v  ->  (node, component): the smallest node reachable.

    Only nodes with a link appear.  Links repeated or given once suffice; an
    empty table gives an empty result.  Rounds go on until one changes nothing.
    """
    tables = Tables(links.sparkSession)
    now, mark = tables.written(links.distinct(), "links"), None
    while True:
        sums = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if (sums.n, sums.x) == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        mark = (sums.n, sums.x)
        now = tables.written(_star(_star(now, True), False), "links")
        tables.delete(but_last=1)
