"""Dense 1-based row numbers over a total order, without a one-task window.

``row_number() OVER (ORDER BY k)`` with no PARTITION BY sends every row to one
task.  Here rows are dealt into ranges of the order ("buckets"), numbered
inside their range, and shifted by the number of rows in the ranges before.
The range bounds come from one bounded, hash-chosen sample, so they are a pure
function of the rows: the counting pass and the numbering pass see the same
ranges, also when executors are lost and tasks run again.  Everything is one
lazy plan; nothing is copied to storage and no job runs while it is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from ..session import shuffle_partitions

SAMPLE_PER_BUCKET = 16
BUCKETS_PER_PARTITION = 4


def with_range_bucket(df: DataFrame, keys: list[str], n_buckets: int, name: str) -> DataFrame:
    """``df`` plus ``name``: the range (0 .. n_buckets) a row's ``keys`` fall into.

    ``n_buckets * SAMPLE_PER_BUCKET`` rows with the smallest key hashes are the
    sample (a bound that depends on the parameter only); every
    ``SAMPLE_PER_BUCKET``-th sampled key is a range bound.  Rows with equal
    keys share a range.  NULL keys sort first.
    """
    key = F.struct(*keys)
    sample = (df.select(key.alias("k")).orderBy(F.xxhash64(key)).limit(n_buckets * SAMPLE_PER_BUCKET)
              .agg(F.array_sort(F.collect_list("k")).alias("a")))
    bounds = sample.select(F.filter(
        "a", lambda x, i: i % SAMPLE_PER_BUCKET == SAMPLE_PER_BUCKET - 1).alias("_rb_bounds"))
    # binary search: add ever smaller powers of two while the bound there is not above the key
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(n_buckets.bit_length()))])
    at = F.col("_rb_bounds")
    def search(k):
        return F.aggregate(steps, F.lit(0), lambda lo, s: F.when(
            (lo + s <= F.size(at)) & (F.get(at, lo + s - 1) <= k), lo + s).otherwise(lo))

    # bound as a variable, the key is built once for a row and not once for a step
    found = F.get(F.transform(F.array(key), search), F.lit(0))
    # the bounds are one row: attaching it is a broadcast, not a product
    return df.crossJoin(F.broadcast(bounds)).withColumn(name, found).drop("_rb_bounds")


def with_row_id(df: DataFrame, order_by: list, name: str = "row_id",
                num_partitions: int | None = None, tiebreak: bool = True,
                total: str | None = None) -> DataFrame:
    """``df`` plus a dense 1-based ``name`` following ``order_by``.

    With ``tiebreak`` the remaining orderable columns are appended to the
    order: rows tied on ``order_by`` get a deterministic order, and a large
    tie group (one value shared by a third of the rows) spreads over several
    ranges.  ``total`` names an extra column holding the number of rows.
    """
    n = num_partitions or shuffle_partitions(df.sparkSession)
    given = {f"_rid_k{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order_by)}
    named = {c for c in order_by if isinstance(c, str)}
    rest = [f.name for f in df.schema.fields if tiebreak and f.name not in named
            and not isinstance(f.dataType, (MapType, VariantType))]
    keys = [*given, *rest]
    keyed = df.withColumns(given)
    keyed = with_range_bucket(keyed, keys, n * BUCKETS_PER_PARTITION, "_rid_b")
    counts = keyed.groupBy("_rid_b").agg(F.count(F.lit(1)).alias("_rid_n"))
    # at most n_buckets + 1 rows: a single-task window and a broadcast are bounded
    before = Window.orderBy("_rid_b").rowsBetween(Window.unboundedPreceding, -1)
    extra = {total: F.sum("_rid_n").over(Window.partitionBy())} if total else {}
    offsets = counts.select("_rid_b", F.coalesce(F.sum("_rid_n").over(before), F.lit(0)).alias("_rid_o"),
                            *[c.alias(k) for k, c in extra.items()])
    inside = F.row_number().over(Window.partitionBy("_rid_b").orderBy(*keys))
    return (keyed.join(F.broadcast(offsets), "_rid_b")
            .withColumn(name, F.col("_rid_o") + inside)
            .drop("_rid_b", "_rid_o", *given))
