"""Context-triggered piecewise hashing of texts, and edit distance of the results.

A rolling hash over the last seven bytes ends a piece wherever its low bits are
all ones, so boundaries depend on nearby bytes only and survive edits elsewhere.
Every piece becomes one of 64 signs.  The block size 2**k (the expected piece
length) follows the length of the text; a fingerprint holds the signs at that
block size and at the next one, so texts whose block sizes are equal or
neighbours can be compared: by the edit distance of the signs at a common size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.row_id import BUCKETS_PER_PARTITION, with_range_bucket
from ..session import shuffle_partitions
from .common import small_batches

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
ROLL = 7
PIECES = 64
STRETCH = 1 << 20  # bytes hashed at a time


def _context_hashes(x: np.ndarray) -> np.ndarray:
    """For each byte, a 32-bit hash of it and the six bytes before (none: zeros)."""
    x = x.astype(np.uint32) + np.uint32(1)
    h = x.copy()
    factor = np.uint32(1)
    with np.errstate(over="ignore"):
        for back in range(1, ROLL):
            factor = factor * np.uint32(0x01000193)
            h[back:] += x[:-back] * factor
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(12)
        h *= np.uint32(0x297A2D39)
        return h ^ (h >> np.uint32(15))


def _signs(sums: np.ndarray) -> str:
    with np.errstate(over="ignore"):
        at = ((sums * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).tolist()
    return "".join([SIGNS[i] for i in at])


def fingerprint(data: bytes) -> str:
    """"k:signs:signs" of a text's bytes: at block size 2**k and at the next one."""
    n = len(data)
    k = max(1, (max(n - 1, 0) // PIECES).bit_length())
    low = np.uint32((1 << k) - 1)
    sums, wide, total = [], [], np.zeros(1, np.uint64)
    for at in range(0, n, STRETCH):
        start = max(0, at - ROLL + 1)
        h = _context_hashes(np.frombuffer(data, np.uint8, min(n, at + STRETCH) - start, start))[at - start:]
        run = np.cumsum(h, dtype=np.uint64) + total
        ends = np.flatnonzero((h & low) == low)
        sums.append(run[ends])
        wide.append((h[ends] >> np.uint32(k)) & np.uint32(1) == 1)
        total = run[-1:]
    if not n:
        return f"{k}::"
    ends, big = np.concatenate(sums), np.concatenate(wide)
    signs = []
    for some in (ends, ends[big]):
        edge = some if len(some) and some[-1] == total[0] else np.concatenate([some, total])
        signs.append(_signs(np.diff(edge, prepend=np.uint64(0))))
    return f"{k}:{signs[0]}:{signs[1]}"


def likeness(a: Column, b: Column) -> Column:
    """0 .. 1: one less the edit distance over the longer length, at a common block size
    (the better of two, if both fingerprints have two in common; 0 if they have none)."""
    x, y = F.split(a, ":"), F.split(b, ":")

    def like(s: Column, t: Column) -> Column:
        longest = F.greatest(F.length(s), F.length(t))
        return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(s, t) / longest)

    gap = x[0].cast("int") - y[0].cast("int")
    return (F.when(a == b, 1.0)
            .when(gap == 0, F.greatest(like(x[1], y[1]), like(x[2], y[2])))
            .when(gap == 1, like(x[1], y[2]))
            .when(gap == -1, like(x[2], y[1]))
            .otherwise(0.0))


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` plus the fingerprint of each whole text (NULL: as empty)."""
    small_batches(docs.sparkSession)

    @F.udf("string", useArrow=True)
    def run(data):
        return fingerprint(data)

    return docs.withColumn(name, run(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def with_neighbour(docs: DataFrame, keys: list[str], n_buckets: int) -> DataFrame:
    """Rows (b, ghost, *docs) such that, sorted by b, ghost descending and ``keys``,
    every row stands right after the row before it in the order of ``keys``.

    Ranges of the order become groups ``b``; the last row of a range is copied
    (``ghost`` 1) to the head of the next one, that of the last range to the
    first.  One copy for each range is all that crosses a boundary.
    """
    t = with_range_bucket(docs, keys, n_buckets, "b")
    tails = t.groupBy("b").agg(F.max(F.struct(*keys)).alias("_nb_tail"))
    order = Window.orderBy("b")  # one row for each range
    first = F.min("b").over(Window.partitionBy())
    tails = tails.select("b", "_nb_tail", F.coalesce(F.lead("b").over(order), first).alias("_nb_next"))
    here = F.struct(F.col("b"), F.lit(0).alias("ghost"))
    copy = F.struct(F.col("_nb_next").alias("b"), F.lit(1).alias("ghost"))
    is_tail = F.struct(*keys).eqNullSafe(F.col("_nb_tail"))
    rows = t.join(F.broadcast(tails), "b").withColumn(
        "_nb_to", F.explode(F.when(is_tail, F.array(here, copy)).otherwise(F.array(here))))
    return rows.select("_nb_to.b", "_nb_to.ghost", *[F.col(f"`{c}`") for c in docs.columns])


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document against itself edited and against the next document.

    The next document is the one before in ascending doc_id (the smallest is
    followed by the largest).  The edit replaces the last third of the code
    points by the first as many of the next document.  A NULL text is empty, a
    NULL doc_id comes before all others, rows of one doc_id are ordered by a
    hash of their text, a lone document is its own next.  An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n = shuffle_partitions(spark)
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    plain = plain.withColumn("h", F.xxhash64("text"))
    rows = with_neighbour(plain, ["doc_id", "h"], n * BUCKETS_PER_PARTITION)
    rows = rows.repartition(n, "b").sortWithinPartitions("b", F.desc("ghost"), "doc_id", "h")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4]

    def run(batches):
        before, before_print = "", ""
        for batch in batches:
            out = []
            for ghost, d, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = fingerprint(t.encode())
                if not ghost:
                    k = len(t) // 3
                    edited = (t[:len(t) - k] + before[:k]).encode()
                    out.append((d, len(t), hashlib.sha256(edited).hexdigest(), own, fingerprint(edited), before_print))
                before, before_print = t, own
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    done = rows.select("ghost", "doc_id", "text").mapInArrow(
        run, ", ".join(f"{c} {'long' if i < 2 else 'string'}" for i, c in enumerate(names)))
    return done.withColumns({"near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")),
                             "near_next": likeness(F.col("fingerprint"), F.col("next_fingerprint"))})
