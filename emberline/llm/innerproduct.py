"""Exact top-k by inner product over vectors in descending order of length.

Candidates are ranged by length into blocks, longest first.  The block of the
longest vectors gives every query a first k-th best score; after that

* a block whose longest vector cannot reach it (Cauchy-Schwarz: the product of
  the lengths) is never joined with the query's block, and inside a block the
  walk from long to short ends there;
* both sides are rotated by the right singular vectors of the data, so the
  first coordinates carry most of the product; the rest is bounded by the
  product of the residual lengths, and only pairs whose partial sum plus bound
  reaches the k-th best score are multiplied out, in integers.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.row_id import with_range_bucket
from .common import small_batches, written

QUERY_BLOCK, BLOCK, STEP, LEADING = 512, 2048, 256, 16
MAX_RANGES = 4096
NONE = -(2**63)
LONGEST = 2.0 ** 62  # squared; no product of two shorter vectors passes 64 bits


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, v, n2): floor(scale * x) of every component, and the squared length.

    Rows without an id, and vectors that are NULL or hold a NULL or non-finite
    component, take no part.  Of repeated ids the smallest vector counts.
    """
    x = F.col(vector)
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return (df.where(F.col(vec_id).isNotNull() & x.isNotNull() & good)
            .select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v"))
            .withColumn("n2", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))))


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r  # a shorter vector has zeros at its end
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all rows, strongest first: from the width x width Gram matrix."""
    def run(batches):
        gram = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch.column(0).to_pylist(), width).astype(float)
            gram += m.T @ m
        i, j = np.indices(gram.shape)
        yield pa.RecordBatch.from_arrays([pa.array(a.ravel()) for a in (i, j, gram)], names=["i", "j", "g"])

    gram = np.zeros((width, width))
    for r in vectors.select("v").mapInArrow(run, "i long, j long, g double").groupBy("i", "j").agg(
            F.sum("g").alias("g")).collect():  # width * width numbers
        gram[r.i, r.j] = r.g
    return np.linalg.eigh(gram)[1][:, ::-1]


def _blocks(rows: DataFrame, width: int, size: int) -> DataFrame:
    """Sorted rows (part, vec_id, v, low) packed into binary blocks of at most ``size`` vectors."""
    schema = "part long, block string, longest double, floor double, ids binary, vs binary, lows binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        import uuid

        def pack(part, held):
            ids, vs, lows = zip(*held)
            m, low = _matrix(vs, width), np.array(lows, np.int64)
            lengths = np.sqrt((m.astype(float) ** 2).sum(axis=1))
            reach = np.where(low == NONE, -np.inf, low / np.maximum(lengths, 1e-300))
            return part, uuid.uuid4().hex, float(lengths.max()), float(reach.min()), \
                np.array(ids, np.int64).tobytes(), m.tobytes(), low.tobytes()

        at, held, out = None, [], []
        for batch in batches:
            for part, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (part != at or len(held) == size):
                    out.append(pack(at, held))
                    held = []
                at = part
                held.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)
                out = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in pack(at, held)], names=names)

    return rows.select("part", "vec_id", "v", "low").mapInArrow(run, schema)


def search_block(q: np.ndarray, q_ids: np.ndarray, low: np.ndarray, c: np.ndarray, c_ids: np.ndarray,
                 turn: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The k best (query id, candidate id, score) of each query, if not under its ``low``.

    Candidates come by descending length.  Every bound is widened by more than
    the rounding error of the rotated coordinates.
    """
    lead = min(LEADING, q.shape[1])
    qr, cr = q @ turn, c @ turn
    q_len, c_len = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    q_rest, c_rest = np.linalg.norm(qr[:, lead:], axis=1), np.linalg.norm(cr[:, lead:], axis=1)
    low = np.where(low == NONE, -np.inf, low.astype(float))
    best: list[list[tuple[int, int]]] = [[] for _ in q_ids]
    for at in range(0, len(c), STEP):
        part = slice(at, at + STEP)
        on = np.flatnonzero(q_len * c_len[at] * (1 + 1e-9) + 1e-6 >= low)
        if not len(on):
            break
        bound = qr[on, :lead] @ cr[part, :lead].T + np.outer(q_rest[on], c_rest[part])
        slack = 1e-9 * np.outer(q_len[on], c_len[part]) + 1e-6
        i, j = np.nonzero(bound + slack >= low[on, None])
        i, j = on[i], j + at
        own = q_ids[i] == c_ids[j]
        i, j = i[~own], j[~own]
        for a in range(0, len(i), 1 << 16):
            some = slice(a, a + (1 << 16))
            scores = np.einsum("ij,ij->i", q[i[some]], c[j[some]])
            for n, x, s in zip(i[some].tolist(), c_ids[j[some]].tolist(), scores.tolist()):
                heap = best[n]
                if s < low[n]:
                    continue
                if len(heap) < k:
                    heapq.heappush(heap, (s, -x))
                elif (s, -x) > heap[0]:
                    heapq.heapreplace(heap, (s, -x))
                if len(heap) == k:
                    low[n] = max(low[n], heap[0][0])
    return [(int(q_ids[n]), -x, s) for n, heap in enumerate(best) for s, x in heap]


def _search(pairs: DataFrame, turn: np.ndarray, k: int) -> DataFrame:
    width = len(turn)

    def run(batches):
        for batch in batches:
            out = []
            for q_ids, qs, lows, c_ids, cs in zip(*(c.to_pylist() for c in batch.columns)):
                q, c = (np.frombuffer(b, np.int64).reshape(-1, width) for b in (qs, cs))
                out += search_block(q, np.frombuffer(q_ids, np.int64), np.frombuffer(lows, np.int64), c,
                                    np.frombuffer(c_ids, np.int64), turn, k)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 names=["query_id", "vec_id", "score"])

    return pairs.select("q_ids", "q_vs", "q_lows", "ids", "vs").mapInArrow(
        run, "query_id long, vec_id long, score long")


def top_k(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id",
          vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query row.

    Candidates are all rows but the query's own; ties go to the smaller id; a
    query with fewer candidates gets them all.  Vectors of unequal length are
    compared as if the shorter ended in zeros.  No query or no row: empty.
    Every task holds a matrix as wide and as high as the longest vector.  Scores
    are 64-bit integers: vectors so long that a product could pass them raise an error.
    """
    spark = df.sparkSession
    small_batches(spark)
    vectors = written(integer_vectors(df, vec_id, vector, scale), "vectors")
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"), F.max("n2").alias("n2")).first()
    if (size.n2 or 0.0) >= LONGEST:
        raise ValueError("a vector's squared length is beyond 2^62; scale it down")
    width = max(1, size.d or 0)
    turn = rotation(vectors, width)
    ranges = max(1, min(MAX_RANGES, -(-size.n // (2 * BLOCK))))
    short = vectors.withColumn("short", -F.col("n2"))
    ranged = with_range_bucket(short, ["short", "vec_id"], ranges, "part").withColumn("low", F.lit(NONE))
    sorted_ = ranged.repartition(ranges, "part").sortWithinPartitions("part", "short", "vec_id")
    blocks = written(_blocks(sorted_, width, BLOCK), "blocks")
    first = blocks.agg(F.min("part")).first()[0]
    queries = vectors.where(is_query)

    def query_blocks(lows: DataFrame) -> DataFrame:
        q = queries.join(lows, "vec_id", "left").withColumn("low", F.coalesce("low", F.lit(NONE)))
        tasks = max(1, -(-size.n // (100 * QUERY_BLOCK)))
        q = q.repartition(tasks).select(F.lit(0).cast("long").alias("part"), "vec_id", "v", "low")
        return written(_blocks(q, width, QUERY_BLOCK), "queries").select(
            F.col("block").alias("q_block"), "floor", F.col("ids").alias("q_ids"), F.col("vs").alias("q_vs"),
            F.col("lows").alias("q_lows"))

    def best(found: DataFrame) -> DataFrame:
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    # the longest range (a bounded number of vectors) against all queries
    none = queries.select("vec_id", F.lit(NONE).alias("low")).limit(0)
    opening = query_blocks(none).join(blocks.where(F.col("part") == first).select("ids", "vs"))
    seeds = written(best(_search(opening.repartition(
        max(1, spark.sparkContext.defaultParallelism)), turn, k)), "seeds")
    lows = seeds.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("low"))
    # all other ranges against the query blocks they can still reach: first the
    # blocks' names and bounds alone, then the vectors by equi-joins
    asked = query_blocks(lows)
    rest = blocks.where(F.col("part") != first)
    meet = rest.select("block", "longest").join(
        asked.select("q_block", "floor"), F.col("longest") * (1 + 1e-9) + 1e-6 >= F.col("floor"))
    pairs = meet.join(asked.drop("floor"), "q_block").join(rest.select("block", "ids", "vs"), "block")
    later = _search(pairs.repartition(max(1, 2 * spark.sparkContext.defaultParallelism)), turn, k)
    return best(seeds.drop("rank").unionByName(later)).select("query_id", "rank", "vec_id", "score")
