"""Removal of long repeated word spans, by a compacted de Bruijn graph.

Edges of the graph are the ``window``-word k-mers of the texts; two edges meet
where the last words of one are the first of the other.  Writing every edge out
would cost a hundred times the text, so paths are compacted before they move:

1. Consecutive edges with the same minimizer (the smallest hash among the
   ``anchor``-word runs inside an edge) form one path, kept as one row: anchor,
   hash of the whole path, source coordinates (document, start, edges).
2. A join with the anchors that occur in several documents leaves only paths
   that can repeat.
3. A join with the distinct paths of each anchor finds the first source of
   every repeated path.  An anchor with a single path has no branch: its edges
   repeat together or not at all, and one row stands for all of them.
4. Where an anchor branches (several distinct paths), the first copy of each
   path is expanded into its edges, and those are joined edge by edge.
5. Repeated paths and edges that continue each other at the same distance from
   the same source are chained into spans.
6. Source coordinates verify each span: the words at the source are read again
   and compared with the words of the copy.  Only verified spans are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, small_batches, written
from .sharding import mix64

NO_ID = 2**63 - 1  # stands for a NULL doc_id: after every other
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F)
CACHED_WORDS = 500_000


class WordHashes(dict):
    """word -> 64-bit hash; forgets everything when full, so memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Rolling:
    """Polynomial hashes (modulo 2**64) of any run of a sequence."""

    def __init__(self, base: int):
        self.base = np.uint64(base | 1)
        self.inverse = np.uint64(pow(base | 1, -1, 2**64))
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, h: np.ndarray) -> None:
        if len(self.up) < len(h) + 1:
            n = 2 * len(h) + 2
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, self.base)], dtype=np.uint64)
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, self.inverse)], dtype=np.uint64)
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * self.up[:len(h)], out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64((self.sums[ends] - self.sums[starts]) * self.down[starts], 0)


def paths_of(h: np.ndarray, window: int, anchor: int, rolls: list[Rolling]):
    """(anchor hash, path hash, start, edges) arrays: the edges of one text, grouped by minimizer."""
    edges, span = len(h) - window + 1, window - anchor + 1
    for r in rolls:
        r.load(h)
    at = np.arange(len(h) - anchor + 1)
    a = rolls[0].runs(at, at + anchor)
    low = np.lib.stride_tricks.sliding_window_view(a, span).argmin(axis=1) + np.arange(edges)
    start = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
    n = np.diff(np.r_[start, edges])
    shape = ((low[start] - start).astype(np.uint64) << np.uint64(32)) | n.astype(np.uint64)
    whole = mix64(rolls[1].runs(start, start + n + (window - 1)) ^ shape, 1)
    return a[low[start]], whole, start, n


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64, copy=False).view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def _paths(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    names = ["d", "anchor", "path", "start", "n"]

    def run(batches):
        hashes, rolls = WordHashes(), [Rolling(b) for b in BASES[:2]]
        for batch in batches:
            out = []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = t.split()
                if len(words) >= window:
                    found = paths_of(hashes.of(words), window, anchor, rolls)
                    out.append((np.full(len(found[0]), d), *found))
            if out:
                yield pa.RecordBatch.from_arrays([_long(np.concatenate(c)) for c in zip(*out)], names=names)

    return docs.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _lists(column) -> list[list[np.ndarray]]:
    """An Arrow list<struct> column as, for each row, one array per field."""
    flat, at = column.values.flatten(), column.offsets.to_numpy()
    fields = [f.to_numpy(zero_copy_only=False) for f in flat]
    return [[f[a:b] for f in fields] for a, b in zip(at, at[1:])]


def _edges(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Single edges (two hashes, document, position) of the ``wanted`` paths (d, start, n)."""
    names = ["e1", "e2", "d", "start"]
    lists = wanted.groupBy("d").agg(F.collect_list(F.struct("start", "n")).alias("p"))

    def run(batches):
        hashes, rolls = WordHashes(), [Rolling(b) for b in BASES[1:]]
        for batch in batches:
            out = []
            for d, t, (start, n) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                        _lists(batch.column(2))):
                h = hashes.of(t.split())
                for r in rolls:
                    r.load(h)
                ends = np.cumsum(n)
                at = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(start, n)
                at = np.unique(at[at + window <= len(h)])
                out.append((*(r.runs(at, at + window) for r in rolls), np.full(len(at), d), at))
            if out:
                yield pa.RecordBatch.from_arrays([_long(np.concatenate(c)) for c in zip(*out)], names=names)

    return docs.join(lists, "d").select("d", "text", "p").mapInArrow(
        run, ", ".join(f"{c} long" for c in names))


def _span_digest(words: list[bytes], start: int, end: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[start:end]), digest_size=16).digest()


def _source_digests(docs: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    """(s, s0, n) of ``spans`` with the digest of the words found there."""
    asked = spans.select("s", "s0", "n").distinct()
    lists = asked.groupBy("s").agg(F.collect_list(F.struct("s0", "n")).alias("p"))

    def run(batches):
        for batch in batches:
            out = []
            for s, t, (s0, n) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                     _lists(batch.column(2))):
                words = t.split()
                out += [(s, a, k, _span_digest(words, a, a + k + window - 1)) for a, k in zip(s0.tolist(), n.tolist())]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 3 + [pa.binary()])],
                    names=["s", "s0", "n", "digest"])

    return docs.withColumnRenamed("d", "s").join(lists, "s").select("s", "text", "p").mapInArrow(
        run, "s long, s0 long, n long, digest binary")


def repeated_spans(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """Spans (d, start, n, s, s0): edges start .. start+n-1 of document d, found at s0 in a smaller document s."""
    paths = _paths(docs, window, anchor)
    # tables, not subplans: Spark splits hot keys of a join only where both sides are shuffled for it
    shared = written(paths.groupBy("anchor").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).where(
        "lo < hi").select("anchor"), "repeat-anchors")
    paths = written(paths.join(shared, "anchor"), "repeat-paths")
    distinct = paths.groupBy("anchor", "path").agg(F.min(F.struct("d", "start")).alias("f")).select(
        "anchor", "path", F.col("f.d").alias("s"), F.col("f.start").alias("s0"))
    branches = distinct.groupBy("anchor").agg((F.count(F.lit(1)) > 1).alias("branches"))
    distinct = written(distinct.join(branches, "anchor"), "distinct-paths")
    known = paths.join(distinct, ["anchor", "path"])
    whole = known.where("s < d").select("d", "start", "n", "s", "s0")
    edges = _edges(docs, known.where("s = d and branches").select("d", "start", "n"), window)
    first = edges.groupBy("e1", "e2").agg(F.min(F.struct("d", "start")).alias("f"), F.max("d").alias("hi")).where("f.d < hi").select(
        "e1", "e2", F.col("f.d").alias("s"), F.col("f.start").alias("s0"))
    single = edges.join(first, ["e1", "e2"]).where("s < d").select(
        "d", "start", F.lit(1).cast("long").alias("n"), "s", "s0")
    found = whole.unionByName(single)
    by = Window.partitionBy("d").orderBy("start", "n")
    follows = ((F.lag("s").over(by) == F.col("s")) & (F.lag("s0").over(by) + F.lag("n").over(by) == F.col("s0"))
               & (F.lag("start").over(by) + F.lag("n").over(by) == F.col("start")))
    chained = found.withColumn("new", F.when(follows, 0).otherwise(1)).withColumn("chain", F.sum("new").over(
        by.rowsBetween(Window.unboundedPreceding, 0)))
    return chained.groupBy("d", "chain").agg(F.min("start").alias("start"), F.sum("n").alias("n"),
                                             F.min("s").alias("s"), F.min("s0").alias("s0")).drop("chain")


def remove_repeats(docs: DataFrame, window: int = 50, anchor: int = 20,
                   doc_id: str = "doc_id", text: str = "text", as_is: bool = False) -> DataFrame:
    """``docs`` without its text (and columns named as the new ones), plus ``n_words``, ``n_removed`` and ``kept`` (the
    words that stay, joined by one space, as UTF-8 bytes; with ``as_is``, a text
    that loses nothing keeps its own spacing).

    A word goes if a window of ``window`` words covers it whose words also start
    in a document with a smaller doc_id; windows are judged on the input.  NULL
    and empty texts have no words.  A NULL doc_id comes after all others and is
    never a source for another NULL.  Rows that repeat a doc_id are judged each
    by its own words.  An empty table gives an empty result.
    """
    if not 0 < anchor <= window:
        raise ValueError("anchor must be 1 .. window words")
    small_batches(docs.sparkSession)
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))
    plain = docs.select(key.alias("d"), as_bytes(F.col(text)).alias("text"))
    spans = written(repeated_spans(plain, window, anchor), "spans")  # read twice
    sure = spans.join(_source_digests(plain, spans, window), ["s", "s0", "n"])
    lists = sure.groupBy("d").agg(F.collect_set(F.struct("start", "n", "digest")).alias("_rr_p"))
    others = [c for c in docs.columns if c not in (text, "n_words", "n_removed", "kept")]
    full = docs.select(key.alias("d"), as_bytes(F.col(text)).alias("text"), *[
        F.col(f"`{c}`").alias(f"_rr_o{i}") for i, c in enumerate(others)])

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for t, spans in zip(batch.column("text").to_pylist(), batch.column("_rr_p").to_pylist()):
                words = t.split()
                marks = np.zeros(len(words) + 1, np.int64)
                for s in spans or ():
                    a, b = s["start"], s["start"] + s["n"] + window - 1
                    if b <= len(words) and _span_digest(words, a, b) == s["digest"]:
                        marks[a] += 1
                        marks[b] -= 1
                gone = (np.cumsum(marks[:-1]) > 0).tolist()
                n_words.append(len(words))
                n_removed.append(sum(gone))
                kept.append(t if as_is and not n_removed[-1] else b" ".join(
                    [w for w, g in zip(words, gone) if not g] if n_removed[-1] else words))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f"_rr_o{i}") for i in range(len(others))),
                 pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
                names=out.names)

    out = full.select(*[f"_rr_o{i}" for i in range(len(others))]).schema.add("n_words", "long").add(
        "n_removed", "long").add("kept", "binary")
    done = full.join(lists, "d", "left").mapInArrow(run, out)
    return done.select(*[F.col(f"_rr_o{i}").alias(c) for i, c in enumerate(others)],
                       "n_words", "n_removed", "kept")
