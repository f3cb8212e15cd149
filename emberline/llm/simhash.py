"""SimHash near-duplicates through pivot distance tables.

Each distinct fingerprint gets a table of Hamming distances to many reference
fingerprints (pivots), computed once.  Two kinds of pivots serve two steps:

* mask pivots (all zeros, and one pivot for each of 32 neighbouring bit pairs):
  the distance to a mask, less the distance to zero, moves only if a bit of its
  pair differs.  Fingerprints with at most ``max_bits`` differing bits disagree
  in at most that many of these coordinates, so of the six groups the pairs are
  dealt into at least ``6 - max_bits`` agree entirely; each choice of that many
  groups is a key on which pairs meet in an ordinary equi-join.
* spread pivots (pseudo-random fingerprints): by the triangle inequality no
  coordinate of a linked pair differs by more than ``max_bits``, so pairs with a
  larger maximum coordinate difference are discarded.

Survivors are verified by the Hamming distance of the fingerprints themselves.
Copies share a fingerprint and enter the join once.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, small_batches, written
from .components import components
from .sharding import mix64

SEED = 42
NO_ID = 2**63 - 1  # stands for a NULL doc_id
PAIRS, GROUPS, SPREAD = 32, 6, 16


def fingerprint_of(words: list[bytes], width: int) -> int:
    """Unsigned 64-bit SimHash of the ``width``-word shingles of ``words``."""
    if not words:
        return 0
    if len(words) > width:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
        n = len(words) - width + 1
    else:
        shingles, n = [b" ".join(words)], 1
    h64 = xxhash.xxh64_intdigest
    h = np.fromiter((h64(s, SEED) for s in shingles), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_key, fp): fp holds the 64 bits as a signed long, row_key a hash of
    the text.  NULL texts count as empty."""
    small_batches(docs.sparkSession)
    names = ["doc_id", "row_key", "fp"]

    def run(batches):
        for batch in batches:
            fps = [fingerprint_of(t.lower().split(), width) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())], names=names)

    # bytes.lower() and bytes.split() act on ASCII letters and on the six ASCII spaces only
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(text), as_bytes(F.col(text))).mapInArrow(
        run, ", ".join(f"{c} long" for c in names))


def row_key(text: str) -> Column:
    """Tells rows of one doc_id apart by their text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("row_key")


def pivots() -> tuple[list[int], list[int]]:
    """Mask pivots (zero first) and spread pivots, as unsigned 64-bit numbers."""
    masks = [0, *(3 << (2 * i) for i in range(PAIRS))]
    spread = [int(x) for x in mix64(np.arange(SPREAD, dtype=np.uint64), 1)]
    return masks, spread


def _distance(fp: Column, pivot: int) -> Column:
    signed = pivot - 2**64 if pivot >= 2**63 else pivot
    return F.bit_count(fp.bitwiseXOR(F.lit(signed).cast("long")))


def pivot_table(fps: DataFrame, max_bits: int) -> DataFrame:
    """fps (fp) plus ``keys``: one per choice of mask-coordinate groups, and the
    spread coordinates ``near``, one byte each, packed into longs."""
    masks, spread = pivots()
    fp = F.col("fp")
    coords = [(_distance(fp, m) - _distance(fp, masks[0])).cast("tinyint") for m in masks[1:]]
    near = []
    for at in range(0, SPREAD, 8):
        word = F.lit(0).cast("long")
        for j, p in enumerate(spread[at:at + 8]):
            word = word.bitwiseOR(F.shiftleft(_distance(fp, p).cast("long"), 8 * j))
        near.append(word)
    t = fps.select("fp", F.array(*coords).alias("c"), *[n.alias(f"near{i}") for i, n in enumerate(near)])
    group = [F.array(*[F.get("c", F.lit(i)) for i in range(g, PAIRS, GROUPS)]) for g in range(GROUPS)]
    keys = [F.xxhash64(F.lit(k), *[group[g] for g in pick])
            for k, pick in enumerate(combinations(range(GROUPS), GROUPS - max_bits))]
    return t.select("fp", F.explode(F.array(*keys)).alias("key"), *[f"near{i}" for i in range(len(near))])


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Linked pairs (u > v) of distinct fingerprints ``fp``."""
    if not 0 <= max_bits < GROUPS:
        raise ValueError(f"max_bits must be 0 .. {GROUPS - 1}")
    t = pivot_table(fps, max_bits)
    a, b = (t.select("key", *[F.col(c).alias(f"{c}_{s}") for c in t.columns if c != "key"]) for s in "ab")
    gap = [F.abs(F.shiftright(f"near{i}_a", 8 * j).bitwiseAND(255) - F.shiftright(f"near{i}_b", 8 * j).bitwiseAND(255))
           for i in range(SPREAD // 8) for j in range(8)]
    kept = (F.greatest(*gap) <= max_bits) & (
        F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= max_bits)
    pairs = a.join(b, (a["key"] == b["key"]) & (F.col("fp_a") > F.col("fp_b")) & kept)
    return pairs.select(F.col("fp_a").alias("u"), F.col("fp_b").alias("v")).distinct()


def _classes(docs: DataFrame, width: int, max_bits: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, row_key, fp), and for each distinct fp its class (the smallest fp
    reachable) and its first row: smallest doc_id, NULL last, then smallest row_key."""
    own = written(fingerprints(docs, width, doc_id, text), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key"))
    distinct = written(own.groupBy("fp").agg(first.alias("first")), "fingerprints")
    found = components(links(distinct.select("fp"), max_bits))
    return own, distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("class"))


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    ``component_id`` is the smallest doc_id reachable over links (NULL ids count
    last: NULL only if a component has no other).  Repeated rows come back each.
    Texts without words have fingerprint zero and link like any other; a text of
    fewer words than ``width`` is one shingle.  An empty table gives none.
    """
    own, classes = _classes(docs, width, max_bits, doc_id, text)
    lowest = classes.groupBy("class").agg(F.min("first.doc_id").alias("component_id"))
    member = written(classes.join(lowest, "class").select("fp", "component_id"), "members")
    return own.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 3, max_bits: int = 2,
             doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their class: one of each, that of the smallest
    doc_id (NULL ids last; of rows that repeat it, that of the smallest text hash)."""
    _, classes = _classes(docs, width, max_bits, doc_id, text)
    stay = classes.groupBy("class").agg(F.min("first").alias("k")).select(
        F.coalesce("k.doc_id", F.lit(NO_ID)).alias("_ko_id"), F.col("k.row_key").alias("_ko_key")).distinct()
    keyed = docs.withColumns({"_ko_id": F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), "_ko_key": row_key(text)})
    return keyed.join(stay, ["_ko_id", "_ko_key"], "left_semi").dropDuplicates(["_ko_id", "_ko_key"]).drop("_ko_id", "_ko_key")
