"""Katz backoff language model over words, counted and evaluated in blocks.

Texts are read once into blocks of about ``BLOCK_TOKENS`` tokens: the distinct
word hashes of the block and, for each token, the place of its word among them.
No row is ever made for a single token: a block asks for each of its distinct
words and word pairs once.  The model is two stored tables partitioned by hash
range, a row of sorted arrays for each partition:

1. words (hash, number, count): every block sends its distinct words with their
   counts in training texts to the partition of the word's hash, which adds them
   up, numbers the words it has seen and stores them.
2. pairs (context, word, count) and contexts (what the backoff weight is made of):
   every block sends its distinct pairs, as numbers, to the partition of the
   context, which adds up and stores them.  Contexts so frequent that they would
   fill a partition are split by the word as well.
3. evaluation: a block's words and pairs are looked up in the rows of their
   partitions.  P(w|h) = d(c) c(h,w) / c(h) if the pair was seen, else
   alpha(h) P(w); P(w) = d(c) c(w) / N if the word was seen, else the mass the
   discounts freed, as the one event "unknown word".  alpha(h) is the mass that
   the discounts free after h over the mass of the words not seen after h, so
   the probabilities after every context sum to one.

The corpus that is counted is looked up where it is counted, while its questions
are there; ``KatzModel.score`` joins the questions of any other texts with the
stored tables.

Discounts are Good-Turing's for counts up to ``CUT``.  Context sums of the few
split contexts (at most 4 for each partition) are the only table that every
task receives.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, ensure_checkpoint_dir, shuffle_partitions
from .common import Tables, as_bytes, small_batches, written
from .sharding import mix64

BLOCK_TOKENS = 1 << 20
CUT = 5
END, BEGIN = xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" begin")  # no word holds a space
NO_ID = 2**63 - 1
UNSEEN = np.uint64(2**64 - 1)  # in place of the number of a word that training texts lack


def pack(x: np.ndarray) -> bytes:
    """An integer or float array, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def good_turing(n: dict[int, int]) -> list[float]:
    """Discount factors d[0..CUT] (d[0] unused) from counts of counts n[1..CUT+1].

    Katz's formula where it gives factors between 0 and 1; else from counts of
    counts smoothed by a line through their logarithms; else half a count off.
    """
    def proper(d: list[float]) -> bool:
        return all(0 < x < 1 for x in d)

    r = range(1, CUT + 1)
    if all(n.get(i, 0) > 0 for i in range(1, CUT + 2)):
        a = (CUT + 1) * n[CUT + 1] / n[1]
        if a < 1:
            d = [((i + 1) * n[i + 1] / (i * n[i]) - a) / (1 - a) for i in r]
            if proper(d):
                return [1.0, *d]
    seen = [i for i in range(1, CUT + 2) if n.get(i, 0) > 0]
    if len(seen) > 1:
        slope = float(np.polyfit(np.log(seen), np.log([n[i] for i in seen]), 1)[0])
        d = [((i + 1) / i) ** (slope + 1) for i in r]
        if proper(d):
            return [1.0, *d]
    return [1.0, *((i - 0.5) / i for i in r)]


class Unigrams:
    """P(w) from a word's count: discounted, with the freed mass for the unknown word."""

    def __init__(self, total: int, distinct: int, of_counts: dict[int, int]):
        self.total, self.distinct = total, distinct
        self.d = np.array([*good_turing(of_counts), 1.0])
        freed = sum((1 - self.d[r]) * r * of_counts.get(r, 0) for r in range(1, CUT + 1))
        self.mass, self.all = (freed, total) if freed > 0 else (1.0, total + 1)

    def p(self, c: np.ndarray) -> np.ndarray:
        c = c.astype(float)
        return np.where(c > 0, self.d[np.minimum(c, CUT + 1).astype(int)] * c, self.mass) / max(self.all, 1)


def _write_blocks(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """The blocks of (d, held, text), as a table bucketed by block, so that later
    joins on the block move only what is joined to it; its name and path."""
    schema = "block long, ids binary, held binary, lens binary, vocab binary, toks binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        def flush():
            hashes = np.array([w if isinstance(w, int) else xxhash.xxh64_intdigest(w) for w in index], np.uint64)
            vocab, place = np.unique(hashes, return_inverse=True)
            row = (uuid.uuid4().int >> 65, pack(np.array(ids, np.int64)), pack(np.array(held, np.uint8)),
                   pack(np.array([len(x) for x in toks], np.int64)), pack(vocab),
                   pack(place.astype(np.uint32)[np.concatenate(toks)]))
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=names)

        def fresh():
            places = defaultdict(count().__next__)
            places[BEGIN], places[END]
            return places, [], [], [], 0

        index, ids, held, toks, size = fresh()
        for batch in batches:
            for d, out, t in zip(*(c.to_pylist() for c in batch.columns)):
                words = t.lower().split()
                words.append(END)
                toks.append(np.fromiter(map(index.__getitem__, words), np.uint32, len(words)))
                ids.append(d)
                held.append(out)
                size += len(words)
                if size >= BLOCK_TOKENS:
                    yield flush()
                    index, ids, held, toks, size = fresh()
        if ids:
            yield flush()

    spark = docs.sparkSession
    name = f"katz_blocks_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/{name}"
    docs.mapInArrow(run, schema).write.format("parquet").bucketBy(shuffle_partitions(spark), "block").option(
        "path", path).saveAsTable(name)
    return spark.table(name), name, path


class Block:
    """One block's arrays."""

    def __init__(self, ids, held, lens, vocab, toks):
        self.ids, self.held, self.lens = unpack(ids, np.int64), unpack(held, np.uint8), unpack(lens, np.int64)
        self.vocab, self.toks = unpack(vocab, np.uint64), unpack(toks, np.uint32)
        self.train = np.repeat(self.held == 0, self.lens)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.toks[self.train], minlength=len(self.vocab))

    def cuts(self, hashes: np.ndarray, bits: int) -> np.ndarray:
        """Where each partition begins in sorted hashes, and the end."""
        starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        return np.append(np.searchsorted(hashes, starts), len(hashes))

    def pairs(self, c: np.ndarray, number: np.ndarray, hot_from: int, bits: int):
        """Distinct pairs in the order they are sent in: context and word places, the
        partition bounds, and for each token the place of its pair.  ``c`` and ``number`` are
        the words' training counts and numbers; contexts counted ``hot_from`` times or more are split."""
        begin, end = (np.searchsorted(self.vocab, np.uint64(x)) for x in (BEGIN, END))
        before = np.empty_like(self.toks)
        before[1:] = self.toks[:-1]
        before[np.cumsum(self.lens) - self.lens] = begin
        by = np.argsort(number, kind="stable")    # sent in the order of the numbers, which packs better
        rank = np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        keys, place = np.unique(rank[before] * len(self.vocab) + rank[self.toks], return_inverse=True)
        h, w = by[keys // len(self.vocab)], by[keys % len(self.vocab)]
        times = c.copy()
        times[begin] = c[end]
        hot = times[h] >= hot_from
        at = self.vocab[h].copy()
        at[hot] = mix64(at[hot] ^ self.vocab[w[hot]], 2)
        part = (at >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        bounds = np.searchsorted(part[order], np.arange((1 << bits) + 1))
        return h[order], w[order], hot[order], bounds, back[place]


ARRAYS = ["ids", "held", "lens", "vocab", "toks"]


def _blocks_in(batch, first: int = 1):
    for row in zip(*(c.to_pylist() for c in batch.columns)):
        yield row[0], Block(*row[first:first + len(ARRAYS)]), row[first + len(ARRAYS):]


def _ask_words(blocks: DataFrame, bits: int) -> DataFrame:
    """(part, block, words, c): each block's words of a partition, with its training counts."""
    def ask(batches):
        for batch in batches:
            for name, b, _ in _blocks_in(batch):
                c, cut = b.word_counts().astype(np.uint32), b.cuts(b.vocab, bits)
                rows = [(p, name, pack(b.vocab[x:y]), pack(c[x:y])) for p, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col, k) for col, k in zip(zip(*rows), [pa.int32(), pa.int64(), pa.binary(), pa.binary()])],
                    names=["part", "block", "words", "c"])

    return blocks.select("block", *ARRAYS).mapInArrow(ask, "part int, block long, words binary, c binary")


WORDS = "block long, part int, c binary, number binary, words binary, total long, of_counts array<long>"
_WORD_KINDS = [pa.int64(), pa.int32(), *[pa.binary()] * 3, pa.int64(), pa.list_(pa.int64())]


def _rows(rows: list[tuple], schema: str, kinds: list) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                names=[c.split()[0] for c in schema.split(", ")])


def _look_up_words(t: pa.Table, asked: list, own: np.ndarray, c: np.ndarray, number: np.ndarray) -> list[tuple]:
    """Each block's counts and numbers of the words it asked for, from a partition's sorted words."""
    rows = []
    for block, part, words in zip(t["block"].to_pylist(), t["part"].to_pylist(), asked):
        i = np.minimum(np.searchsorted(own, words), max(len(own) - 1, 0))
        known = own[i] == words if len(own) else np.zeros(len(words), bool)
        rows.append((block, part, pack(np.where(known, c[i], 0) if len(own) else np.zeros(len(words), np.int64)),
                     pack(np.where(known, number[i], UNSEEN) if len(own) else np.full(len(words), UNSEEN)), None, None, None))
    return rows


def _word_table(blocks: DataFrame, bits: int) -> DataFrame:
    """The stored words, a row for each partition whose block is NULL: (part, c, number, words,
    total, of_counts: distinct words by count up to CUT + 1, more), and the answers to each
    block (block, part, c, number)."""
    def answer(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        asked = [unpack(x, np.uint64) for x in t["words"].to_pylist()]
        own, place = np.unique(np.concatenate(asked), return_inverse=True)
        c = np.bincount(place, np.concatenate([unpack(x, np.uint32) for x in t["c"].to_pylist()])).astype(np.int64)
        kept = (c > 0) | (own == np.uint64(BEGIN))
        own, c = own[kept], c[kept]
        part = t["part"][0].as_py()
        rank = np.empty(len(own), np.uint64)
        rank[np.argsort(-c, kind="stable")] = np.arange(len(own), dtype=np.uint64)
        number = rank << np.uint64(bits) | np.uint64(part)      # small for frequent words, once in all partitions
        seen = np.bincount(np.minimum(c[c > 0], CUT + 2), minlength=CUT + 3)
        return _rows([*_look_up_words(t, asked, own, c, number),
                      (None, part, pack(c), pack(number), pack(own), int(c.sum()), seen.tolist())], WORDS, _WORD_KINDS)

    return _ask_words(blocks, bits).groupBy("part").applyInArrow(answer, WORDS)


def _join_words(blocks: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """The answers of a stored word table to the blocks of any texts."""
    def answer(t: pa.Table, stored: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _rows([], WORDS, _WORD_KINDS)
        t = t.combine_chunks()
        own, c, number = ((unpack(stored[k][0].as_py(), kind) if stored.num_rows else np.empty(0, kind))
                          for k, kind in (("words", np.uint64), ("c", np.int64), ("number", np.uint64)))
        return _rows(_look_up_words(t, [unpack(x, np.uint64) for x in t["words"].to_pylist()], own, c, number), WORDS, _WORD_KINDS)

    return _ask_words(blocks, bits).groupBy("part").cogroup(words.groupBy("part")).applyInArrow(answer, WORDS)


STATS = CUT + 2  # pairs counted 1 .. CUT times, sum of larger counts, sum of all counts


def _context_stats(h: np.ndarray, c: np.ndarray, p: np.ndarray):
    """Distinct contexts of distinct seen pairs, their STATS and the sum of their words' P(w)."""
    own, place = np.unique(h, return_inverse=True)
    n = len(own)
    stats = np.zeros((STATS, n), np.int64)
    for r in range(1, CUT + 1):
        stats[r - 1] = np.bincount(place[c == r], minlength=n)
    stats[CUT] = np.bincount(place[c > CUT], c[c > CUT], minlength=n)
    stats[CUT + 1] = np.bincount(place, c, minlength=n)
    return own, stats, np.bincount(place, p, minlength=n)


def _counts_of(words: DataFrame) -> DataFrame:
    """(block, words): each block's answers, by partition."""
    return words.where("block is not null").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("part", "c", "number"))).alias("words"))


def _joined(answers: list) -> tuple[np.ndarray, np.ndarray]:
    """A block's word counts and numbers."""
    return (np.concatenate([unpack(a["c"], np.int64) for a in answers]),
            np.concatenate([unpack(a["number"], np.uint64) for a in answers]))


def _ask_pairs(blocks: DataFrame, words: DataFrame, bits: int, hot_from: int) -> DataFrame:
    """(part, block, h, n, hot, w, c, cw): each block's pairs of a partition by the numbers of
    their words: the contexts, how many pairs each has, and the pairs' words and counts."""
    def ask(batches):
        for batch in batches:
            for name, b, (answers,) in _blocks_in(batch):
                c, number = _joined(answers)
                h, w, hot, bounds, place = b.pairs(c, number, hot_from, bits)
                mine = np.bincount(place[b.train], minlength=len(h)).astype(np.uint32)
                rows = []
                for p, (x, y) in enumerate(zip(bounds, bounds[1:])):
                    if y > x:
                        runs = np.flatnonzero(np.r_[True, h[x + 1:y] != h[x:y - 1]])
                        rows.append((p, name, pack(number[h[x:y][runs]]), pack(np.diff(np.r_[runs, y - x]).astype(np.uint32)),
                                     pack(hot[x:y][runs].astype(np.uint8)), pack(number[w[x:y]]), pack(mine[x:y]), pack(c[w[x:y]])))
                for at in range(0, len(rows), 8):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(col, k) for col, k in zip(zip(*rows[at:at + 8]), [pa.int32(), pa.int64(), *[pa.binary()] * 6])],
                        names=["part", "block", "h", "n", "hot", "w", "c", "cw"])

    return blocks.select("block", *ARRAYS).join(_counts_of(words), "block").select("block", *ARRAYS, "words").mapInArrow(
        ask, "part int, block long, h binary, n binary, hot binary, w binary, c binary, cw binary")


def _asked_pairs(t: pa.Table):
    """Of each block its contexts, their pair counts and hot flags; context and word of every pair."""
    hs, ns, hots = ([unpack(x, k) for x in t[c].to_pylist()] for c, k in (("h", np.uint64), ("n", np.uint32), ("hot", np.uint8)))
    return hs, ns, hots, np.repeat(np.concatenate(hs), np.concatenate(ns)), np.concatenate([unpack(x, np.uint64) for x in t["w"].to_pylist()])


def _distinct(h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs: where each distinct one first stands, in order, and the place of each pair among them."""
    order = np.lexsort((w, h))
    new = np.flatnonzero(np.r_[True, (h[order[1:]] != h[order[:-1]]) | (w[order[1:]] != w[order[:-1]])][:len(order)])
    place = np.empty_like(order)
    place[order] = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(order)]))
    return order[new], place


PAIRS = ("block long, part int, c binary, stats binary, sums binary, h binary, n binary, w binary, "
         "hot long, hot_stats array<long>, hot_sum double, of_counts array<long>")
_PAIR_KINDS = [pa.int64(), pa.int32(), *[pa.binary()] * 6, pa.int64(), pa.list_(pa.int64()), pa.float64(), pa.list_(pa.int64())]


def _look_up_pairs(t: pa.Table, hs, ns, hots, c: np.ndarray, own: np.ndarray, stats: np.ndarray, sums: np.ndarray) -> list[tuple]:
    """Each block's pair counts ``c`` and what the backoff weights of its contexts need, from a
    partition's sorted contexts; split contexts are left to their sums."""
    ends, rows = np.cumsum([int(n.sum()) for n in ns]), []
    for name, part, mine, n, split, e in zip(t["block"].to_pylist(), t["part"].to_pylist(), hs, ns, hots, ends):
        ask_for = mine[split == 0]
        i = np.minimum(np.searchsorted(own, ask_for), max(len(own) - 1, 0))
        ok = (own[i] == ask_for) if len(own) else np.zeros(len(ask_for), bool)
        got = np.where(ok, stats[:, i], 0) if len(own) else np.zeros((STATS, len(ask_for)), np.int64)
        sure = np.where(ok, sums[i], 0.0) if len(own) else np.zeros(len(ask_for))
        rows.append((name, part, pack(c[e - int(n.sum()):e]), pack(got.ravel()), pack(sure), *[None] * 7))
    return rows


def _pair_table(blocks: DataFrame, words: DataFrame, uni: Unigrams, bits: int, hot_from: int) -> DataFrame:
    """The stored pairs, a row for each partition whose h is not NULL: (part, h, n, w, c: contexts, how
    many pairs each has, the pairs' words and counts; stats, sums of the contexts), the answers to
    each block (block, part, c, stats, sums), and (hot, hot_stats, hot_sum) for split contexts."""
    def answer(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        hs, ns, hots, h, w = _asked_pairs(t)
        at, place = _distinct(h, w)
        c = np.bincount(place, np.concatenate([unpack(x, np.uint32) for x in t["c"].to_pylist()])).astype(np.int64)
        cw = np.concatenate([unpack(x, np.int64) for x in t["cw"].to_pylist()])[at]
        seen = c > 0
        own, stats, sums = _context_stats(h[at][seen], c[seen], uni.p(cw[seen]))
        hot_set = np.unique(np.concatenate(hs)[np.concatenate(hots) > 0])
        rows = _look_up_pairs(t, hs, ns, hots, c[place], own, stats, sums)
        n = np.diff(np.r_[np.searchsorted(h[at][seen], own), int(seen.sum())]).astype(np.uint32)
        rows.append((None, t["part"][0].as_py(), pack(c[seen]), pack(stats.ravel()), pack(sums), pack(own), pack(n), pack(w[at][seen]),
                     None, None, None, np.bincount(np.minimum(c[seen], CUT + 2), minlength=CUT + 3).tolist()))
        for x in hot_set[np.isin(hot_set, own)]:
            i = int(np.searchsorted(own, x))
            rows.append((*[None] * 8, int(x.view(np.int64)), stats[:, i].tolist(), float(sums[i]), None))
        return _rows(rows, PAIRS, _PAIR_KINDS)

    return _ask_pairs(blocks, words, bits, hot_from).groupBy("part").applyInArrow(answer, PAIRS)


def _join_pairs(blocks: DataFrame, words: DataFrame, pairs: DataFrame, bits: int, hot_from: int) -> DataFrame:
    """The answers of a stored pair table to the blocks of any texts."""
    def answer(t: pa.Table, stored: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _rows([], PAIRS, _PAIR_KINDS)
        t = t.combine_chunks()
        hs, ns, hots, h, w = _asked_pairs(t)
        own, n, w0, c0, stats, sums = ((unpack(stored[k][0].as_py(), kind) if stored.num_rows else np.empty(0, kind)) for k, kind in (
            ("h", np.uint64), ("n", np.uint32), ("w", np.uint64), ("c", np.int64), ("stats", np.int64), ("sums", np.float64)))
        at, place = _distinct(np.concatenate([np.repeat(own, n), h]), np.concatenate([w0, w]))
        c = np.zeros(len(at), np.int64)
        c[place[:len(w0)]] = c0
        return _rows(_look_up_pairs(t, hs, ns, hots, c[place[len(w0):]], own, stats.reshape(STATS, -1), sums), PAIRS, _PAIR_KINDS)

    return _ask_pairs(blocks, words, bits, hot_from).groupBy("part").cogroup(pairs.groupBy("part")).applyInArrow(answer, PAIRS)


def backoff(stats: np.ndarray, sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each context: alpha, the divisor of its counts, and whether discounts apply.

    A context whose pairs were all seen more than CUT times frees no mass: one
    count is added to its divisor instead.  An unseen context has alpha 1.
    """
    r = np.arange(1, CUT + 1)[:, None]
    total = stats[CUT + 1].astype(float)
    kept = (d[1:CUT + 1, None] * r * stats[:CUT]).sum(axis=0) + stats[CUT]
    cut = stats[:CUT].any(axis=0)
    over = np.where(cut, total, total + 1)
    alpha = (1 - np.where(cut, kept, total) / np.maximum(over, 1)) / np.maximum(1 - sums, 1e-300)
    return np.where(total > 0, alpha, 1.0), over, cut


@dataclass
class KatzModel:
    """``words`` (part, words, number, c) and ``pairs`` (part, h, n, w, c, stats, sums): the stored
    tables, a row for each hash range; ``d``: the pairs' discount factors; ``hot``: numbers, STATS
    and sums of the split contexts."""

    words: DataFrame
    pairs: DataFrame
    uni: Unigrams
    d: np.ndarray
    bits: int
    hot_from: int
    hot: tuple[np.ndarray, np.ndarray, np.ndarray]

    def score(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """The rows of the module's ``score`` for any texts, none of which is learnt from."""
        small_batches(docs.sparkSession)
        blocks, name, path = _write_blocks(_source(docs, F.lit(True), doc_id, text))
        tables = Tables(docs.sparkSession)
        words = tables.written(_join_words(blocks, self.words, self.bits), "words")
        pairs = tables.written(_join_pairs(blocks, words, self.pairs, self.bits, self.hot_from), "pairs")
        return _finished(self._evaluate(blocks, words, pairs), name, path, tables)

    def _evaluate(self, blocks: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        uni, d, bits, hot_from, (hot_h, hot_stats, hot_sum) = self.uni, self.d, self.bits, self.hot_from, self.hot

        def run(batches):
            by = np.argsort(hot_h)
            for batch in batches:
                for _, b, (answers, found) in _blocks_in(batch):
                    c, number = _joined(answers)
                    h, w, split, bounds, place = b.pairs(c, number, hot_from, bits)
                    n_hw = np.concatenate([unpack(a["c"], np.int64) for a in found])
                    stats = np.zeros((STATS, len(b.vocab)), np.int64)
                    sums = np.zeros(len(b.vocab))
                    for a in found:
                        x, y = bounds[a["part"]], bounds[a["part"] + 1]
                        runs = np.flatnonzero(np.r_[True, h[x + 1:y] != h[x:y - 1]])
                        own = h[x:y][runs][~split[x:y][runs]]
                        stats[:, own] = unpack(a["stats"], np.int64).reshape(STATS, -1)
                        sums[own] = unpack(a["sums"], np.float64)
                    if len(hot_h):
                        i = np.minimum(np.searchsorted(hot_h[by], number), len(hot_h) - 1)
                        is_hot = hot_h[by][i] == number
                        stats[:, is_hot], sums[is_hot] = hot_stats[:, by[i[is_hot]]], hot_sum[by[i[is_hot]]]
                    alpha, over, cut = backoff(stats, sums, d)
                    low = uni.p(c)
                    kept = np.where(cut[h], d[np.minimum(n_hw, CUT + 1)], 1.0) * n_hw / np.maximum(over[h], 1)
                    with np.errstate(divide="ignore"):
                        logs = np.log10(np.where(n_hw > 0, kept, alpha[h] * low[w]))
                    base = np.log10((c + 1) / (uni.total + uni.distinct + 1))
                    starts = np.cumsum(b.lens) - b.lens
                    out = [b.lens, np.add.reduceat((c > 0)[b.toks].astype(np.int64), starts), np.full(len(starts), uni.total),
                           np.add.reduceat(base[b.toks], starts), np.add.reduceat(logs[place], starts)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(b.ids, mask=b.ids == NO_ID), pa.array(b.held.astype(bool)), *map(pa.array, out)], names=names)

        answers = pairs.where("block is not null").groupBy("block").agg(
            F.array_sort(F.collect_list(F.struct("part", "c", "stats", "sums"))).alias("pairs"))
        full = blocks.select("block", *ARRAYS).join(_counts_of(words), "block").join(answers, "block").select(
            "block", *ARRAYS, "words", "pairs")
        return full.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                    "base_score double, score double")


def _source(docs: DataFrame, held_out, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("d"),
                       held_out.cast("int").alias("held"), as_bytes(F.col(text)).alias("text"))


def _finished(scores: DataFrame, name: str, path: str, tables: Tables) -> DataFrame:
    """The scores, stored; blocks and answers are deleted."""
    out = written(scores, "scores")
    out.sparkSession.sql(f"DROP TABLE {name}")
    discard(out.sparkSession, path)
    tables.delete()
    return out


def fit(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> tuple[KatzModel, DataFrame]:
    """The model of the rows where ``held_out`` is false, in stored tables, and the scores of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    blocks, name, path = _write_blocks(_source(docs, held_out, doc_id, text))
    bits = max(4, (blocks.count() // 2).bit_length())
    words = written(_word_table(blocks, bits), "words")

    def of_counts(table: DataFrame) -> dict[int, int]:
        rows = table.where("of_counts is not null").select(F.posexplode("of_counts").alias("r", "n")).groupBy("r").agg(F.sum("n"))
        return {r: n for r, n in rows.collect()}  # CUT + 3 numbers

    word_counts = of_counts(words)
    uni = Unigrams(words.agg(F.sum("total")).first()[0] or 0, sum(word_counts.values()), word_counts)
    hot_from = max(1000, uni.total >> (bits + 2))
    pairs = written(_pair_table(blocks, words, uni, bits, hot_from), "pairs")
    d = np.array([*good_turing(of_counts(pairs)), 1.0])
    # every split context was counted hot_from times: at most 2 ** (bits + 2) of them
    hot = pairs.where("hot is not null").groupBy("hot").agg(
        F.sum("hot_sum").alias("p"), *[F.sum(F.col("hot_stats")[i]).alias(f"s{i}") for i in range(STATS)]).orderBy("hot").collect()
    hot_h = np.array([r.hot for r in hot], np.int64).view(np.uint64)
    hot_stats = np.array([[r[f"s{i}"] for r in hot] for i in range(STATS)], np.int64).reshape(STATS, len(hot))
    hot_sum = np.array([r.p for r in hot])
    model = KatzModel(words.where("words is not null").select("part", "words", "number", "c"),
                      pairs.where("h is not null").select("part", "h", "n", "w", "c", "stats", "sums"),
                      uni, d, bits, hot_from, (hot_h, hot_stats, hot_sum))
    return model, _finished(model._evaluate(blocks, words, pairs), name, path, Tables(spark))


def score(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model learns from the rows where ``held_out`` is false.  Tokens are the
    words of the text, A-Z lower-cased, and one end; a NULL text is empty.
    Repeated rows are counted and scored each.  Scores are base-10 logarithms.
    With no training text every word is the unknown one, of probability 1.  An
    empty table gives an empty result.
    """
    return fit(docs, held_out, doc_id, text)[1]
