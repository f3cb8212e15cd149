"""Collocations by prefix-free parsing.

Each text is cut where the hash of the next ``longest - 1`` words is a multiple
of ``SPARSE``: what the words are decides, so equal passages are cut alike
wherever they stand.  Neighbouring chunks overlap in those ``longest - 1``
words, so every phrase lies whole in a chunk; it belongs to the chunk in which
it begins before the overlap, so none counts twice.  Equal chunks become one
row of a dictionary with the parse's frequency, and phrases are counted inside
distinct chunks only, weighted by it.

A phrase is at most as frequent as its parts.  Phrases are counted level by
level under 64-bit hashes, and only where their parts reach the least count:
a fixed-size filter knows these parts, and what it lets through wrongly is
counted and dropped.  The last pass counts the phrases that remain by their
texts, exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bitfilter import bit_filter, passes
from .common import small_batches, written
from .wordhash import byte_values, folded, mixed, regrouped, texts_words

SPARSE = 64  # words of a chunk, on average
NO_LANG = "und"
BLANK = re.compile(rb"[ \t]+")
BREAK = re.compile(rb" ?[.,;:!?\n-\r][ .,;:!?\n-\r]*")
VALUES = byte_values(b" \t.,;:!?\n\v\f\r")  # of normalised texts, where only space and line feed are left


def normalised(text: bytes) -> bytes:
    """Lower-case words, one space between words of a piece, one line feed between pieces."""
    return BREAK.sub(b"\n", BLANK.sub(b" ", text.lower())).strip(b" \n")


def chunks(docs: DataFrame, longest: int, lang: str, text: str) -> DataFrame:
    """(lang, chunk, own, freq): distinct chunks, how many of their words begin phrases of
    theirs, and how often the parse has them."""
    overlap = longest - 1

    def run(batches):
        for table in regrouped(batches, 1):
            texts = [normalised(t) for t in table.column(1).to_pylist()]
            starts, h, bounds, data = texts_words(texts, VALUES, b"\n")
            window = np.zeros(max(0, len(h) - overlap + 1), np.uint64)
            for i in range(overlap):
                window = folded(window, h[i:i + len(window)])
            trigger = np.flatnonzero(window % np.uint64(SPARSE) == 0)
            langs, out, own, who = table.column(0).to_pylist(), [], [], []
            at, first = starts.tolist(), np.searchsorted(trigger, bounds)
            # past the end of a text, and without the line feed that joins it to the next
            stop = (np.cumsum([len(t) + 1 for t in texts]) - 1).tolist()
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if a == b:
                    continue
                cuts = [c for c in trigger[first[k]:first[k + 1]].tolist() if a < c < b - overlap] + [b]
                last = a
                for c in cuts:
                    end = min(c + overlap, b)
                    out.append(data[at[last]:stop[k] if end == b else at[end] - 1])
                    own.append(c - last)
                    who.append(langs[k])
                    last = c
            for i in range(0, len(out), 5000):
                yield pa.RecordBatch.from_arrays([pa.array(who[i:i + 5000], pa.string()), pa.array(out[i:i + 5000], pa.binary()),
                                                  pa.array(own[i:i + 5000], pa.int32())], names=["lang", "chunk", "own"])

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)), F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return rows.mapInArrow(run, "lang string, chunk binary, own int").groupBy("lang", "chunk", "own").agg(
        F.count(F.lit(1)).alias("freq"))


@dataclass
class Phrases:
    """The phrases of some chunks: for each length the hashes, and where they begin."""

    table: pa.Table
    data: bytes
    starts: np.ndarray
    words: np.ndarray     # hash of each word
    weight: np.ndarray    # frequency of its chunk if a phrase of the chunk may begin there, else 0
    cut: np.ndarray       # whether a piece or chunk begins with the word
    chunk: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Phrases:
        starts, words, bounds, data = texts_words(table.column(1).to_pylist(), VALUES, b"\n")
        sizes = np.diff(bounds)
        chunk = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(words)) - bounds[chunk]
        weight = np.where(place < table.column(2).to_numpy()[chunk], table.column(3).to_numpy()[chunk], 0)
        cut = np.ones(len(words), bool)
        cut[1:] = np.frombuffer(data, np.uint8)[starts[1:] - 1] == ord("\n")
        return cls(table, data, starts, words, weight, cut, chunk)

    def hashes(self) -> np.ndarray:
        """Of single words; they differ between languages."""
        langs = self.table.column(0).to_pylist()
        seeds = {x: xxhash.xxh64_intdigest(x.encode(), 1) for x in set(langs)}
        return mixed(self.words ^ np.array([seeds[x] for x in langs], np.uint64)[self.chunk])

    def longer(self, h: np.ndarray, whole: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-word phrases from those one word shorter, and which are in one piece."""
        m = max(0, len(self.words) - n + 1)
        return folded(h[:m], self.words[n - 1:]), whole[:m] & ~self.cut[n - 1:]


def summed(h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, where each is first, and the sum of its weights."""
    keys, first, which = np.unique(h, return_index=True, return_inverse=True)
    # weights are integers; float sums are exact below 2^53
    return keys, first, np.bincount(which, weight, minlength=len(keys)).astype(np.int64)


def level(dictionary: DataFrame, parts: np.ndarray | None, n: int) -> DataFrame:
    """(g, n): counts by hash of all ``n``-word phrases both of whose parts one word shorter
    pass the filter ``parts`` (None: all)."""
    shared = dictionary.sparkSession.sparkContext.broadcast(parts)

    def run(batches):
        for table in regrouped(batches, 1):
            p = Phrases.of(table)
            h, whole = p.hashes(), np.ones(len(p.words), bool)
            for k in range(2, n + 1):
                if k == n:
                    whole &= passes(shared.value, h)
                    whole[:-1] &= whole[1:]  # the part without the first word is that of the next place
                h, whole = p.longer(h, whole, k)
            use = np.flatnonzero(whole & (p.weight[:len(h)] > 0))
            keys, _, total = summed(h[use], p.weight[use])
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + 100_000].view(np.int64)),
                                                  pa.array(total[i:i + 100_000])], names=["g", "n"])

    return dictionary.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))


def exact_counts(dictionary: DataFrame, known: np.ndarray, longest: int) -> DataFrame:
    """(lang, phrase, f): exact counts, by text, of all phrases that the filter lets through."""
    shared = dictionary.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for table in regrouped(batches, 1):
            p = Phrases.of(table)
            langs = table.column(0).to_pylist()
            h, whole = p.hashes(), np.ones(len(p.words), bool)
            # the byte after a word: the next word begins one later
            after = np.append(p.starts[1:], len(p.data) + 1) - 1
            for n in range(1, longest + 1):
                if n > 1:
                    h, whole = p.longer(h, whole, n)
                use = np.flatnonzero(whole & (p.weight[:len(h)] > 0))
                use = use[passes(shared.value, h[use])]
                _, first, total = summed(h[use], p.weight[use])
                first = use[first]
                for i in range(0, len(first), 100_000):
                    own = first[i:i + 100_000].tolist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([langs[c] for c in p.chunk[first[i:i + 100_000]].tolist()], pa.string()),
                        pa.array([p.data[p.starts[x]:after[x + n - 1]] for x in own], pa.binary()),
                        pa.array(total[i:i + 100_000])], names=["lang", "phrase", "f"])

    counts = dictionary.mapInArrow(run, "lang string, phrase binary, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))
    return counts.withColumn("phrase", F.col("phrase").cast("string"))


def frequent(docs: DataFrame, least: int, longest: int, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to ``longest`` words with f >= ``least``, and
    (lang, n): all word occurrences."""
    small_batches(docs.sparkSession)
    dictionary = written(chunks(docs, longest, lang, text), "chunks")
    parts = every = None
    for n in range(1, longest + 1):
        parts = bit_filter(level(dictionary, parts, n).where(F.col("n") >= least), "g")
        every = parts if every is None else every | parts
    counts = written(exact_counts(dictionary, every, longest).where(F.col("f") >= least), "phrases")
    return counts, dictionary.groupBy("lang").agg(F.sum(F.col("own") * F.col("freq")).alias("n"))


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(14,0)")


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, scale: int = 1000,
                 lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language.

    A candidate has 2 to ``longest`` words and a = f(phrase) >= ``least``.  Its score
    is that of its lowest cut, floor(scale * a * n / (l * r)) (ties: the earliest cut).
    Candidates inside a longer one that is as frequent are dropped.  Ties in score
    go to the larger a, then to the smaller phrase by its UTF-8 bytes.

    NULL texts count as empty, a NULL language as ``und``.  Repeated rows count each
    time.  Texts of any length are cut into chunks as they come.  Tables without a
    frequent phrase give an empty result.  Other columns are not read.
    """
    if longest < 2:
        raise ValueError("a collocation has two words at least")
    counts, totals = frequent(docs, least, longest, lang, text)
    many = counts.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    many = many.withColumn("k", F.size("w")).where("k > 1")
    part = lambda w, a, b: F.array_join(F.slice(w, a, b), " ")
    inside = many.where("k > 2").select("lang", "a", "w", "k", F.explode(F.expr("sequence(2, k - 1)")).alias("m")).select(
        "lang", "a", "w", "m", F.explode(F.expr("sequence(1, k - m + 1)")).alias("s")).select(
        "lang", "a", part(F.col("w"), F.col("s"), F.col("m")).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = many.join(inside, ["lang", "phrase"], "left").where(F.coalesce("most", F.lit(0)) < F.col("a"))
    cuts = kept.select("lang", "phrase", "a", "w", "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut")).select(
        "lang", "phrase", "a", "cut", part(F.col("w"), F.lit(1), F.col("cut")).alias("left"),
        part(F.col("w"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    for side, f in (("left", "l"), ("right", "r")):
        own = counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
        cuts = cuts.join(own, ["lang", side])
    scored = cuts.join(totals, "lang").withColumns({"x": _exact("a") * _exact("n") * F.lit(scale).cast("decimal(8,0)"),
                                                    "y": _exact("l") * _exact("r")})
    scored = scored.withColumn("score", F.expr("x div y"))
    low = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("low")).select(
        "lang", "phrase", "low.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return low.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
