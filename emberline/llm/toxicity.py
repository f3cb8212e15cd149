"""Toxicity of texts through noisy-channel restoration of disguised words.

Words that look disguised - digits and signs among letters, letters drawn out
or spelled with gaps - become character lattices: each sign may stand for a
letter, each run for one or two, each separator for nothing or a space, each
space of the text for nothing.  A Viterbi search
under a character trigram model, counted over the whole corpus, picks the most
likely reading.  Ordinary words have one reading and pass through.  Restored
words are then scored: a word's weight is the best log-odds among itself and
its stems, and a document's evidence is the sum of its three strongest words.
"""

from __future__ import annotations

import math
import os
import re
from collections import Counter
from collections.abc import Iterator
from operator import add

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

# Letters that signs stand for in disguised words.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l"}
GAPS = ".-_*~'`,·"
ANY = "abcdefghijklmnopqrstuvwxyz"  # what a star inside a word may hide
KINDS = 28  # a-z, any other letter, and the edge of a word
EDGE, OTHER = 27, 26
ODD = re.compile(r"[0-9@$!|+(<€£.\-_*~'`,·]|([^\W\d_])\1")  # more than one reading, if there is a letter too
LETTER = re.compile(r"[^\W\d_]")
TRIM = " \t\n\r\v\f.,;:!?\"'()[]{}<>*#%&$~^=/\\|-_`+@"
STEMS = range(3, 8)
TOXIC_ROWS, CLEAN_ROWS = 10_000, 30_000  # labelled rows the classifier is fitted on, at most
LEAST_TEXTS, LEAST_SHARE, LEAST_WEIGHT, TOP = 2, 0.0025, 1.5, 3
CACHED_WORDS, LONGEST = 400_000, 64
SPACE = 3.0  # cost of reading a space of the text as nothing
OR = "\n"  # between readings of one word that are scored as one


def kinds_table() -> np.ndarray:
    """The kind of every code point, as ``_kind`` has it; capitals like small letters."""
    letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    kind = np.where(letters, OTHER, EDGE).astype(np.uint8)
    kind[ord("a"):ord("z") + 1] = kind[ord("A"):ord("Z") + 1] = np.arange(26)
    return kind


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def trigram_counts(docs: DataFrame, text: str) -> np.ndarray:
    """Character trigrams of all whole texts, over ``KINDS`` kinds of character."""
    def run(batches):
        kind, total = kinds_table(), np.zeros(KINDS ** 3, np.int64)
        for batch in batches:
            points = code_points("  ".join(["", *batch.column(0).to_pylist(), ""]))
            for at in range(0, len(points), 1 << 20):
                x = kind[points[max(0, at - 2):at + (1 << 20)]].astype(np.int32)
                total += np.bincount((x[:-2] * KINDS + x[1:-1]) * KINDS + x[2:], minlength=KINDS ** 3)
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(total[i])], names=["i", "n"])

    counts = np.zeros(KINDS ** 3)
    found = docs.select(F.coalesce(F.col(text), F.lit(""))).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    for r in found.collect():  # KINDS ** 3 numbers at most
        counts[r.i] = r.n
    return counts


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probability of the third character after two, add-half smoothed."""
    c = counts.reshape(KINDS, KINDS, KINDS) + 0.5
    return -np.log(c / c.sum(axis=2, keepdims=True))


def _kind(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else OTHER if c.isalpha() else EDGE


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """Readings of each unit of a word, with the cost of the disguise."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(word):
        c, j = word[i], i + 1
        while j < len(word) and word[j] == c:
            j += 1
        n = j - i
        if n == 1 and c.isalpha() and out and len(out[-1]) == 1:
            out[-1] = [(out[-1][0][0] + c, 0.0)]
        elif c.isalpha():
            out.append([(c, 0.0 if n != 2 else 1.0)] + ([(c + c, 0.0 if n == 2 else 1.0)] if n > 1 else []))
        elif c in LEET:
            out.append([(x, 1.0 if n != 2 else 2.0) for x in LEET[c]] + [(word[i:j], 8.0)]
                       + ([(x + x, 1.0 if n == 2 else 2.0) for x in LEET[c]] if n > 1 else []))
        elif c == "*" and out and j < len(word):
            out += [[("", 0.5), (c, 8.0)] + [(x, 1.5) for x in ANY]] * n
        elif c in GAPS:
            out.append([("", 0.5), (" ", 0.5), (word[i:j], 8.0)])
        else:
            out.append([(c, 0.0)])
        i = j
    return out


def best_units(units: list[list[tuple[str, float]]], costs: np.ndarray | list) -> list[str]:
    """The likeliest reading of each unit (Viterbi over the last two characters).

    Of long tokens, what all paths begin with is settled on the way.
    """
    paths: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
    sure: list[str] = []
    for i, unit in enumerate([*units, [(" ", 0.0)]]):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        kinds = [(reading, extra, [_kind(c) for c in reading]) for reading, extra in unit]
        for (a, b), (cost, done) in paths.items():
            for reading, extra, ks in kinds:
                total, x, y = cost + extra, a, b
                for k in ks:
                    total += costs[x][y][k]
                    x, y = y, k
                if (x, y) not in after or total < after[x, y][0]:
                    after[x, y] = (total, done + (reading,))
        paths = after
        if i % LONGEST == LONGEST - 1:
            settled = os.path.commonprefix([t for _, t in paths.values()])
            sure.extend(settled)
            paths = {k: (c, t[len(settled):]) for k, (c, t) in paths.items()}
    return [*sure, *min(paths.values())[1][:-1]]


def restore(word: str, costs: np.ndarray | list) -> str:
    """The likeliest reading of a disguised word."""
    return "".join(best_units(lattice(word), costs)).strip()


def readings(word: str, costs: np.ndarray | list) -> str:
    """A lower-case word as it is scored: restored if it looks disguised, without outer signs.

    Separators may cut it into several words (a space between them).  Where signs
    at its end may be letters or not, the word without them follows after ``OR``.
    """
    plain = word.strip(TRIM)
    word = word.lstrip("\"'([{").rstrip(".,;:!?\"')]}" + GAPS)
    if not ODD.search(word) or not LETTER.search(word):
        return plain
    out = " ".join(w for w in (w.strip(TRIM) for w in restore(word, costs).split(" ")) if w)
    bare = word.rstrip(TRIM)
    if bare != word and (other := readings(bare, costs)) != out:
        return out + (" " if " " in out + other else OR) + other if out and other else out or other
    return out


def splits(key: str, costs: list) -> list[bool]:
    """Which spaces of ``key`` stay in its likeliest reading; those next to other signs do."""
    parts = key.split(" ")
    sure = [not all(c.isalpha() or c in LEET for c in (a[-1], b[0])) for a, b in zip(parts, parts[1:])]
    if all(sure) or not LETTER.search(key):
        return [True] * len(sure)
    units, at = [], []
    for part, stays in zip(parts, [*sure, True]):
        units += [u for c in part for u in lattice(c)]
        at.append(len(units))
        units.append([(" ", 0.0)] if stays else [("", SPACE), (" ", 0.0)])
    chosen = best_units(units, costs)
    return [chosen[i] == " " for i in at[:-1]]


def joined(words: list[str], cache: Readings) -> list[str]:
    """The words that arise where the likeliest reading has nothing for spaces of the text.

    A gap between two longer words depends on two letters to each side only;
    single letters are read as one run with their neighbours.
    """
    gaps = cache.gaps
    stays = list(map(gaps.__getitem__, map(add, [w[-2:] for w in words[:-1]], [w[:2] for w in words[1:]])))
    singles = [i for i, w in enumerate(words) if len(w) == 1]
    done = -1
    for i in singles:
        if i >= done:
            a, done = max(0, i - 1), i + 1
            while done < len(words) and len(words[done]) == 1:
                done += 1
            key = " ".join([words[a][-2:], *words[a + 1:done], *(w[:2] for w in words[done:done + 1])])
            stays[a:done if done < len(words) else done - 1] = gaps.run(key)
    if all(stays):
        return []
    cuts = [0, *(i for i, x in enumerate(stays, 1) if x), len(words)]
    return ["".join(words[a:b]) for a, b in zip(cuts, cuts[1:]) if b - a > 1]


def words_of(text: str, costs: np.ndarray, cache: Readings) -> set[str]:
    """Distinct restored words, and those that spaces took apart."""
    words = text.lower().split()
    found = set(map(cache.__getitem__, set(words)))
    found.update(map(cache.__getitem__, set(joined(words, cache))))
    out = set()
    for w in found:
        out.update(w.split(" ")) if " " in w else out.add(w)
    return out


class Gaps(dict):
    """Two letters on each side of a space -> whether it stays, bounded."""

    def __init__(self, costs: list):
        super().__init__()
        self.costs, self.runs = costs, {}

    def __missing__(self, key: str) -> bool:
        # shorter: a single letter, which is read with its whole run
        out = self[key] = len(key) < 4 or splits(f"{key[:2]} {key[2:]}", self.costs)[0]
        if len(self) > CACHED_WORDS:
            self.clear()
        return out

    def run(self, key: str) -> list[bool]:
        if (out := self.runs.get(key)) is None:
            out = splits(key, self.costs)
            if len(self.runs) >= CACHED_WORDS:
                self.runs.clear()
            if len(key) <= LONGEST:
                self.runs[key] = out
        return out


class Readings(dict):
    """word -> restored word, bounded."""

    def __init__(self, costs: np.ndarray):
        super().__init__()
        self.costs = costs.tolist()
        self.gaps = Gaps(self.costs)

    def __missing__(self, word: str) -> str:
        if len(self) >= CACHED_WORDS:
            self.clear()
        out = self[word] = readings(word, self.costs)
        return out


def features(word: str) -> list[str]:
    """The word and its stems (first letters, marked by a trailing sign)."""
    return [f for w in word.split(OR) if len(w) > 2 for f in (w, *(w[:n] + "~" for n in STEMS if len(w) > n))]


class Weights(dict):
    """word -> best weight among its features, bounded."""

    def __init__(self, weights: dict):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= CACHED_WORDS:
            self.clear()
        out = self[word] = max((self.weights.get(f, 0.0) for f in features(word)), default=0.0)
        return out


def evidence(words: set[str], weights: dict) -> float:
    found = sorted((w for w in map(weights.__getitem__, words) if w > 0), reverse=True)
    return sum(found[:TOP])


def skeleton_classes() -> np.ndarray:
    """A class for every code point up to the signs' last: what may be read as one another
    shares a class, 0 is what a reading may leave out."""
    top = max(map(ord, [*LEET, *GAPS, ANY[-1]])) + 1
    same = np.arange(top, dtype=np.uint32)
    for sign, letters in LEET.items():
        low = min(same[ord(x)] for x in letters)
        for x in letters:
            same[same == same[ord(x)]] = low
        same[ord(sign)] = low
    same[[ord(c) for c in GAPS + " "]] = 0
    return same


class Finder:
    """Finds the words of a text that may carry a weight, and decodes only those.

    Every reading of a token has the token's skeleton: its characters by class,
    without gaps and spaces, runs as one.  So a word, or words that spaces took apart,
    can only restore to a weighted feature if the feature's skeleton stands in the
    text's.  All others weigh 0 and need no reading; a star may hide any letter,
    so words with one are always read.
    """

    def __init__(self, costs: np.ndarray, weights: dict):
        self.cache, self.weights = Readings(costs), Weights(weights)
        self.classes = skeleton_classes()
        self.features, self.bare = ahocorasick.Automaton(), False
        for f in weights:
            key, _ = self.skeleton(f)  # the sign of a stem is a gap
            if key:
                self.features.add_word(key, len(key))
            else:
                self.bare = True
        self.features.make_automaton()

    def skeleton(self, text: str) -> tuple[str, np.ndarray]:
        """The skeleton of ``text``, and where each of its characters stands in it."""
        points = code_points(text)
        classes = np.where(points < len(self.classes), self.classes[np.minimum(points, len(self.classes) - 1)], points)
        at = np.flatnonzero(classes)
        own = classes[at]
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        return own[new].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), at[new]

    def evidence(self, text: str) -> float:
        words = text.lower().split()
        if not words or not self.weights.weights:
            return 0.0
        line = " ".join(words)
        key, at = self.skeleton(line)
        spaces = np.flatnonzero(code_points(line) == 32)
        hits = set(np.searchsorted(spaces, [i for i, c in enumerate(line) if c == "*"]).tolist()) if "*" in line else set()
        if self.bare:  # some feature is signs only
            hits.update(range(len(words)))
        elif found := list(self.features.iter(key)):
            ends, sizes = np.array(found).T
            first = np.searchsorted(spaces, at[ends - sizes + 1])
            # a run may go on in later words, up to the next character of the skeleton
            last = np.searchsorted(spaces, np.append(at, len(line))[ends + 1] - 1)
            for a, b in set(zip(first.tolist(), last.tolist())):
                hits.update(range(a, b + 1))
        if not hits:
            return 0.0
        whole = {words[i] for i in hits} | joined_at(words, hits, self.cache)
        out: set[str] = set()
        for w in map(self.cache.__getitem__, whole):
            out.update(w.split(" ")) if " " in w else out.add(w)
        return evidence(out, self.weights)


def joined_at(words: list[str], hits: set[int], cache: Readings) -> set[str]:
    """Those words of ``joined`` that hold one of the words ``hits``."""
    known: dict[int, bool] = {}

    def stays(i: int) -> bool:
        """Whether the space after word i stays."""
        if i not in known:
            if len(words[i]) > 1 and len(words[i + 1]) > 1:
                known[i] = cache.gaps[words[i][-2:] + words[i + 1][:2]]
            else:  # a run of single letters is read as one, with its neighbours
                a = i if len(words[i]) == 1 else i + 1
                done = a
                while a > 0 and len(words[a - 1]) == 1:
                    a -= 1
                while done < len(words) and len(words[done]) == 1:
                    done += 1
                a = max(0, a - 1)
                key = " ".join([words[a][-2:], *words[a + 1:done], *(w[:2] for w in words[done:done + 1])])
                known.update(zip(range(a, len(words) - 1), cache.gaps.run(key)))
        return known[i]

    out: set[str] = set()
    done = -1
    for i in sorted(hits):
        if i <= done:
            continue
        a = b = i
        while a > 0 and not stays(a - 1):
            a -= 1
        while b < len(words) - 1 and not stays(b):
            b += 1
        done = b
        if b > a:
            out.add("".join(words[a:b + 1]))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str, text: str) -> tuple[DataFrame, dict]:
    """(h, text, toxic): at most TOXIC_ROWS and CLEAN_ROWS labelled texts, each text once; and
    how many usable labelled documents one document of each class stands for.

    Chosen by a hash of the id; the ids are broadcast, so no text is shuffled to find them.
    """
    caps = {1: TOXIC_ROWS, 0: CLEAN_ROWS}
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic")).withColumn("_h", F.xxhash64("doc_id")).where(usable)
    picks = [known.where(F.col("toxic") == y).orderBy("_h", "doc_id").limit(n)
             for y, n in caps.items()]
    picked = picks[0].unionByName(picks[1]).select(F.col("doc_id").alias("_id"), "toxic")
    own = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = own.join(F.broadcast(picked), "_id").groupBy(F.sha2("text", 256).alias("h")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    return sample, {y: max(1.0, sizes.get(y, 0) / n) for y, n in caps.items()}


def _feature_counts(sample: DataFrame, costs: np.ndarray, only: frozenset | None) -> DataFrame:
    """(f, n): in how many texts of ``sample`` each feature stands."""
    def run(batches):
        cache, counts = Readings(costs), Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found = {f for w in words_of(t, costs, cache) for f in features(w)}
                counts.update(found if only is None else found & only)
            if len(counts) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()))], names=["f", "n"])
                counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                         names=["f", "n"])

    return sample.select("text").mapInArrow(run, "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str = "doc_id", text: str = "text") -> dict:
    """Character costs, feature weights and the calibration (a, b) of the evidence."""
    small_batches(docs.sparkSession)
    costs = trigram_costs(trigram_counts(docs, text))
    sample, stands_for = labelled_sample(docs, labels, usable, doc_id, text)
    sample = written(sample.withColumn(
        "fold", F.pmod(F.crc32(F.col("h").cast("binary")), F.lit(4))), "labelled")
    part = sample.where("fold > 0")
    sizes = {r.toxic: r["count"] for r in part.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    least = max(LEAST_TEXTS, math.ceil(LEAST_SHARE * toxic))
    # bounded by the sample: features of that many of at most TOXIC_ROWS texts
    pos = {r.f: r.n for r in _feature_counts(part.where("toxic = 1"), costs, None).where(
        F.col("n") >= least).toLocalIterator()}
    neg = {r.f: r.n for r in _feature_counts(part.where("toxic = 0"), costs, frozenset(pos)).toLocalIterator()}
    weights = {}
    for f, n in pos.items():
        w = math.log((n + 0.5) / (toxic + 1)) - math.log((neg.get(f, 0) + 0.5) / (clean + 1))
        w *= n / (n + LEAST_TEXTS)
        if w >= LEAST_WEIGHT:
            weights[f] = w
    model = {"costs": costs, "weights": weights, "a": -3.0, "b": 1.0}
    held = evidences(sample.where("fold = 0").select("text", "toxic"), model).drop("text").toPandas()  # a quarter of the sample
    model["a"], model["b"] = calibrate(held["evidence"].to_numpy(), held["toxic"].to_numpy(), model["a"], model["b"],
                                       held["toxic"].map(stands_for).to_numpy(np.float64))
    return model


def calibrate(x: np.ndarray, y: np.ndarray, a: float, b: float, weight: np.ndarray) -> tuple[float, float]:
    """Logistic fit of y on one feature, by Newton steps with a small ridge around the start.

    ``weight``: how many documents each row stands for, so a bounded sample keeps the share of its classes.
    """
    if len(x) == 0 or len(set(y.tolist())) < 2:
        return a, b
    start, beta = np.array([a, b]), np.array([a, b])
    m = np.c_[np.ones(len(x)), x]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ beta, -30, 30)))
        grad = m.T @ (weight * (p - y)) + 0.1 * (beta - start)
        step = np.linalg.solve((m * (weight * p * (1 - p))[:, None]).T @ m + 0.1 * np.eye(2), grad)
        beta = beta - np.clip(step, -1, 1)
    return float(beta[0]), float(max(beta[1], 1e-3))


def evidences(docs: DataFrame, model: dict, text: str = "text", name: str = "evidence") -> DataFrame:
    """``docs`` plus the evidence under ``name``, 0 for empty and NULL texts."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model["costs"], model["weights"]))  # bounded by the sample

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(*shared.value)
        for texts in parts:
            yield pd.Series([finder.evidence(t) for t in texts], dtype="float64")

    return docs.withColumn(name, run(F.coalesce(F.col(text), F.lit(""))))


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` (0 to 1), in place of a column of that name.

    Empty and NULL texts have no evidence and get the lowest score; repeated
    rows come back each; an empty table gives an empty result.
    """
    return evidences(docs, model, text, "_tx_evidence").withColumn(
        "score", 1 / (1 + F.exp(-(F.lit(model["a"]) + model["b"] * F.col("_tx_evidence"))))).drop("_tx_evidence")
