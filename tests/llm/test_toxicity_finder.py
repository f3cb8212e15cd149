"""Decoding only words that can carry a weight changes no evidence."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emberline.llm import toxicity as T
from emberline.llm.common import table

TEXT = "the idiot is a stupid fool and little hills call billions of good people to sell books in the valley below"


def costs():
    kind, counts = T.kinds_table(), np.zeros(T.KINDS ** 3)
    x = kind[T.code_points("  " + TEXT + "  ")].astype(int)
    np.add.at(counts, (x[:-2] * T.KINDS + x[1:-1]) * T.KINDS + x[2:], 1)
    return T.trigram_costs(counts)


COSTS = costs()
WEIGHTS = {"idiot": 3.0, "idio~": 2.5, "stu~": 2.0, "fool": 4.0, "hill": 1.5, "bill~": 1.7, "good": 1.9, "a1b": 2.2, "über~": 2.1, "x-y": 1.6}


def plain(text, weights, c=COSTS):
    """All words decoded, as ``words_of`` does."""
    cache = T.Readings(c)
    return T.evidence(T.words_of(text, c, cache), T.Weights(weights))


pieces = st.sampled_from(["idiot", "1d10t", "i d i o t", "id iot", "idio", "tic", "s.t.u.p.i.d", "stuuupid", "5tup1d", "st*pid", "f00l", "foool", "f o", "ol",
                          "(ool", "h1ll", "hi11", "b!ll!on", "6ood", "g-o-o-d", "a1b", "x-y", "x", "y", "über", "ÜBERall", "*", "**", "·", "---", "@", "l", "i",
                          "the", "valley", "book", "Ⅷ", "\x00", "日本", "ß", "!!!", "gooood", "go", "od", "e", "a", "\n", "  ", "1", "11"])


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=14), st.sampled_from([" ", "", " ", ".", "\n"]))
def test_same_evidence(parts, glue):
    finder = T.Finder(COSTS, WEIGHTS)
    text = glue.join(parts)
    assert finder.evidence(text) == plain(text, WEIGHTS)


def test_features_of_signs_only():
    weights = {"···": 2.0, "fool": 1.5}
    for text in ("a ··· b", "f o o l ···", "", "nothing here"):
        assert T.Finder(COSTS, weights).evidence(text) == plain(text, weights)
    assert T.Finder(COSTS, {}).evidence("fool") == 0.0


@pytest.fixture(scope="module")
def model(spark):
    d = table(spark, SF_SMALL, "documents").select("doc_id", "text")
    return T.fit(d, table(spark, SF_SMALL, "labels"), F.lit(True))


def test_same_evidence_on_documents(spark, model):
    texts = [r.text for r in table(spark, SF_SMALL, "documents").select("text").collect()]
    rng = random.Random(3)
    features = sorted(f.rstrip("~") for f in model["weights"]) or ["fool"]
    for _ in range(100):  # weighted words, disguised
        w = rng.choice(features)
        w = rng.choice([w, " ".join(w), w.replace("o", "0").replace("i", "1"), ".".join(w), "".join(c * rng.randrange(1, 4) for c in w)])
        texts.append(f"well {w} then {rng.choice(features)}s")
    finder = T.Finder(model["costs"], model["weights"])
    got = [finder.evidence(t) for t in texts]
    assert got == [plain(t, model["weights"], model["costs"]) for t in texts]
    assert sum(x > 0 for x in got) > 50


def test_characters_are_counted_as_they_are_read(spark):
    df = spark.createDataFrame([("É日!a",), (None,), ("",)], "text string")
    counts = T.trigram_counts(df, "text").reshape(T.KINDS, T.KINDS, T.KINDS)
    for a, b, c in (("  "[0], " ", "é"), (" ", "é", "日"), ("é", "日", "!"), ("日", "!", "a"), ("!", "a", " ")):
        assert counts[T._kind(a), T._kind(b), T._kind(c)] >= 1
    assert counts[T.OTHER, T.OTHER, T.OTHER] == 0   # not four bytes


def brute_units(units, c):
    """All paths."""
    best = None
    def go(i, cost, a, b, out):
        nonlocal best
        if i == len(units):
            cost += c[a][b][T.EDGE]
            if best is None or cost < best[0] - 1e-12:
                best = cost, out
            return
        for reading, extra in units[i]:
            t, x, y = cost + extra, a, b
            for ch in reading:
                t += c[x][y][T._kind(ch)]
                x, y = y, T._kind(ch)
            go(i + 1, t, x, y, [*out, reading])
    go(0, 0.0, T.EDGE, T.EDGE, [])
    return best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["0", "1", "6", "a", "l", "oo", "-", "x", "ss"]), min_size=1, max_size=7))
def test_the_likeliest_path(parts):
    c = COSTS.tolist()
    units = T.lattice("".join(parts))
    cost, _ = brute_units(units, c)
    got = T.best_units(units, c)
    assert len(got) == len(units)
    total, x, y = 0.0, T.EDGE, T.EDGE
    for unit, reading in zip([*units, [(" ", 0.0)]], [*got, " "]):
        total += min(e for r, e in unit if r == reading)
        for ch in reading:
            total += c[x][y][T._kind(ch)]
            x, y = y, T._kind(ch)
    assert abs(total - cost) < 1e-9


def test_long_tokens_settle_on_shared_beginnings_only(monkeypatch):
    rng = random.Random(5)
    word = "".join(rng.choice("a1l06!gso") for _ in range(900))
    whole = T.best_units(T.lattice(word), COSTS.tolist())
    monkeypatch.setattr(T, "LONGEST", 10 ** 9)
    assert T.best_units(T.lattice(word), COSTS.tolist()) == whole
