"""Jaccard classes against all pairs, and the lemma that the prefixes rest on."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from emberline.llm import jaccard as J
from emberline.llm import queries as q


def shingles(text, width=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, width=5, percent=80):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) and 100 * len(x & y) >= percent * len(x | y):
                up[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted(((d, len(x), low.get(top(i))) for i, ((d, _), x) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, *args):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, J.near_duplicates(df, *args).collect()), key=str)


def edited(words, rng, share):
    return " ".join(rng.choice(["x", "y", "z"]) + str(rng.randrange(99)) if rng.random() < share else w for w in words)


def corpus(seed):
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(14):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 8, 30, 120, 400]))]
        for _ in range(rng.randrange(1, 9)):
            text = edited(base, rng, rng.choice([0, 0.01, 0.03, 0.05, 0.3]))
            rows.append(text.upper() if rng.random() < 0.2 else text)
        rows.append(" ".join(base[:40] + passage))
    rows += [" ".join(passage[:rng.randrange(40, 60)]) for _ in range(20)]
    rows += [None, "", " \t\n", "one", "ONE", "one two", "one\ttwo", "é b c d e", "É b c d e", "a a a a a a a a"]
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1])
def test_classes_match_all_pairs(spark, seed):
    rows = corpus(seed) + [(None, "one two"), (None, None), (4, "one two"), (4, "one two"), (7, "alone in the world today my friend")]
    assert run(spark, rows) == brute(rows)


def test_other_widths_and_shares(spark):
    rows = corpus(4)
    for args in ((1, 30),):
        assert run(spark, rows, *args) == brute(rows, *args)
    with pytest.raises(ValueError):
        run(spark, rows, 5, 0)


def test_query_matches_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, q.queries()["op11_jaccard"](spark, SF_SMALL).collect()), key=str) == brute(rows)


def test_chain_of_near_copies(spark):
    """Neighbours link, ends do not: one component, found beyond the pivots."""
    words = [f"c{i}" for i in range(300)]
    rows = [(100 - i, " ".join([f"e{i}-{j}" if j < 4 * i else w for j, w in enumerate(words)])) for i in range(30)]
    got = run(spark, rows)
    assert got == brute(rows) and len({c for _, _, c in got}) < 30


def test_empty_table_and_clashing_names(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (None, None)]) == brute([(1, None), (None, None)])
    df = spark.createDataFrame([(1, "a b c d e f", 5, 6, "h"), (2, "a b c d e f", 7, 8, "h")], "doc_id long, text string, sig int, n int, h string")
    assert sorted(map(tuple, J.near_duplicates(df).collect())) == [(1, 2, 1), (2, 2, 1)]


def test_long_text(spark):
    words = [f"v{i % 50021}" for i in range(300_000)]
    rows = [(2, " ".join(words)), (1, " ".join(words + ["end"])), (3, "z" * 300_000 + " " * 300_000)]
    assert run(spark, rows) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=16), min_size=2, max_size=8), st.integers(40, 100))
def test_linked_sets_share_enough_of_their_prefixes(sets, percent):
    linked = J.Linked(percent)
    count = {h: sum(h in x for x in sets) for x in sets for h in x}
    prefix = []
    for x in sets:
        order = sorted((count[h], h) for h in x if count[h] > 1)
        k, length = J.prefix_choice(np.array([d for d, _ in order], np.int64), len(x), linked)
        own = len(x) - len(order)
        prefix.append((k, {h for _, h in order[:length]}, {h: own + at for at, (_, h) in enumerate(order)}))
    for i, x in enumerate(sets):
        for j in range(i):
            if linked.holds(len(x & sets[j]), len(x), len(sets[j])):
                (k, a, at), (m, b, bt) = prefix[i], prefix[j]
                assert len(a & b) >= min(k, m)
                n, o = len(x), len(sets[j])
                least = linked.overlap(n, o)
                # they meet on a shingle of both 1-prefixes, at places that allow the link
                assert any(at[h] <= n - least and bt[h] <= o - least and at[h] <= n - linked.need(n) and bt[h] <= o - linked.need(o)
                           for h in at.keys() & bt.keys())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 4)), max_size=40), st.integers(1, 7))
def test_runs_are_told_apart_across_batches(rows, size):
    rows.sort()
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i:i + size]], pa.int64()), pa.array([r[1] for r in rows[i:i + size]], pa.int64())],
                                          names=["h", "sig"]) for i in range(0, len(rows), size)]
    got = {}
    for b in J.runs(iter(batches)):
        for s, m in zip(*(c.to_pylist() for c in b.columns)):
            got[s] = got.get(s, 0) + m
    own = sorted(set(rows))
    want = {}
    for h, s in own:
        if sum(h == x for x, _ in own) > 1 or h in (own[0][0], own[-1][0]):
            want[s] = want.get(s, 0) + 1
    # the last run counts as shared if it has one row only; more rows are shared anyway
    assert got == want


def test_blocks_of_a_common_shingle(spark, monkeypatch):
    """Every pair of a large group meets, in whichever blocks."""
    monkeypatch.setattr(J, "BLOCK_ROWS", 7)
    rng = random.Random(8)
    base = [f"b{i}" for i in range(100)]
    rows = [(i, edited(base, rng, 0.03)) for i in range(60)]
    monkeypatch.setattr(J, "pivot_pairs", lambda rows, linked, turn: rows.select(F.col("sig").alias("a"), F.col("sig").alias("b")).limit(0))
    assert run(spark, rows) == brute(rows)


def test_common_words_do_not_multiply_pairs(spark):
    """A passage in every text: rare shingles come first, so it makes no candidates."""
    passage = " ".join(f"p{i}" for i in range(50))
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit(passage), F.expr(
        "transform(sequence(1, 60), i -> concat('u', id, '-', i))")).alias("text"))
    linked = J.Linked(80)
    own = J.sets_of(df, 5, "doc_id", "text")
    sets = own.where("sig IS NOT NULL").groupBy("sig").agg(F.first("n").alias("n"))
    chosen = J.chosen_sets(df, sets, 5, "text")
    assert chosen.count() == 400 and J.nodes(chosen, linked).count() == 0
