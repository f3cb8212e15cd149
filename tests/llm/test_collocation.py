"""Collocations against direct counting, and the parse's overlaps counted once."""

import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from emberline.llm import collocation as C


def brute(rows, least, longest, top, scale=1000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            if any(b >= a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, k = min((scale * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), lang, c[p[:k]], c[p[k:]], n[lang]))
        for rank, (s, a, p, lang, l, r, t) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, t, -s))
    return sorted(out)


def run(spark, rows, *args):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, text string")
    return sorted(map(tuple, C.collocations(df, *args).collect()))


PASSAGE = "the quick brown fox jumps over the lazy dog and runs far away from here "


def test_matches_direct_counting(spark):
    rows = [("en", PASSAGE * 9 + f"word{i} x, y z. New  York\tCity; new york"[i % 5:]) for i in range(30)]
    rows += [("de", "Über die Straße über die Straße über DIE straße!" * 3)] * 4 + [(None, "a b a b a b")] * 3
    rows += [("en", None), ("en", ""), (None, " \n.,"), ("en", "a " * 3000), ("fr", "."), ("und", "a b")]
    rows += [("en", "z" * 70000 + " long word"), ("en", " " * 200000 + "end of the day")]
    for args in ((3, 5, 2000), (2, 3, 4), (10, 5, 7)):
        assert run(spark, rows, *args) == brute(rows, *args)


def test_ties_and_empty(spark):
    rows = [("en", "b c. a b. c d"), ("en", "b c. a b. c d")]
    got = run(spark, rows, 2, 5, 2)
    assert got == brute(rows, 2, 5, 2)
    assert run(spark, [], 2) == [] and run(spark, [("en", "one two")], 2) == []


def test_other_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(None, "a b, a b", "en", 1, "x")] * 3, "doc_id long, text string, lang string, n int, phrase string")
    assert [tuple(r) for r in C.collocations(df, 2).collect()] == [("en", 1, "a b", 6, 6, 6, 12, 2000)]


words = st.lists(st.sampled_from(["a", "b", "c", "d.", ",", "é", "E\n", "\t"]), max_size=400)


@settings(max_examples=60, deadline=None)
@given(st.lists(words, min_size=1, max_size=6), st.sampled_from([1, 2, 5]))
def test_every_phrase_belongs_to_one_chunk(texts, sparse):
    """The chunks of some texts, as the tasks cut and count them, hold each phrase as often as the texts."""
    import pyarrow as pa

    old, C.SPARSE = C.SPARSE, sparse
    try:
        rows = [("en", " ".join(t).encode()) for t in texts]
        seen = {}
        df = Fake(pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.binary())], names=["lang", "text"]))
        for batch in df.chunks():
            for lang, chunk, own in zip(*(c.to_pylist() for c in batch.columns)):
                seen[lang, chunk, own] = seen.get((lang, chunk, own), 0) + 1
        got = Counter()
        for (_, chunk, own), freq in seen.items():
            at = 0
            for piece in chunk.split(b"\n"):
                w = piece.split(b" ")
                for i in range(len(w)):
                    if at + i < own:
                        for k in range(1, 6):
                            if i + k <= len(w):
                                got[tuple(w[i:i + k])] += freq
                at += len(w)
        want = Counter()
        for _, text in rows:
            for piece in re.split(rb"[.,;:!?\x0A-\x0D]", text.lower()):
                w = re.findall(rb"[^\x20\x09]+", piece)
                for k in range(1, 6):
                    want.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        assert got == want
    finally:
        C.SPARSE = old


class Fake:
    """Runs the cutting function of ``chunks`` on one batch, without Spark."""

    def __init__(self, batch):
        self.batch = batch

    def select(self, *_):
        return self

    def mapInArrow(self, f, _schema):
        self.f = f
        return self

    def groupBy(self, *_):
        return self

    def agg(self, *_):
        return self

    def chunks(self):
        import unittest.mock as m

        with m.patch.object(C, "F", m.MagicMock()):
            C.chunks(self, 5, "lang", "text")
        return list(self.f([self.batch]))


def test_repeats_become_one_row_of_the_dictionary(spark):
    df = spark.createDataFrame([(i, "en", PASSAGE * 40) for i in range(50)], "doc_id long, lang string, text string")
    found = C.chunks(df, 5, "lang", "text")
    assert found.agg({"freq": "sum"}).first()[0] >= 50 and found.count() <= 12


def test_needs_two_words(spark):
    df = spark.createDataFrame([("en", "a b")], "lang string, text string")
    with pytest.raises(ValueError):
        C.collocations(df, 1, 1)
