"""The stored model of ``katz``: tables partitioned by hash range that score other texts by joins."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.llm import katz

TEXTS = ["alpha beta gamma alpha beta", "beta gamma delta", None, "", "alpha alpha alpha beta rare", "gamma delta alpha beta Gamma"] * 5


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)


def results(df):
    return sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9), round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("hot_from", [1000, 6])
def test_stored_tables_score_other_texts(docs, monkeypatch, hot_from):
    monkeypatch.setattr(katz, "max", lambda *a: hot_from if a and a[0] == 1000 else max(*a), raising=False)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 15)
    model, scores = katz.fit(docs, F.col("doc_id") % 7 == 2)
    assert results(model.score(docs)) == results(scores)
    other = docs.sparkSession.createDataFrame([(1, "never seen words"), (2, "alpha never beta"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in model.score(other).collect()}
    assert [got[i].n_known for i in (1, 2, 3)] == [1, 3, 1] and all(np.isfinite(r.score) and r.score < 0 for r in got.values())


def test_the_tables_hold_every_pair_once_in_its_hash_range(docs):
    model, _ = katz.fit(docs, F.lit(False))
    words = {}
    for r in model.words.collect():
        own, number, c = katz.unpack(r.words, np.uint64), katz.unpack(r.number, np.uint64), katz.unpack(r.c, np.int64)
        assert (own >> np.uint64(64 - model.bits) == r.part).all()
        words.update(zip(number.tolist(), zip(own.tolist(), c.tolist())))
    have = Counter()
    for r in model.pairs.collect():
        h = np.repeat(katz.unpack(r.h, np.uint64), katz.unpack(r.n, np.uint32)).tolist()
        for a, b, c in zip(h, katz.unpack(r.w, np.uint64).tolist(), katz.unpack(r.c, np.int64).tolist()):
            assert (a, b) not in have
            have[a, b] = c
    want = Counter()
    for t in TEXTS:
        own = [katz.BEGIN, *(katz.xxhash.xxh64_intdigest(w.encode()) for w in (t or "").lower().split()), katz.END]
        want.update(zip(own, own[1:]))
    assert Counter({(words[a][0], words[b][0]): c for (a, b), c in have.items()}) == want


def test_no_table_is_left_in_the_catalog(spark, docs):
    katz.score(docs, F.lit(False)).count()
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("katz_blocks")]
