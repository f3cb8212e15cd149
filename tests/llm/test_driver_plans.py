"""Plans stay small for the driver, whose memory they fill; budgets of three levels against brute force."""

import math
import re
from collections import defaultdict

from emberline.llm import mixing, substring

LEVELS = ["domain", "lang", "source"]


def nodes(df, name):
    """How many operators of that name stand in the plan."""
    return len(re.findall(rf"^[\s:+|-]*{name}\b", df._jdf.queryExecution().sparkPlan().toString(), re.M))


def test_mix_does_not_repeat_the_budgets_in_its_plan(spark):
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('l', id % 2) AS domain", "concat('s', id % 3) AS lang",
                                      "concat('d', id % 5) AS source", "id + 1 AS n_tokens")
    got = mixing.mix(docs, LEVELS, [{}, {"s1": 2}, {}], [1, 1, 1], (9, 10), 1, 7)
    # the running sums over a leaf's ranges and inside a range; budgets come from a table
    assert nodes(got, "Window") == 2
    assert nodes(got, "HashAggregate") + nodes(got, "ObjectHashAggregate") <= 2
    kept = sum(r.n_tokens for r in got.where("copies > 0").collect())
    assert got.count() == 40 and 0 < kept <= 40 * 41 // 2 * 9 // 10


def test_repeated_spans_are_found_once(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, passage), (2, "x " + passage), (3, "y")], "doc_id long, text string")
    got = substring.remove_repeats(docs, 6, 3)
    # the words are read at the sources of spans, and where spans are removed
    assert nodes(got, "MapInArrow") == 2
    assert {r.doc_id: r.n_removed for r in got.collect()} == {1: 0, 2: 12, 3: 0}


def dealt(children, given):
    """Shares of (name, cap, w), by the level at which all that are not full meet."""
    some = sorted((x for x in children if x[2] > 0), key=lambda x: (x[1] / x[2], x[0]))
    level = max(((given - sum(x[1] for x in some[:i])) / sum(x[2] for x in some[i:]) for i in range(len(some))), default=0)
    return {n: min(cap, math.floor(w * level)) for n, cap, w in some}


def test_budgets_of_three_levels(spark):
    rows = [(f"a{i % 3}", f"b{i % 4}", f"c{i % 7}", (i * 37) % 101 * (i % 9)) for i in range(60)]
    leaves = {r[:3]: r[3] for r in rows}
    weights, defaults, share, epochs = [{"a0": 5, "a1": 0}, {"b1": 6, "b2": 0}, {"c3": 3}], [1, 2, 1], (3, 10), 2

    def below(path, given):
        depth, caps = len(path), defaultdict(int)
        for leaf, tokens in leaves.items():
            if leaf[:depth] == path:
                caps[leaf[depth]] += tokens * epochs
        shares = dealt([(n, cap, weights[depth].get(n, defaults[depth])) for n, cap in caps.items()], given)
        if depth == 2:
            return {(*path, n): x for n, x in shares.items()}
        return {k: v for n, x in shares.items() for k, v in below((*path, n), x).items()}

    wanted = below((), sum(leaves.values()) * share[0] // share[1])
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "domain string, lang string, source string, tokens long")
    got = {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(df, LEVELS, weights, defaults, share, epochs).collect()}
    assert got == {k: wanted.get(k, 0) for k in leaves} and sum(got.values()) > 0
