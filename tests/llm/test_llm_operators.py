"""The training-data operators against brute force, and on awkward rows."""

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberline.llm import html, innerproduct, katz, mixing, packing, piecewise, sharding, simhash, substring, toxicity
from emberline.llm import queries as q
from emberline.llm.components import components
from emberline.llm.toxicity import readings, trigram_costs

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, b long, kept string, domain string"


def prose(seed, n):
    return " ".join(WORDS[int(x)] for x in np.random.default_rng(seed).integers(0, len(WORDS), n))


def rows():
    """NULLs in every column, empty and long texts, copies, near copies, shared passages, repeated rows."""
    passage = prose(99, 80)
    long = prose(5, 9000)
    texts = [prose(1, 120), prose(1, 120), prose(2, 60) + " " + passage, passage + " " + prose(3, 70), None, "",
             " \n\t ", "One", "two words", long, long + " end", "x" * 5000, "tab\tline\nÜmläut ✓ <|endoftext|> İ z",
             prose(4, 300) + " a", prose(4, 300) + " b", passage, "word " * 400, "word " * 400]
    out = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, None, i, "own", None)
           for i, t in enumerate(texts)]
    out += [out[2], out[2], (None, passage + " tail", None, None, None, None, None, None),
            (None, None, None, None, None, None, None, None), (3, prose(8, 90) + " " + passage, "en", "src1", 1, 1, "", "")]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- sharding

@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**63))
def test_permutation_is_a_bijection_and_can_be_undone(n, seed):
    to = sharding.permute(np.arange(n), n, seed)
    assert sorted(to) == list(range(n))
    assert (sharding.permute(to, n, seed, undo=True) == np.arange(n)).all()


def test_shards_are_even_gapless_and_reproducible(spark, docs, none):
    narrow = docs.select("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("c"), "b")
    got = sharding.assign_shards(narrow, ["doc_id"], 4, 7).collect()
    again = sharding.assign_shards(narrow.repartition(2), ["doc_id"], 4, 7).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(got) == len(rows()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    numbers = sharding.permute(np.arange(len(got)), len(got), 7)
    assert all(numbers[r.row_number] == r.slot * 4 + r.shard for r in got)
    assert sharding.assign_shards(none.select("doc_id"), ["doc_id"], 4).count() == 0


# --- substring

def brute_kept(data, window):
    """Removed words by definition, for rows in any order; NULL ids are after all others."""
    key = lambda d: (d is None, d or 0)
    first = {}
    for d, t in data:
        w = words(t)
        for i in range(len(w) - window + 1):
            s = tuple(w[i:i + window])
            first[s] = min(first.get(s, key(d)), key(d))
    for d, t in data:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < key(d):
                gone.update(range(i, i + window))
        yield d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("window,anchor", [(50, 20), (7, 3), (5, 5)])
def test_repeated_windows_go(docs, window, anchor):
    got = substring.remove_repeats(docs, window, anchor).collect()
    want = brute_kept([(r[0], r[1]) for r in rows()], window)
    assert Counter((r.doc_id, r.n_words, r.n_removed, bytes(r.kept).decode()) for r in got) == Counter(want)
    assert {"lang", "b", "domain"} <= set(got[0].asDict()) and "text" not in got[0].asDict()


def test_first_source_is_the_smallest_start(spark, monkeypatch):
    # a passage twice in the source: its rows reach the aggregates in descending order
    passage = " ".join(f"w{i}" for i in range(12))
    df = spark.createDataFrame([(1, f"a b {passage} c d e {passage}".encode()), (2, f"x {passage} y".encode())],
                               "d long, text binary").coalesce(1)
    keep, edges = substring._paths, substring._edges
    for name, f in (("_paths", keep), ("_edges", edges)):
        monkeypatch.setattr(substring, name, lambda *a, f=f: f(*a).coalesce(1).sortWithinPartitions(F.desc("start")))
    spans = substring.repeated_spans(df, 10, 4).where("d = 2").collect()
    assert spans and all(r.s == 1 and r.s0 < 15 for r in spans)


def test_substring_of_nothing(none):
    assert substring.remove_repeats(none).count() == 0


# --- simhash

def brute_classes(data, bits, with_class=False):
    def fp(t):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = words(w)
        s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    fps = [fp(t) for _, t in data]
    distinct = sorted(set(fps))
    root = {x: x for x in distinct}
    for _ in distinct:
        for x in distinct:
            for y in distinct:
                if (x ^ y).bit_count() <= bits:
                    root[x] = root[y] = min(root[x], root[y])
    low = {}
    for (d, _), x in zip(data, fps):
        c = root[x]
        low[c] = min((v for v in (low.get(c), d) if v is not None), default=None)
    return [(d, f"{x:016x}", low[root[x]], *[root[x]] * with_class) for (d, _), x in zip(data, fps)]


@pytest.mark.parametrize("bits", [0, 2, 3])
def test_simhash_classes(docs, bits):
    got = simhash.near_duplicates(docs, 3, bits).collect()
    assert Counter(map(tuple, got)) == Counter(brute_classes([(r[0], r[1]) for r in rows()], bits))


def test_simhash_finds_every_planted_link(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 40, dtype=np.uint64)]
    fps = {b ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 64, (6, 2))} | set(base)
    signed = {x - 2**64 if x >= 2**63 else x for x in fps}
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), 2).collect()}
    assert got == {(a, b) for a in signed for b in signed if a > b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}


def test_one_of_each_class_stays(docs, none):
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    classes = {c: d for _, _, d, c in brute_classes([(r[0], r[1]) for r in rows()], 2, True)}
    assert Counter(r.doc_id for r in got.collect()) == Counter(classes.values())
    assert simhash.keep_one(none).count() == simhash.near_duplicates(none).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i + 1, i) for i in range(200)]
    star = [(1000 + i, 999) for i in range(1, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 999: 999, **dict.fromkeys(range(1001, 1300), 999)}


# --- piecewise

def test_piecewise_by_definition(docs, none):
    got = piecewise.edited_likeness(docs).collect()
    h = {r.t: r.h for r in docs.select(F.coalesce("text", F.lit("")).alias("t"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    data = sorted(((r[0], r[1] or "") for r in rows()), key=lambda r: (r[0] is not None, r[0] or 0, h[r[1]]))
    want = Counter()
    for i, (d, t) in enumerate(data):
        k, after = len(t) // 3, data[i - 1][1]
        want[d, len(t), sha256((t[:len(t) - k] + after[:k]).encode()).hexdigest(), piecewise.fingerprint(t.encode())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert piecewise.edited_likeness(none).count() == 0


def test_likeness_tells_edits_from_strangers(spark):
    a, b = prose(1, 800), prose(2, 800)
    pairs = [(a, a), (a, a[:3000] + b[:1000]), (a, b), ("", ""), (a, "")]
    got = spark.createDataFrame([(piecewise.fingerprint(x.encode()), piecewise.fingerprint(y.encode())) for x, y in pairs],
                                "x string, y string").select(piecewise.likeness(F.col("x"), F.col("y")).alias("v")).collect()
    same, edited, other, empty, one = (r.v for r in got)
    assert same == empty == 1.0 and edited > 0.5 > 0.3 > other and one == 0.0


def test_fingerprint_does_not_depend_on_the_stretch(monkeypatch):
    data = prose(7, 3000).encode()
    whole = piecewise.fingerprint(data)
    monkeypatch.setattr(piecewise, "STRETCH", 777)
    assert piecewise.fingerprint(data) == whole


# --- inner products

def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(size=(700, 6)), rng.normal(size=(60, 6)) * 8]).round(2)
    v[100:140] = v[100]  # ties
    data = [(i, x.tolist()) for i, x in enumerate(v)]
    bad = [(2000, None), (2100, [1.0, None]), (2200, [float("nan")] * 6), (2300, [float("inf")] * 6), (None, [1.0] * 6),
           (0, v[0].tolist()), (2400, []), (2500, [3.0])]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<double>")
    got = innerproduct.top_k(df, F.col("vec_id") % 100 == 0, 10).collect()
    m = {i: np.floor(1024 * x).astype(int) for i, x in enumerate(v)} | {2400: np.zeros(6, int), 2500: np.array([3072, 0, 0, 0, 0, 0])}
    want = []
    for a in [i for i in m if i % 100 == 0]:
        best = sorted(((-int(m[a] @ m[b]), b) for b in m if b != a))[:10]
        want += [(a, n + 1, b, -s) for n, (s, b) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_with_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0]), (5, [2.0]), (7, [-2.0])], schema)
    got = innerproduct.top_k(few, F.col("vec_id") % 100 == 0, 10).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 5, 2 * 1024 * 1024), (0, 2, 7, -2 * 1024 * 1024)]
    assert innerproduct.top_k(few.limit(0), F.col("vec_id") % 100 == 0, 10).count() == 0


def test_pruned_blocks_lose_nothing():
    rng = np.random.default_rng(2)
    c = rng.integers(-900, 900, (1500, 12))
    c = c[np.argsort(-(c ** 2).sum(axis=1))]
    p = rng.integers(-900, 900, (9, 12))
    turn = np.linalg.eigh((c.T @ c).astype(float))[1][:, ::-1]
    got = innerproduct.search_block(p, np.arange(9) - 100, np.full(9, innerproduct.NONE), c, np.arange(1500), turn, 5)
    for n in range(9):
        best = sorted((-int(p[n] @ x), i) for i, x in enumerate(c))[:5]
        assert sorted((-s, i) for a, i, s in got if a == n - 100) == best


# --- html

def test_main_text():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a < b) x("<p>no</p>");</script></head>
    <body><header><h1>Site</h1></header><nav><ul><li><a href=x>One</a></li><li><a>Two</a></li></ul></nav>
    <div class="cookie-notice">We use cookies on this long and wordy site, be warned.</div><!-- <p>gone</p> -->
    <article><h1>The &quot;Title&quot; &amp; more</h1><p>First  paragraph\n with <b>bold</b> &lt;signs&gt;.<br><p>Next<br>line, unclosed
    <div class="share">Share me</div><p>Last.</p><section id="comments"><p>Reader says no.</p></section></article>
    <aside>Side</aside><form><label>Mail</label><input></form><footer>&copy; me</footer></body></html><p cl"""
    assert html.main_text(page) == 'The "Title" & more\nFirst paragraph with bold <signs>.\nNext line, unclosed\nLast.'
    assert html.main_text("") == html.main_text("<p>") == html.main_text("<nav>x</nav>") == ""
    assert html.main_text("plain &amp; simple") == "plain & simple"
    assert html.main_text("<div><p>" + "word " * 40 + "</p><p>Yes.</p></div><div><a>x</a><a>y</a><a>z</a></div>").endswith("\nYes.")


@pytest.mark.parametrize("start,end", [("<div class='content has-sidebar'>", "</div>"), ("<main class='page with-sidebar'>", "</main>"),
                                       ("<article id='comment-on-policy'>", "</article>"), ("<article class='share-price'>", "</article>"),
                                       ("<div class='has-sidebar'><article>", "</article></div>")])
def test_names_do_not_drop_the_article(start, end):
    text = "word " * 60
    page = f"<body><nav><a>x</a></nav>{start}<p>{text}</p><p>Yes.</p>{end}<div class='ad'>Buy this now.</div></body>"
    assert html.main_text(page) == f"{text.strip()}\nYes."


def test_extract_rows(spark):
    df = spark.createDataFrame([(1, None, "u"), (2, "<p>Ünï</p>", "u"), (2, "<p>Ünï</p>", "u"), (None, "", None)],
                               "page_id long, html string, text string")
    got = Counter((r.page_id, r.text, r.n_chars) for r in html.extract(df).collect())
    assert got == Counter({(1, "", 0): 1, (2, "Ünï", 3): 2, (None, "", 0): 1})
    assert html.extract(df.limit(0)).count() == 0


# --- toxicity

@pytest.fixture(scope="module")
def costs():
    counts = np.zeros(28 ** 3)
    text = "  the idiot was a moron and the loser was stupid there boot tells  " * 20
    kinds = [toxicity._kind(c) for c in text]
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        counts[(a * 28 + b) * 28 + c] += 1
    return trigram_costs(counts)


@pytest.mark.parametrize("seen,read", [("1d10t", "idiot"), ("i.d.i.o.t", "idiot"), ("m0r0n!", "moron"), ("loooser", "loser"),
                                       ("$tup1d", "stupid"), ("boot", "boot"), ("plain,", "plain"), ("été", "été"), ("", "")])
def test_disguised_words_are_restored(costs, seen, read):
    assert readings(seen, costs) == read


def test_spelled_out_words_are_restored(costs):
    assert "moron" in toxicity.words_of("you m o r o n there", costs, toxicity.Readings(costs))


@pytest.fixture(scope="module")
def curses():
    counts = np.zeros(28 ** 3)
    text = "  you are a stupid person an idiot i moron ass there was the dumb loser and  " * 20
    kinds = [toxicity._kind(c) for c in text]
    for a, b, c in zip(kinds, kinds[1:], kinds[2:]):
        counts[(a * 28 + b) * 28 + c] += 1
    return trigram_costs(counts)


@pytest.mark.parametrize("seen,read", [("stu.pid", "stupid"), ("st*pid", "stupid"), ("mor*n", "moron"), ("id-iot", "idiot"),
                                       ("stu_pid", "stupid"), ("s.tupid", "stupid"), ("a55", "ass"), ("as$", "ass\nas"),
                                       ("a$$", "ass\na"), ("stuupid", "stupid"), ("idiot-moron", "idiot moron")])
def test_every_lattice_is_read(curses, seen, read):
    assert readings(seen, curses) == read


@pytest.mark.parametrize("text,found", [("you are a s t u p i d person", {"stupid", "person"}), ("i s t u p i d", {"stupid"}),
                                        ("an i d i o t m o r o n there", {"idiot", "moron"}), ("the stu pid person", {"stupid"}),
                                        ("the " + "m o r o n " * 60 + "i d i o t", {"moron", "idiot"})])
def test_spaces_are_chosen(curses, text, found):
    got = toxicity.words_of(text, curses, toxicity.Readings(curses))
    assert found <= got and not any(len(w) > 9 for w in got)


def test_toxicity_on_held_out_rows(spark, none):
    rng = np.random.default_rng(4)
    bad = ["idiot", "moron", "scum"]
    data = []
    for i in range(400):
        w = prose(1000 + i, 40).split()
        if i % 4 == 0:
            w[3], w[30] = rng.choice(bad), rng.choice(["1d10t", "m0r0n", "s.c.u.m"])
        data.append((i, " ".join(w)))
    df = spark.createDataFrame([*data, (400, None), (401, ""), (None, "idiot moron"), (0, data[0][1])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 4 == 0 and 1 or 0) for i in range(400)] + [(None, 1), (7, None), (999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels, F.col("doc_id") % 5 != 0)
    got = toxicity.score(df, model).collect()
    assert len(got) == 404 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 5 == 0]
    assert all((r.score >= 0.3) == (r.doc_id % 4 == 0) for r in held)
    assert all(r.score < 0.3 for r in got if not r.text)
    empty = toxicity.fit(none, labels.limit(0), F.lit(True))
    assert toxicity.score(none, empty).count() == 0 and toxicity.score(df, empty).count() == 404


def test_caps_do_not_move_the_threshold(spark, monkeypatch):
    # "maybe" stands in 1 of 2 toxic and 1 of 11 clean texts: a quarter of the texts that hold it are toxic
    data, labels = [], []
    for i in range(2640):
        toxic = i % 17 == 0
        word = ("maybe" if i % 2 else "scum") if toxic else "maybe" if i % 11 == 0 else "plain"
        data.append((i, f"{prose(5000 + i, 12)} {word}"))
        labels.append((i, int(toxic)))
    df = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")

    def predicted():
        model = toxicity.fit(df, labels, F.lit(True))
        return {r.doc_id for r in toxicity.score(df, model).where("score >= 0.3").collect()}
    whole = predicted()
    assert whole == {i for i, t in data if t.endswith("scum")}
    monkeypatch.setattr(toxicity, "CLEAN_ROWS", 500)
    assert predicted() == whole


# --- mixing

def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", 10), ("a", "y", 1000), ("b", "x", 1000), ("b", "y", 1000)], "d string, l string, tokens long")
    got = {(r.d, r.l): r.budget for r in mixing.leaf_budgets(leaves, ["d", "l"], [{"a": 1, "b": 1}, {"x": 3, "y": 1}], [1, 1], (1, 3), 1).collect()}
    # a third of 3010 is 1003, 501 for each domain; a/x can use 10 only, a/y takes the rest of a's share
    assert got == {("a", "x"): 10, ("a", "y"): 491, ("b", "x"): 375, ("b", "y"): 125}
    got = {(r.d, r.l): r.budget for r in mixing.leaf_budgets(leaves, ["d", "l"], [{"a": 1}, {}], [1, 1], (9, 10), 1).collect()}
    assert got[("a", "x")] == 10 and got[("a", "y")] == 1000 and got[("b", "x")] + got[("b", "y")] >= 2709 - 1010 - 2


def test_mix_takes_epochs_and_a_prefix(docs, none):
    df = docs.withColumn("n_tokens", F.size(F.split(F.coalesce("text", F.lit("")), " ")).cast("long"))
    got = mixing.mix(df, ["lang", "source"], [{}, {}], [1, 1], (1, 1), 3, 5).collect()
    assert len(got) == len(rows())
    leaves = defaultdict(list)
    for r in got:
        leaves[r.lang or "", r.source or ""].append(r)
    for leaf in leaves.values():
        total = sum(r.n_tokens for r in leaf)
        used = sum(r.n_tokens * r.copies for r in leaf)
        assert used <= leaf[0].leaf_budget <= 3 * total
        full = leaf[0].leaf_budget // total if total else 0
        order = sorted(leaf, key=lambda r: (__import__("hashlib").md5(
            f"5:{full}:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), r.n_tokens))
        run = 0
        for r in order:
            run += r.n_tokens
            rest = leaf[0].leaf_budget % total if total else 0
            assert r.copies == full + (1 if rest and run <= rest else 0)
    assert mixing.mix(none.withColumn("n_tokens", F.lit(1)), ["lang"], [{}], [1]).count() == 0


# --- katz

def test_katz_against_brute_force(docs, none):
    data = [(r[0], words(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")) + [1]) for r in rows()]
    held = lambda d: d is not None and d % 3 == 1
    got = katz.score(docs, F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False))).collect()
    uni, bi = Counter(), Counter()
    for d, t in data:
        if not held(d):
            uni.update(t)
            bi.update(zip([0, *t], t))
    total = sum(uni.values())
    d1, d2 = katz.good_turing(Counter(uni.values())), katz.good_turing(Counter(bi.values()))
    freed = sum((1 - d1[c]) * c for c in uni.values() if c <= katz.CUT)

    def low(w):
        return uni[w] * (d1[uni[w]] if uni[w] <= katz.CUT else 1) / total if uni[w] else freed / total

    seen = defaultdict(dict)
    for (h, w), c in bi.items():
        seen[h][w] = c

    def p(h, w):
        m = seen.get(h)
        if not m:
            return low(w)
        cut = any(c <= katz.CUT for c in m.values())
        n = sum(m.values()) + (not cut)
        star = {x: c * (d2[c] if cut and c <= katz.CUT else 1) / n for x, c in m.items()}
        return star[w] if w in star else (1 - sum(star.values())) / (1 - sum(map(low, m))) * low(w)

    for h in [0, "alpha", "never"]:
        assert math.isclose(sum(p(h, w) for w in uni) + p(h, "unknown word"), 1, rel_tol=1e-9)
    want = {}
    for d, t in data:
        base = sum(math.log10((uni[w] + 1) / (total + len(uni) + 1)) for w in t)
        want.setdefault((d, held(d), len(t), sum(uni[w] > 0 for w in t), total), []).append(
            (round(base, 6), round(sum(math.log10(p(h, w)) for h, w in zip([0, *t], t)), 6)))
    have = defaultdict(list)
    for r in got:
        have[r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens].append((round(r.base_score, 6), round(r.score, 6)))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    assert katz.score(none, F.lit(False)).count() == 0
    alone = katz.score(docs, F.lit(True)).collect()
    assert len(alone) == len(rows()) and all(r.train_tokens == r.n_known == 0 and r.score == 0 for r in alone)


def test_split_contexts_give_the_same_scores(docs, monkeypatch):
    def scores():
        return sorted((r.n_tokens, round(r.score, 9)) for r in katz.score(docs, F.coalesce(F.col("doc_id") == 4, F.lit(False))).collect())
    plain = scores()
    split = katz.Block.pairs
    monkeypatch.setattr(katz, "max", lambda *a: 20 if a and a[0] == 1000 else max(*a), raising=False)
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 700)
    assert scores() == plain and split is katz.Block.pairs


def test_discounts_are_proper():
    for n in ({}, {1: 5}, {1: 100, 2: 40, 3: 20, 4: 12, 5: 8, 6: 5}, {1: 1, 2: 50, 3: 9}, {i: 7 for i in range(1, 7)}):
        d = katz.good_turing(n)
        assert len(d) == katz.CUT + 1 and all(0 < x < 1 for x in d[1:])


# --- packing

@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=80))
def test_best_fit_is_valid_and_not_under_the_bound(sizes):
    sizes = np.array(sizes)
    bins, offsets, room = packing.best_fit_decreasing(sizes, 50)
    for b in range(len(room)):
        own = sorted((o, s) for x, o, s in zip(bins, offsets, sizes) if x == b)
        assert [o for o, _ in own] == [0, *np.cumsum([s for _, s in own])[:-1]] and sum(s for _, s in own) == 50 - room[b]
    assert packing.lower_bound(sizes, 50) <= len(room)


def test_lower_bound_sees_large_items():
    assert packing.lower_bound(np.array([26] * 7), 50) == 7
    assert packing.lower_bound(np.array([17] * 7 + [34] * 2), 50) >= 4


def test_pieces_have_the_ids_of_the_tokenizer(docs):
    from tokenizers import Tokenizer
    path = q.tokenizer_path()
    t = Tokenizer.from_file(path)
    pieces = packing.token_pieces(docs, path, 64, 2)
    got = defaultdict(list)
    for r in packing.pack(pieces, 64, pieces_per_task=200).collect():
        got[r.doc_id].append(r)
    at = defaultdict(int)
    for p in got.values():
        for r in p:
            at[r.sequence_id] += r.length
    assert max(at.values()) <= 64
    want = Counter()
    for d, text, *_ in rows():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        n = len(ids)
        cuts = [0, *range(n % 64 or 64, n + 1, 64)] if n > 64 else [0, n]
        want.update((d, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for p in got.values() for r in p) == want
    total = sum(r.length for p in got.values() for r in p)
    assert len(at) <= -(-total // 64) * 1.1 + 2
    for p in [r for p in got.values() for r in p]:
        assert 0 <= p.offset <= 64 - p.length


def test_long_white_space_has_the_ids_of_the_tokenizer():
    from tokenizers import Tokenizer
    path = q.tokenizer_path()
    t, encode = Tokenizer.from_file(path), packing.encoder(*packing.vocabulary(path))
    for text in (" " * 2_000_000 + "x", "a" + "\n" * 2_000_000 + "x <|endoftext|>", "b" + " \n" * 60_000 + "x", " " * 99_999 + "x"):
        assert encode(text) == t.encode(text, add_special_tokens=False).ids


def test_packing_nothing(none):
    assert packing.pack(packing.token_pieces(none, q.tokenizer_path(), 64, 2), 64).count() == 0
