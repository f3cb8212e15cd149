"""N-gram Jaccard join with adaptive multi-match prefixes.

A set of n shingles that is linked with one of m shares at least
overlap(n, m) = ceil(share / (1 + share) * (n + m)) of them, and so need(n) =
ceil(share * n) with any partner.  Under any order of all shingles, the first
n - overlap + k shingles of the one and m - overlap + k of the other (their
k-prefixes) share at least k.  Shingles are ordered by how many sets hold them,
rare ones first, so prefixes are rare shingles.  Documents meet on a shingle of
their 1-prefixes.  Each document then chooses its own k: a longer prefix costs
more to compare, but more shared shingles are asked for before a pair is
verified.  It takes the k with the least expected cost; a pair must share as many
shingles of its prefixes as the smaller k of both.

Stages on Spark:

1. documents with equal sets become one node (a signature of the set);
2. a screen by the same lemma, under the order of the hashes: a set whose
   prefix is hardly shared with anybody has no partner.  Only what is left goes on,
   so that counting shingles does not move all of them;
3. shingle counts, prefixes, postings;
4. rounds of pivots: each node is verified against the pivot of the rarest shingle
   it shares; groups of near copies fall into few components by a number of pairs
   linear in their size;
5. nodes that share a shingle with another component meet in blocks.  A bitmap of
   each node's shingles bounds the overlap of a pair from above: bits that the other
   lacks are shingles that it lacks.  Only pairs whose bound suffices leave a block,
   to be verified.

Components, not pairs, are the result, so pairs inside a component need no check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitfilter import bit_filter, passes
from .common import Tables, as_bytes, small_batches, written
from .components import components
from .wordhash import SPACES, byte_values, folded, regrouped, texts_words

SCREEN = 20  # the screen asks for one more shared shingle per so many
SEEN = 200_000  # signatures a task remembers
VALUES = byte_values(SPACES)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text; a text of fewer words is one shingle."""
    _, words, bounds, _ = texts_words(texts, VALUES)
    shingles = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for i in range(width):
        shingles = folded(shingles, words[i:i + len(shingles)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            yield np.unique(shingles[a:b - width + 1])
        else:
            whole = np.zeros(min(1, b - a), np.uint64)
            for i in range(a, b):
                whole = folded(whole, words[i:i + 1])
            yield whole


def signature(own: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(own.tobytes(), 11) - 2 ** 63


class Linked:
    """When two sets link: 100 * intersection >= percent * union."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent must be 1 .. 100")
        self.percent = percent

    def need(self, n):
        """The least intersection that a set of ``n`` has with any partner."""
        return -(-self.percent * n // 100)

    def overlap(self, a, b):
        """The least intersection of two linked sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def holds(self, common, a, b):
        return 100 * common >= self.percent * (a + b - common)

    def may(self, n: Column, m: Column, at_n: Column, at_m: Column) -> Column:
        """Whether sets of n and m, whose first shared shingle has these places, can link."""
        least = F.ceil((n + m) * self.percent / (100 + self.percent))
        return (100 * F.least(n, m) >= self.percent * F.greatest(n, m)) & (at_n <= n - least) & (at_m <= m - least)


def sets_of(docs: DataFrame, width: int, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, sig) for every row; sig is NULL for texts without words."""
    def run(batches):
        for table in regrouped(batches, 1):
            found = list(shingle_sets(table.column(1).to_pylist(), width))
            yield pa.RecordBatch.from_arrays([
                table.column(0).combine_chunks(), pa.array([len(x) for x in found], pa.int64()),
                pa.array([signature(x) if len(x) else None for x in found], pa.int64())], names=["doc_id", "n", "sig"])

    return docs.select(F.col(doc_id).cast("long"), as_bytes(F.col(text))).mapInArrow(run, "doc_id long, n long, sig long")


def distinct_sets(texts: DataFrame, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(signature, set) of the texts of a task, most copies once."""
    seen: set[int] = set()
    for table in regrouped(texts, 0):
        for own in shingle_sets(table.column(0).to_pylist(), width):
            if len(own) and (sig := signature(own)) not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(sig)
                yield sig, own


def pairs_of(found: Iterator[tuple[int, np.ndarray]], size: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """(h, sig) batches: a row for each hash."""
    sigs, parts, total = [], [], 0

    def batch():
        h = np.concatenate(parts).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.repeat(np.array(sigs, np.int64), [len(p) for p in parts]))], names=["h", "sig"])

    for sig, own in found:
        sigs.append(sig)
        parts.append(own)
        total += len(own)
        if total >= size:
            yield batch()
            sigs, parts, total = [], [], 0
    if parts:
        yield batch()


def runs(batches) -> Iterator[pa.RecordBatch]:
    """(sig, m): of the rows (h, sig) of one range, sorted, how many of each sig share their h.

    Runs are told apart while the rows stream past.  What lies at either end of the
    range may go on in the next one and counts as shared.
    """
    first = held = None  # held: the last row, and whether it is known to be shared

    def counted(sig):
        keys, m = np.unique(sig, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(m)], names=["sig", "m"])

    for batch in batches:
        if not batch.num_rows:
            continue
        h, sig = (batch.column(i).to_numpy() for i in (0, 1))
        if held is not None:
            h, sig = np.append(held[0], h), np.append(held[1], sig)
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (sig[1:] != sig[:-1])  # copies of a set that several tasks gave
        h, sig = h[new], sig[new]
        first = h[0] if first is None else first
        same = h[1:] == h[:-1]
        shared = h == first
        shared[1:] |= same
        shared[:-1] |= same
        if held is not None:
            shared[0] |= held[2]
        held = h[-1], sig[-1], shared[-1]
        yield counted(sig[:-1][shared[:-1]])
    if held is not None:
        yield counted(np.array([held[1]], np.int64))


def screened(docs: DataFrame, own: DataFrame, width: int, linked: Linked, text: str) -> DataFrame:
    """(sig, n) of the sets that may have a partner.

    Prefixes are taken in the order of the hashes, each longer by n / SCREEN.  A partner
    has need(n) shingles at least, and so a prefix that is longer by need(n) / SCREEN.
    """
    def run(batches):
        return pairs_of((sig, x[:len(x) - linked.need(len(x)) + 1 + len(x) // SCREEN])
                        for sig, x in distinct_sets(batches, width))

    rows = docs.select(as_bytes(F.col(text))).mapInArrow(run, "h long, sig long")
    shared = rows.repartitionByRange("h", "sig").sortWithinPartitions("h", "sig").mapInArrow(runs, "sig long, m long")
    shared = shared.groupBy("sig").agg(F.sum("m").alias("m"))
    sizes = own.where(F.col("sig").isNotNull()).groupBy("sig").agg(F.first("n").alias("n"))
    least = F.ceil(F.col("n") * linked.percent / 100).cast("long")
    return sizes.join(shared, "sig").where(F.col("m") >= F.floor(least / SCREEN) + 1).select("sig", "n")


def chosen_sets(docs: DataFrame, keep: DataFrame, width: int, text: str) -> DataFrame:
    """(sig, n, x): the sets of ``keep``, once each, as sorted hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(keep, "sig"))

    def run(batches):
        for table in regrouped(batches, 0):
            found = [x for x in shingle_sets(table.column(0).to_pylist(), width) if len(x)]
            sigs = np.array([signature(x) for x in found], np.int64)
            own = np.unique(sigs, return_index=True)[1] if len(sigs) else np.zeros(0, np.int64)
            own = own[passes(shared.value, sigs[own])]
            yield pa.RecordBatch.from_arrays([pa.array(sigs[own]), pa.array([found[i].tobytes() for i in own.tolist()], pa.binary())],
                                             names=["sig", "x"])

    rows = docs.select(as_bytes(F.col(text))).mapInArrow(run, "sig long, x binary")
    return rows.join(keep, "sig").groupBy("sig").agg(F.first("n").alias("n"), F.first("x").alias("x"))


def prefix_choice(df: np.ndarray, n: int, linked: Linked) -> tuple[int, int]:
    """(k, length): the prefix of a set of ``n`` whose shared shingles have the sorted counts ``df``.

    ``length`` counts shared shingles only; those of nobody else come first in the
    prefix.  It is 0 if some k-prefix holds fewer than k shared ones: no partner.
    """
    need = linked.need(n)
    meets = float((df[:max(0, len(df) - need + 1)] - 1).sum())  # documents met on the 1-prefix, at most
    best, k = None, 1
    while k <= need:
        length = min(len(df), len(df) - need + k)
        if length < k:
            return 1, 0
        # prefixes compared, and verifications of those that may have k matches
        cost = meets * (length + len(df) / k)
        if best is None or cost < best[0]:
            best = cost, k, length
        k *= 2
    return best[1], best[2]


NODE = "sig long, n long, k long, prefix long, own long, x binary, bits binary"
POSTING = "h long, sig long, n long, at long"


def nodes(sets: DataFrame, linked: Linked) -> DataFrame:
    """(sig, n, k, prefix, own, x, bits): ``x`` holds the shingles shared with others in their
    order, ``own`` of the n come before them, the first ``prefix`` of x are in the k-prefix,
    and ``bits`` is the bitmap of x."""
    def explode(batches):
        for batch in batches:
            yield from pairs_of(zip(batch.column(0).to_pylist(), (np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist())))

    def choose(batches):
        for batch in batches:
            rows = []
            for sig, n, pairs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                order = sorted((p["d"], p["h"]) for p in pairs)
                k, length = prefix_choice(np.array([d for d, _ in order], np.int64), n, linked)
                if length:
                    x = np.array([h for _, h in order], np.int64)
                    bits = np.zeros(BITMAP, bool)
                    bits[x & (BITMAP - 1)] = True
                    rows.append((sig, n, k, length, n - len(order), x.tobytes(), np.packbits(bits).tobytes()))
            kinds = [pa.int64()] * 5 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, kinds)],
                                             names=[c.split()[0] for c in NODE.split(", ")])

    tokens = sets.select("sig", "x").mapInArrow(explode, "h long, sig long")
    many = tokens.groupBy("h").agg(F.count(F.lit(1)).alias("d")).where("d > 1")
    shared = tokens.join(many, "h").groupBy("sig").agg(F.collect_list(F.struct("d", "h")).alias("shared"))
    least = F.ceil(F.col("n") * linked.percent / 100)
    return sets.select("sig", "n").join(shared, "sig").where(F.size("shared") >= least).select(
        "sig", "n", "shared").mapInArrow(choose, NODE)


def postings(found: DataFrame, linked: Linked) -> DataFrame:
    """(h, sig, n, at): the shared shingles of each node's 1-prefix and their places in the set."""
    def run(batches):
        for batch in batches:
            sig, n, own, x = (batch.column(i).to_pylist() for i in range(4))
            parts = [np.frombuffer(b, np.int64)[:m - linked.need(m) + 1 - o] if m - linked.need(m) + 1 > o else np.zeros(0, np.int64)
                     for m, o, b in zip(n, own, x)]
            sizes = [len(p) for p in parts]
            at = [np.arange(o, o + c) for o, c in zip(own, sizes)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([*parts, np.zeros(0, np.int64)])), pa.array(np.repeat(np.array(sig, np.int64), sizes)),
                pa.array(np.repeat(np.array(n, np.int64), sizes)), pa.array(np.concatenate([*at, np.zeros(0, np.int64)]))],
                names=["h", "sig", "n", "at"])

    return found.select("sig", "n", "own", "x").mapInArrow(run, POSTING)


class Comparison:
    """Prefixes and shingles of some nodes, as sets."""

    def __init__(self, linked: Linked):
        self.linked, self.known = linked, {}

    def sets(self, sig: int, prefix: int, x: bytes) -> tuple[frozenset, frozenset]:
        if sig not in self.known:
            all_ = np.frombuffer(x, np.int64).tolist()
            self.known[sig] = frozenset(all_[:prefix]), frozenset(all_)
        return self.known[sig]

    def links(self, a: tuple, b: tuple) -> bool:
        """a, b: (sig, n, k, prefix, x).  Enough matches in the prefixes, then the whole sets."""
        (p, x), (q, y) = (self.sets(s, length, own) for s, _, _, length, own in (a, b))
        return len(p & q) >= min(a[2], b[2]) and self.linked.holds(len(x & y), a[1], b[1])


def verified(pairs: DataFrame, found: DataFrame, linked: Linked) -> DataFrame:
    """(u, v) links among the pairs (a, b), u > v."""
    names = ("sig", "n", "k", "prefix", "x")

    def run(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            own = Comparison(linked)
            keep = [(max(a[0], b[0]), min(a[0], b[0])) for a, b in zip(zip(*columns[:5]), zip(*columns[5:])) if own.links(a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*keep) if keep else ((), ()))], names=["u", "v"])

    left, right = (found.select(*[F.col(c).alias(f"{side}_{c}") for c in names]) for side in "ab")
    joined = pairs.join(left, pairs["a"] == left["a_sig"]).join(right, pairs["b"] == right["b_sig"])
    return joined.select(*left.columns, *right.columns).mapInArrow(run, "u long, v long")


def placed(posts: DataFrame, classes: DataFrame | None) -> DataFrame:
    """``posts`` with the component ``c`` of each node so far and ``d``, the nodes of each shingle,
    without shingles that one component has alone."""
    if classes is None:
        rows = posts.withColumn("c", F.col("sig"))
    else:
        rows = posts.join(classes.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
            "c", F.coalesce("component", "sig")).drop("component")
    open_ = rows.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("d")).where(
        "lo < hi").select("h", "d")
    return rows.join(open_, "h")


def pivot_pairs(rows: DataFrame, linked: Linked, turn: int) -> DataFrame:
    """(a, b): each node with the pivot, of another component, of the rarest shingle by which they may link.

    The pivot of a shingle is the node with the smallest hash in this turn.
    """
    pivot = rows.groupBy("h").agg(F.min(F.struct(
        F.xxhash64(F.lit(turn), "sig").alias("o"), F.col("sig").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"),
        F.col("at").alias("at_b"))).alias("p")).select("h", "p.*")
    near = rows.join(pivot, "h").where((F.col("c") != F.col("cb")) & linked.may(F.col("n"), F.col("nb"), F.col("at"), F.col("at_b")))
    return near.groupBy(F.col("sig").alias("a")).agg(F.min(F.struct("d", "b")).alias("v")).select("a", "v.b")


def blocked(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The nodes of each shingle in blocks of about ``BLOCK_ROWS``, every two blocks of a
    shingle together once, under (h, i, j)."""
    size = found.select("sig", (F.col("n") - F.col("own")).alias("m"), "bits")
    parts = F.ceil(F.col("d") / BLOCK_ROWS).cast("int")
    own = F.pmod(F.xxhash64("sig"), F.col("parts")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    return rows.join(size, "sig").withColumn("parts", parts).withColumn("own_part", own).select("*", each.alias("other")).select(
        "h", F.least("own_part", "other").alias("i"), F.greatest("own_part", "other").alias("j"), "own_part",
        "sig", "n", "m", "at", "c", "bits")


BITMAP, BLOCK_ROWS = 1024, 2048
FEW = 50  # pivot rounds end when one links less than a node in so many


def block_pairs(linked: Linked):
    """(a, b): the pairs of different components in each run of rows with one (h, i, j) that may link."""
    def compare(rows: list[tuple]) -> np.ndarray:
        part, sig, n, m, at, c = (np.array(x) for x in list(zip(*rows))[:6])
        bits = np.unpackbits(np.frombuffer(b"".join(r[6] for r in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(np.float32)
        ones = bits.sum(axis=1)
        out = []
        for at_row in range(0, len(rows), 512):
            a = slice(at_row, at_row + 512)
            least = linked.overlap(n[a, None], n[None, :])
            fits = (c[a, None] < c[None, :]) & (at[a, None] <= n[a, None] - least) & (at[None, :] <= n[None, :] - least)
            if part.min() != part.max():  # pairs inside one block meet elsewhere
                fits &= part[a, None] != part[None, :]
            if not fits.any():
                continue
            both = bits[a] @ bits.T
            most = np.minimum(m[a, None] - (ones[a, None] - both), m[None, :] - (ones[None, :] - both))
            x, y = np.nonzero(fits & (most >= least))
            out.append(np.stack([sig[a][x], sig[y]]))
        return np.concatenate([*out, np.zeros((2, 0), np.int64)], axis=1)

    def run(batches):
        key, held = None, []
        for batch in batches:
            found = []
            columns = [x.to_pylist() for x in batch.columns]
            for k, row in zip(zip(*columns[:3]), zip(*columns[3:])):
                if k != key:
                    found += [compare(held)] if len(held) > 1 else []
                    key, held = k, []
                held.append(row)
            if found:
                yield pairs_batch(found)
        if len(held) > 1:
            yield pairs_batch([compare(held)])

    def pairs_batch(found):
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)  # many shingles give one pair
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def links(sets: DataFrame, linked: Linked) -> DataFrame:
    """(u, v): links that connect the nodes as all links do."""
    tables = Tables(sets.sparkSession)
    found = tables.written(nodes(sets, linked), "nodes")
    posts = tables.written(postings(found, linked), "postings")
    every, classes, turn, size = None, None, 0, found.count()
    while True:
        rows = tables.written(placed(posts, classes), "placed")
        pairs = tables.written(pivot_pairs(rows, linked, turn), "pivots")
        new = written(verified(pairs, found, linked), "verified")
        hit = new.count()
        if hit:
            every = new if every is None else every.unionByName(new)
            classes = written(components(every), "classes")
        if FEW * hit < size or not hit:  # pivots link hardly anything more
            break
        turn += 1
    rows = tables.written(placed(posts, classes), "placed") if hit else rows
    meet = blocked(rows, found).repartition("h", "i", "j").sortWithinPartitions("h", "i", "j")
    pairs = tables.written(meet.mapInArrow(block_pairs(linked), "a long, b long").distinct(), "pairs")
    rest = written(verified(pairs, found, linked), "verified")
    tables.delete()  # links and classes are whole
    return rest if every is None else every.unionByName(rest)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row.

    Words are lower-cased (A-Z) and parted by ASCII white space.  Two documents link
    when 100 * intersection >= ``percent`` * union of their distinct ``width``-word
    shingles; a text of fewer words is one shingle.  ``component_id`` is the
    smallest doc_id reachable (NULL ids count last).  NULL texts and texts without
    words have no shingles, link with nothing and are their own component.
    Repeated rows come back each.  Texts of any length are taken whole.  An empty
    table gives none.  Other columns are not read.  Shingles and sets are told apart
    by 64-bit hashes.
    """
    linked = Linked(percent)
    small_batches(docs.sparkSession)
    own = written(sets_of(docs, width, doc_id, text), "sets")
    keep = written(screened(docs, own, width, linked, text), "screened")
    sets = written(chosen_sets(docs, keep, width, text), "chosen")
    found = components(links(sets, linked))
    first = own.where(F.col("sig").isNotNull()).groupBy("sig").agg(F.min("doc_id").alias("first"))
    classes = first.join(found.withColumnRenamed("node", "sig"), "sig", "left").select(
        "sig", "first", F.coalesce("component", "sig").alias("class"))
    lowest = classes.groupBy("class").agg(F.min("first").alias("component_id"))
    member = written(classes.join(lowest, "class").select("sig", "component_id"), "members")
    return own.join(member, "sig", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
