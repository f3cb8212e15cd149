"""Best-fit packing of token sequences, certified by lower bounds and repaired.

Documents become pieces of at most ``capacity`` tokens.  Each partition packs
its pieces by best-fit decreasing and compares the number of bins with a lower
bound from dual feasible functions.  Equal: the packing is certified optimal
for these pieces and stays.  Otherwise its full bins stay, the documents of
all other bins go back, are exchanged between the partitions that have gaps,
and best-fit decreasing runs again on the new mixtures.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, written

PIECES_PER_TASK = 100_000  # pieces (a few numbers each) that one task packs together
ROUNDS = 3


def vocabulary(path: str) -> tuple[dict[bytes, int], list[tuple[str, int]], str]:
    """Byte sequences -> ids, and special strings -> ids, of a byte-level BPE file; and the file's text."""
    with open(path, encoding="utf-8") as f:
        whole = f.read()
    spec = json.loads(whole)
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = [(t["content"], t["id"]) for t in spec.get("added_tokens", [])]
    names = {s for s, _ in special}
    return {bytes(byte_of[c] for c in s): i for s, i in spec["model"]["vocab"].items()
            if s not in names}, special, whole


def encoder(ranks: dict, special: list, whole: str):
    """text -> ids.  A byte-level BPE file numbers its merges in rank order, so a
    rank-based encoder gives the ids of the file's own library, several times faster.
    Its pattern overflows the stack in white space of about a million characters, so
    texts with ``LONG_SPACE`` of it in a row go to the file's own library."""
    import tiktoken
    own = []
    enc = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = dict(special)
    cut = re.compile("(" + "|".join(re.escape(s) for s in ids) + ")") if ids else None

    def encode(text: str) -> list[int]:
        if len(text) >= LONG_SPACE and SPACES.search(text):
            if not own:
                from tokenizers import Tokenizer
                own.append(Tokenizer.from_str(whole))
            return own[0].encode(text, add_special_tokens=False).ids
        if cut is None or not cut.search(text):
            return enc.encode_ordinary(text)
        out: list[int] = []
        for part in cut.split(text):
            out.extend([ids[part]] if part in ids else enc.encode_ordinary(part))
        return out
    return encode


# Fixed value: the split pattern of byte-level BPE files of this family.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

LONG_SPACE = 100_000
SPACES = re.compile(r"(?<!\s)\s{%d}" % LONG_SPACE)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    Whole texts are tokenized (NULL: empty) and ended by ``end_id``; a document
    longer than ``capacity`` is cut so that all pieces but the first are full.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = spark.sparkContext.broadcast(vocabulary(tokenizer))  # as large as the vocabulary file

    def run(batches):
        encode = encoder(*known.value)
        for batch in batches:
            out = []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(t), end_id], dtype="<u4").tobytes()
                n = len(ids) // 4
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    out.append((d, k, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    src = docs.select(F.col(doc_id).cast("long"), F.coalesce(F.col(text), F.lit("")))
    return src.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each size, and the room left in each bin."""
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    room: list[int] = []
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set while a bin has exactly r left
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fits = rooms >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = open_at[r].pop()
            if not open_at[r]:
                rooms &= ~(1 << r)
        else:
            b, r = len(room), capacity
            room.append(capacity)
        bins[i], offsets[i], room[b] = b, capacity - r, r - s
        if r - s:
            open_at[r - s].append(b)
            rooms |= 1 << (r - s)
    return bins, offsets, np.array(room, np.int64)


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual feasible functions.

    f_k drops sizes under k and rounds sizes over capacity - k up to the
    capacity; u_m rounds (m + 1) * size / capacity down unless it is whole.
    Each maps any set of sizes that fits one bin to values that still fit it.
    """
    n = np.bincount(sizes, minlength=capacity + 1)
    x = np.arange(capacity + 1)
    best = 0
    for k in range(0, capacity // 2 + 1):
        f = np.where(x > capacity - k, capacity, np.where(x < k, 0, x))
        best = max(best, -(-int(n @ f) // capacity))
    for m in range(1, 33):
        whole = (m + 1) * x % capacity == 0
        u = np.where(whole, m * x, (m + 1) * x // capacity * capacity)
        best = max(best, -(-int(n @ u) // (m * capacity)))
    return best


def _pack(pieces: DataFrame, capacity: int, tasks: int, turn: int) -> DataFrame:
    cols = list(pieces.columns)

    def run(frames):
        own = [f for f in frames if len(f)]
        if not own:
            return
        frame = pd.concat(own, ignore_index=True)
        sizes = frame["length"].to_numpy()
        bins, offsets, room = best_fit_decreasing(sizes, capacity)
        first = (turn << 56) | (TaskContext.get().partitionId() << 32)
        yield frame.assign(sequence_id=first + bins, offset=offsets, _pk_room=room[bins],
                           _pk_sure=len(room) == lower_bound(sizes, capacity))

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long") \
        .add("_pk_room", "long").add("_pk_sure", "boolean")
    return pieces.select(*cols).repartition(tasks).mapInPandas(run, schema)


def pack(pieces: DataFrame, capacity: int, pieces_per_task: int = PIECES_PER_TASK,
         rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (column ``length``, 1 .. capacity) plus ``sequence_id`` and ``offset``.

    Partition sizes are bounded by ``pieces_per_task``, whatever the input.  A
    rerun is kept only where it needs fewer bins than before.  Each round is a
    written table.  Repeated rows are packed each; an empty table gives none.
    """
    todo, done = written(pieces, "pieces"), []
    old = None
    for turn in range(rounds):
        tasks = max(1, -(-todo.count() // pieces_per_task))
        new = written(_pack(todo, capacity, tasks, turn), "packed")
        if old is not None:
            bins = [f.agg(F.count_distinct("sequence_id")).first()[0] for f in (old, new)]
            if bins[1] >= bins[0]:
                break
        gap = "not _pk_sure and _pk_room > 0"
        if old is not None:
            done.pop()
        done += [new.where(f"not ({gap})"), old := new.where(gap)]
        if turn == rounds - 1 or old.isEmpty():
            break
        todo = old.drop("sequence_id", "offset", "_pk_room", "_pk_sure")
    out = done[0]
    for f in done[1:]:
        out = out.unionByName(f)
    return out.drop("_pk_room", "_pk_sure")
