"""64-bit hashes of all words of many texts at once, by numpy over their bytes.

A word's hash is the sum of its bytes' values times powers of an odd number,
modulo 2^64, then mixed; equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21  # bytes hashed at a time (a longer word is taken whole)
ODD = np.uint64(0x9E3779B97F4A7C15)
SPACES = bytes([0x20, *range(0x09, 0x0E)])
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` or more powers of an odd number."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 2 * len(_powers)), 0xD1342543DE82EF95, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * ODD
    return h ^ (h >> np.uint64(29))


def byte_values(separators: bytes) -> np.ndarray:
    """A 64-bit value for each byte: 0 for separators, A-Z like a-z."""
    v = mixed(mixed(np.arange(1, 257, dtype=np.uint64)))
    v[ord("A"):ord("Z") + 1] = v[ord("a"):ord("z") + 1]
    v[list(separators)] = 0
    return v


def word_hashes(data: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and hash of every word of ``data`` (bytes; separators have the value 0)."""
    inside = values[data] != 0
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & ~before)
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + BLOCK)))
        a, b = int(starts[i]), int(starts[j]) if j < len(starts) else len(data)
        s = starts[i:j] - a
        place = np.arange(b - a) - np.repeat(s, np.diff(np.append(s, b - a)))
        out[i:j] = np.add.reduceat(values[data[a:b]] * powers(int(place.max()) + 1)[place], s)
        i = j
    return starts, mixed(out)


def texts_words(texts: list[bytes], values: np.ndarray, glue: bytes = b" ") -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Words of all ``texts``: first byte, hash, the bounds of each text's words, and the joined bytes."""
    data = glue.join(texts)
    starts, hashes = word_hashes(np.frombuffer(data, np.uint8), values)
    ends = np.cumsum([len(t) + len(glue) for t in texts], dtype=np.int64)
    return starts, hashes, np.concatenate([[0], np.searchsorted(starts, ends)]), data


def folded(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a sequence from that of its beginning and its next word."""
    h = (h ^ word) * ODD
    return h ^ (h >> np.uint64(31))


def regrouped(batches, column: int, size: int = 1 << 22):
    """Arrow batches joined until ``column`` holds about ``size`` bytes."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.column(column).nbytes
        if total >= size:
            yield pa.Table.from_batches(held).combine_chunks()
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
