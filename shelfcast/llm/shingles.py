"""Word shingles of whole texts and their MinHash signatures, in numpy.

Words are runs of bytes other than 0x20 and 0x09-0x0D after lower-casing A-Z. A
shingle is five consecutive words; a text of one to four words is one shingle,
a text without words has none. Words and shingles are 64-bit hashes: a word is
a polynomial over random byte values (all words of a batch by one running sum),
a shingle mixes its words in order.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from shelfcast.llm.common import slices

WIDTH = 5
BATCH = 1 << 20
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(20240607)
BYTE_VALUES = _rng.integers(1, 1 << 64, 256, dtype=np.uint64)[LOWERED]
BASE = 0x9E3779B97F4A7C15
PLACES = _rng.integers(1 << 32, 1 << 64, WIDTH, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the one of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    def run(base: int) -> np.ndarray:
        steps = np.full(n, base & (2**64 - 1), dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)
    return run(BASE), run(pow(BASE, -1, 1 << 64))


def word_hashes(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts laid end to end (``cuts``: their offsets),
    and how many words lie before each cut."""
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(cuts), dtype=np.int64)
    inside = ~WHITE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[cuts] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:n]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    width = 1 << max(20, (n - 1).bit_length())
    up, down = _powers(width)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:n], out=sums[1:])
    return mixed((sums[end] - sums[begin]) * down[begin]), np.searchsorted(begin, cuts)


def shingle_sets(data: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words, at = word_hashes(data, cuts)
    n = len(words)
    full = np.zeros(n, dtype=np.uint64)
    if n >= WIDTH:
        whole = full[:n - WIDTH + 1]
        for k in range(WIDTH):
            whole += words[k:n - WIDTH + 1 + k] * PLACES[k]
        whole[:] = mixed(whole)
    out = []
    bounds = at.tolist()
    for a, b in zip(bounds, bounds[1:]):
        if b - a >= WIDTH:
            out.append(np.unique(full[a:b - WIDTH + 1]))
        elif b > a:
            short = np.uint64(b - a) + (words[a:b] * PLACES[:b - a]).sum(dtype=np.uint64)
            out.append(mixed(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


@functools.cache
def coordinates(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7919)
    return (rng.integers(0, 1 << 64, count, dtype=np.uint64) | np.uint64(1),
            rng.integers(0, 1 << 64, count, dtype=np.uint64))


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash signature of each set, 32 bits a coordinate; empty sets get 0."""
    out = np.zeros((len(sets), count), dtype=np.uint32)
    filled = [i for i, s in enumerate(sets) if len(s)]
    factor, shift = coordinates(count)
    run, held = [], 0
    for place, i in enumerate(filled):
        run.append(i)
        held += len(sets[i])
        if held < 16384 and place + 1 < len(filled):      # work arrays that stay in a core's cache
            continue
        x = np.concatenate([sets[j] for j in run])
        starts = np.cumsum([0] + [len(sets[j]) for j in run[:-1]])
        for k in range(count):
            out[run, k] = np.minimum.reduceat((x ^ shift[k]) * factor[k], starts) >> np.uint64(32)
        run, held = [], 0
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column (null: empty), without copying."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def sets_of(column: pa.Array) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Runs of rows of bounded size with their shingle sets."""
    column = column.cast(pa.binary())
    for a, b in slices(column, BATCH):
        yield a, b, shingle_sets(*buffers(column.slice(a, b - a)))


def set_key(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
