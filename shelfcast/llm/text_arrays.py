"""Word and n-gram hashes of whole Arrow text batches in a few numpy passes.

A word is a run of bytes other than space and U+0009..U+000D (white space never occurs
inside a UTF-8 sequence).  Its hash is a polynomial over a table of random numbers,
taken from one running sum over the batch, and finished by a 64-bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE_BYTES = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RANDOM = np.random.default_rng(20240607)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_STEPS = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) * U(2) + U(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (one-to-one)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _BASE_INVERSE):
        p = np.full(1 << bits, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts one after the other, n + 1 offsets); NULL is empty."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer text is a range of its own."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size, dtype=np.int64) // most
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
    yield from ((a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a)


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray | None = LOWER, space: np.ndarray = SPACE):
    """(hash of each word, number of words before each text; n + 1 entries)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    blank = space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    begin = np.empty(n, bool)
    begin[0] = True
    begin[1:] = blank[:-1]
    begin |= edge[:n]
    begin &= ~blank
    finish = np.empty(n, bool)
    finish[-1] = True
    finish[:-1] = blank[1:]
    finish |= edge[1:]
    finish &= ~blank
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    power, inverse = _powers(max(16, int(n - 1).bit_length()))
    values = _BYTES[data if table is None else table[data]]
    values *= power[:n]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts]), np.searchsorted(starts, offsets)


def ngrams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``n`` words inside one text, number of them before each text)."""
    words = np.diff(first)
    count = np.maximum(words - n + 1, 0)
    before = np.concatenate([[0], np.cumsum(count)])
    if not before[-1]:
        return np.zeros(0, np.uint64), before
    total = len(hashes) - n + 1
    out = np.zeros(total, np.uint64)
    for k in range(n):
        out += hashes[k:k + total] * _STEPS[k]
    # windows that begin within the last n - 1 words of a text cross its end
    keep = np.ones(len(hashes), bool)
    for k in range(1, n):
        at = first[1:] - k
        keep[at[at >= first[:-1]]] = False
    return mix(out[keep[:total]]), before
