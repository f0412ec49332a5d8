"""Cutting texts where no tokenizer match can span, and expanding per-segment results.

A blank that follows a character which is surely not white space always starts a new match
of the byte-level split patterns and is never merged with what stands before it, so a text
may be cut there.  The distinct segments of a slice are encoded once and taken back by
their codes.  Where a text offers no such place it stays whole.  By the same rule segments
that begin with a blank and end solidly can be joined into long strings for the tokenizer,
which spares it a call and a result object for every segment.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfcast.llm.text_arrays import SPACE, flat

SLICE_BYTES = 4 << 20
#: Segments expanded at a time, bytes of segments joined for one call of the tokenizer.
EXPAND = 500_000
JOIN_BYTES = 1 << 16
ONLY_SPACE = np.zeros(256, bool)
ONLY_SPACE[0x20] = True


def _solid(data: np.ndarray) -> np.ndarray:
    """Whether a byte ends a character that is surely not white space: graphic ASCII, or
    the second byte of U+00C0..U+07FF."""
    out = (data > 0x20) & (data < 0x7F)
    out[1:] |= (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    return out


def _strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    raw = pa.py_buffer(np.ascontiguousarray(data))
    if len(data) < 1 << 31:
        return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), raw)
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), raw)


def text_segments(texts: pa.Array, blank: np.ndarray = SPACE) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct segments, code of every segment of all texts one after the other, number of
    segments before each text: n + 1 entries).  The segments of a text joined are the text."""
    data, offsets = flat(texts)
    n = len(data)
    if not n:
        return pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[1:n] = blank[data[1:]] & _solid(data)[:-1]
    cut[offsets] = True
    cut[n] = True
    at = np.flatnonzero(cut)
    coded = _strings(data, at).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(at[:-1], offsets)


def encode_segments(distinct: pa.Array, call: Callable[[list[str]], list], token_size: np.ndarray,
                    blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all distinct segments one after the other, number of ids of each).  ``call``
    encodes a list of strings; ``token_size`` is the number of bytes of each id."""
    data, at = flat(distinct)
    if not len(distinct):
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    joins = blank[data[at[:-1]]] & _solid(data)[at[1:] - 1]
    joined, lone = np.flatnonzero(joins), np.flatnonzero(~joins)
    inner, inner_at = flat(pc.take(distinct, pa.array(joined)))
    edges = [0, *(np.flatnonzero(np.diff(inner_at[1:] // JOIN_BYTES)) + 1).tolist(), len(joined)] if len(joined) else []
    spans = list(zip(edges, edges[1:], strict=False))
    strings = [inner[inner_at[a]:inner_at[b]].tobytes().decode() for a, b in spans]
    found = call(strings + pc.take(distinct, pa.array(lone)).to_pylist())
    pools, sizes, order = [], [], []
    for (a, b), ids in zip(spans, found[:len(strings)], strict=True):
        ids = np.asarray(ids, np.int32)
        reach = np.cumsum(token_size[ids])
        until = inner_at[a + 1:b + 1] - inner_at[a]
        ends = np.searchsorted(reach, until) + 1
        if len(ids) and reach[-1] == until[-1] and (reach[ends - 1] == until).all():
            pools.append(ids)
            sizes.append(np.diff(np.concatenate([[0], ends])))
            order.append(joined[a:b])
        else:  # some segment does not come back byte by byte: no telling where its ids end
            lone = np.concatenate([lone, joined[a:b]])
            found += call(pc.take(distinct, pa.array(joined[a:b])).to_pylist())
    alone = found[len(strings):]
    pools += [np.asarray(x, np.int32) for x in alone]
    sizes.append(np.fromiter(map(len, alone), np.int64, len(alone)))
    order.append(lone)
    pool, sizes, order = np.concatenate(pools), np.concatenate(sizes), np.concatenate(order)
    # put the ids into the order of the segments
    size, start = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
    size[order], start[order] = sizes, np.cumsum(sizes) - sizes
    total = np.cumsum(size)
    return pool[np.arange(total[-1]) + np.repeat(start - (total - size), size)], size


def expand(pool: np.ndarray, size: np.ndarray, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, n + 1 offsets) from the ids of the distinct
    segments and the segments of each text."""
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)])), pa.array(pool))
    parts = [lists.take(pa.array(codes[a:a + EXPAND])).flatten().to_numpy() for a in range(0, len(codes), EXPAND)]
    before = np.concatenate([[0], np.cumsum(size[codes])]).astype(np.int64)
    return (np.concatenate(parts) if parts else pool[:0]), before[first]
