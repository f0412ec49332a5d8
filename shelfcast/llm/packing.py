"""Packing token sequences into windows by best-fit decreasing.

Every document is tokenized whole and ends with an end id.  Overlong documents are first
cut into full windows; the remainders are placed, longest first, into the open window
with the least sufficient room, found in a segment tree indexed by remaining capacity.
Pieces are dealt to shards one after the other and each shard is packed on its own, so a
shard holds about ``shard_rows`` pieces at any input size, whatever the lengths and however
often a row repeats, and leaves at most a few windows unfilled.

Defined results: NULL and empty texts give one piece holding only the end id; repeated
rows give one set of pieces each; an empty table gives no rows; input columns other than
the key and the text are not used.  The text is split at ASCII white space, across which
the tokenizer never merges ids; a task encodes each distinct word once by the library, as
long as its words fit ``CACHE_BYTES``, and the words unused for longest go first.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.text_arrays import LOWER, flat, word_hashes

WINDOW = 4096
END_ID = 2
SHARD_ROWS = 8192
#: Bytes of text tokenized at a time, bytes of encoded words a task keeps, and words
#: expanded at a time.
SLICE_BYTES = 4 << 20
CACHE_BYTES = 48 << 20
EXPAND_WORDS = 500_000


class RoomTree:
    """Segment tree over remaining capacity 0..capacity; a node is the number of open
    windows below it."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def put(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(window, room) with the least room >= need, removed from the tree."""
        i, count = need + self.size, self.count
        while not count[i]:
            while i & 1:  # a right child: its range ends here, go up
                i >>= 1
            if not i:
                return None
            i += 1  # the sibling to the right
        while i < self.size:
            i <<= 1
            if not count[i]:
                i += 1
        room = i - self.size
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; pieces of equal length keep their order."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, n = RoomTree(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = tree.take(need)
        if found is None:
            found, n = (n, capacity), n + 1
        window[i], offset[i] = found[0], capacity - found[1]
        if found[1] > need:
            tree.put(found[1] - need, found[0])
    return window, offset


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Marks that the tokenizer always parts from an ASCII letter before them.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK[list(b".,;:!?*$%&#()=")] = True


def _plain(texts: pa.Array) -> pa.Array:
    """The same texts in ASCII lower case and with a space between an ASCII letter and a
    mark after it.  The tokenizer lower-cases, parts letters from marks and drops white
    space itself, so the ids are the same, but far fewer words are distinct.  Texts with
    "<|", which may spell a special token, are left as they are."""
    data, offsets = flat(texts)
    if not len(data) or b"<|" in data.tobytes():
        return pc.fill_null(texts, "")
    part = np.zeros(len(data), bool)
    part[1:] = _MARK[data[1:]] & _LETTER[data[:-1]]
    first = offsets[:-1]
    part[first[first < len(data)]] = False
    shift = np.cumsum(part, dtype=np.int64)
    out = np.full(len(data) + int(shift[-1]), 32, np.uint8)
    out[np.arange(len(data)) + shift] = LOWER[data]
    moved = offsets + np.concatenate([[0], shift])[offsets]
    if moved[-1] < 1 << 31:
        return pa.StringArray.from_buffers(len(texts), pa.py_buffer(moved.astype(np.int32)), pa.py_buffer(out))
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(moved), pa.py_buffer(out))


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs data[start:start + size], one after the other."""
    total = np.cumsum(size)
    if not len(total):
        return data[:0]
    return data[np.arange(total[-1]) + np.repeat(start - (total - size), size)]


class Words:
    """Encoded words of one task, in a few arrays that are freed with it: words are found by
    their hash and compared byte by byte."""

    def __init__(self, path: str, most: int = CACHE_BYTES):
        self.path, self.most, self.now = path, most, 0
        self.hash, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.data, self.at = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.ids_at = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def size(self) -> int:
        return sum(x.nbytes for x in (self.hash, self.used, self.data, self.at, self.ids, self.ids_at))

    def encode(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after the other, number of ids of each)."""
        data, at = flat(distinct)
        length = np.diff(at)
        hashed, _ = word_hashes(data, at, None)
        place = np.minimum(np.searchsorted(self.hash, hashed), max(0, len(self.hash) - 1))
        known = np.zeros(len(distinct), bool)
        if len(self.hash):
            known = (self.hash[place] == hashed) & (np.diff(self.at)[place] == length)
            rows = np.flatnonzero(known)
            differ = _gather(self.data, self.at[place[rows]], length[rows]) != _gather(data, at[rows], length[rows])
            known[rows[np.searchsorted(np.cumsum(length[rows]), np.flatnonzero(differ), "right")]] = False
        new = np.flatnonzero(~known)
        made = [e.ids for e in _tokenizer(self.path).encode_batch_fast(pc.take(distinct, pa.array(new)).to_pylist(), add_special_tokens=False)]
        made_size = np.fromiter(map(len, made), np.int64, len(made))
        made_ids = np.fromiter((i for ids in made for i in ids), np.uint32, int(made_size.sum()))
        size, start = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
        old = place[known]
        size[known], start[known] = np.diff(self.ids_at)[old], self.ids_at[old]
        size[new], start[new] = made_size, len(self.ids) + np.cumsum(made_size) - made_size
        out = _gather(np.concatenate([self.ids, made_ids]), start, size)
        self.used[old] = self.now
        self._keep(hashed[new], _gather(data, at[new], length[new]), length[new], made_ids, made_size)
        return out, size

    def _keep(self, hashed: np.ndarray, data: np.ndarray, length: np.ndarray, ids: np.ndarray, n_ids: np.ndarray) -> None:
        all_hash, first = np.unique(np.concatenate([self.hash, hashed]), return_index=True)
        used = np.concatenate([self.used, np.full(len(hashed), self.now, np.int32)])[first]
        if self.size() + len(data) + 4 * len(ids) + 28 * len(hashed) > self.most:  # the half used last stays
            stay = used >= np.median(used) if (used > np.median(used)).sum() == 0 else used > np.median(used)
            if stay.all():
                stay[::2] = False
            all_hash, first, used = all_hash[stay], first[stay], used[stay]
        at, ids_at = (np.concatenate([x[:-1], x[-1] + np.cumsum(n) - n]) for x, n in ((self.at, length), (self.ids_at, n_ids)))
        length, n_ids = np.concatenate([np.diff(self.at), length])[first], np.concatenate([np.diff(self.ids_at), n_ids])[first]
        self.data = _gather(np.concatenate([self.data, data]), at[first], length)
        self.ids = _gather(np.concatenate([self.ids, ids]), ids_at[first], n_ids)
        self.at, self.ids_at = (np.concatenate([[0], np.cumsum(n)]) for n in (length, n_ids))
        self.hash, self.used, self.now = all_hash, used, self.now + 1


def encode_texts(texts: pa.Array, path: str, end_id: int = END_ID, words: Words | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, number of ids of each text)."""
    words = words or Words(path)
    lists = pc.ascii_split_whitespace(_plain(texts))
    per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # a blank text is a list of empty words
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    pool, size = np.zeros(0, np.uint32), np.zeros(len(empty), np.int64)
    if not empty.all():
        pool, size[~empty] = words.encode(coded.dictionary.filter(pa.array(~empty)))
    # the end of a text counts as one more word
    pool, size = np.concatenate([pool, np.array([end_id], np.uint32)]), np.concatenate([size, [1]])
    word = np.full(len(coded) + len(per_text), len(empty), np.int32)
    text_of_word = np.repeat(np.arange(len(per_text)), per_text)
    word[np.arange(len(coded)) + text_of_word] = coded.indices.to_numpy(zero_copy_only=False)
    ends = np.cumsum(per_text + 1)
    n_ids = np.add.reduceat(size[word], ends - per_text - 1) if len(ends) else np.zeros(0, np.int64)
    lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)])), pa.array(pool))
    parts = [lists.take(pa.array(word[a:a + EXPAND_WORDS])).flatten().to_numpy() for a in range(0, len(word), EXPAND_WORDS)]
    return np.concatenate(parts).astype("<u4", copy=False) if parts else pool[:0], n_ids


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(size) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
    yield from ((a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a)


PIECE = "id {key}, start long, length long, ids_crc32 long, doc_tokens long, turn long"


def cut_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
               end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Full windows and the remainder of each document: key, start, length, crc32 of the
    piece's ids, ids of the document, turn (a running number of the task's pieces, begun at
    a number of the task's own) and, if asked for, the ids as little-endian 32-bit binary."""

    def run(batches):
        words, turn = Words(path), TaskContext.get().partitionId() * 7919
        for batch in batches:
            keys, texts = batch.column("id"), batch.column("text")
            for a, b in _slices(texts):
                ids, n_ids = encode_texts(texts.slice(a, b - a), path, end_id, words)
                pieces = -(-n_ids // window)
                row = np.repeat(np.arange(b - a), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                length = np.minimum(window, n_ids[row] - start)
                begin = (np.cumsum(n_ids) - n_ids)[row] + start
                raw = memoryview(ids).cast("B")
                parts = [raw[4 * s:4 * (s + n)] for s, n in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [keys.slice(a, b - a).take(pa.array(row)), pa.array(start), pa.array(length),
                           pa.array([zlib.crc32(x) for x in parts], pa.int64()), pa.array(n_ids[row]),
                           pa.array(turn + np.arange(len(row)))]
                turn += len(row)
                names = ["id", "start", "length", "ids_crc32", "doc_tokens", "turn"]
                if with_ids:
                    columns.append(pa.array([bytes(x) for x in parts], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = PIECE.format(key=source.schema["id"].dataType.simpleString()) + (", ids binary" if with_ids else "")
    return source.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", window: int = WINDOW,
         end_id: int = END_ID, shard_rows: int = SHARD_ROWS, with_ids: bool = False) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``ids``).  Only these rows are shuffled, one shard of bounded size per group."""
    # a byte makes one id at most, so rows + bytes / window bounds the pieces
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text).cast("long")), F.lit(0))).first()
    shards = max(1, -(-(rows + size // window) // shard_rows))
    pieces = cut_pieces(docs, path, key, text, window, end_id, with_ids)
    dealt = pieces.withColumn("shard", F.pmod("turn", F.lit(shards))).drop("turn")

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "ids_crc32", "start", "id"], ascending=[False, True, True, True],
                                  kind="stable", ignore_index=True)
        seq, offset = best_fit_decreasing(frame["length"].to_numpy(), window)
        return frame.assign(sequence_id=(frame["shard"].to_numpy() << 32) + seq, offset=offset).drop(columns="shard")

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.drop("turn").schema.fields)
    placed = dealt.groupBy("shard").applyInPandas(place, f"{fields}, sequence_id long, offset long")
    return placed.withColumnRenamed("id", key)


def sequences(packed: DataFrame, end_pad: int = END_ID, window: int = WINDOW) -> DataFrame:
    """Whole windows from ``pack(..., with_ids=True)``: sequence_id, n_ids and the ids,
    padded to ``window`` unless their number is a power of two.  A group is one window."""

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        ids = b"".join(frame.sort_values("offset")["ids"])
        n = len(ids) // 4
        full = n if n & (n - 1) == 0 else window
        ids += np.full(full - n, end_pad, "<u4").tobytes()
        return pd.DataFrame({"sequence_id": [frame["sequence_id"].iloc[0]], "n_ids": [n], "ids": [ids]})

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(
        join, "sequence_id long, n_ids long, ids binary")
