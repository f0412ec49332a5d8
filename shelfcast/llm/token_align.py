"""Alignment of the tokens of two tokenizers over the bytes of each text.

Both tokenizers see a space and the text.  Each gives a rising list of byte ends.  The
shorter list drives a galloping search into the longer one: every end starts at its
proportional place in its text, doubles its step until it is bracketed and bisects the
bracket (all ends of a slice at once).  Ends found in both lists cut the tokens into groups.
The differences of the ranks give each token's range of overlapped tokens, the links.

``link_statistics`` also counts, for every pair of token ids, the documents that hold it
linked.  A task keeps the links of its documents as blocks of bounded size: the distinct
pairs of a block once, and per document the places and multiplicities of its pairs.  Pairs
are counted per block first and summed by a shuffle of one row per block and distinct pair;
the sums go back to the blocks the same way.  Neither texts nor single links are shuffled,
and nothing is collected or broadcast by hand.

Defined results: NULL and empty texts, and texts whose joined token bytes differ from the
space and the text, have no tokens and zero counts (``groups`` is empty, its digest '');
repeated rows are documents each; NULL keys are kept; an empty table gives no rows; input
columns other than the key and the text are not used, so their names never clash.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.byte_bpe import character_bytes
from shelfcast.llm.segments import ONLY_SPACE, encode_segments, expand, text_segments
from shelfcast.llm.text_arrays import SPACE, flat, slices
from shelfcast.sources.sinks import materialize

SLICE_BYTES = 2 << 20
#: Pairs of (document, id pair) in a block, not counting the slice that fills it.
BLOCK_ENTRIES = 400_000
#: Fixed value: the pieces' mark of a space.
SPACE_MARK = "▁"


class Tokens:
    """The bytes of a vocabulary's tokens (by id), and how to encode strings with it.

    ``blank`` are the bytes at which a text may be cut for encoding; None: it may not be.
    """

    def __init__(self, spelled: list[bytes], call, blank: np.ndarray | None):
        size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.at = np.concatenate([[0], np.cumsum(size)])
        self.size, self.call, self.blank = size, call, blank

    def encode(self, spaced: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pool, size, codes, first, whole): ids and sizes of the distinct segments, the
        segments of each text, and whether a text's token bytes are the text."""
        if self.blank is None:
            coded = spaced.dictionary_encode()
            distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
            first = np.arange(len(spaced) + 1)
            found = self.call(distinct.to_pylist())
            size = np.fromiter(map(len, found), np.int64, len(found))
            pool = np.concatenate([np.zeros(0, np.int32), *[np.asarray(x, np.int32) for x in found]])
        else:
            distinct, codes, first = text_segments(spaced, self.blank)
            pool, size = encode_segments(distinct, self.call, self.size, self.blank)
        same = self._same(pool, size, distinct)[codes]
        bad = np.concatenate([[0], np.cumsum(~same)])[first]
        return pool, size, codes, first, np.diff(bad) == 0

    def _same(self, pool: np.ndarray, size: np.ndarray, distinct: pa.Array) -> np.ndarray:
        """Whether the joined bytes of a segment's tokens are the segment."""
        data, at = flat(distinct)
        length = self.size[pool]
        reach = np.concatenate([[0], np.cumsum(length)])
        mine = reach[np.concatenate([[0], np.cumsum(size)])]
        same = np.diff(mine) == np.diff(at)
        if same.all():
            spelled = self.data[np.arange(reach[-1]) + np.repeat(self.at[pool] - reach[:-1], length)]
            same[np.searchsorted(at, np.flatnonzero(spelled != data), "right") - 1] = False
            return same
        until = np.concatenate([[0], np.cumsum(size)])
        for i in np.flatnonzero(same).tolist():
            spelled = b"".join(self.data[self.at[x]:self.at[x + 1]].tobytes() for x in pool[until[i]:until[i + 1]].tolist())
            same[i] = spelled == data[at[i]:at[i + 1]].tobytes()
        return same


@lru_cache(maxsize=2)
def byte_level_tokens(path: str) -> Tokens:
    """A byte-level BPE file of the tokenizers library; special tokens are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    vocabulary = model.get_vocab(with_added_tokens=False)
    spelled = [b""] * (max(model.get_vocab().values()) + 1)
    for token, i in vocabulary.items():
        try:
            spelled[i] = character_bytes(token)
        except KeyError:  # a special token
            pass
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    split = spec.get("pre_tokenizer") or {}
    plain = spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) \
        and not split.get("add_prefix_space") and len({x for x in spelled if len(x) == 1}) == 256
    call = lambda part: [e.ids for e in model.encode_batch_fast(part, add_special_tokens=False)]
    return Tokens(spelled, call, SPACE if plain else None)


@lru_cache(maxsize=2)
def piece_tokens(path: str) -> Tokens:
    """A sentencepiece model, which puts a space before each string itself."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    model = SentencePieceProcessor(model_file=path)
    spelled = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            spelled.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            spelled.append(b"")
        else:
            spelled.append(piece.replace(SPACE_MARK, " ").encode())
    spec = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        spec.ParseFromString(f.read())
    rules, lone = spec.normalizer_spec, model.piece_to_id(SPACE_MARK)
    # no merge may span a space after another character, and a string's own spaces must stay
    inner = any(SPACE_MARK in model.id_to_piece(i).lstrip(SPACE_MARK) for i in range(model.vocab_size()))
    plain = (rules.name == "identity" and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and not inner
             and spec.trainer_spec.model_type == spec.trainer_spec.BPE and spec.trainer_spec.byte_fallback
             and lone != model.unk_id())

    def call(part: list[str]) -> list[list[int]]:
        found = model.encode([x[1:] for x in part], num_threads=1) if part else []
        return [ids if x != " " else [lone] for x, ids in zip(part, found, strict=True)]

    return Tokens(spelled, call, ONLY_SPACE if plain else None)


def gallop(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """Rank of each end of ``short`` in ``long`` (entries below it), by doubling steps from
    ``guess`` until the end is bracketed and halving the bracket.  All ends move at once."""
    n = len(long)
    if not n or not len(short):
        return np.zeros(len(short), np.int64)
    low, high = np.clip(guess, 0, n - 1), None
    up = long[low] < short
    # bracket: long[low - 1] < x <= long[high], with -inf before and inf behind the list
    high = np.where(up, low + 1, low)
    low = np.where(up, low + 1, low)
    step, moving = 1, np.flatnonzero(up)
    while len(moving):
        high[moving] = np.minimum(low[moving] + step - 1, n)
        moving = moving[(high[moving] < n) & (long[np.minimum(high[moving], n - 1)] < short[moving])]
        low[moving] = high[moving] + 1
        step *= 2
    step, moving = 1, np.flatnonzero(~up)
    while len(moving):
        low[moving] = np.maximum(high[moving] - step, 0)
        moving = moving[(low[moving] > 0) & (long[low[moving]] >= short[moving])]
        high[moving] = low[moving]
        step *= 2
    moving = np.flatnonzero(low < high)
    while len(moving):
        middle = (low[moving] + high[moving]) >> 1
        below = long[np.minimum(middle, n - 1)] < short[moving]
        low[moving[below]] = middle[below] + 1
        high[moving[~below]] = middle[~below]
        moving = moving[low[moving] < high[moving]]
    return low


class Aligned:
    """The alignment of a slice of texts; tokens of all texts stand one after the other.

    ids_a, ids_b; before_a, before_b (n + 1 entries: tokens before each text); last_a,
    last_b (the tokens that end a group); link_a, link_b (places of linked tokens) and
    links_before (n + 1 entries).
    """

    def __init__(self, texts: pa.Array, a: Tokens, b: Tokens):
        filled = pc.fill_null(texts, "")
        spaced = pc.binary_join_element_wise("", filled, " ")
        found = [t.encode(spaced) for t in (a, b)]
        keep = found[0][4] & found[1][4] & (pc.binary_length(filled).to_numpy(zero_copy_only=False) > 0)
        sides = []
        for pool, size, codes, first, _ in found:
            stay = np.repeat(keep, np.diff(first))
            count = np.where(keep, np.diff(first), 0)
            sides.append(expand(pool, size, codes[stay], np.concatenate([[0], np.cumsum(count)])))
        (self.ids_a, self.before_a), (self.ids_b, self.before_b) = sides
        ends = np.cumsum(a.size[self.ids_a]), np.cumsum(b.size[self.ids_b])
        befores = self.before_a, self.before_b
        s, l = (0, 1) if len(ends[0]) <= len(ends[1]) else (1, 0)
        n_short, n_long = np.diff(befores[s]), np.diff(befores[l])
        row = np.repeat(np.arange(len(n_short)), n_short)
        inside = np.arange(len(ends[s])) - befores[s][row]
        rank = gallop(ends[s], ends[l], befores[l][row] + inside * n_long[row] // np.maximum(n_short[row], 1))
        equal = ends[l][rank] == ends[s] if len(rank) else np.zeros(0, bool)
        last = [None, None]
        last[s], last[l] = np.flatnonzero(equal), rank[equal]
        self.last_a, self.last_b = last
        # a token overlaps the other side's tokens from the one after all ends up to its
        # begin to the one that reaches its own end
        first = np.concatenate([[0], (rank + equal)[:-1]]) if len(rank) else rank
        count = rank - first + 1
        total = np.concatenate([[0], np.cumsum(count)])
        link = [None, None]
        link[s] = np.repeat(np.arange(len(rank)), count)
        link[l] = np.arange(total[-1]) + np.repeat(first - total[:-1], count)
        self.link_a, self.link_b = link
        self.links_before = total[befores[s]]

    def group_counts(self) -> np.ndarray:
        return np.diff(np.searchsorted(self.last_a, self.before_a))

    def listed(self, names: pa.Array, n_ids_a: int, n_ids_b: int) -> Iterator[memoryview]:
        """`a1,a2|b1;a3|b2,b3` of each text.  ``names`` are the ids of A with ',' behind,
        with '|', those of B with ',' and with ';'."""
        n_a, n_b = len(self.ids_a), len(self.ids_b)
        ends_a, ends_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        ends_a[self.last_a] = True
        ends_b[self.last_b] = True
        group_a = np.cumsum(ends_a) - ends_a
        group_b = np.cumsum(ends_b) - ends_b
        which = np.empty(n_a + n_b, np.int64)
        which[np.arange(n_a) + np.concatenate([[0], self.last_b + 1])[group_a]] = self.ids_a + n_ids_a * ends_a
        which[np.arange(n_b) + (self.last_a + 1)[group_b]] = 2 * n_ids_a + self.ids_b + n_ids_b * ends_b
        data, at = flat(names.take(pa.array(which)))
        view = memoryview(np.ascontiguousarray(data))
        cut = at[self.before_a + self.before_b]
        for x, y in zip(cut.tolist(), cut[1:].tolist(), strict=False):
            yield view[x:max(x, y - 1)]


@lru_cache(maxsize=2)
def _names(n_a: int, n_b: int) -> pa.Array:
    return pa.array([f"{i}{mark}" for n, marks in ((n_a, ",|"), (n_b, ",;")) for mark in marks for i in range(n)], pa.string())


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids_a, ids_b (array<int>), groups (text, as `a1,a2|b1;a3|b2,b3`), links_a and
    links_b (array<int>: places of the linked tokens in the text) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level_tokens(path_a), piece_tokens(path_b)
        names = _names(len(a.size), len(b.size))
        for batch in batches:
            for x, y in slices(batch.column("text"), SLICE_BYTES):
                found = Aligned(batch.column("text").slice(x, y - x), a, b)
                row = np.repeat(np.arange(y - x), np.diff(found.links_before))
                groups = [bytes(v).decode() for v in found.listed(names, len(a.size), len(b.size))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(x, y - x), _lists(found.ids_a, found.before_a), _lists(found.ids_b, found.before_b),
                     pa.array(groups, pa.string()), _lists(found.link_a - found.before_a[row], found.links_before),
                     _lists(found.link_b - found.before_b[row], found.links_before)],
                    ["id", "ids_a", "ids_b", "groups", "links_a", "links_b"])

    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = (f"id {source.schema['id'].dataType.simpleString()}, ids_a array<int>, ids_b array<int>, groups string, "
              "links_a array<int>, links_b array<int>")
    return source.mapInArrow(run, schema).withColumnRenamed("id", key)


class _Block:
    """Documents and their (pair, multiplicity) entries until a block is full."""

    FIELDS = ("n_a", "n_b", "n_groups", "n_links")

    def __init__(self, key_type: pa.DataType):
        self.key_type = key_type
        self.clear()

    def clear(self) -> None:
        self.keys, self.digests, self.counts = [], [], []
        self.entries, self.codes, self.times = [], [], []
        self.size = 0

    def add(self, keys: pa.Array, found: Aligned, names: pa.Array, n_a: int, n_b: int) -> None:
        self.keys.append(keys)
        self.digests += [hashlib.sha256(v).hexdigest() if len(v) else "" for v in found.listed(names, n_a, n_b)]
        self.counts.append(np.stack([np.diff(found.before_a), np.diff(found.before_b), found.group_counts(),
                                     np.diff(found.links_before)]))
        code = found.ids_a[found.link_a].astype(np.int64) * n_b + found.ids_b[found.link_b]
        row = np.repeat(np.arange(len(keys)), np.diff(found.links_before))
        # rows of a slice and id pairs share 63 bits: sort once, then count equal neighbours
        bits = int(n_a * n_b).bit_length()
        if len(keys).bit_length() + bits > 63:
            raise ValueError("vocabularies too large for a slice")
        both = np.sort((row << bits) | code)
        begin = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
        self.times.append(np.diff(np.concatenate([begin, [len(both)]])).astype(np.int32))
        self.codes.append(both[begin] & ((1 << bits) - 1))
        self.entries.append(np.bincount(both[begin] >> bits, minlength=len(keys)).astype(np.int32))
        self.size += len(begin)

    def batch(self, number: int) -> pa.RecordBatch:
        codes = np.concatenate(self.codes)
        pairs = np.unique(codes)
        place = np.searchsorted(pairs, codes).astype(np.int32)
        packed = pa.compress(place.tobytes() + np.concatenate(self.times).tobytes(), codec="zstd", asbytes=True)
        counts = np.concatenate(self.counts, axis=1)
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        keys = pa.concat_arrays(self.keys)
        columns = [pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                   one(self.digests, pa.string()), *[one(c, pa.int32()) for c in counts.astype(np.int32)],
                   one(np.concatenate(self.entries), pa.int32()), one(pairs, pa.int64()),
                   one(np.bincount(place, minlength=len(pairs)).astype(np.int64), pa.int64()), pa.array([packed], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["block", "ids", "digests", *self.FIELDS, "entries", "pairs", "n_docs", "packed"])


def _blocks(source: DataFrame, path_a: str, path_b: str, block_entries: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level_tokens(path_a), piece_tokens(path_b)
        n_a, n_b = len(a.size), len(b.size)
        number, block = TaskContext.get().partitionId() << 32, None
        for batch in batches:
            block = block or _Block(batch.column("id").type)
            for x, y in slices(batch.column("text"), SLICE_BYTES):
                block.add(batch.column("id").slice(x, y - x), Aligned(batch.column("text").slice(x, y - x), a, b), _names(n_a, n_b), n_a, n_b)
                if block.size >= block_entries:
                    yield block.batch(number)
                    number += 1
                    block.clear()
        if block and block.keys:
            yield block.batch(number)

    key = source.schema["id"].dataType.simpleString()
    schema = (f"block long, ids array<{key}>, digests array<string>, " + ", ".join(f"{f} array<int>" for f in _Block.FIELDS)
              + ", entries array<int>, pairs array<long>, n_docs array<long>, packed binary")
    return source.mapInArrow(run, schema)


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each block with the sums over their links."""
    numbers = lambda column: column.flatten().to_numpy(zero_copy_only=False)
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            entries = numbers(row.column("entries")).astype(np.int64)
            total = int(entries.sum())
            raw = np.frombuffer(pa.decompress(row.column("packed")[0].as_buffer(), 8 * total, codec="zstd"), np.int32) \
                if total else np.zeros(0, np.int32)
            place, times = raw[:total], raw[total:].astype(np.int64)
            docs_of, best_of = np.zeros(len(row.column("pairs")[0]), np.int64), np.zeros(len(row.column("pairs")[0]), np.int64)
            answers = row.column("answers").flatten()
            at = answers.field("place").to_numpy(zero_copy_only=False)
            docs_of[at] = answers.field("docs").to_numpy(zero_copy_only=False)
            best_of[at] = answers.field("best").cast(pa.int64()).to_numpy(zero_copy_only=False)
            until = np.concatenate([[0], np.cumsum(entries)])
            sums = [np.diff(np.concatenate([[0], np.cumsum(times * of[place])])[until]) for of in (best_of, docs_of)]
            columns = [row.column("ids").flatten(), *[pa.array(numbers(row.column(f)).astype(np.int64)) for f in _Block.FIELDS],
                       pa.array(sums[0]), pa.array(sums[1]), row.column("digests").flatten()]
            yield pa.RecordBatch.from_arrays(columns, ["id", *_Block.FIELDS, "n_best", "count_sum", "groups_sha256"])


def link_statistics(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text",
                    block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best (links whose pair is in as many documents as
    any pair of their A id), count_sum (documents of each link's pair, summed) and
    groups_sha256 of every whole text."""
    ids = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    blocks = materialize(_blocks(ids, path_a, path_b, block_entries))
    n_b = len(piece_tokens(path_b).size)
    held = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("place", "x"))
    held = held.select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.n_docs").alias("n"))
    sums = held.groupBy("pair").agg(F.sum("n").alias("docs")).withColumn("a", F.expr(f"pair div {n_b}"))
    sums = materialize(sums)
    most = sums.groupBy("a").agg(F.max("docs").alias("most"))
    known = sums.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    answers = (held.select("block", "place", "pair").join(known, "pair").groupBy("block")
                   .agg(F.collect_list(F.struct("place", "docs", "best")).alias("answers")))
    whole = blocks.drop("n_docs").join(answers, "block", "left").withColumn(
        "answers", F.coalesce("answers", F.array().cast("array<struct<place:int,docs:bigint,best:boolean>>")))
    schema = (f"id {ids.schema['id'].dataType.simpleString()}, " + ", ".join(f"{f} long" for f in _Block.FIELDS)
              + ", n_best long, count_sum long, groups_sha256 string")
    return whole.mapInArrow(_by_document, schema).withColumnRenamed("id", key)
