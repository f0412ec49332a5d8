"""Byte-level BPE encoding with character offsets, and decoding, over Arrow batches.

Every byte stands for one printable character; the tokenizers library merges those
characters by the ranks of a vocabulary file.  A file of ranks names no merges: a pair may
merge whenever its joined bytes are a token, the pair of the lowest rank first, and a match
of the split pattern that is a token itself is taken whole.  The model is therefore built
with every split of every token into two tokens, in the order of ranks.

Decoding looks up each id's bytes and joins them.  A character may be split between tokens:
``decode`` can also give the text of each token, where a character belongs to the token
that completes it, and bytes that form no character become U+FFFD.

Only rows travel; nothing is collected.  Texts are cut at blanks that always start a new
match, the distinct segments of a slice are encoded once.

Defined results: NULL and empty texts have an empty list of ids; repeated rows give a row
each; an empty table gives no rows; a NULL list of ids decodes to NULL; ids outside the
vocabulary raise an error; input columns other than the key and the text (ids) are not used,
so their names never clash.
"""

from __future__ import annotations

import base64
import codecs
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.segments import SLICE_BYTES, encode_segments, expand, text_segments
from shelfcast.llm.text_arrays import flat, slices


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The printable character of each byte: printable Latin-1 bytes stand for themselves,
    the others for the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, more = [], 0x100
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(more))
            more += 1
    return out


def character_bytes(token: str) -> bytes:
    """The bytes that a byte-level token stands for."""
    table = _reverse()
    return bytes(table[c] for c in token)


@lru_cache(maxsize=1)
def _reverse() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_characters())}


@lru_cache(maxsize=2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every pair of tokens whose joined bytes are a token, by the rank of the result."""
    out = []
    for token in sorted(ranks, key=ranks.__getitem__):
        out += [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    return out


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str):
    """A tokenizers model of the ranks file; special tokens are unknown to it."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, chars = read_ranks(path), byte_characters()
    spell = {token: "".join(chars[b] for b in token) for token in ranks}
    model = models.BPE(vocab={spell[t]: r for t, r in ranks.items()},
                       merges=[(spell[a], spell[b]) for a, b in merges_of(ranks)], ignore_merges=True)
    made = Tokenizer(model)
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all tokens one after the other, offsets by id); missing ids are empty."""
    ranks = read_ranks(path)
    by_id = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    size = np.fromiter(map(len, by_id), np.int64, len(by_id))
    return np.frombuffer(b"".join(by_id), np.uint8), np.concatenate([[0], np.cumsum(size)])


def encode_texts(texts: pa.Array, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, n + 1 offsets)."""
    model = tokenizer(path, pattern)
    distinct, codes, first = text_segments(texts)
    pool, size = encode_segments(distinct, lambda part: [e.ids for e in model.encode_batch_fast(part, add_special_tokens=False)],
                                 np.diff(token_bytes(path)[1]))
    return expand(pool, size, codes, first)


def character_ranges(texts: pa.Array, ids: np.ndarray, before: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last character of each token; both tokens that share a split
    character cover it.  Bytes are mapped to characters by counting leading bytes."""
    data, offsets = flat(texts)
    _, at = token_bytes(path)
    end = np.cumsum(at[ids + 1] - at[ids])
    begin = end - (at[ids + 1] - at[ids])
    character = np.cumsum((data & 0xC0) != 0x80) - 1  # of each byte, over the slice
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    origin = np.concatenate([character, [character[-1] + 1 if len(data) else 0]])[offsets[:-1]][row]
    return character[begin] - origin, character[end - 1] + 1 - origin


def decode_ids(ids: np.ndarray, before: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all lists of ids one after the other, n + 1 offsets)."""
    data, at = token_bytes(path)
    if len(ids) and (ids.min() < 0 or ids.max() >= len(at) - 1 or (at[ids] == at[ids + 1]).any()):
        raise ValueError("ids outside the vocabulary")
    size = at[ids + 1] - at[ids]
    total = np.concatenate([[0], np.cumsum(size)])
    where = np.arange(total[-1]) + np.repeat(at[ids] - total[:-1], size)
    return data[where], total[before]


def token_texts(ids: list[int], path: str) -> list[str]:
    """The text of each token; a split character comes with the token that completes it,
    and what is left open at the end is added to the last token as U+FFFD."""
    data, at = token_bytes(path)
    utf8 = codecs.getincrementaldecoder("utf-8")("replace")
    out = [utf8.decode(data[at[i]:at[i + 1]].tobytes()) for i in ids]
    if out:
        out[-1] += utf8.decode(b"", final=True)
    return out


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text",
           offsets: bool = True) -> DataFrame:
    """key, ids array<int> (and char_start, char_end array<int>: the characters that each
    token covers) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("id"), batch.column("text")
            for a, b in slices(texts, SLICE_BYTES):
                part = texts.slice(a, b - a)
                ids, before = encode_texts(part, path, pattern)
                columns, names = [keys.slice(a, b - a), _lists(ids, before)], ["id", "ids"]
                if offsets:
                    for name, found in zip(("char_start", "char_end"), character_ranges(part, ids, before, path), strict=True):
                        columns.append(_lists(found, before))
                        names.append(name)
                yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    schema = f"id {source.schema['id'].dataType.simpleString()}, ids array<int>"
    if offsets:
        schema += ", char_start array<int>, char_end array<int>"
    return source.mapInArrow(run, schema).withColumnRenamed("id", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids", pieces: bool = False,
           keep_ids: bool = False) -> DataFrame:
    """key, decoded binary (and, if asked for, the ids and pieces array<string>, the text
    of each token) of every list of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            # about SLICE_BYTES of decoded bytes at a time
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(size, dtype=np.int64) // (SLICE_BYTES // 4)
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a == b:
                    continue
                part = lists.slice(a, b - a)
                flat_ids = part.flatten().to_numpy(zero_copy_only=False)
                data, at = decode_ids(flat_ids, np.concatenate([[0], np.cumsum(size[a:b], dtype=np.int64)]), path)
                raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b - a, [None, pa.py_buffer(at), pa.py_buffer(data)])
                raw = pc.if_else(part.is_null(), None, raw).cast(pa.binary())
                columns, names = [batch.column("id").slice(a, b - a), raw], ["id", "decoded"]
                if keep_ids:
                    columns.append(part)
                    names.append("ids")
                if pieces:
                    found = [None if x is None else token_texts(x, path) for x in part.to_pylist()]
                    columns.append(pa.array(found, pa.list_(pa.string())))
                    names.append("pieces")
                yield pa.RecordBatch.from_arrays(columns, names)

    source = encoded.select(F.col(key).alias("id"), F.col(ids).cast("array<int>").alias("ids"))
    schema = f"id {source.schema['id'].dataType.simpleString()}, decoded binary"
    schema += (", ids array<int>" if keep_ids else "") + (", pieces array<string>" if pieces else "")
    return source.mapInArrow(run, schema).withColumnRenamed("id", key)
