"""Byte-level BPE, token alignment and the filter audit against plain Python versions."""
import codecs
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfcast.llm import byte_bpe, filter_audit, queries, token_align
from shelfcast.llm.segments import text_segments

SF = "/root/testdata/sf0.001"
RANKS, BYTES, PIECES = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PARTS = [" ", "  ", "\n", "\t", "\r\n", "a", "b", "the", "'s", " the", " of", "-", "--", "=", "é", "ü", "漢", "字", "😀", " ", "　",
         "0", "12", "<|endoftext|>", "▁", "<s>", "<0x41>", "́", "*", "A", " ", "x", "aa", "....", "_", "\x00", "\x7f", "﻿"]
LONG = " ".join(f"w{i % 977} Überfluß" for i in range(30000)) + "z" * 30000


def random_texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 50))) for _ in range(n)]


def awkward(spark, texts):
    rows = list(enumerate(texts)) + [(None, "the of"), (None, None), (3, "a "), (3, "a ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for name in ("id", "ids", "block", "pair", "place", "answers", "digest", "part", "n", "mask", "first", "decoded", "docs"):
        df = df.withColumn(name, F.lit(1))
    return rows, df


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_segments_join_to_the_texts():
    texts = [None, "", *random_texts(300), LONG]
    distinct, codes, first = text_segments(pa.array(texts))
    parts = distinct.to_pylist()
    assert ["".join(parts[c] for c in codes[a:b]) for a, b in zip(first, first[1:])] == [t or "" for t in texts]


def test_encoding_equals_the_library(library):
    rng = random.Random(1)
    texts = [None, "", LONG, *random_texts(4000), *[rng.choice("-=a.*_ 0\n#é漢") * rng.randint(1, 70) for _ in range(500)],
             *["".join(chr(rng.choice([rng.randint(1, 0x7FF), rng.randint(0x800, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]))
                       for _ in range(rng.randint(1, 40))) for _ in range(1500)]]
    ids, before = byte_bpe.encode_texts(pa.array(texts), RANKS, P.PATTERN)
    for i, t in enumerate(texts):
        assert ids[before[i]:before[i + 1]].tolist() == library.encode_ordinary(t or ""), t


def test_offsets_and_split_characters(spark):
    texts = [None, "", "a😀é 漢字 x", "  ", *random_texts(200, 8), LONG[:5000]]
    rows, df = awkward(spark, texts)
    encoded = byte_bpe.encode(df, RANKS, P.PATTERN)
    assert encoded.columns == ["doc_id", "ids", "char_start", "char_end"]
    by_id = {i: token for token, i in byte_bpe.read_ranks(RANKS).items()}
    want = Counter((k, t or "") for k, t in rows)
    got = Counter()
    for r in encoded.collect():
        raw = b"".join(by_id[i] for i in r.ids)
        text = raw.decode()
        got[(r.doc_id, text)] += 1
        end = 0
        for i, a, b in zip(r.ids, r.char_start, r.char_end, strict=True):
            begin, end = end, end + len(by_id[i])
            # the smallest run of characters that covers the token's bytes
            cover = [c for c in range(len(text)) if len(text[:c].encode()) < end and len(text[:c + 1].encode()) > begin] if len(text) < 300 else None
            if cover is not None:
                assert (a, b) == (cover[0], cover[-1] + 1)
    assert got == want
    pieces = byte_bpe.decode(encoded, RANKS, pieces=True, keep_ids=True).collect()
    for r in pieces:
        assert "".join(r.pieces) == bytes(r.decoded).decode() and len(r.pieces) == len(r.ids)
    assert any("" in r.pieces for r in pieces)  # a token that completes no character


def test_decoding_any_ids(spark):
    rng = random.Random(2)
    lists = [None, [], *[[rng.randint(0, 50255) for _ in range(rng.randint(1, 30))] for _ in range(100)], list(range(256))]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    by_id = {i: token for token, i in byte_bpe.read_ranks(RANKS).items()}
    for r in byte_bpe.decode(df, RANKS, pieces=True).collect():
        ids = lists[r.doc_id]
        if ids is None:
            assert r.decoded is None and r.pieces is None
            continue
        raw = b"".join(by_id[i] for i in ids)
        assert bytes(r.decoded) == raw and "".join(r.pieces) == codecs.decode(raw, "utf-8", "replace")
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [50256])], "doc_id long, ids array<int>"), RANKS).collect()
    assert byte_bpe.decode(df.limit(0), RANKS).count() == 0


def test_op12_whole_table(spark, library):
    rows = queries.QUERIES["op12_byte_bpe"](spark, SF).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())


@pytest.fixture(scope="module")
def both():
    tokens = Tokenizer.from_file(BYTES)
    tokens.encode_special_tokens = True
    names = {i: t for t, i in tokens.get_vocab().items()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def piece(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()

    def encode(text):
        a, b = tokens.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        return a, [byte_bpe.character_bytes(names[i]) for i in a], b, [piece(i) for i in b]
    return encode


def aligned(encode, text):
    """(ids a, ids b, groups, links as places) by walking over the bytes."""
    if not text:
        return [], [], [], []
    a, bytes_a, b, bytes_b = encode(text)
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return [], [], [], []
    ends_a, ends_b = list(itertools.accumulate(map(len, bytes_a))), list(itertools.accumulate(map(len, bytes_b)))
    owner = {}
    for side, ends in (("a", ends_a), ("b", ends_b)):
        begin = 0
        for i, end in enumerate(ends):
            owner.update({(side, at): i for at in range(begin, end)})
            begin = end
    links = sorted({(owner["a", at], owner["b", at]) for at in range(ends_a[-1])})
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return a, b, groups, links


def listing(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def statistics(encode, rows):
    found = [(k, *aligned(encode, t)) for k, t in rows]
    count = Counter(pair for _, a, b, _, links in found for pair in {(a[i], b[j]) for i, j in links})
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for k, a, b, groups, links in found:
        pairs = [(a[i], b[j]) for i, j in links]
        out.append((k, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in pairs), sum(count[p] for p in pairs),
                    hashlib.sha256(listing(groups).encode()).hexdigest() if groups else ""))
    return out


def test_gallop():
    rng = np.random.default_rng(4)
    for _ in range(200):
        long = np.unique(rng.integers(0, 400, rng.integers(0, 300)))
        short = np.unique(rng.integers(0, 400, rng.integers(0, 100)))
        guess = rng.integers(-5, 500, len(short))
        assert token_align.gallop(short, long, guess).tolist() == np.searchsorted(long, short).tolist()


def test_alignment(spark, both):
    texts = [None, "", " ", "a ", *random_texts(150, 9)]
    rows, df = awkward(spark, texts)
    out = token_align.align(df, BYTES, PIECES)
    got = sorted(((r.doc_id, r.ids_a, r.ids_b, r.groups, list(zip(r.links_a, r.links_b))) for r in out.collect()), key=str)
    want = []
    for k, t in rows:
        a, b, groups, links = aligned(both, t)
        want.append((k, a, b, listing(groups), links))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("entries", [50, 400_000])
def test_link_statistics(spark, both, entries):
    rows, df = awkward(spark, [None, "", " ", "a ", *random_texts(400, 11), " of the" * 3000])
    got = token_align.link_statistics(df, BYTES, PIECES, block_entries=entries)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(statistics(both, rows), key=str)
    assert token_align.link_statistics(df.limit(0), BYTES, PIECES).count() == 0
    nothing = df.filter("text is null")
    assert {tuple(r)[1:] for r in token_align.link_statistics(nothing, BYTES, PIECES).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_tokenizers_that_may_not_be_cut(both):
    """Without a place to cut, whole texts are encoded; the alignment is the same."""
    texts = pa.array([None, "", *random_texts(100, 12)])
    cut = [token_align.byte_level_tokens(BYTES), token_align.piece_tokens(PIECES)]
    whole = [token_align.byte_level_tokens.__wrapped__(BYTES), token_align.piece_tokens.__wrapped__(PIECES)]
    for t in whole:
        t.blank = None
    x, y = token_align.Aligned(texts, *cut), token_align.Aligned(texts, *whole)
    for name, value in vars(x).items():
        assert np.array_equal(value, getattr(y, name)), name


def test_op11_whole_table(spark, both):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.QUERIES["op11_token_alignment"](spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(statistics(both, rows))


def audited(docs, labels):
    """The audit by walking each order over all rows."""
    words = lambda t: [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]
    least = {}
    for k, t, _ in docs:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    good, toxic = defaultdict(bool), defaultdict(bool)
    for k, q, x in labels:
        if k is not None:
            good[k] |= q == 1
            toxic[k] |= x == 1
    out, parts = [], defaultdict(list)
    for k, t, part in docs:
        ws, text = words(t), t or ""
        fails = {"A": len(ws) < 200, "B": 100 * len(set(ws)) < 50 * len(ws), "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)), "E": k is not None and k > least[text]}
        parts[part or ""].append((fails, k is not None and good[k], k is not None and toxic[k]))
    for part, rows in parts.items():
        shapley, lines = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                shapley[f] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), sum(r[0][f] for r in rows) - len(gone),
                              sum(r[0][f] and sum(r[0].values()) == 1 for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)))
        out += [(*line, shapley[line[1][line[2] - 1]]) for line in lines]
    return out


def test_neighbour_swaps_reach_every_order():
    for n in range(1, 6):
        order, seen = list(range(n)), set()
        seen.add(tuple(order))
        for i in filter_audit.neighbour_swaps(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            seen.add(tuple(order))
        assert seen == set(itertools.permutations(range(n)))


def test_diagram_shares_nodes_and_keeps_weights():
    rng = random.Random(6)
    cells = {m: (rng.randint(1, 9), 0, 1) for m in rng.sample(range(32), 20)}
    diagram = filter_audit.MaskDiagram(cells, 5, 3)
    total = tuple(map(sum, zip(*cells.values())))
    for i in filter_audit.neighbour_swaps(5):
        diagram.swap(i)
        assert diagram.weight[0] == [total]
        assert all(len(set(nodes)) == len(nodes) for nodes in diagram.levels)
        for level in range(5):
            below = diagram.weight[level + 1]
            assert [tuple(map(int.__add__, below[p], below[f])) for p, f in diagram.levels[level]] == diagram.weight[level]
    equal = filter_audit.MaskDiagram({m: (1, 1, 1) for m in range(32)}, 5, 3)
    assert [len(x) for x in equal.levels] == [1] * 5


def test_filter_audit_awkward(spark):
    rich = " ".join(f"w{i}" for i in range(250))
    texts = [None, "", " \n", "A B C", rich, rich, rich.upper(), "a " * 300, rich + " #", rich + " é", "x", LONG]
    docs = [(i % 9, t, [None, "", "en", "de"][i % 4]) for i, t in enumerate(texts)]
    docs += docs[4:6] + [(None, rich, "en"), (None, rich, "en"), (None, None, None), (-1, "x", "fr")] + [(5, f"same id {i}", "en") for i in range(20)]
    labels = [(0, 1, 0), (4, 1, 1), (4, 0, None), (5, None, 1), (None, 1, 1), (5, 1, 1), (77, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    for name in ("id", "part", "digest", "mask", "n", "good", "toxic", "quality", "first"):
        df = df.withColumn(name, F.lit(7))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1)).withColumn("mask", F.lit(1))
    assert sorted(map(tuple, filter_audit.audit_documents(df, lab).collect())) == sorted(audited(docs, labels))
    assert filter_audit.audit_documents(df.limit(0), lab).count() == 0
    assert sorted(map(tuple, filter_audit.audit_documents(df, lab.limit(0)).collect())) == sorted(audited(docs, []))


def test_op13_whole_table(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    got = queries.QUERIES["op13_filter_audit"](spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(audited(docs, labels))
