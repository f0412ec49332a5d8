"""Operators on texts against brute force, on small fixtures with awkward rows."""
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import language_id, line_dedup, lm_score, mixing, ngram_join, packing, pii, quality_classifier, quality_rules
from shelfcast.llm.common import connected_components
from shelfcast.llm.text_arrays import flat, ngrams, word_hashes

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977} Überfluß" for i in range(20000))
TEXTS = [None, "", "   \n\t ", "one", "a b c d", "a b c d e f g", "a b c d e f g", "A B c D e f g", LONG, LONG + " tail",
         "é ü ß 漢字  x", "x\ny\nx\n\ny", "9" * 5000, "a@b.co " * 600, "1.2.3.4.5.6.7.8 call +1 (201) 555-0123 4111 1111 1111 1111"]


def fixture(spark, texts=TEXTS, extra=False):
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else "s", len(t or "")) for i, t in enumerate(texts)]
    rows += rows[5:7] + [(None, "a b c d e f g h i j", None, None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        for c in ("id", "node", "counts", "stratum", "row", "doc", "key", "copy", "rate", "mixed", "language", "line_dedup", "shard"):
            df = df.withColumn(c, F.lit(1))
    return df


def words(t):
    return [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_word_and_ngram_hashes():
    data, offsets = flat(pa.array(TEXTS))
    h, first = word_hashes(data, offsets)
    lists = [words((t or "").translate({c: c + 32 for c in range(65, 91)})) for t in TEXTS]
    assert np.diff(first).tolist() == list(map(len, lists))
    flat_words = [w for ws in lists for w in ws]
    seen = {}
    for w, x in zip(flat_words, h.tolist(), strict=True):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)
    grams, before = ngrams(h, first, 5)
    assert np.diff(before).tolist() == [max(0, len(ws) - 4) for ws in lists]
    tuples = [tuple(ws[i:i + 5]) for ws in lists for i in range(len(ws) - 4)]
    assert len(set(zip(tuples, grams.tolist(), strict=True))) == len(set(tuples)) == len(set(grams.tolist()))


def test_connected_components(spark):
    edges = [(1, 2), (3, 2), (4, 5), (9, 8), (8, 7), (7, 6), (6, 5), (11, 10), (2, 2)] + [(100 + i, 101 + i) for i in range(40)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got[3] == got[2] == got[1] == 1 and {got[i] for i in range(4, 10)} == {4} and got[11] == 10
    assert {got[i] for i in range(100, 141)} == {100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- operator 1 -----------------------------------------------------------------------------

def counts(t):
    w = words(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    c = Counter(tri)
    repeat = {j for i, g in enumerate(tri) if c[g] > 1 for j in (i, i + 1, i + 2)}
    ls = [x for x in (t or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t or ""), len(ls) - len(set(ls)), len(repeat)


def test_quality_counts_on_awkward_rows(spark):
    texts = TEXTS + ["a b c a b c a", "# | <x> $5 50% & *", "l\nl\n \nl", "x " * 60]
    docs = fixture(spark, texts, extra=True)
    out = quality_rules.apply_rules(docs, spark.createDataFrame([(None, 1), (3, None), (4, 0), (4, 1)], "doc_id long, quality int"))
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out.collect())
    want = Counter((r["doc_id"], *counts(r["text"])) for r in docs.collect())
    assert got == want
    for r in out.collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"])  # too few labels certify nothing


def test_binomial_tail_is_exact(spark):
    from math import comb
    cases = [(10, 0, .1), (500, 3, .02), (5000, 40, .01), (100000, 800, .01), (7, 7, .5), (0, 0, .1)]
    df = spark.createDataFrame(cases, "n long, k long, a double")
    for n, k, a, p in df.select("n", "k", "a", quality_rules.binomial_tail(F.col("n"), F.col("k"), F.col("a"))).collect():
        if k >= n * a:
            assert p == 1.0
        elif n <= 5000:
            assert p == pytest.approx(sum(comb(n, i) * a**i * (1 - a) ** (n - i) for i in range(k + 1)), rel=1e-9)
        else:
            assert 0 < p < 1e-9


def test_cutoffs_bound_false_rejection(spark):
    """Bad texts are full of symbols: a cutoff is certified, and good texts stay."""
    good, bad = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}###" for i in range(60))
    texts = [good + f" n{i}" for i in range(1500)] + [bad + f" n{i}" for i in range(200)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 1500)) for i in range(1700)], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.apply_rules(docs, labels).collect()}
    assert all(kept[i] for i in range(1500)) and not any(kept[i] for i in range(1500, 1700))


# --- operator 2 -----------------------------------------------------------------------------

def tokenizer():
    import public_tokenizers as P
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    return path, Tokenizer.from_file(path)


def test_best_fit_decreasing_matches_a_scan():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 41, 500)
    window, offset = packing.best_fit_decreasing(lengths, 40)
    room, want = [], np.zeros(500, int)
    for i in np.argsort(-lengths, kind="stable"):
        fits = [r for r in room if r >= lengths[i]]
        want[i] = min(fits) - lengths[i] if fits else 40 - lengths[i]
        if fits:
            room.remove(min(fits))
        room.append(want[i])
    assert len(set(window.tolist())) == len(room)
    for w in set(window.tolist()):
        at = np.flatnonzero(window == w)
        at = at[np.argsort(offset[at])]
        assert (offset[at] == np.cumsum(lengths[at]) - lengths[at]).all() and lengths[at].sum() <= 40


def test_packing_round_trip(spark):
    path, tok = tokenizer()
    texts = TEXTS + ["don't STOP, it's; a-b.c 3.14 x’s…, <|endoftext|> y.", "É, È! ﬁ Å İx, Σς."]
    docs = fixture(spark, texts, extra=True)
    out = packing.pack(docs, path, window=64, shard_rows=5, with_ids=True)
    rows = out.collect()
    want = Counter((r["doc_id"], tuple(tok.encode(r["text"] or "", add_special_tokens=False).ids + [2])) for r in docs.collect())
    for (doc, ids), n in want.items():
        mine = [r for r in rows if r["doc_id"] == doc and r["doc_tokens"] == len(ids)]
        for start in range(0, len(ids), 64):
            part = np.array(ids[start:start + 64], "<u4").tobytes()
            same = [r for r in mine if r["start"] == start and bytes(r["ids"]) == part]
            assert len(same) == n and all(r["ids_crc32"] == zlib.crc32(part) and r["length"] == len(part) // 4 for r in same)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64
    whole = packing.sequences(out, window=64).collect()
    assert sum(r["n_ids"] for r in whole) == sum(r["length"] for r in rows)
    assert all(len(r["ids"]) == 4 * (r["n_ids"] if r["n_ids"] & (r["n_ids"] - 1) == 0 else 64) for r in whole)
    assert packing.pack(docs.limit(0), path).count() == 0


# --- operator 3 -----------------------------------------------------------------------------

def test_lm_scores_edges(spark):
    out = lm_score.scores(fixture(spark, extra=True))
    rows = out.collect()
    assert len(rows) == len(TEXTS) + 4
    for r in rows:
        assert (r["n_words"] == 0) == (r["log_score"] is None)
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lm_score.scores(one).first()["log_score"] == pytest.approx(np.log(1.0) + np.log(0.4))
    pair = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "a c")], "doc_id long, text string")
    got = {r["doc_id"]: r["log_score"] for r in lm_score.scores(pair).collect()}
    assert got[1] == pytest.approx(np.log(2 / 4) + np.log(1 / 2)) and got[3] == pytest.approx(np.log(2 / 4) + np.log(0.4 / 5))
    assert lm_score.scores(one.limit(0)).count() == 0


# --- operator 4 -----------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    return sum((d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0


def base_spans(t):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, t or ""):
            g = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")))
                    or (kind == "card" and 14 <= len(g) <= 19 and luhn(g)) or (kind == "phone" and 10 <= len(g) <= 15)):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_match_plain_patterns(spark):
    rng = np.random.default_rng(3)
    alphabet = list("aB9012345.@+-_% ()\n|é漢") + ["4111111111111111", "+1 (201) 555-0123", "x@y.de", "10.0.0.1", "001.2.3.04"]
    texts = TEXTS + ["".join(rng.choice(alphabet, rng.integers(1, 60))) for _ in range(400)]
    docs = fixture(spark, texts, extra=True)
    got = Counter((r["doc_id"], tuple(map(tuple, r["base"]))) for r in pii.find(docs).collect())
    want = Counter((r["doc_id"], tuple(base_spans(r["text"]))) for r in docs.collect())
    assert got == want
    assert pii.find(docs.limit(0)).count() == 0


def test_added_spans(spark):
    token = hashlib.sha1(b"x").hexdigest()
    texts = [f'say token = "{hashlib.sha1(str(i).encode()).hexdigest()}" now' for i in range(40)]
    texts += ["+1 (201) 555-0123 10.0.0.1 hello", f"plain words only {'a' * 30}", "pay 4111111111111111 5500005555555559 now", token]
    texts += [f"mail a{i}@b{i}.com or 10.0.0.{i} or +1 (201) 555-01{i:02d}." for i in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.find(docs).collect()}
    for i in range(40):
        (s,) = out[i]["added"]
        assert pii.KINDS[s["kind"]] == "secret" and texts[i][s["start"]:s["end"]] == hashlib.sha1(str(i).encode()).hexdigest()
    assert not out[41]["added"]
    found = {texts[42][s["start"]:s["end"]] for s in out[42]["added"]}
    assert found == {"4111111111111111", "5500005555555559"}  # the whole run fails as one number
    for r in out.values():
        spans = sorted([tuple(s) for s in r["base"]] + [tuple(s) for s in r["added"]])
        assert set(map(tuple, r["base"])) == set(base_spans(texts[r["doc_id"]]))
        for s in r["added"]:
            assert all(s["end"] <= b["start"] or b["end"] <= s["start"] for b in r["base"])
        assert len(set(spans)) == len(spans)


def test_reliabilities_follow_the_votes():
    # two labelers agree, one votes at random: it gets the lowest reliability
    rows = [(0, (1, 1, None, v, None), 500) for v in (0, 1)] + [(0, (0, 0, None, v, None), 500) for v in (0, 1)]
    post, rel = pii.expectation_maximisation(rows)
    assert post[rows[0][0], rows[0][1]] > 0.9 > 0.1 > post[rows[2][0], rows[2][1]]
    assert rel["edges", 1] < rel["format", 1]


# --- operator 6 -----------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_edit_distance():
    rng = np.random.default_rng(5)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abc "), rng.integers(0, 25))) for _ in range(2))
        d = distance(a, b)
        assert line_dedup.edit_distance(a, b, 30) == d
        assert line_dedup.similar(a, b, 0.8) == (d <= int(0.2 * max(len(a), len(b)) + 1e-9))


def removed_lines(rows):
    """Brute force over (doc, text) rows: set of (doc, line) that go."""
    occ = {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for k, line in enumerate((t or "").split("\n")):
            n = line_dedup.normal(line)
            if len(n.split()) >= line_dedup.MIN_WORDS:
                occ.setdefault(n, []).append((2**63 if d is None else d, k))
    keys = list(occ)
    if not keys:
        return set()
    data, offsets = flat(pa.array(keys))
    h, first = word_hashes(data, offsets)
    sim = line_dedup.simhash(h, first)
    up = list(range(len(keys)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if int(sim[i] ^ sim[j]).bit_count() <= line_dedup.DISTANCE and line_dedup.similar(keys[i], keys[j], line_dedup.SIMILARITY):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    groups = {}
    for i, k in enumerate(keys):
        groups.setdefault(find(i), []).extend(occ[k])
    return {x for g in groups.values() for x in set(g) if x != min(g)}


def test_line_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    vocab = [f"word{i}" for i in range(200)]
    base = [" ".join(rng.choice(vocab, 40)) for _ in range(12)]
    texts = [t for t in TEXTS if t is not LONG]
    for i in range(60):
        ls = []
        for _ in range(4):
            w = base[rng.integers(len(base))].split()
            if rng.random() < 0.6:
                w[rng.integers(len(w))] = "changed"
            ls.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w) + ".")
        texts.append("\n".join(ls))
    rows = list(enumerate(texts)) + [(None, base[0] + "\nfresh words only here"), (7, "own text of id seven")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line_dedup", F.lit(1)).withColumn("row", F.lit(2))
    got = line_dedup.dedup_lines(docs)
    assert set(got.columns) == {"doc_id", "text", "line_dedup", "row"}
    gone = removed_lines([r for r in rows if r != (7, "own text of id seven")])
    assert len(gone) > 50
    seen = {(r["doc_id"], r["line_dedup"]["n_lines"], r["line_dedup"]["n_removed"], r["text"]) for r in got.collect()}
    for d, t in rows:
        mine = set() if t == "own text of id seven" else {k for x, k in gone if x == (2**63 if d is None else d)}
        kept = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in mine)
        assert (d, 0 if t is None else t.count("\n") + 1, len(mine), kept) in seen
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_block_masks_cover_every_pair():
    rng = np.random.default_rng(2)
    for n in (10, 10**8, 10**11):
        masks = line_dedup.block_masks(n)
        for _ in range(200):
            a = int(rng.integers(0, 1 << 62))
            b = a
            for bit in rng.choice(64, 3, replace=False):
                b ^= 1 << int(bit)
            assert any(a & m == b & m for m in masks)
    assert len(line_dedup.block_masks(10)) < len(line_dedup.block_masks(10**8)) < len(line_dedup.block_masks(10**11))


def test_hot_block_key_is_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_RUN", 20)
    values = [(1 << 40) + i for i in range(100)] + [1 << 50, 7]
    edges = line_dedup.near_hashes(spark.createDataFrame([(v,) for v in values], "simhash long"))
    got = dict(map(tuple, connected_components(edges).collect()))
    up = {v: v for v in values}

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                up[y] = x
    assert {v: got.get(v, v) for v in values} == {v: find(v) for v in values}


# --- operator 7 -----------------------------------------------------------------------------

def test_language_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter("doc_id % 2 = 0"))
    out = language_id.predict(docs.filter("doc_id % 2 = 1"), model).collect()
    assert np.mean([r["language"]["lang"] == r["lang"] for r in out]) > 0.95
    odd = fixture(spark, extra=True)
    got = language_id.predict(odd, model)
    assert got.columns == [c for c in odd.columns if c != "language"] + ["language"]
    for r in got.collect():
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["language"]["lang"] == "und") == blank and 0 <= r["language"]["score"] <= 1
    assert language_id.predict(odd.limit(0), model).count() == 0
    none = language_id.fit(docs.limit(0))
    assert {r["language"]["lang"] for r in language_id.predict(odd, none).collect()} == {"und"}
    one = language_id.fit(docs.filter("lang = 'en'"))
    assert {r["language"]["lang"] for r in language_id.predict(odd, one).collect()} == {"und", "en"}


def test_folded_weights_equal_the_kernel_form():
    """X V is the Nyström kernel expansion: k(x, L) K_mm^-1/2 W."""
    texts = [b"the cat sat on the mat", b"a dog and the cat", b"le chat est sur la table", b"un chien et le chat"]
    model = language_id.fit_texts(texts, ["en", "en", "fr", "fr"], ridge=1e-9)
    data = language_id._flat(texts)
    marks = language_id.presence(*data, 4, model.lookup(), len(model.weights))
    unit = language_id._unit(marks)
    k = unit @ unit.T
    pairs = [[len(a & b) / np.sqrt(len(a) * len(b)) for b in map(grams, texts)] for a in map(grams, texts)]
    assert np.allclose(k, pairs, atol=1e-6)
    assert (unit @ model.weights).argmax(1).tolist() == [0, 0, 1, 1]


def grams(t):
    return {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}


# --- operator 8 -----------------------------------------------------------------------------

def jaccard_components(rows, percent=75, n=5):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in rows:
        w = words((t or "").translate(low))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    low_id = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low_id[find(i)] = min(low_id.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), low_id.get(find(i)) if r[0] is not None else None) for i, r in enumerate(rows))


def near_texts(seed, groups, copies, size):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        w = [f"v{rng.integers(3000)}" for _ in range(int(rng.integers(2, size)))]
        for _ in range(copies):
            x = list(w)
            for _ in range(int(rng.integers(0, 1 + len(w) // 25))):
                x[rng.integers(len(x))] = f"new{rng.integers(10**6)}"
            if rng.random() < 0.3:
                x = x[:int(len(x) * rng.uniform(0.7, 1))] or x
            out.append(" ".join(x))
    return out


def test_jaccard_join_matches_brute_force(spark, monkeypatch):
    texts = [t for t in TEXTS if t is not None and len(t) < 10**5] + near_texts(4, 40, 6, 150) + [None, LONG, LONG + " tail"]
    rows = list(enumerate(texts)) + [(3, "one"), (None, "a b c d e f g"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("rep", F.lit(1))
    want = jaccard_components(rows)
    assert sum(1 for d, _, c in want if c is not None and d != c) > 100
    assert Counter(map(tuple, ngram_join.components(docs).collect())) == want
    # the paths for long runs and large clusters give the same
    for name in ("SHORT_RUN", "HOT_RUN", "CHUNK"):
        monkeypatch.setattr(ngram_join, name, 3)
    assert Counter(map(tuple, ngram_join.components(docs).collect())) == want
    assert ngram_join.components(docs.limit(0)).count() == 0


def test_linking_sets_share_a_signature():
    rng = np.random.default_rng(6)
    edges = ngram_join.band_edges(4000)
    for n in [1, 2, 3, 4, 5, 7, 10, 16, 30, 64, 150, 700]:
        for _ in range(30):
            x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            keep = int(np.ceil(0.75 * n)) if rng.random() < 0.5 else n
            y = x[:keep]
            extra = (100 * keep - 75 * n) // 75  # the most new shingles that still link
            if extra > 0:
                y = np.concatenate([y, rng.integers(0, 1 << 63, int(rng.integers(0, extra + 1)), dtype=np.uint64)])
            both = len(np.intersect1d(x, y))
            assert 100 * both >= 75 * (len(x) + len(y) - both)
            found, owner, _ = ngram_join.set_signatures([np.sort(x), np.sort(y)], edges)
            assert len(np.intersect1d(found[owner == 0], found[owner == 1])) > 0
            s = ngram_join.Sketches([ngram_join.sketch(z, ngram_join.sketch_bits(len(z))).tobytes() for z in (x, y)], [len(x), len(y)], 75)
            assert s.pairs(np.array([0]), np.array([1]))[0]


# --- operators 9 and 10 -----------------------------------------------------------------------

def test_poisson_counts_and_mixture(spark):
    docs = fixture(spark, extra=True)
    out = mixing.mix(docs, epochs=3.0)
    assert set(out.columns) == set(docs.columns)
    rows = out.collect()
    by = {}
    for r in rows:
        by.setdefault((r["doc_id"], r["text"]), []).append((r["mixed"]["copy"], r["mixed"]["n_copies"]))
    for v in by.values():
        n = v[0][1]
        assert sorted({c for c, _ in v}) == list(range(1, n + 1))
    big = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("12345").alias("text"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    rates = {r["source"]: r for r in mixing.source_rates(big, weights={"hot": 1, "s0": 1, "s1": 2}).collect()}
    mixed = {r["source"]: r["n"] for r in mixing.mix(big, weights={"hot": 1, "s0": 1, "s1": 2}).groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert set(mixed) == {"hot", "s0", "s1"}
    for s, n in mixed.items():
        assert abs(n - rates[s]["rate"] * rates[s]["n_docs"]) < 5 * np.sqrt(n)
    assert mixing.mix(docs.limit(0)).count() == 0
    many = mixing.mix(big.filter("source = 's0'"), epochs=40.0)
    assert abs(many.count() / big.filter("source = 's0'").count() - 40) < 1


def test_quality_classifier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    counted = quality_classifier.feature_counts(docs)
    model = quality_classifier.fit(counted, labels.filter("doc_id % 4 <> 2"))
    held = quality_classifier.score(counted, model).join(labels.filter("doc_id % 4 = 2"), "doc_id").collect()
    assert np.mean([(r["score"] >= 0.7) == (r["quality"] == 1) for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in held)
    odd = fixture(spark, extra=True)
    got = quality_classifier.score(quality_classifier.feature_counts(odd), model).collect()
    assert len(got) == len(TEXTS) + 4 and all(0 <= r["score"] <= 1 for r in got)
    none = quality_classifier.fit(counted, labels.filter("quality = 1"))
    assert {r["score"] for r in quality_classifier.score(quality_classifier.feature_counts(odd), none).collect()} == {0.5}


def test_bradley_terry_orders_pairs():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (300, 3)), rng.normal(-1, 1, (300, 3))
    w = quality_classifier.bradley_terry(good, bad)
    assert (good @ w).mean() > (bad @ w).mean() and np.mean((good @ w)[:, None] > (bad @ w)[None]) > 0.95
