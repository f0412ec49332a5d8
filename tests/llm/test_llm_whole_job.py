"""Cases in which an operator or stage once did less than the whole job."""
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfcast.llm import language_id, line_dedup, mixing
from shelfcast.llm.common import connected_components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# --- language ID ----------------------------------------------------------------------------

def test_language_of_long_labelled_texts_is_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").filter("lang IN ('de', 'fr')")
    long = docs.withColumn("text", F.when(F.col("lang") == "fr", F.concat(F.lit("1 2 3 " * 4000), F.repeat("text", 400))).otherwise(F.col("text")))
    long = long.filter("lang = 'de' OR char_length(text) > 24000 + 20000")
    model = language_id.fit(long)
    assert model.languages == ["de", "fr"]
    out = language_id.predict(docs.filter("lang = 'fr' AND char_length(text) > 100"), model).collect()
    assert len(out) > 5 and sum(r["language"]["lang"] == "fr" for r in out) > 0.9 * len(out)


def test_language_stage_keeps_texts_if_nothing_can_be_learned(spark):
    rows = [(1, "the cat sat on the mat", None, "a", 22), (2, "12 34", None, "a", 5), (3, None, None, None, None), (None, "le chat", None, "b", 7)]
    kept = corpus_pipeline.language_stage(spark, spark.createDataFrame(rows, DOCS), SF)
    assert sorted((str(r["doc_id"]), r["lang"]) for r in kept.collect()) == [("1", None), ("None", None)]
    rows = [(1, "the cat sat on the mat " * 2000, "en", "a", 46000), (2, "le chat est sur la table " * 2000, "fr", "a", 50000)]
    kept = corpus_pipeline.language_stage(spark, spark.createDataFrame(rows, DOCS), SF)
    assert sorted((r["doc_id"], r["lang"]) for r in kept.collect()) == [(1, "en"), (2, "fr")]


# --- mixing ---------------------------------------------------------------------------------

def test_rows_that_share_an_id_are_drawn_one_by_one(spark):
    n = 3000
    rows = [(None, f"text {i:06d}", "en", "null", 11) for i in range(n)] + [(7, f"text {i:06d}", "en", "hot", 11) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.mix(docs, weights={"null": 0.3, "hot": 0.7}).groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("text").alias("d"))
    out = {r["source"]: r for r in found.collect()}
    # rates 0.6 and 1.4; a Poisson total stays within five standard deviations
    for source, rate in (("null", 0.6), ("hot", 1.4)):
        assert abs(out[source]["n"] - rate * n) < 5 * (rate * n) ** 0.5
        assert abs(out[source]["d"] - (1 - 2.718281828 ** -rate) * n) < 150
    stage = corpus_pipeline.mixing_stage(spark, docs, SF)  # both sources at rate 1
    assert 0.9 * n < stage.filter("source = 'null'").count() < 1.1 * n


# --- line dedup -----------------------------------------------------------------------------

def changed_words(rng, line, vocab, share):
    w = line.split(" ")
    for i in rng.choice(len(w), max(1, round(share * len(w))), replace=False):
        w[i] = vocab[rng.integers(len(vocab))]
    return " ".join(w)


@pytest.mark.parametrize("n_words", [5, 10, 20, 50])
def test_recall_of_pairs_by_edit_similarity_alone(spark, n_words):
    rng = np.random.default_rng(n_words)
    vocab = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 10))) for _ in range(5000)]
    rows, pairs = [], []
    for i in range(200):
        line = " ".join(rng.choice(vocab, n_words))
        other = changed_words(rng, line, vocab, (0.0, 0.1, 0.2)[i % 3])
        rows += [(2 * i, line), (2 * i + 1, other)]
        if line != other and line_dedup.similar(line, other, line_dedup.SIMILARITY):
            pairs.append(2 * i + 1)
    assert len(pairs) > 60
    out = {r["doc_id"]: r["line_dedup"]["n_removed"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(out[i] for i in pairs) >= 0.9 * len(pairs)
    assert not any(n for i, n in out.items() if i not in pairs and rows[i][1] not in [t for j, t in rows if j < i])


def test_lines_without_spaces_and_short_copies(spark):
    notice = "".join(chr(0x4E00 + 37 * i % 5000) for i in range(99))
    near = notice[:50] + "新" + notice[51:]
    apart = "".join(chr(0x5000 + 91 * i % 5000) for i in range(99))
    rows = [(1, f"{notice}\nRead more\n----\nown line of one"), (2, f"{notice}\nRead More!\n----\nx"), (3, f"{near}\nread\n```\nx"), (4, f"{apart}\n\n===\n- -")]
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: "x", 3: "read\n```\nx", 4: rows[3][1]}


def test_hot_bands_are_compared_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    vocab = [f"word{chr(97 + i % 26)}{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocab, 12)) for _ in range(3)]
    rows = [(i, changed_words(rng, base[i % 3], vocab, 0)) for i in range(120)] + [(200 + i, b) for i, b in enumerate(base)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, line_dedup.dedup_lines(docs).collect()))
    monkeypatch.setattr(line_dedup, "HOT_BAND", 20)
    assert sorted(map(str, line_dedup.dedup_lines(docs).collect())) == want
    assert sum("n_removed=0" in r for r in want) == 3


def test_candidates_do_not_depend_on_the_number_of_lines(spark, monkeypatch):
    rng = np.random.default_rng(11)
    vocab = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 10))) for _ in range(3000)]
    rows = []
    for i in range(150):
        line = list(" ".join(rng.choice(vocab, 10)))
        rows.append((2 * i, "".join(line)))
        for k in rng.choice(len(line), round(0.1 * len(line)), replace=False):
            line[k] = "abcdefghijklmnopqrstuvwxyz"[rng.integers(26)]
        rows.append((2 * i + 1, "".join(line)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def found():
        return sorted(connected_components(line_dedup.near_sketches(line_dedup.lines(docs))).collect())

    small = found()
    assert len(small) > 200
    count = line_dedup.row_count
    monkeypatch.setattr(line_dedup, "row_count", lambda df: count(df) and 5_000_000)
    assert found() == small


# --- n-gram Jaccard join in the pipeline ------------------------------------------------------

def test_near_copies_that_share_an_id_go(spark):
    def text(k):
        return " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(7, text(0)), (7, text(0) + " more"), (7, text(1)), (9, text(1) + " more"), (3, text(1) + " again"), (7, text(1)),
            (None, text(2)), (None, text(2)), (None, text(2) + " more"), (None, "stands alone here"), (8, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], DOCS)
    kept = corpus_pipeline.near_duplicate_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    found = [(r["doc_id"], r["text"]) for r in kept.collect()]
    ids = sorted(str(i) for i, _ in found)
    assert ids == ["3", "7", "8", "None", "None", "None"]
    assert (3, text(1) + " again") in found and (None, "stands alone here") in found and (None, None) in found and (8, None) in found
    assert next(t for i, t in found if i == 7) in (text(0), text(0) + " more")


# --- repeated rows ---------------------------------------------------------------------------

def test_a_row_repeated_many_times_is_drawn_for_each_time(spark):
    n = 3000
    rows = [(5, "one text", "en", "same", 8)] * n + [(None, None, "en", "none", None)] * 50 + [(i, f"text {i:04d}", "en", "own", 9) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS).repartition(6)
    rates = {r["source"]: r["rate"] for r in mixing.source_rates(docs, weights={"same": 0.3, "own": 0.7, "none": 0.0}).collect()}
    out = {r["source"]: r["n"] for r in mixing.mix(docs, weights={"same": 0.3, "own": 0.7, "none": 0.0}).groupBy("source").agg(F.count("*").alias("n")).collect()}
    for source in ("same", "own"):
        assert abs(out[source] - rates[source] * n) < 5 * (rates[source] * n) ** 0.5
    assert rates["none"] == 1.0 and 15 < out["none"] < 100


def test_copies_are_one_trial_of_the_quality_rules(spark):
    from shelfcast.llm import quality_rules
    good = " ".join(f"word{i}" for i in range(60))
    bad = " ".join(f"WORD{i} #" for i in range(60))
    rows = [(i, good, "en") for i in range(1500)] + [(2000 + i, bad, "en") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 2000)) for i, _, _ in rows], "doc_id long, quality int")
    out = quality_rules.apply_rules(docs, labels)
    assert out.filter("NOT kept").count() == 0  # two texts are no evidence
    many = [(i, good + f" own{i}", "en") for i in range(1500)] + [(2000 + i, bad + f" OWN{i} #", "en") for i in range(50)]
    kept = quality_rules.apply_rules(spark.createDataFrame(many, docs.schema), spark.createDataFrame([(i, int(i < 2000)) for i, _, _ in many], labels.schema))
    assert {r["doc_id"] < 2000 for r in kept.filter("kept").collect()} == {True} and kept.filter("kept").count() == 1500


def test_a_dirty_label_column_leaves_the_frequent_languages(spark):
    from shelfcast.llm import language_id
    en, fr = "the cat sits on the mat and looks at the house", "le chat est sur la table et regarde la maison"
    rows = [(i, f"{en} {i}", "en") for i in range(30)] + [(100 + i, f"{fr} {i}", "fr") for i in range(20)]
    rows += [(200 + i, f"{en if i % 2 else fr} x{i}", f"junk{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df, max_languages=2)
    assert sorted(model.languages) == ["en", "fr"]
    for r in language_id.predict(df, model).collect():
        assert r["language"]["lang"] == ("en" if r["text"].startswith("the") else "fr")
    assert len(language_id.fit(df).languages) == 42


def test_lines_of_a_large_cluster_meet_in_turns(spark, monkeypatch):
    """Every pair of chunks meets, with a bounded number of copies of a line in one shuffle
    (as many as chunks before)."""
    base = "the quick brown fox jumps over the lazy dog near the old river bank"
    docs = spark.createDataFrame([(i, f"{base} number {i}") for i in range(40)], "doc_id long, text string")
    rows = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    w = F.struct(F.lit(0).alias("line"), F.col("doc_id").alias("key"), F.lit(0).cast("long").alias("simhash"), F.lit(None).cast("binary").alias("packed"),
                 F.lit(1).cast("long").alias("cluster"), F.lit(7).alias("parts"))
    by_doc = rows.select("row", F.array(w).alias("w")).checkpoint()
    copies, made = [], line_dedup.per_group

    def seen(df, *args):
        copies.append(df.groupBy("key").count().agg(F.max("count")).first()[0])
        return made(df, *args)

    monkeypatch.setattr(line_dedup, "per_group", seen)
    monkeypatch.setattr(line_dedup, "TURNS_AT_ONCE", 2)
    links = line_dedup._links(docs.union(docs), by_doc, "doc_id", "text", 3, 0.8)
    assert {r["component"] for r in connected_components(links).collect()} == {0}
    assert connected_components(links).count() == 40 and len(copies) == 4 and max(copies) <= 2
    pairs = line_dedup.chunk_rows(by_doc.select(F.col("w")[0]["key"].alias("key"), F.lit(5).alias("__parts")), "key").collect()
    assert {(r["lo"], r["hi"]) for r in pairs} == {(a, b) for b in range(5) for a in range(b)} and len(pairs) == 40 * 4


def test_lines_that_meet_by_chance_do_not_form_a_cluster():
    """Lines with few equal bins are compared as pairs (their clusters grew into one before)."""
    line, cell = np.arange(16)[:, None], np.arange(line_dedup.BINS)
    bins = np.where(cell < 18, cell, line + cell).astype(np.uint16)  # 18 equal bins, the others all different
    bins = np.concatenate([bins, bins[[5] * 4]])
    bins[16:, 63] += 1
    found = line_dedup._near_in_bands(np.ones(20, np.uint64), np.arange(20), np.full(20, 100, np.int32), line_dedup._packed(bins), 0.8)
    strong, weak = found[~found["weak"]], found[found["weak"]]
    assert {*strong["a"], *strong["b"]} == {5, 16, 17, 18, 19} and len(strong) == 4
    assert len(weak.drop_duplicates()) == len(weak) == 20 * 19 // 2 - 10  # every other pair is there once


def test_pairs_are_given_up_only_if_surely_apart():
    rng = np.random.default_rng(6)
    letters = np.array(list("abcdefgh é\u4e00"))
    a, b = [], []
    for i in range(600):
        line = list(rng.choice(letters, rng.integers(1, 300)))
        other = list(line) if i % 2 else list(rng.choice(letters, len(line)))
        for _ in range(rng.integers(0, len(line) // 4 + 1)):
            k = rng.integers(len(other) + 1)
            other[k:k + rng.integers(2)] = rng.choice(letters, rng.integers(2))
        a.append("".join(line))
        b.append("".join(other))
    most = np.array([int(0.2 * max(len(x), len(y)) + 1e-9) for x, y in zip(a, b, strict=True)])
    apart = line_dedup.surely_apart(a, b, most)
    alike = np.array([line_dedup.similar(x, y, 0.8) for x, y in zip(a, b, strict=True)])
    assert not (apart & alike).any() and alike.sum() > 100 and apart.sum() > 100


def test_only_texts_go_to_the_language_workers(spark):
    """Whole rows went through Python, each with its text twice; each text is scored once."""
    rows = [(i, "the cat and the dog" if i % 2 else "le chat et le chien", "en" if i % 2 else "fr", "x" * 50) for i in range(40)]
    docs = spark.createDataFrame([*rows, (40, None, "en", "x"), (40, None, "en", "x"), (None, "12", None, None)], "doc_id long, text string, lang string, `a b` string")
    out = corpus_pipeline.language_stage(spark, docs, "")
    assert sorted(map(tuple, out.collect())) == sorted(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan
    sent = next(x for x in plan.splitlines() if "ArrowEvalPython" in x).split("]")[0]
    assert "text" in sent and not any(c in sent for c in ("doc_id", "lang", "a b"))


def changed_lines(n, seed=3):
    """Lines of 40 letters in groups around one text, each with up to 10 letters changed."""
    rng = np.random.default_rng(seed)
    letters, out = np.array(list("abcdefghijklmnop")), []
    for i in range(n):
        line = np.array(list("the first old text of this large group ab" if i % 3 else "no such line stands in the other ones xyz"))
        at = rng.choice(len(line), rng.integers(11), replace=False)
        line[at] = rng.choice(letters, len(at))
        out.append(line_dedup.normal("".join(line)))
    return out


def linked(n, links):
    a, b = (np.array([x[k] for x in links], np.int64) for k in (0, 1))
    return line_dedup.local_components(n, a, b).tolist()


def test_weak_pairs_are_compared_in_rounds(spark, monkeypatch):
    """The texts of all weak pairs were shuffled at once, both of each pair, and whole documents
    for them; now a round carries a bounded number of texts for each line, and only such lines."""
    value = changed_lines(30)
    docs = spark.createDataFrame([(i, f"{'other words ' * 50}\n\n{v}\n") for i, v in enumerate(value)] + [(99, None), (98, "")], "doc_id long, text string")
    places = docs.filter("doc_id < 30").select(F.col("doc_id").alias("key"), line_dedup._row_key("doc_id", "text").alias("row"), F.lit(2).alias("line")).checkpoint()
    pairs = [(i, j) for j in range(30) for i in range(j)]
    weak = spark.createDataFrame(pairs, "a long, b long").checkpoint()
    made, keep = [], line_dedup.materialize

    def seen(df):
        made.append(keep(df))
        return made[-1]

    monkeypatch.setattr(line_dedup, "materialize", seen)
    monkeypatch.setattr(line_dedup, "PAIRS_A_LINE", 4)
    links = line_dedup._pair_links(docs.union(docs), weak, places, "doc_id", "text", 0.8)
    want = sorted((i, j) for i, j in pairs if line_dedup.similar(value[i], value[j], 0.8))
    assert sorted(map(tuple, links.collect())) == want and 0 < len(want) < len(pairs)
    texts = next(df for df in made if "value" in df.columns)
    assert sorted(map(tuple, texts.collect())) == list(enumerate(value))  # no other line, each once
    assert len(made) >= 1 + 4  # 435 pairs, about 4 x 30 at once
    nothing = line_dedup._pair_links(docs, weak.limit(0), places.limit(0), "doc_id", "text", 0.8)
    assert nothing.count() == 0


def test_sketches_are_gone_when_texts_are_compared(spark, monkeypatch):
    """The sketches of all lines stayed on disk until the end."""
    docs = spark.createDataFrame([(i, f"{v}\nline of text number {i % 5}") for i, v in enumerate(changed_lines(20))], "doc_id long, text string")
    want = sorted(map(str, line_dedup.dedup_lines(docs).collect()))
    seen, groups = [], line_dedup.line_groups

    def compared(*args):
        seen.extend(c for df in args if hasattr(df, "columns") for c in df.columns)
        return groups(*args)

    monkeypatch.setattr(line_dedup, "line_groups", compared)
    assert sorted(map(str, line_dedup.dedup_lines(docs).collect())) == want
    assert "key" in seen and not {"sketch", "simhash", "chars"} & {*seen}


@pytest.mark.parametrize("first", [1, 500, 10**6])
def test_a_cluster_is_connected_as_by_all_its_pairs(monkeypatch, first):
    monkeypatch.setattr(line_dedup, "FIRST_CHARS", first)
    monkeypatch.setattr(line_dedup, "CHARS_AT_ONCE", max(first, 2000))
    value = changed_lines(60) + changed_lines(20, seed=4)
    n = len(value)
    frame = {"key": np.arange(n), "simhash": np.zeros(n, np.int64), "packed": [None] * n, "value": value}
    found = line_dedup._decide(line_dedup.pd.DataFrame(frame), 3, 0.8)
    pairs = [(i, j) for j in range(n) for i in range(j) if line_dedup.similar(value[i], value[j], 0.8)]
    assert linked(n, found.to_numpy().tolist()) == linked(n, pairs) and len(found) < n


def test_lines_of_impossible_lengths_are_not_linked_by_their_simhash(spark):
    """Lines of one SimHash were linked whatever their lengths, which joined unrelated clusters."""
    rows = [(1, 7, 100), (2, 7, 110), (3, 6, 300), (4, 7, 310), (5, 1 << 40, 100), (6, 5, 2000)]
    edges = line_dedup.near_hashes(spark.createDataFrame(rows, "key long, simhash long, chars int"))
    assert {tuple(sorted((r["a"], r["b"]))) for r in edges.collect()} == {(1, 2), (3, 4)}


def test_pairs_of_a_band_are_those_of_all_pairs(monkeypatch):
    """Compared in blocks; too many weak pairs to be held are found again."""
    rng = np.random.default_rng(8)
    n = 700
    bins = rng.integers(0, 3, (n, line_dedup.BINS)).astype(np.uint16)
    near = rng.integers(0, n, 300)
    bins[near] = bins[rng.integers(0, 5, 300)]
    key, chars = rng.integers(0, 3, n).astype(np.uint64) % np.uint64(2), rng.integers(60, 130, n).astype(np.int32)
    packed = line_dedup._packed(bins)
    equal = (bins[:, None] == bins[None]).sum(axis=2)
    assert (line_dedup._equal_bins(packed[:, None], packed[None]) == equal).all()
    longer = np.maximum(chars[:, None], chars[None]).astype(np.int64)
    maybe = (key[:, None] == key[None]) & (abs(chars[:, None] - chars[None]) <= (0.2 * longer + 1e-9).astype(np.int64)) & np.triu(np.ones((n, n), bool), 1)
    for strong in (24, 40):
        monkeypatch.setattr(line_dedup, "STRONG_BINS", strong)
        label = line_dedup.local_components(n, *np.nonzero(maybe & (equal >= strong)))
        want = {(i, j) for i, j in zip(*(x.tolist() for x in np.nonzero(maybe & (equal >= line_dedup.NEAR_BINS))), strict=True) if label[i] != label[j]}
        for held in (line_dedup.LINKS_AT_ONCE, 10):
            monkeypatch.setattr(line_dedup, "LINKS_AT_ONCE", held)
            found = line_dedup._near_in_bands(key, np.arange(n), chars, packed, 0.8)
            tied, weak = found[~found["weak"]], found[found["weak"]]
            assert (line_dedup.local_components(n, tied["a"].to_numpy(), tied["b"].to_numpy()) == label).all()
            assert {(a, b) for a, b in zip(weak["a"], weak["b"], strict=True)} == want and len(weak) == len(want)


def test_many_pairs_at_once_are_told_as_one_by_one(monkeypatch):
    """Similar pairs were all compared one by one, in Python."""
    monkeypatch.setattr(line_dedup, "FEW_IN_BAND", 1)
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefgh \u00e9\u4e00\0"))
    a, b = [], []
    for i in range(300):
        line = list(rng.choice(letters, rng.integers(0, 400 if i % 3 else 30)))
        other = list(line) if i % 4 else list(rng.choice(letters, len(line)))
        for _ in range(rng.integers(0, len(line) // 5 + 2)):
            k = rng.integers(len(other) + 1)
            other[k:k + rng.integers(3)] = rng.choice(letters, rng.integers(3))
        if i % 5 == 0:
            del other[:rng.integers(60)]
        a.append("".join(line))
        b.append("".join(other))
    apart = np.array([line_dedup.edit_distance(x, y, 10**6) for x, y in zip(a, b, strict=True)])
    for most in (apart, apart - 1, np.array([int(0.2 * max(len(x), len(y)) + 1e-9) for x, y in zip(a, b, strict=True)])):
        most = np.maximum(most, 0)
        near, told = line_dedup.alike(a, b, most)
        assert told.all() and (near == (apart <= most)).all()


def test_small_clusters_are_compared_together(monkeypatch):
    for few in (1, line_dedup.FEW_IN_BAND):
        monkeypatch.setattr(line_dedup, "FEW_IN_BAND", few)
        value, rows = changed_lines(90), np.array([2, 30, 3, 55])
        frame = line_dedup.pd.DataFrame({"key": range(90), "simhash": 0, "packed": None, "value": value})
        found = line_dedup._decide_small(frame, rows, 3, 0.8)
        cluster = np.repeat(range(4), rows)
        pairs = [(i, j) for j in range(90) for i in range(j) if cluster[i] == cluster[j] and line_dedup.similar(value[i], value[j], 0.8)]
        assert linked(90, list(zip(found["a"], found["b"], strict=True))) == linked(90, pairs) and len(found) < 90
