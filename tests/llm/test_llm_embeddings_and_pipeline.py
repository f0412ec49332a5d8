"""Embedding join, registered queries and the pipeline."""
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from shelfcast.llm import embedding_dedup, line_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, cosine=0.9):
    ok = [r for r in rows if r[0] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    up, n = {r[0]: r[0] for r in rows if r[0] is not None}, {}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (a, x) in enumerate(ok):
        for b, y in ok[:i]:
            if len(x) == len(y) and np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y)) >= cosine:
                n[a], n[b] = n.get(a, 0) + 1, n.get(b, 0) + 1
                lo, hi = sorted((find(a), find(b)))
                up[hi] = lo
    return {i: (n.get(i, 0), find(i)) for i in up}


def vectors():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[rng.integers(6)] + rng.normal(scale=0.35, size=8)).tolist()) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(5)] + [(300, [2 * x for x in rows[3][1]])]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan")] * 8), (404, [1.0, None] + [0.0] * 6),
             (405, [float("inf")] + [0.0] * 7), (406, [1.0, 0.0]), (407, [1.0, 0.1]), (408, [1e-160] * 8), (409, [1e160] * 8), (None, rows[3][1])]
    return rows


@pytest.mark.parametrize("cell_rows", [7, 40, 4096])
def test_embedding_join_matches_brute_force(spark, cell_rows):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(1)).withColumn("id", F.lit("x"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.components(df, cell_rows=cell_rows).collect()}
    want = brute([(i, v) for i, v in rows if i not in (408, 409)])
    for i, v in want.items():
        if i not in (408, 409):
            assert got[i] == v, i
    assert got[408] == got[409][:1] + (408,)  # extreme lengths, one direction
    assert len(got) == len(rows) and got[None] == (0, None)
    assert embedding_dedup.components(df.limit(0)).count() == 0


def test_every_operator_is_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and [s for s, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "n-gram Jaccard join", "mixing sources", "packing"]


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_lm_scores", "op9_mix_sources", "op13_filter_audit"])
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    a, b = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    key = lambda df: sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False, name=None)))
    assert key(a) == key(b)


def awkward(spark):
    rows = [(1, "the cat sat on the mat today", "en", "a", 28), (2, "the cat sat on the mat today", "en", "a", 28), (3, None, None, None, None),
            (4, "", "en", "a", 0), (5, "12345 67890", None, "b", 11), (None, "le chat est sur la table ici", "fr", None, 28),
            (6, "le chien dort dans la maison", "fr", "b", 28), (6, "le chien dort dans la maison", "fr", "b", 28)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_on_awkward_and_empty_tables(spark, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (awkward(spark), awkward(spark).limit(0)):
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SF)
            path = str(tmp_path / f"{i}-{docs.count()}")
            out.write.mode("overwrite").parquet(path)
            if i < 4:
                assert out.columns == columns, name
                docs = spark.read.parquet(path)


def test_pipeline_stages_do_their_work(spark):
    docs = awkward(spark)
    kept = corpus_pipeline.language_stage(spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, None, 6}  # texts without a letter go
    lines = {(r["doc_id"], r["text"]) for r in corpus_pipeline.line_stage(spark, kept, SF).collect()}
    assert (1, "the cat sat on the mat today") in lines and 2 not in {i for i, _ in lines}
    text = " ".join(f"w{i}" for i in range(60))
    near = spark.createDataFrame([(1, text, "en", "a", 0), (2, text + " more", "en", "a", 0), (2, text + " more", "en", "a", 0),
                                  (3, "other words that stand alone here", "en", "a", 0), (None, text, "en", "a", 0)], docs.schema)
    assert sorted(str(r["doc_id"]) for r in corpus_pipeline.near_duplicate_stage(spark, near, SF).collect()) == ["1", "3"]


def test_run_covers_all_tokens(spark):
    out = corpus_pipeline.run(spark, SF)
    rows = out.select("sequence_id", "offset", "length").collect()
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert rows and max(ends.values()) <= 4096
    assert line_dedup.MIN_WORDS == 3
