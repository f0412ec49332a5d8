"""Registered queries of the operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import byte_bpe, embedding_dedup, filter_audit, language_id, line_dedup, lm_score, mixing, ngram_join, packing, pii, quality_classifier, quality_rules, token_align
from shelfcast.llm.common import crc_mod, read
from shelfcast.session import ship_package
from shelfcast.sources.sinks import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)  # executors' Python workers import the package from this zip
            return fn(spark, sf_dir)
        run.__doc__, run.__name__ = fn.__doc__, fn.__name__
        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return run
    return add


def _ladder_sql() -> str:
    rows = []
    for r in quality_rules.RULES:
        for i, c in enumerate(r.ladder):
            rows.append(f"('{r.name}', {i}, {c!r}::DOUBLE, {str(r.above).lower()})")
    return ", ".join(rows)


def _ratio_sql() -> str:
    cases = " ".join(
        f"WHEN '{r.name}' THEN CASE WHEN {r.denominator} = 0 THEN 0.0 ELSE {r.numerator}::DOUBLE / {r.denominator} END"
        for r in quality_rules.RULES)
    return f"CASE rule {cases} END"


_R = len(quality_rules.RULES)
OP1_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
tri AS (SELECT doc_id, unnest(range(1, greatest(len(ws) - 1, 1))) AS p, ws FROM w),
win AS (SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS g FROM tri),
dup AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM dup) GROUP BY 1),
f AS (SELECT w.doc_id, stratum, text, len(ws)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        len(ls)::BIGINT AS n_lines, (length(text) - length(regexp_replace(text, '\p{{Lu}}', '', 'g')))::BIGINT AS n_upper
      FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
b AS (SELECT *, (n_words < {quality_rules.MIN_WORDS}
                 OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM f),
lab AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY 1),
rules(rule, step, cutoff, above) AS (VALUES {_ladder_sql()}),
once AS (SELECT stratum, text, any_value(b) AS b, min(good) AS good FROM b JOIN lab USING (doc_id) WHERE NOT base_failed GROUP BY 1, 2),
cross_ AS (SELECT stratum, rule, step, cutoff, above, good, {_ratio_sql()} AS v
           FROM (SELECT b.*, good FROM once), rules),
cell AS (SELECT stratum, rule, step, cutoff,
           count(*) FILTER (good = 1) AS n, count(*) FILTER (good = 1 AND hit) AS k,
           count(*) FILTER (good = 0) AS nb, count(*) FILTER (good = 0 AND hit) AS kb
         FROM (SELECT *, CASE WHEN above THEN v > cutoff ELSE v < cutoff END AS hit FROM cross_) GROUP BY 1, 2, 3, 4),
tail AS (SELECT *, CASE WHEN k >= n * (0.05::DOUBLE / {_R}) THEN 1.0 ELSE
           list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(greatest(i, 0) + 1) - lgamma(n - i + 1)
             + i * ln(0.05::DOUBLE / {_R}) + (n - i) * ln(1 - 0.05::DOUBLE / {_R})))) END AS p FROM cell),
tested AS (SELECT *, coalesce(CASE WHEN nb > 0 AND n > 0 THEN kb::DOUBLE / nb - k::DOUBLE / n END, 0) AS gain,
             max((p > 0.05::DOUBLE / ((SELECT count(DISTINCT stratum) FROM cell) * {_R}))::INT)
               OVER (PARTITION BY stratum, rule ORDER BY step) AS failed FROM tail),
cut AS (SELECT stratum, rule, arg_max(cutoff, (gain, -step)) AS cutoff FROM tested
        WHERE failed = 0 AND gain > 0 GROUP BY 1, 2),
hit AS (SELECT DISTINCT doc_id FROM (
          SELECT doc_id, cutoff, {_ratio_sql()} AS v, rule FROM b JOIN cut USING (stratum)) JOIN
          (SELECT DISTINCT rule, above FROM rules) USING (rule) WHERE CASE WHEN above THEN v > cutoff ELSE v < cutoff END)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND hit.doc_id IS NULL) AS kept
FROM b LEFT JOIN hit USING (doc_id)
"""


@query(OP1_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of every whole text, the base rule, and the risk-controlled verdict."""
    out = quality_rules.apply_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


# for rows that are unique by id and text: repeated ones are told apart by their place
OP9_SQL = f"""
WITH s AS (SELECT source, sum(length(text))::DOUBLE AS size, pow(sum(length(text))::DOUBLE, 0.5) AS weight
           FROM documents GROUP BY 1),
r AS (SELECT source, CASE WHEN coalesce(size, 0) = 0 THEN 1.0 ELSE
        weight / (SELECT sum(weight) FROM s) * (SELECT sum(size) FROM s) / size END AS rate FROM s),
u AS (SELECT d.*, rate, ceil(rate / {mixing.MAX_RATE})::INT AS parts FROM documents d JOIN r
        ON d.source IS NOT DISTINCT FROM r.source),
x AS (SELECT *, unnest(range(1, parts + 1)) AS i FROM u),
y AS (SELECT *, (('0x' || left(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null') || ':0:' || i), 13))::BIGINT::DOUBLE + 0.5)
        / {2**mixing.BITS}.0 AS un FROM x),
z AS (SELECT doc_id, text, lang, source, n_chars, sum(len(list_filter(range(0, {mixing.MAX_COPIES}),
        lambda k: un > list_sum(list_transform(range(0, k + 1),
               lambda j: exp(-rate / parts + j * ln(rate / parts) - lgamma(j + 1))))))) AS n_copies
      FROM y GROUP BY ALL)
SELECT doc_id, md5(coalesce(text, '')) AS text_md5, lang, source, n_chars, n_copies::INT AS n_copies,
       unnest(range(1, n_copies::INT + 1))::INT AS copy FROM z
"""


@query(OP9_SQL)
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated to square-root-of-size source weights, in shuffled order; the
    text itself travels through the shuffle and is returned with its md5."""
    out = mixing.mix(read(spark, sf_dir, "documents"))
    return out.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), "lang", "source",
                      "n_chars", F.col("mixed.n_copies").alias("n_copies"), F.col("mixed.copy").alias("copy"))


@query()
def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document tokenized, cut and packed into windows of 4096 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned on two of three id folds."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = language_id.fit(docs.filter(~held_out))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                      F.col("language.score").alias("score"))


@query()
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, ranked from pairs of three of four id folds."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    labels = read(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "quality")
    counted = materialize(quality_classifier.feature_counts(docs))
    model = quality_classifier.fit(counted, labels)
    out = quality_classifier.score(counted, model)
    return out.select("doc_id", held_out.alias("held_out"), "score",
                      (F.col("score") >= quality_classifier.CUT).cast("int").alias("predicted"))


@query()
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: base spans and those the classifier adds."""
    found = pii.find(read(spark, sf_dir, "documents"))
    n = [F.size(F.array_remove(F.transform("base", lambda s: s["kind"] == F.lit(pii.KINDS.index(k))), False)).cast("long")
         .alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select("doc_id", *n, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
                        pii.listed(F.array_sort(F.concat("base", "added"))).alias("spans"))


@query()
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle-set size and near-duplicate component of every document."""
    return ngram_join.components(read(spark, sf_dir, "documents"))


@query()
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of links and component of every vector at cosine 0.9."""
    return embedding_dedup.components(read(spark, sf_dir, "embeddings"))


@query()
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat, exactly or nearly, across the corpus."""
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "line_dedup.n_lines", "line_dedup.n_removed")


OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
n AS (SELECT sum(len(ws)) AS n FROM d),
p AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
g AS (SELECT r, i, len(ws) AS own, ws[i] AS w1, CASE WHEN i > 1 THEN ws[i - 1] || ' ' || ws[i] END AS w2,
             CASE WHEN i > 2 THEN ws[i - 2] || ' ' || ws[i - 1] || ' ' || ws[i] END AS w3 FROM p),
c AS (SELECT *, count(w1) OVER (PARTITION BY w1) - count(w1) OVER (PARTITION BY r, w1) AS c1,
             count(w2) OVER (PARTITION BY w2) - count(w2) OVER (PARTITION BY r, w2) AS c2,
             count(w3) OVER (PARTITION BY w3) - count(w3) OVER (PARTITION BY r, w3) AS c3 FROM g),
b AS (SELECT *, lag(c1) OVER w AS b1, lag(c2) OVER w AS b2 FROM c WINDOW w AS (PARTITION BY r ORDER BY i)),
s AS (SELECT r, ln(CASE WHEN c3 > 0 THEN c3::DOUBLE / b2
        ELSE CASE WHEN i > 2 THEN 0.4::DOUBLE ELSE 1 END * CASE WHEN c2 > 0 THEN c2::DOUBLE / b1
        ELSE CASE WHEN i > 1 THEN 0.4::DOUBLE ELSE 1 END * CASE WHEN c1 > 0 THEN c1::DOUBLE / (n - own)
        ELSE 1::DOUBLE / (n - own + 1) END END END) AS l FROM b, n),
m AS (SELECT r, sum(l) AS l FROM s GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, round(l / len(ws), 6) AS mean_log_score FROM d LEFT JOIN m USING (r)
"""


@query(OP3_SQL)
def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean stupid-backoff log score of every whole text against the rest of the corpus."""
    out = lm_score.scores(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", F.round("mean_log_score", 6).alias("mean_log_score"))


@query()
def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by the ranks of a byte-level vocabulary, and decoded again."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = byte_bpe.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, offsets=False)
    out = byte_bpe.decode(encoded, path, keep_ids=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


_FAILS = "CASE substr(filter_order, {i}, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END"
OP13_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM t),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, len(ws) < {filter_audit.MIN_WORDS} AS a,
             100 * len(list_distinct(ws)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(ws) AS b,
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {filter_audit.MAX_UPPER_PERCENT} * length(text) AS c,
             regexp_matches(text, '[#$%&*|]') AS d,
             coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false) AS e,
             coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
k AS (SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM m GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT f1.f || f2.f || f3.f || f4.f || f5.f AS filter_order FROM f f1, f f2, f f3, f f4, f f5
      WHERE len(list_distinct([f1.f, f2.f, f3.f, f4.f, f5.f])) = 5),
p AS (SELECT *, list_position([{", ".join("(" + _FAILS.format(i=i) + ")" for i in range(1, 6))}], true) AS first_fail FROM k, o),
s AS (SELECT *, unnest(range(1, 6)) AS step FROM p),
q AS (SELECT *, {_FAILS.format(i="step")} AS fails, a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails FROM s),
r AS (SELECT part, filter_order, step::INT AS step,
             coalesce(sum(n) FILTER (first_fail IS NULL OR first_fail > step), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (first_fail = step), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (fails AND first_fail < step), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (fails AND n_fails = 1), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (first_fail = step), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (first_fail = step), 0)::BIGINT AS toxic_lost
      FROM q GROUP BY ALL)
SELECT *, sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1))::BIGINT AS shapley FROM r
"""


@query(OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep and remove at each step of all their orders, per language."""
    return filter_audit.audit_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned over every whole text, with corpus-wide link counts."""
    return token_align.link_statistics(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                       public_tokenizers.path("piece_bpe_32k.model"))
