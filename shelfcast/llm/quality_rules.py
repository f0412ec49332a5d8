"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Per document a few counts are taken over the whole text.  A base rule rejects texts
that are too short or mostly repetition.  For the rest, labelled documents of each
stratum decide how strict every further rule may be:

* each rule has a fixed ladder of cutoffs, from lenient to strict;
* for a cutoff, ``k`` of the stratum's ``n`` good labelled documents are rejected; the
  exact binomial tail ``P(Bin(n, a) <= k)`` is the p-value of "this cutoff rejects more
  than a share ``a`` of good documents";
* rejection rates grow along a ladder, so it is tested in fixed sequence (stop at the
  first failure, no penalty), while the ladders of all strata and rules are corrected
  by Bonferroni: level ``delta / (strata * rules)`` each;
* the union of R rules gets the risk ``alpha``, so each rule has ``a = alpha / R``.

With probability at least ``1 - delta``, in every stratum at the same time, at most a
share ``alpha`` of good documents is rejected.  Among the certified cutoffs the one
that best separates good from bad labelled documents is taken; a stratum without enough
labels, or a rule that separates nothing, gets no cutoff and rejects nothing.

Defined results: NULL or blank text has no words (base rule fails it); a NULL stratum
is a stratum of its own; repeated rows are scored row by row; several labels of one
document count as the worst one; NULL labels are ignored; empty tables give no rows.
Repeated 3-word windows are compared by 64-bit hash within one text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import let, words
from shelfcast.sources.sinks import materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The characters counted as symbols, and those that separate words.
SYMBOLS = "#*$%&|<>"
SEPARATORS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rule:
    """Reject when ``numerator / denominator`` lies beyond a cutoff of the ladder."""

    name: str
    numerator: str
    denominator: str
    above: bool
    ladder: tuple[float, ...]


RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", True, (4.0, 3.0, 2.0, 1.5, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.1)),
    Rule("repeated_share", "n_repeat_words", "n_words", True, (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("dup_line_share", "n_dup_lines", "n_lines", True, (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1)),
    Rule("upper_share", "n_upper", "word_chars", True, (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    Rule("long_words", "word_chars", "n_words", True, (20.0, 16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0)),
    Rule("short_words", "word_chars", "n_words", False, (1.0, 1.5, 2.0, 2.5, 3.0, 3.5)),
)


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c))
    return text


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice: sort the windows by hash,
    keep those equal to a neighbour, and measure the union of their positions."""
    n = F.size(w)
    windows = F.transform(F.sequence(F.lit(0), n - 3),
                          lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                                             i.alias("p")))

    def repeated(s):
        same = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def covered(p):
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        step = lambda a, x: F.struct((a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last"))
        return F.aggregate(p, start, step, lambda a: a["n"])

    return F.when(n < 4, F.lit(0)).otherwise(let(let(F.sort_array(windows), repeated), covered))


def _line_stats(lines: Column) -> Column:
    return F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("distinct"))


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, plus the counts of each whole text (column ``counts``)."""
    t = F.coalesce(F.col(text), F.lit(""))
    by_word = let(words(t), lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("repeat")))
    with_word = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    kept = [c for c in docs.columns if c not in (text, "counts")]
    parts = docs.select(
        *kept, by_word.alias("__w"), let(with_word, _line_stats).alias("__l"),
        F.char_length(_without(t, SEPARATORS)).alias("__chars"),
        (F.octet_length(t) - F.octet_length(_without(t, SYMBOLS))).alias("__symbols"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).alias("__upper"))
    n = lambda c: c.cast("long")
    counts = F.struct(n(F.col("__w.n")).alias("n_words"), n(F.col("__chars")).alias("word_chars"),
                      n(F.col("__symbols")).alias("n_symbols"),
                      n(F.col("__l.n") - F.col("__l.distinct")).alias("n_dup_lines"),
                      n(F.col("__w.repeat")).alias("n_repeat_words"),
                      n(F.col("__l.n")).alias("n_lines"), n(F.col("__upper")).alias("n_upper"))
    return parts.select(*kept, counts.alias("counts"))


def base_failed(c: str = "counts") -> Column:
    return ((F.col(f"{c}.n_words") < MIN_WORDS)
            | (100 * F.col(f"{c}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{c}.n_words")))


def _ratio(rule: Rule, c: str = "counts") -> Column:
    d = F.col(f"{c}.{rule.denominator}")
    return F.when(d == 0, F.lit(0.0)).otherwise(F.col(f"{c}.{rule.numerator}").cast("double") / d)


def binomial_tail(n: Column, k: Column, a: Column) -> Column:
    """Exact ``P(Bin(n, a) <= k)``, summed in log space; 1 where ``k >= n * a`` (such a
    cutoff can never be certified), which also bounds the sum by ``n * a`` terms."""
    first = n * F.log(1 - a)
    start = F.struct(first.alias("t"), first.alias("s"))

    def step(acc, i):
        t = F.when(i == 0, acc["t"]).otherwise(
            acc["t"] + F.log((n - i + 1).cast("double") / F.greatest(i, F.lit(1)) * a / (1 - a)))
        hi, lo = F.greatest(acc["s"], t), F.least(acc["s"], t)
        return F.struct(t.alias("t"), F.when(i == 0, acc["s"]).otherwise(hi + F.log1p(F.exp(lo - hi))).alias("s"))

    tail = F.aggregate(F.sequence(F.lit(0).cast("long"), k), start, step, lambda acc: F.exp(acc["s"]))
    return F.when(k >= n * a, F.lit(1.0)).otherwise(tail)


def certified_cutoffs(counted: DataFrame, labels: DataFrame, stratum: str, key: str = "doc_id",
                      label: str = "quality", alpha: float = 0.05, delta: float = 0.05,
                      rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per stratum with labels: ``stratum`` and a map rule name -> cutoff.

    ``counted`` holds ``counts`` and ``digest``, a hash of the text; documents that fail the
    base rule are outside the population.  A trial is a distinct text of a stratum: copies and
    repeated rows are no further evidence, and a text counts as good if all its labelled rows
    are.  Sums per (stratum, rule, cutoff) are combined before the shuffle.
    """
    marks = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
                   .groupBy(F.col(key).alias("__key")).agg(F.min(label).alias("__good")))
    held = (counted.filter(~base_failed())
                   .select(F.col(key).alias("__key"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"),
                           "counts", "digest").join(marks, "__key")
                   .groupBy("stratum", "digest").agg(F.any_value("counts").alias("counts"), F.min("__good").alias("__good")))
    ladders = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
                 ((_ratio(r) > c) if r.above else (_ratio(r) < c)).alias("hit"))
        for r in rules for i, c in enumerate(r.ladder)])
    cells = (held.select("stratum", "__good", F.explode(ladders).alias("x"))
                 .groupBy("stratum", "x.rule", "x.step", "x.cutoff")
                 .agg(F.count_if(F.col("__good") == 1).alias("n_good"),
                      F.count_if((F.col("__good") == 1) & F.col("x.hit")).alias("bad_hits"),
                      F.count_if(F.col("__good") == 0).alias("n_bad"),
                      F.count_if((F.col("__good") == 0) & F.col("x.hit")).alias("good_hits")))
    cells = materialize(cells)
    strata = cells.agg(F.count_distinct("stratum").alias("n_strata"))
    a = F.lit(alpha / len(rules))
    level = F.lit(delta) / (F.col("n_strata") * len(rules))
    gain = (F.try_divide(F.col("good_hits").cast("double"), F.col("n_bad"))
            - F.try_divide(F.col("bad_hits").cast("double"), F.col("n_good")))
    # one ladder is at most a dozen rows: gather it, cut it at the first failure, pick the best
    ladder = (cells.join(F.broadcast(strata))  # one row
                   .withColumn("ok", binomial_tail(F.col("n_good"), F.col("bad_hits"), a) <= level)
                   .groupBy("stratum", "rule")
                   .agg(F.array_sort(F.collect_list(F.struct("step", "ok", F.coalesce(gain, F.lit(0.0)).alias("gain"),
                                                            "cutoff"))).alias("ladder")))
    stop = F.coalesce(F.array_min(F.transform(F.filter("ladder", lambda x: ~x["ok"]), lambda x: x["step"])), F.lit(10**6))
    usable = F.filter("ladder", lambda x: (x["step"] < F.col("stop")) & (x["gain"] > 0))
    best = F.array_max(F.transform(usable, lambda x: F.struct(x["gain"].alias("gain"), (-x["step"]).alias("lenient"),
                                                              x["cutoff"].alias("cutoff"))))
    return (ladder.withColumn("stop", stop).withColumn("best", best)
                  .groupBy("stratum")
                  .agg(F.map_from_entries(F.collect_list(F.struct("rule", F.col("best.cutoff")))).alias("cutoffs")))


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", text: str = "text",
                alpha: float = 0.05, delta: float = 0.05, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document row: key, the counts, ``base_failed``, ``kept``, and the names
    of the rules that rejected it.  Texts are read once; the counts are checkpointed."""
    small = docs.select(key, F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.col(text).alias("__text"))
    small = small.withColumn("digest", F.unhex(F.md5(F.coalesce("__text", F.lit("")).cast("binary"))))
    counted = materialize(text_counts(small, "__text"))
    cuts = certified_cutoffs(counted, labels, "stratum", key, alpha=alpha, delta=delta, rules=rules)
    hits = F.filter(F.array(*[
        F.when((_ratio(r) > F.col("cutoffs")[r.name]) if r.above else (_ratio(r) < F.col("cutoffs")[r.name]), F.lit(r.name))
        for r in rules]), lambda x: x.isNotNull())
    return (counted.join(cuts, "stratum", "left")
                   .withColumn("failed_rules", F.coalesce(hits, F.array().cast("array<string>")))
                   .select(F.col(key), "stratum", "counts.*", base_failed().alias("base_failed"),
                           (~base_failed() & (F.size("failed_rules") == 0)).alias("kept"), "failed_rules"))
