"""Quality scores by Bradley-Terry pairwise ranking.

A document has a strength ``w . x`` with ``x`` a vector of text features; the probability
that document a is preferred to document b is ``sigmoid(w . (x_a - x_b))``.  Preference
pairs are formed from a bounded labelled sample (a good document is preferred to a bad
one), and ``w`` minimises the logistic loss on feature differences by Newton steps.

The threshold is a score quantile: over *all* labelled learning rows, the quantile of the
strengths at the share of bad documents.  The published score is the logistic of the
distance to that quantile, shifted so that the quantile lies at ``cut`` (0.7): a score of
at least ``cut`` means "above the quantile".

Sample bound: about ``per_class`` rows of either label, chosen by a hash of the id over
all learning rows; ``pairs`` preference pairs.  Features and scores cover whole texts and
are computed by DataFrame functions; only the sample's feature vectors reach the driver.

Defined results: NULL and blank texts have all-zero counts and get the score of such a
text; without labels of both kinds every score is 0.5; NULL labels are ignored and several
labels of one document count as the worst; repeated rows are scored one by one; ties get
equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.quality_rules import text_counts
from shelfcast.sources.sinks import materialize

PER_CLASS = 2000
PAIRS = 20_000
CUT = 0.7
RIDGE = 1e-3
QUANTILE_ACCURACY = 100_000

#: name -> (numerator, denominator) of the share features.
SHARES = {"symbols": ("n_symbols", "word_chars"), "repeats": ("n_repeat_words", "n_words"),
          "dup_lines": ("n_dup_lines", "n_lines"), "upper": ("n_upper", "word_chars"),
          "marks": ("n_marks", "word_chars"), "digits": ("n_digits", "word_chars")}
#: Each share also enters by its root and by the parts above these knots.
KNOTS = (0.02, 0.1, 0.3)


def feature_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, plus ``counts`` with two more character counts."""
    t = F.coalesce(F.col(text), F.lit(""))
    extra = docs.withColumn("marks_and_digits", F.struct(
        F.regexp_count(t, F.lit(r"[!?;:=_~^@/\\\[\]{}]")).cast("long").alias("n_marks"),
        F.regexp_count(t, F.lit(r"[0-9]")).cast("long").alias("n_digits")))
    out = text_counts(extra, text)
    return out.withColumn("counts", F.struct("counts.*", "marks_and_digits.*")).drop("marks_and_digits")


def features(c: str = "counts") -> list[Column]:
    """The feature vector, in a fixed order."""
    share = lambda a, b: F.when(F.col(f"{c}.{b}") == 0, F.lit(0.0)).otherwise(
        F.col(f"{c}.{a}").cast("double") / F.col(f"{c}.{b}"))
    out = []
    for num, den in SHARES.values():
        x = F.least(share(num, den), F.lit(1.0))
        out += [x, F.sqrt(x)] + [F.greatest(x - k, F.lit(0.0)) for k in KNOTS]
    mean = F.least(share("word_chars", "n_words"), F.lit(50.0))
    out += [F.log1p(F.col(f"{c}.n_words").cast("double")) / 10, F.abs(mean - 5.0) / 10, F.greatest(mean - 8.0, F.lit(0.0)) / 10]
    return out


@dataclass
class Model:
    weights: list[float] | None  # None: nothing to rank by
    threshold: float = 0.0

    def strength(self, c: str = "counts") -> Column:
        out = F.lit(0.0)
        for w, x in zip(self.weights, features(c), strict=True):
            out = out + F.lit(float(w)) * x
        return out


def bradley_terry(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = 7) -> np.ndarray:
    """Weights that minimise the mean logistic loss over preference pairs (good over bad)."""
    rng = np.random.default_rng(seed)
    d = good[rng.integers(0, len(good), pairs)] - bad[rng.integers(0, len(bad), pairs)]
    w = np.zeros(d.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(np.clip(d @ w, -35, 35)))  # probability of the wrong order
        grad = -(d.T @ p) / pairs + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(counted: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", per_class: int = PER_CLASS,
        pairs: int = PAIRS) -> Model:
    """Fit on the rows of ``counted`` (with ``counts``) that have a label of 0 or 1."""
    marks = (labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
                   .groupBy(F.col(key).alias("id")).agg(F.min(label).alias("good")))
    known = materialize(counted.select(F.col(key).alias("id"), "counts").join(marks, "id"))
    n = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return Model(None)
    share = F.when(F.col("good") == 1, F.lit(per_class / n[1])).otherwise(F.lit(per_class / n[0]))
    draw = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    sample = (known.withColumn("draw", draw).filter(F.col("draw") < share)
                   .select("id", "good", "draw", F.array(*features()).alias("x")).limit(8 * per_class).collect())
    sample = sorted(sample, key=lambda r: (r["draw"], r["id"], r["x"]))
    rows = {g: np.array([r["x"] for r in sample if r["good"] == g]) for g in (0, 1)}
    if not len(rows[0]) or not len(rows[1]):
        return Model(None)
    model = Model(bradley_terry(rows[1], rows[0], pairs).tolist())
    model.threshold = float(known.agg(F.percentile_approx(model.strength(), float(n[0] / (n[0] + n[1])),
                                                          QUANTILE_ACCURACY)).first()[0])
    return model


def score(counted: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """``counted`` plus ``score`` in (0, 1); ``score >= cut`` is "at or above the quantile"."""
    if model.weights is None:
        return counted.withColumn("score", F.lit(0.5))
    beyond = model.strength() - model.threshold
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), beyond)) + float(np.log(cut / (1 - cut)))
    return counted.withColumn("score", 1.0 / (1.0 + F.exp(-z)))
