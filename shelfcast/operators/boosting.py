"""Boosting under the pinball loss over MLlib regression trees (M5; the search of M8).

A round fits one tree to the sign of the errors (q above the forecast, q - 1 below: the
negative gradient of the pinball loss), on a hashed sample of the rows and a drawn subset of
the features, and then gives every leaf the q-quantile of its errors, times the step size.
q = 0.5 is the absolute loss.  Rows are never collected: a round is an MLlib fit and one
grouped aggregate, which also gives the validation loss of the rounds before.  The driver
sees one row per leaf (at most 2^maxDepth).

The leaf quantile is the exact order statistic of rank ceil(q n).  ``percentile_approx``
gives it for leaves of up to ``ACCURACY`` rows; for larger ones its values a little below and
above bracket the rank, and counts in a fixed number of bins give the least and largest values
that bound the next pass, until both are the same value.

An ensemble is a few arrays per tree, read from MLlib's published description of the tree.
It can be kept and continued, and scores rows without a plan that grows with the rounds.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import ship_package
from shelfcast.sources.sinks import materialize

ACCURACY = 10_000
BINS = 512
#: Rounds between two checkpoints of the running forecast.
CUT_EVERY = 10
DEFAULTS = {"stepSize": 0.15, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetFraction": 0.6,
            "minInstancesPerNode": 24, "maxBins": 64}


@dataclass
class Tree:
    """Inner nodes test ``X[:, feature] <= threshold`` (left if so); a node with feature -1
    is a leaf, ``value`` what it adds."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def add(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        rows = np.flatnonzero(self.feature[node] >= 0)
        while len(rows):
            at = node[rows]
            low = x[rows, self.feature[at]] <= self.threshold[at]
            node[rows] = np.where(low, self.left[at], self.right[at])
            rows = rows[self.feature[node[rows]] >= 0]
        return self.value[node]


@dataclass
class Ensemble:
    """Boosted trees for one quantile: a start value and what each tree adds to it."""

    quantile: float
    columns: list[str]
    params: dict
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)  # validation loss with 0, 1, 2, ... trees

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for tree in self.trees:
            out += tree.add(x)
        return out


def _parse(text: str, used: list[int], values: list[float]) -> Tree:
    """A tree from MLlib's description: `If (feature 3 <= 1.5)`, `Else (...)`, `Predict: 2.0`
    by line, a node before its left and right subtrees.  Leaves take ``values`` in that order;
    ``used`` maps the tree's features to the columns of the whole matrix."""
    feature, threshold, left, right, value = [], [], [], [], []
    open_nodes, leaves = [], iter(values)

    def node() -> int:
        for into in (feature, left, right):
            into.append(-1)
        threshold.append(0.0)
        value.append(0.0)
        return len(feature) - 1

    for line in text.splitlines()[1:]:
        words = line.split()
        if not words:
            continue
        if words[0] == "Else":  # the left subtree of the open node is complete
            continue
        at = node()
        if open_nodes:
            above = open_nodes[-1]
            if left[above] < 0:
                left[above] = at
            else:
                right[above] = at
                open_nodes.pop()
        if words[0] == "If":
            feature[at] = used[int(words[2])]
            threshold[at] = float(words[4].rstrip(")"))
            open_nodes.append(at)
        else:
            value[at] = next(leaves)
    return Tree(*(np.array(x, t) for x, t in ((feature, np.int64), (threshold, float), (left, np.int64), (right, np.int64), (value, float))))


def pinball(actual: Column, forecast: Column, q: float) -> Column:
    e = actual - forecast
    return F.greatest(F.lit(q) * e, F.lit(q - 1.0) * e)


def exact_quantiles(df: DataFrame, group: str, value: str, q: float, *more: Column, accuracy: int = ACCURACY,
                    bins: int = BINS) -> tuple[dict, list]:
    """({group: value of rank ceil(q n)}, rows of the first aggregate with ``more``).

    NULL values are left out; a group without values gets no entry.  Only rows per group
    and bin reach the driver, so ``group`` must have few distinct values.
    """
    v, near = F.col(value), 2.0 / accuracy
    ranks = [max(0.0, q - near), float(q), min(1.0, q + near)]
    first = df.groupBy(group).agg(F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"),
                                  F.percentile_approx(v, ranks, accuracy).alias("_q"), *more).collect()
    found = {r[group]: r["_q"][1] for r in first if 0 < r["_n"] <= accuracy}
    # group -> (least, largest) of the open brackets; the counts of the first pass show whether
    # the approximate ranks hold the wanted one
    left = {r[group]: (r["_q"][0], r["_q"][2]) for r in first if r["_n"] > accuracy}
    whole = {r[group]: (r["_lo"], r["_hi"], max(1, math.ceil(q * r["_n"]))) for r in first}
    while left:
        names = list(left)
        at = F.array_position(F.lit(names) if not isinstance(names[0], str) else F.array(*map(F.lit, names)), F.col(group)).cast("int") - 1
        lo, hi = (F.get(F.lit([float(left[g][i]) for g in names]), at) for i in (0, 1))
        inside = df.select(group, v.cast("double").alias("_v"), lo.alias("_a"), hi.alias("_b")).filter("_v <= _b")
        place = F.least(F.floor(F.coalesce(F.try_divide(F.col("_v") - F.col("_a"), F.col("_b") - F.col("_a")), F.lit(0.0)) * bins), F.lit(bins - 1))
        rows: dict = {}
        for r in (inside.groupBy(group, F.when(F.col("_v") < F.col("_a"), -1).otherwise(place).alias("_bin"))
                        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")).collect()):
            rows.setdefault(r[group], []).append(r)
        for g in names:
            *left[g], rank = whole[g]
            for r in sorted(rows.get(g, ()), key=lambda r: r["_bin"]):
                if rank <= r["_n"]:
                    if r["_bin"] >= 0:
                        left[g] = (r["_lo"], r["_hi"])
                    break
                rank -= r["_n"]
        found |= {g: lo for g, (lo, hi) in left.items() if lo == hi}
        left = {g: b for g, b in left.items() if b[0] != b[1]}
    return found, first


def training_rows(train: DataFrame, val: DataFrame | None, columns: list[str], target: str = "sales",
                  key: tuple[str, ...] = ("id", "date")) -> DataFrame:
    """x (vector), y, is_val and a hash of the row's key, materialised: every round and every
    trial reads them."""
    from pyspark.ml.feature import VectorAssembler

    rows = train.withColumn("is_val", F.lit(False))
    if val is not None:
        rows = rows.unionByName(val.withColumn("is_val", F.lit(True)))
    put = VectorAssembler(inputCols=columns, outputCol="x", handleInvalid="error").transform(rows)
    return materialize(put.select("x", F.col(target).cast("double").alias("y"), "is_val", F.xxhash64(*key).alias("pick")))


def start_value(rows: DataFrame, quantile: float) -> float:
    """What boosting begins with: the quantile of the training targets."""
    found, _ = exact_quantiles(rows.filter(F.col("y").isNotNull() & ~F.col("is_val")).withColumn("g", F.lit(0)), "g", "y", quantile)
    return float(found.get(0, 0.0))


def add_score(df: DataFrame, ensemble: Ensemble, columns: list[Column], name: str) -> DataFrame:
    """``name``: what the ensemble gives for the features in ``columns`` (in its order)."""
    ship_package(df.sparkSession)
    if not ensemble.trees:
        return df.withColumn(name, F.lit(float(ensemble.start)))

    @F.pandas_udf("double")
    def score(*parts: pd.Series) -> pd.Series:
        return pd.Series(ensemble.score(np.column_stack([p.to_numpy(float) for p in parts])))

    return df.withColumn(name, score(*columns))


def boost(rows: DataFrame, columns: list[str], quantile: float = 0.5, rounds: int = 40, params: dict | None = None,
          begin: Ensemble | None = None, patience: int | None = None, seed: int = 42) -> Ensemble:
    """``rounds`` more trees on ``rows`` (of ``training_rows``), from ``begin`` if given.

    With ``patience`` rounds stop once the validation loss has not fallen for that many, and
    the trees after the best round are dropped.  NULL targets are left out.  A ``start`` among
    the parameters is that of ``start_value``.  Callers with several fits persist ``rows``.
    """
    p = {**DEFAULTS, **(params or {})}
    start = p.pop("start", None)
    rows = rows.filter(F.col("y").isNotNull())
    if begin is None:
        begin = Ensemble(quantile, list(columns), p, start_value(rows, quantile) if start is None else start)
    made = Ensemble(quantile, list(columns), p, begin.start, list(begin.trees), list(begin.losses[:len(begin.trees)]))
    if not made.trees:
        state = rows.withColumn("now", F.lit(made.start))
    else:
        values = vector_to_array("x")
        state = add_score(rows, made, [values[i] for i in range(len(columns))], "now")
    state = state.select("x", "y", "is_val", "pick", "now")
    if made.trees:
        state = state.persist()
    n_used = max(1, round(p["featureSubsetFraction"] * len(columns)))
    share = int(p["subsamplingRate"] * 10_000)
    error = F.col("y") - F.col("now")
    # a state is computed by the next round's fit; the two before it are let go after that
    held = [state] if made.trees else []
    try:
        end = len(made.trees) + rounds
        for r in range(len(made.trees), end):
            used = sorted(random.Random(seed * 100_003 + r).sample(range(len(columns)), n_used))
            drawn = ~F.col("is_val") & (F.pmod(F.xxhash64("pick", F.lit(seed), F.lit(r)), F.lit(10_000)) < share)
            cut = VectorSlicer(inputCol="x", outputCol="part", indices=used)
            sample = cut.transform(state.filter(drawn)).withColumn("gradient", F.when(error > 0, quantile).otherwise(quantile - 1.0))
            tree = DecisionTreeRegressor(featuresCol="part", labelCol="gradient", predictionCol="side", leafCol="leaf",
                                         maxDepth=int(p["maxDepth"]), maxBins=int(p["maxBins"]),
                                         minInstancesPerNode=int(p["minInstancesPerNode"]), seed=seed + r).fit(sample)
            leafed = tree.transform(cut.transform(state)).withColumn("leaf", F.col("leaf").cast("int"))
            measured = leafed.withColumn("error", F.when(drawn, error))
            loss = pinball(F.col("y"), F.col("now"), quantile)
            found, first = exact_quantiles(measured, "leaf", "error", quantile,
                                           F.sum(F.when(F.col("is_val"), loss)).alias("_loss"),
                                           F.count_if(F.col("is_val")).alias("_val"))
            n_val = sum(x["_val"] for x in first)
            made.losses.append(sum(x["_loss"] or 0.0 for x in first) / n_val if n_val else math.nan)
            n_leaves = (tree.numNodes + 1) // 2
            adds = [p["stepSize"] * float(found.get(i, 0.0)) for i in range(n_leaves)]
            made.trees.append(_parse(tree.toDebugString, used, adds))
            state = leafed.select("x", "y", "is_val", "pick", (F.col("now") + F.get(F.lit(adds), F.col("leaf"))).alias("now"))
            if r + 1 < end:  # the forecast of the last round is read once
                state = materialize(state) if (r + 1) % CUT_EVERY == 0 else state.persist()
            if patience and n_val and r + 1 - int(np.argmin(made.losses)) > patience:
                break
            held.append(state)
            if len(held) > 2:
                held.pop(0).unpersist()
        last = state.filter("is_val").agg(F.avg(pinball(F.col("y"), F.col("now"), quantile))).first()[0]
        made.losses.append(math.nan if last is None else float(last))
    finally:
        for old in [*held, state]:
            old.unpersist()
    if patience and not math.isnan(made.losses[0]):
        best = int(np.argmin(made.losses))
        made.trees, made.losses = made.trees[:best], made.losses[:best + 1]
    return made


def predict(df: DataFrame, ensemble: Ensemble, name: str = "yhat") -> DataFrame:
    """The ensemble's forecast, clipped at 0."""
    scored = add_score(df, ensemble, [F.col(c).cast("double") for c in ensemble.columns], name)
    return scored.withColumn(name, F.greatest(F.col(name), F.lit(0.0)))


def fit_quantiles(rows: DataFrame, columns: list[str], quantiles: list[float], **kwargs) -> dict[float, Ensemble]:
    """M5: one ensemble per quantile; their jobs run side by side."""
    from concurrent.futures import ThreadPoolExecutor

    rows = rows.persist()
    try:
        with ThreadPoolExecutor(len(quantiles)) as pool:
            return dict(zip(quantiles, pool.map(lambda q: boost(rows, columns, q, **kwargs), quantiles), strict=True))
    finally:
        rows.unpersist()


def predict_quantiles(df: DataFrame, ensembles: dict[float, Ensemble]) -> DataFrame:
    """q10, q50, ... per row, sorted per row so that they never cross."""
    names = [f"q{int(round(q * 100))}" for q in sorted(ensembles)]
    for q, name in zip(sorted(ensembles), names, strict=True):
        df = predict(df, ensembles[q], f"_{name}")
    ordered = F.array_sort(F.array(*[F.col(f"_{n}") for n in names]))
    return df.withColumns({n: ordered[i] for i, n in enumerate(names)}).drop(*[f"_{n}" for n in names])


def successive_halving(rows: DataFrame, columns: list[str], draws: list[dict], scale: float, first_rounds: int = 1,
                       keep: int = 3, last_rounds: int = 27, at_once: int = 8, seed: int = 42) -> list[dict]:
    """M8: all draws get ``first_rounds`` trees; the best ``1 / keep`` of them (by validation
    MASE: mean absolute error over ``scale``) go on from their ensembles with ``keep`` times
    as many trees, until one is left or ``last_rounds`` are reached.

    Returns trial, value, rounds and the parameters of every draw; ``value`` is that of the
    trial's last rung.  Ties keep the earlier trial.
    """
    from concurrent.futures import ThreadPoolExecutor

    made: dict[int, Ensemble | None] = dict.fromkeys(range(len(draws)))
    out: dict[int, dict] = {}
    total = first_rounds
    rows = rows.persist()
    start = start_value(rows, 0.5)  # the same for all draws

    def rung(i: int) -> None:
        before = made[i]
        made[i] = boost(rows, columns, 0.5, total - (len(before.trees) if before else 0), {**draws[i], "start": start}, before, seed=seed + i)
        # pinball loss at one half is half the absolute error
        out[i] = {"trial": i, "value": 2 * made[i].losses[-1] / scale, "rounds": total, **draws[i]}

    try:
        while True:
            with ThreadPoolExecutor(at_once) as pool:
                list(pool.map(rung, list(made)))
            if len(made) == 1 or total * keep > last_rounds:
                return [out[i] for i in sorted(out)]
            best = sorted(made, key=lambda i: (out[i]["value"], i))[:math.ceil(len(made) / keep)]
            made, total = {i: made[i] for i in best}, total * keep
    finally:
        rows.unpersist()
