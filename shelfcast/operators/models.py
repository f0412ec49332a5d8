"""Global tree models on the feature matrix.

* M4 point model: MLlib ``GBTRegressor`` with absolute loss; early stopping through a
  validation indicator column (rows of the validation span) and a tolerance.
* M5 intervals: boosting under the pinball loss, see ``operators.boosting``.  A cheaper
  form takes the target's P10/P50/P90 in the leaves of one regression tree
  (``percentile_approx``), joined back on the leaf of each scored row.  The leaf table
  has at most 2^maxDepth rows, a proven bound, so it is broadcast.
* M7 importances: impurity-gain importances zipped with the feature names.
* M8 search: seeded draws over the ranges MLlib shares with the reference, scored by
  validation MASE; successive halving continues the better ones, ``random_search`` fits
  every draw to the end.

Every fit and prediction is a distributed MLlib job; nothing is collected but model
parameters and one metric per trial.
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions.numeric import clip_at_zero, title_label
from shelfcast.operators import boosting

# ---- fixed values -----------------------------------------------------------------------
QUANTILES = [0.1, 0.5, 0.9]
PRICE_FEATURES = ["sell_price", "log_price", "price_momentum", "price_vs_dept_mean"]
# search ranges that exist in MLlib (learning rate log-uniform, depth, row and column
# fractions, minimum rows per leaf)
SEARCH_SPACE = {
    "stepSize": (0.01, 0.3, "log"),
    "maxDepth": (3, 10, "int"),
    "subsamplingRate": (0.5, 1.0, "float"),
    "featureSubsetFraction": (0.5, 1.0, "float"),
    "minInstancesPerNode": (10, 100, "int"),
}
# -------------------------------------------------------------------------------------------

DEFAULT_GBT = {"maxIter": 60, "stepSize": 0.1, "maxDepth": 6, "subsamplingRate": 0.8,
               "featureSubsetStrategy": "0.6", "minInstancesPerNode": 24, "validationTol": 1e-4,
               "maxBins": 64, "seed": 42}


def model_frame(features: DataFrame) -> DataFrame:
    """Nulls cannot enter a vector: price-derived features are 0 where no price is listed,
    with an ``is_listed`` flag; encodings of unseen keys are 0."""
    enc = [c for c in ("item_store_enc", "dept_store_enc", "cat_store_enc") if c in features.columns]
    df = features.withColumn("is_listed", F.col("sell_price").isNotNull().cast("int"))
    return df.fillna(0.0, subset=[c for c in PRICE_FEATURES + enc if c in df.columns])


def _assembler(feature_cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="error")


def fit_point_model(train: DataFrame, feature_cols: list[str], target: str = "sales",
                    val: DataFrame | None = None, params: dict | None = None) -> PipelineModel:
    """M4: global boosted trees, absolute loss; ``val`` rows drive early stopping."""
    p = {**DEFAULT_GBT, **(params or {})}
    data = train.withColumn("is_val", F.lit(False))
    if val is not None:
        data = data.unionByName(val.withColumn("is_val", F.lit(True)))
    gbt = GBTRegressor(featuresCol="features", labelCol=target, lossType="absolute", **p)
    if val is not None:
        gbt = gbt.setValidationIndicatorCol("is_val")
    data = data.withColumn(target, F.col(target).cast("double"))
    return Pipeline(stages=[_assembler(feature_cols), gbt]).fit(data)


def predict_point(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M6: prediction clipped at 0, as ``yhat``."""
    return model.transform(df).withColumn("yhat", clip_at_zero("prediction")).drop("features", "prediction")


def fit_leaf_quantiles(train: DataFrame, feature_cols: list[str], target: str = "sales",
                       quantiles=QUANTILES, max_depth: int = 8, min_rows: int = 24, seed: int = 42):
    """M5: a regression tree and the target's quantiles in each of its leaves."""
    tree = DecisionTreeRegressor(featuresCol="features", labelCol=target, leafCol="leaf",
                                 maxDepth=max_depth, minInstancesPerNode=min_rows, maxBins=64, seed=seed)
    data = train.withColumn(target, F.col(target).cast("double"))
    model = Pipeline(stages=[_assembler(feature_cols), tree]).fit(data)
    q = F.percentile_approx(F.col(target), list(quantiles), 10000)
    leaves = (model.transform(data).groupBy("leaf").agg(q.alias("_q"))
                   .select("leaf", *[F.col("_q")[i].alias(f"q{int(round(qq * 100))}") for i, qq in enumerate(quantiles)]))
    return model, leaves


def predict_quantiles(model: PipelineModel, leaves: DataFrame, df: DataFrame) -> DataFrame:
    """Quantile columns for each scored row (broadcast of at most 2^maxDepth leaves);
    sorted per row so that q10 <= q50 <= q90 always holds."""
    out = model.transform(df).drop("features", "prediction").join(F.broadcast(leaves), "leaf", "left")
    qs = [c for c in leaves.columns if c.startswith("q")]
    arr = F.array_sort(F.array(*[F.col(c) for c in qs]))
    return out.withColumns({c: clip_at_zero(arr[i]) for i, c in enumerate(qs)}).drop("leaf")


def feature_importance(model: PipelineModel, feature_cols: list[str], spark: SparkSession,
                       top: int | None = None) -> DataFrame:
    """M7 + T3 + T4: impurity-gain importance per feature, its share of the shown rows in
    percent, and a readable label (one row per feature; a handful of driver-side
    numbers from the fitted model)."""
    imp = model.stages[-1].featureImportances.toArray()
    df = spark.createDataFrame([(f, float(v)) for f, v in zip(feature_cols, imp)], "feature string, importance double")
    df = df.orderBy(F.col("importance").desc(), "feature")
    if top:
        df = df.limit(top)
    total = df.agg(F.sum("importance").alias("_t")).withColumn("_k", F.lit(1))
    return (df.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k")
              .select("feature", title_label("feature").alias("label"), "importance",
                      (F.try_divide(F.col("importance"), F.col("_t")) * 100).alias("share_pct")))


def save_model(model: PipelineModel, path: str) -> None:
    """S10."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def sample_params(rng: random.Random) -> dict:
    """One draw of the search space."""
    out = {}
    for name, (lo, hi, kind) in SEARCH_SPACE.items():
        if kind == "log":
            out[name] = math.exp(rng.uniform(math.log(lo), math.log(hi)))
        elif kind == "int":
            out[name] = rng.randint(lo, hi)
        else:
            out[name] = rng.uniform(lo, hi)
    frac = out.pop("featureSubsetFraction")
    out["featureSubsetStrategy"] = f"{frac:.4f}"
    return out


def random_search(train: DataFrame, val: DataFrame, feature_cols: list[str], score_fn, n_trials: int = 50,
                  seed: int = 42, base: dict | None = None, spark: SparkSession | None = None,
                  at_once: int = 4) -> DataFrame:
    """M8 + T8: ``n_trials`` seeded draws; each fits M4 on ``train`` (early stopping on
    ``val``) and is scored by ``score_fn(model) -> float`` (validation MASE).  Returns the
    trial table; ``best_trials`` sorts it.  ``at_once`` trials submit their jobs together."""
    rng = random.Random(seed)

    def trial(i: int, params: dict) -> tuple:
        model = fit_point_model(train, feature_cols, val=val, params=params)
        return (i, float(score_fn(model)), params["stepSize"], int(params["maxDepth"]),
                params["subsamplingRate"], params["featureSubsetStrategy"], int(params["minInstancesPerNode"]))

    draws = [{**(base or {}), **sample_params(rng)} for _ in range(n_trials)]
    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(trial, range(n_trials), draws))
    spark = spark or train.sparkSession
    return spark.createDataFrame(rows, "trial int, value double, stepSize double, maxDepth int, "
                                       "subsamplingRate double, featureSubsetStrategy string, minInstancesPerNode int")


def best_trials(trials: DataFrame, n: int = 5) -> DataFrame:
    return trials.orderBy("value", "trial").limit(n)


def search_draws(n_trials: int = 50, seed: int = 42) -> list[dict]:
    """``n_trials`` seeded draws, with the parameters of ``operators.boosting``."""
    rng = random.Random(seed)
    draws = [sample_params(rng) for _ in range(n_trials)]
    for d in draws:
        d["featureSubsetFraction"] = float(d.pop("featureSubsetStrategy"))
    return draws


def halving_search(train: DataFrame, val: DataFrame, feature_cols: list[str], scale: float, n_trials: int = 50,
                   seed: int = 42, **kwargs) -> DataFrame:
    """M8 + T8 by successive halving: every draw is fitted for a few rounds, the best third
    goes on.  One row per draw with its validation MASE (mean absolute error over ``scale``)
    and the rounds it got; ``best_halving_trials`` ranks it."""
    rows = boosting.training_rows(train, val, feature_cols)
    found = boosting.successive_halving(rows, feature_cols, search_draws(n_trials, seed), scale, seed=seed, **kwargs)
    fields = "trial int, value double, rounds int, stepSize double, maxDepth int, subsamplingRate double, featureSubsetFraction double, minInstancesPerNode int"
    names = [f.split()[0] for f in fields.split(", ")]
    return train.sparkSession.createDataFrame([tuple(r[n] for n in names) for r in found], fields)


def best_halving_trials(trials: DataFrame, n: int = 5) -> DataFrame:
    """Trials that were kept longest come first, then the lower value."""
    return trials.orderBy(F.col("rounds").desc(), "value", "trial").limit(n)
