"""Forecast evaluation.

Conventions: a *scored* frame has one row per (series, day) of the evaluation span with
``actual`` and ``yhat`` (and optionally ``q10``/``q90``); a *history* frame is the panel
restricted to the training span (``id``, ``date``, ``sales``).  Every metric is a grouped
aggregate, so ``by`` turns a single number into one row per store, category, model...
The seasonal scale differences within a series only (trap D4): ``lag`` over ``id``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import SCALE_EPS
from shelfcast.plans.panel import series_window

SEASON = 7


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def _agg(df: DataFrame, by, *cols: Column) -> DataFrame:
    keys = _by(by)
    return df.groupBy(*keys).agg(*cols) if keys else df.agg(*cols)


def abs_error(actual="actual", forecast="yhat") -> Column:
    return F.abs(F.col(actual) - F.col(forecast))


def mae(scored: DataFrame, by=None, actual="actual", forecast="yhat") -> DataFrame:
    """Mean |actual - forecast|."""
    return _agg(scored, by, F.avg(abs_error(actual, forecast)).alias("MAE"))


def seasonal_errors(history: DataFrame, season: int = SEASON, col: str = "sales") -> DataFrame:
    """|x_t - x_{t-season}| within each series (the first ``season`` rows have none)."""
    return (history.withColumn("naive_err", F.abs(F.col(col) - F.lag(col, season).over(series_window())))
                   .filter(F.col("naive_err").isNotNull()))


def seasonal_scale(history: DataFrame, by=None, season: int = SEASON) -> DataFrame:
    """Mean in-sample seasonal-naive error per group (the MASE denominator, no epsilon)."""
    return _agg(seasonal_errors(history, season), by, F.avg("naive_err").alias("naive_mae"))


def _keyed(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Ungrouped metrics join on a constant key (one row each side), never a cross join."""
    return (df, keys) if keys else (df.withColumn("_all", F.lit(1)), ["_all"])


def mase(scored: DataFrame, history: DataFrame, by=None, season: int = SEASON,
         actual="actual", forecast="yhat", also: list[Column] = ()) -> DataFrame:
    """MAE / (mean seasonal-naive error on the training span + 1e-8), pooled per group.
    ``also`` are further aggregates of ``scored``, taken in the same pass."""
    keys = _by(by)
    s, k = _keyed(scored, keys)
    h, _ = _keyed(history, keys)
    err = _agg(s, k, F.avg(abs_error(actual, forecast)).alias("MAE"), *also)
    scale = seasonal_scale(h, k, season)
    more = [c for c in err.columns if c not in (*k, "MAE")]
    return (err.join(scale, k)
               .select(*keys, "MAE", (F.col("MAE") / (F.col("naive_mae") + F.lit(SCALE_EPS))).alias("MASE"), *more))


def per_series_metrics(scored: DataFrame, history: DataFrame, season: int = SEASON) -> DataFrame:
    """E6 (first half): MAE and MASE for every series."""
    return mase(scored, history, "id", season)


def mean_of_series_metrics(scored: DataFrame, history: DataFrame, by=None, season: int = SEASON,
                           series_attrs: DataFrame | None = None) -> DataFrame:
    """Mean over series of the per-series MAE and MASE."""
    per = per_series_metrics(scored, history, season)
    keys = _by(by)
    if keys:
        attrs = series_attrs if series_attrs is not None else scored.select("id", *keys).distinct()
        per = per.join(attrs, "id")
    return _agg(per, keys, F.avg("MAE").alias("mean_MAE"), F.avg("MASE").alias("mean_MASE"),
                F.count("*").alias("n_series"))


def _inside(actual="actual", lo="q10", hi="q90") -> Column:
    inside = F.when((F.col(actual) >= F.col(lo)) & (F.col(actual) <= F.col(hi)), 1.0).otherwise(0.0)
    return F.avg(inside).alias("Coverage_80%")


def coverage(scored: DataFrame, by=None, actual="actual", lo="q10", hi="q90") -> DataFrame:
    """Share of actuals inside [lo, hi], inclusive; a missing bound counts as outside."""
    return _agg(scored, by, _inside(actual, lo, hi))


def _pinball(q: float, qcol: str, actual="actual") -> Column:
    e = F.col(actual) - F.col(qcol)
    return F.avg(F.greatest(F.lit(q) * e, F.lit(q - 1.0) * e)).alias(f"pinball_{qcol}")


def pinball_loss(scored: DataFrame, q: float, qcol: str, by=None, actual="actual") -> DataFrame:
    """Mean max(q*e, (q-1)*e), e = actual - quantile forecast."""
    return _agg(scored, by, _pinball(q, qcol, actual))


def wrmsse(scored: DataFrame, history: DataFrame, cutoff, horizon: int = 28,
           weights: DataFrame | None = None, by=None) -> DataFrame:
    """E3 as coded by the reference (trap D6): per series
    scale = mean over i of (last_h[i] - previous_h[i])^2 + 1e-8 on the training span,
    rmsse = sqrt(mean squared error / scale); weight = share of last-h training units
    (or a given ``(id, weight)`` frame); result = sum(weight * rmsse) per group.

    The panel is dense, so the last 2h training rows are the days (cutoff-2h, cutoff];
    block and offset come from the day number, no sort of the full history.
    """
    keys = _by(by)
    cut = cutoff if isinstance(cutoff, Column) else F.lit(cutoff).cast("date")
    start = F.date_sub(cut, 2 * horizon - 1)
    tail = history.filter((F.col("date") >= start) & (F.col("date") <= cut))
    pos = F.datediff(F.col("date"), start)
    last = pos >= horizon
    pairs = (tail.groupBy("id", (pos % horizon).alias("offset"))
                 .agg(F.sum(F.when(last, F.col("sales")).otherwise(-F.col("sales"))).alias("block_diff"),
                      F.sum(F.when(last, F.col("sales")).otherwise(0)).alias("last_units")))
    scale = (pairs.groupBy("id")
                  .agg((F.avg(F.col("block_diff") * F.col("block_diff")) + F.lit(SCALE_EPS)).alias("scale"),
                       F.sum("last_units").cast("double").alias("last_units")))
    err = scored.groupBy("id", *keys).agg(
        F.avg((F.col("actual") - F.col("yhat")) * (F.col("actual") - F.col("yhat"))).alias("mse"))
    per = err.join(scale, "id").withColumn("rmsse", F.sqrt(F.col("mse") / F.col("scale")))
    if weights is None:
        # sum(w_i * r_i) with w_i = u_i / (sum u + eps)  ==  sum(u_i * r_i) / (sum u + eps):
        # one aggregate, no window over all series and no join with the total
        return _agg(per, keys, (F.sum(F.col("last_units") * F.col("rmsse"))
                                / (F.sum("last_units") + F.lit(SCALE_EPS))).alias("WRMSSE"))
    per = per.join(weights.select("id", "weight"), "id")
    return _agg(per, keys, F.sum(F.col("weight") * F.col("rmsse")).alias("WRMSSE"))


def evaluate(scored: DataFrame, history: DataFrame, model_name: str, by=None,
             season: int = SEASON, quantiles: dict[str, float] | None = None) -> DataFrame:
    """E5: one row per model (and group) with MAE, MASE and, when both bounds exist,
    Coverage_80%; with ``quantiles`` (column: level) also their pinball losses (E8).  One
    pass over ``scored``.  WRMSSE is separate, as in the reference (trap D13)."""
    also = [_inside()] if "q10" in scored.columns and "q90" in scored.columns else []
    also += [_pinball(q, c) for c, q in (quantiles or {}).items()]
    res = mase(scored, history, by, season, also=also)
    return res.select(F.lit(model_name).alias("model"), *res.columns)


def horizon_scores(scored: DataFrame, history: DataFrame, model_name: str, spans: list[tuple[int, int]],
                   season: int = SEASON, scale: DataFrame | None = None) -> DataFrame:
    """E7 by horizon: MAE and MASE of the steps first..last of each span (``h`` counts from 1),
    one row per span.  A row is emitted once per span that holds its step; the scale is one
    number, the pooled seasonal error of ``history`` (``scale`` if it is known already)."""
    inside = F.array_compact(F.array(*[F.when(F.col("h").between(a, b), F.lit(f"{a}-{b}")) for a, b in spans]))
    err = (scored.select(F.explode(inside).alias("horizon"), abs_error().alias("_e"))
                 .groupBy("horizon").agg(F.avg("_e").alias("MAE")).withColumn("_all", F.lit(1)))
    scale = seasonal_scale(history, None, season) if scale is None else scale
    return (err.join(F.broadcast(scale.withColumn("_all", F.lit(1))), "_all")
               .select(F.lit(model_name).alias("model"), "horizon", "MAE",
                       (F.col("MAE") / (F.col("naive_mae") + F.lit(SCALE_EPS))).alias("MASE")))


def horizon_leaderboard(reports: list[DataFrame], digits: int = 4) -> DataFrame:
    """U1 + T5 per span: the models of each horizon ranked by MAE."""
    rows = reduce(DataFrame.unionByName, reports)
    rank = F.row_number().over(Window.partitionBy("horizon").orderBy("MAE", "model"))
    return rows.select("horizon", rank.cast("int").alias("Rank"), "model", F.bround("MAE", digits).alias("MAE"),
                       F.bround("MASE", digits).alias("MASE"))


def leaderboard(reports: list[DataFrame], rank_by: str = "MAE", digits: int = 4) -> DataFrame:
    """U1 + T5: union of reports (missing metrics are NULL), rank by ``rank_by`` ascending
    from 1, numeric columns rounded half-even.  One row per model: a single-partition
    window over a handful of rows."""
    allrep = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)
    numeric = [f.name for f in allrep.schema.fields
               if f.dataType.typeName() in ("double", "float") and f.name != "Rank"]
    ranked = allrep.withColumn("Rank", F.row_number().over(Window.orderBy(F.col(rank_by).asc_nulls_last(), "model")))
    return ranked.select("Rank", *[F.bround(c, digits).alias(c) if c in numeric else F.col(c)
                                   for c in allrep.columns])


def best_model(board: DataFrame, metric: str = "MASE") -> DataFrame:
    """Model with the lowest ``metric`` and how far it sits below 1.0, in percent."""
    return board.agg(F.min_by("model", F.col(metric)).alias("best_model"),
                     F.min(metric).alias(f"best_{metric}"),
                     ((F.lit(1.0) - F.min(metric)) * 100).alias("pct_below_naive"))
