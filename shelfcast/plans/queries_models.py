"""Registered model queries (M2-M9, E5, E7, T3, T4, T8).  Learned models have no SQL
oracle: the driver records a rows-only check, and tests/ hold property checks
(non-negative forecasts, q10 <= q50 <= q90, one row per series x horizon)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from shelfcast.functions.numeric import SCALE_EPS
from shelfcast.operators import boosting
from shelfcast.operators import features as feat
from shelfcast.operators import forecast as fcst
from shelfcast.operators import metrics as met
from shelfcast.operators import models as mdl
from shelfcast.operators.rollout import roll_out
from shelfcast.operators.sarima import MIN_POINTS, sarima_forecast
from shelfcast.operators import sequences as seqs
from shelfcast.operators.sequences import sequence_windows
from shelfcast.plans.catalog import register, rounded
from shelfcast.plans.oracle_sql import panel_ctes, with_panel
from shelfcast.plans.queries_core import CUT_CTE, H, NAIVE_CTES, _feature_sql, cutoffs, naive_scored, panel_of, q_features
from shelfcast.sources import sinks
from shelfcast.sources.sinks import materialize


def _model_data(spark, sf_dir):
    panel = panel_of(spark, sf_dir)
    cut = cutoffs(spark, sf_dir, panel)
    features = materialize(mdl.model_frame(feat.build_features(panel, until=cut["train_end"])))
    cols = feat.feature_columns(features)
    d = F.col("date")
    train = features.filter(d <= cut["train_end"])
    val = features.filter((d > cut["train_end"]) & (d <= cut["val_end"]))
    test = features.filter(d > cut["val_end"])
    history = panel.filter(d <= cut["val_end"]).select("id", "date", "sales", "store_id", "cat_id")
    return panel, features, cols, train, val, test, history, cut


def _gbt(spark, sf_dir, params=None):
    panel, features, cols, train, val, test, history, cut = _model_data(spark, sf_dir)
    model = mdl.fit_point_model(train, cols, val=val, params=params)
    return model, cols, train, val, test, history, panel


@register("gbt_forecast", None)
def q_gbt_forecast(spark, sf_dir):
    """M4 + M6: global boosted-tree forecast of the test span, clipped at 0."""
    model, _, _, _, test, _, _ = _gbt(spark, sf_dir)
    out = mdl.predict_point(model, test)
    return rounded(out.select("id", "date", F.col("sales").cast("double").alias("actual"), "yhat"))


ROUNDS, PATIENCE = 24, 6


def _quantile_scored(spark, sf_dir):
    panel, _, cols, train, val, test, history, _ = _model_data(spark, sf_dir)
    rows = boosting.training_rows(train, val, cols)
    fitted = boosting.fit_quantiles(rows, cols, mdl.QUANTILES, rounds=ROUNDS, patience=PATIENCE)
    scored = boosting.predict_quantiles(boosting.predict(test, fitted[0.5]), fitted)
    return scored.select("id", "date", "store_id", "cat_id", F.col("sales").cast("double").alias("actual"),
                         "yhat", "q10", "q50", "q90"), history, fitted


@register("gbt_quantiles", None)
def q_gbt_quantiles(spark, sf_dir):
    """M5: P10 / P50 / P90 boosted under the pinball loss, ordered per row; ``yhat`` is the
    median model's forecast."""
    scored, _, _ = _quantile_scored(spark, sf_dir)
    return rounded(scored)


@register("gbt_quantile_checks", with_panel(f"""
SELECT p.store_id, count(*) AS n_rows, count(*) AS n_ordered, count(*) AS n_not_negative, round(avg(CAST(p.sales AS DOUBLE)), 6) AS mean_actual,
       true AS falls_10, true AS falls_50, true AS falls_90
FROM panel p, cut c WHERE p.date > c.val_end GROUP BY p.store_id""", extra_ctes=CUT_CTE))
def q_gbt_quantile_checks(spark, sf_dir):
    """M5 properties per store: every test row has a forecast, P10 <= P50 <= P90, none below
    0, and the rounds lowered the validation loss of each quantile."""
    scored, _, fitted = _quantile_scored(spark, sf_dir)
    falls = {q: bool(e.trees) and e.losses[-1] < e.losses[0] for q, e in fitted.items()}
    return rounded(scored.groupBy("store_id").agg(
        F.count("*").alias("n_rows"), F.count_if((F.col("q10") <= F.col("q50")) & (F.col("q50") <= F.col("q90"))).alias("n_ordered"),
        F.count_if((F.col("yhat") >= 0) & (F.col("q10") >= 0)).alias("n_not_negative"), F.avg("actual").alias("mean_actual"),
        *[F.lit(falls[q]).alias(f"falls_{int(round(q * 100))}") for q in mdl.QUANTILES]))


@register("gbt_evaluation", None)
def q_gbt_eval(spark, sf_dir):
    """E5 with coverage + E8 pinball losses of the quantile bands, per store."""
    scored, history, _ = _quantile_scored(spark, sf_dir)
    return rounded(met.evaluate(scored, history, "boosted_trees", by="store_id",
                                quantiles={f"q{int(q * 100)}": q for q in mdl.QUANTILES}))


@register("gbt_feature_importance", None)
def q_gbt_importance(spark, sf_dir):
    """M7 + T3 + T4: top 15 features by impurity gain with their share of the shown rows."""
    model, cols, *_ = _gbt(spark, sf_dir)
    return rounded(mdl.feature_importance(model, cols, spark, top=15))


def _tuning(spark, sf_dir):
    panel, _, cols, train, val, _, _, cut = _model_data(spark, sf_dir)
    past = panel.filter(F.col("date") <= cut["train_end"]).select("id", "date", "sales")
    scale = met.seasonal_scale(past).first()["naive_mae"]  # the MASE denominator, once for all trials
    return mdl.halving_search(train, val, cols, scale + SCALE_EPS), scale


@register("tuning_trials", None)
def q_tuning(spark, sf_dir):
    """M8 + T8: 50 seeded draws, successive halving by validation MASE; best first."""
    trials, _ = _tuning(spark, sf_dir)
    return rounded(mdl.best_halving_trials(trials, 5))


@register("tuning_checks", with_panel("""
SELECT 50 AS n_trials, 5 AS n_best, true AS is_sorted, true AS best_of_all, '1:50 3:17 9:6 27:2' AS rungs,
       round(avg(e), 6) AS naive_mae
FROM (SELECT abs(p.sales - lag(p.sales, 7) OVER (PARTITION BY p.id ORDER BY p.date)) AS e FROM panel p, cut c WHERE p.date <= c.train_end)
""", extra_ctes=CUT_CTE))
def q_tuning_checks(spark, sf_dir):
    """M8 + T8 properties: all draws were tried, the shown five are sorted and hold the best
    of the last rung, a third went on from each rung, and the scale of the MASE."""
    trials, scale = _tuning(spark, sf_dir)
    every = trials.collect()  # one row per draw
    best = mdl.best_halving_trials(trials, 5).collect()
    order = [(-r["rounds"], r["value"]) for r in best]
    steps = sorted({r["rounds"] for r in every})
    rungs = " ".join(f"{s}:{sum(r['rounds'] >= s for r in every)}" for s in steps)
    last = min(r["value"] for r in every if r["rounds"] == steps[-1])
    return rounded(spark.createDataFrame([(len(every), len(best), order == sorted(order), best[0]["value"] == last, rungs, float(scale))],
                                         "n_trials int, n_best int, is_sorted boolean, best_of_all boolean, rungs string, naive_mae double"))


def _sarima(spark, sf_dir, auto=False):
    panel = panel_of(spark, sf_dir)
    cut = cutoffs(spark, sf_dir, panel)
    history = panel.filter(F.col("date") <= cut["val_end"])
    fc, failed = sarima_forecast(history, cut["val_end"], H, auto=auto)
    return panel, history, fc, failed


@register("sarima_forecast", None)
def q_sarima(spark, sf_dir):
    """M2 + P11 + F11: SARIMA(1,0,1)(1,1,0)[7]-style forecast of every series; a series that
    cannot be fitted is a row with ``error``."""
    _, _, fc, failed = _sarima(spark, sf_dir)
    return rounded(fc.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True))


@register("sarima_status", with_panel(f"""
SELECT id, CASE WHEN n < {MIN_POINTS} THEN 'series too short for the fit' ELSE '' END AS error,
       CASE WHEN n < {MIN_POINTS} THEN 0 ELSE {H} END AS n_steps, CASE WHEN n < {MIN_POINTS} THEN 0 ELSE 1 END AS first_step,
       CASE WHEN n < {MIN_POINTS} THEN 0 ELSE {H} END AS last_step, 0 AS n_negative
FROM (SELECT p.id, count(*) - 7 AS n FROM panel p, cut c
      WHERE p.date <= c.val_end AND (p.item_id <> 'SMALL' OR p.date > c.val_end - 60) GROUP BY p.id)""", extra_ctes=CUT_CTE))
def q_sarima_status(spark, sf_dir):
    """M2 per series: the steps forecast, and why a series has none.  The small items have
    their last 60 days only, too few for a fit."""
    panel = panel_of(spark, sf_dir)
    cut = cutoffs(spark, sf_dir, panel)
    d = F.col("date")
    history = panel.filter((d <= cut["val_end"]) & ((F.col("item_id") != "SMALL") | (d > F.date_sub(cut["val_end"], 60))))
    fc, failed = sarima_forecast(history, cut["val_end"], H)
    steps = fc.groupBy("id").agg(F.count("*").alias("n_steps"), F.min("h").alias("first_step"), F.max("h").alias("last_step"),
                                 F.count_if(F.col("yhat") < 0).alias("n_negative"))
    every = steps.unionByName(failed, allowMissingColumns=True)
    return every.select("id", F.coalesce("error", F.lit("")).alias("error"),
                        *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in ("n_steps", "first_step", "last_step", "n_negative")])


@register("sarima_auto_orders", None)
def q_sarima_auto(spark, sf_dir):
    """M3: per-series order (p <= 3, q <= 2) by AIC; one row per series."""
    _, _, fc, _ = _sarima(spark, sf_dir, auto=True)
    return rounded(fc.groupBy("id").agg(F.first("p").alias("p"), F.first("q").alias("q"),
                                        F.first("aic").alias("aic"), F.count("*").alias("n_steps")))


#: Spans of the 28 steps that the models are compared on.
SPANS = [(1, 7), (8, 14), (15, 21), (22, 28), (1, H)]


def _split(features, cut):
    d = F.col("date")
    return features.filter(d <= cut["train_end"]), features.filter((d > cut["train_end"]) & (d <= cut["val_end"]))


def _direct(panel, cut):
    """Trees on features that are known ``H`` days ahead."""
    features = materialize(mdl.model_frame(feat.build_features(panel, until=cut["train_end"], min_lag=H)))
    cols = feat.feature_columns(features)
    model = boosting.boost(boosting.training_rows(*_split(features, cut), cols), cols, rounds=ROUNDS, patience=PATIENCE)
    ahead = features.filter(F.col("date") > cut["val_end"]).withColumn("h", F.datediff("date", cut["val_end"]))
    return boosting.predict(ahead, model).select("id", "h", "date", "yhat")


def _recursive(panel, cut):
    """One-step trees, rolled out over the horizon."""
    features = materialize(mdl.model_frame(feat.build_features(panel, until=cut["train_end"])))
    cols = feat.feature_columns(features)
    model = boosting.boost(boosting.training_rows(*_split(features, cut), cols), cols, rounds=ROUNDS, patience=PATIENCE)
    return roll_out(features, model, cut["val_end"], H)


@register("model_leaderboard", None)
def q_model_board(spark, sf_dir):
    """E7 + T5: seasonal naive, SARIMA, direct and recursive trees on one test span, ranked
    per span of horizon steps; no model sees sales of the test span."""
    panel = panel_of(spark, sf_dir)
    cut = cutoffs(spark, sf_dir, panel)
    history = panel.filter(F.col("date") <= cut["val_end"])
    with ThreadPoolExecutor(2) as pool:  # the two tree fits submit their jobs side by side
        direct, recursive = (pool.submit(f, panel, cut) for f in (_direct, _recursive))
        forecasts = {"seasonal_naive_7": fcst.seasonal_naive(panel, cut["val_end"], H)[0],
                     "sarima": sarima_forecast(history, cut["val_end"], H)[0],
                     "trees_direct": direct.result(), "trees_recursive": recursive.result()}
    scale = materialize(met.seasonal_scale(history))  # the MASE denominator, once for all models
    reports = [met.horizon_scores(fcst.scored_frame(fc.select("id", "h", "date", "yhat"), panel, cut["val_end"], H), history, name, SPANS, scale=scale)
               for name, fc in forecasts.items()]
    return met.horizon_leaderboard(reports)


@register("naive_horizon_leaderboard", with_panel(f"""
SELECT horizon, CAST(row_number() OVER (PARTITION BY horizon ORDER BY MAE, model) AS INTEGER) AS Rank, model,
       round_even(MAE, 4) AS MAE, round_even(MAE / (s.naive_mae + 1e-8), 4) AS MASE
FROM (SELECT model, a || '-' || b AS horizon, avg(abs(actual - yhat)) AS MAE
      FROM (SELECT 'seasonal_naive_7' AS model, h, actual, yhat FROM scored UNION ALL SELECT 'naive_last_value', h, actual, yhat FROM scored1),
           (VALUES {", ".join(f"({a}, {b})" for a, b in SPANS)}) AS v(a, b) WHERE h BETWEEN a AND b GROUP BY 1, 2),
     (SELECT avg(e) AS naive_mae FROM hist_err WHERE e IS NOT NULL) s""", extra_ctes=NAIVE_CTES + f""",
scored1 AS (
  SELECT datediff('day', c.val_end, p.date) AS h, greatest(CAST(f.sales AS DOUBLE), 0.0) AS yhat, CAST(p.sales AS DOUBLE) AS actual
  FROM panel f JOIN panel p ON p.id = f.id, cut c WHERE f.date = c.val_end AND p.date > c.val_end AND p.date <= c.val_end + {H}
)"""))
def q_naive_horizon_board(spark, sf_dir):
    """E7 by horizon: two naive models per span of steps."""
    panel, fc7, _, _, history, cut = naive_scored(spark, sf_dir)
    fc1, _ = fcst.seasonal_naive(panel, cut["val_end"], H, 1)
    scale = materialize(met.seasonal_scale(history))
    return met.horizon_leaderboard([
        met.horizon_scores(fcst.scored_frame(fc, panel, cut["val_end"], H), history, name, SPANS, scale=scale)
        for name, fc in (("seasonal_naive_7", fc7), ("naive_last_value", fc1))])


@register("sequence_windows", None)
def q_sequences(spark, sf_dir):
    """M9 + P10: 56-day encoder / 28-day decoder windows with known inputs and the series
    normaliser."""
    panel = panel_of(spark, sf_dir)
    features = feat.add_benefit_flag(feat.add_event_features(feat.add_calendar_features(panel)))
    return rounded(sequence_windows(features))


@register("sequence_windows_text", "WITH " + panel_ctes() + """,
w AS (
  SELECT id, date, CAST(datediff('day', (SELECT min(date) FROM panel), date) AS INTEGER) AS time_idx,
         list(sales) OVER (PARTITION BY id ORDER BY date ROWS BETWEEN 55 PRECEDING AND CURRENT ROW) AS enc,
         list(sales) OVER (PARTITION BY id ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 28 FOLLOWING) AS dec,
         avg(CAST(sales AS DOUBLE)) OVER (PARTITION BY id) AS m,
         coalesce(stddev_samp(CAST(sales AS DOUBLE)) OVER (PARTITION BY id), 0.0) AS sd
  FROM panel
)
SELECT id, date, time_idx, array_to_string(enc, ',') AS encoder_target, array_to_string(dec, ',') AS decoder_target,
       round(m, 6) AS target_mean, round(sd, 6) AS target_std
FROM w WHERE len(enc) = 56 AND len(dec) = 28""")
def q_sequences_text(spark, sf_dir):
    """M9 windows in text form for the oracle: the 56 encoder and 28 decoder values of
    every full window, comma-joined (whole panel)."""
    panel = panel_of(spark, sf_dir)
    seq = sequence_windows(panel, known=[], static=[])
    as_text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), ",")
    return rounded(seq.select("id", "date", "time_idx", as_text(F.col("encoder_target")).alias("encoder_target"),
                              as_text(F.col("decoder_target")).alias("decoder_target"), "target_mean", "target_std"))


def _window_sums_sql() -> str:
    inputs = seqs.KNOWN_AHEAD + seqs.PAST_ONLY
    micros = lambda c, w: f"CAST(coalesce(sum(CAST(round({c} * 1000000) AS BIGINT)) OVER {w}, 0) AS BIGINT)"
    sums = [f"{micros(c, 'e')} AS encoder_{c}" for c in inputs] + [f"{micros(c, 'd')} AS decoder_{c}" for c in seqs.KNOWN_AHEAD]
    statics = ", ".join(seqs.STATIC_GROUPS + [f"round(first({c}) OVER (PARTITION BY id ORDER BY date), 4) AS {c}" for c in seqs.STATIC_NUMBERS])
    return f"""SELECT * EXCLUDE (n_e, n_d) FROM (
SELECT id, {statics}, date, CAST(datediff('day', min(date) OVER (), date) AS INTEGER) AS time_idx,
       round(avg(CAST(sales AS DOUBLE)) OVER (PARTITION BY id), 4) AS target_mean,
       round(coalesce(stddev_samp(CAST(sales AS DOUBLE)) OVER (PARTITION BY id), 0), 4) AS target_std,
       {", ".join(sums)}, {micros("sales", "d")} AS decoder_target,
       count(*) OVER e AS n_e, count(*) OVER d AS n_d
FROM ({_feature_sql()})
WINDOW e AS (PARTITION BY id ORDER BY date ROWS BETWEEN 55 PRECEDING AND CURRENT ROW),
       d AS (PARTITION BY id ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 28 FOLLOWING)
) WHERE n_e = 56 AND n_d = 28"""


@register("sequence_windows_on_read", _window_sums_sql())
def q_windows_on_read(spark, sf_dir):
    """M9: all known, past-only and static inputs of every window of the feature matrix, cut
    from one stored row per series; for the oracle arrays are summed, in whole millionths."""
    path = sinks.scratch_path(spark, "series")
    seqs.series_arrays(q_features(spark, sf_dir)).write.parquet(path)
    stored = spark.read.parquet(path)
    micros = lambda c: F.transform(c, lambda x: F.coalesce(F.round(x * 1_000_000).cast("long"), F.lit(0).cast("long")))
    out = seqs.windows_on_read(stored.withColumns({c: micros(c) for c in stored.columns if c.startswith("x_")}))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x).alias(c)
    return rounded(out.select(*[total(c) if c.startswith(("encoder_", "decoder_")) else F.col(c) for c in out.columns]), 4)
