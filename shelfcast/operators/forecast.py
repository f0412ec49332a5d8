"""Forecasting helpers and the seasonal naive model.

Forecasts are long: one row per (id, h) with ``date`` and ``yhat``; ``forecast_wide``
pivots to ``F1..Fh`` only for export.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import clip_at_zero

HORIZON = 28
SEASON = 7
# ---- fixed values (dashboard band) ----
EWM_SPAN = 7            # pandas ewm(span=7): alpha = 2 / (span + 1), adjusted weights
BAND_Z = 1.28           # ~80% normal band
DISPLAY_DAYS = 28
# ---------------------------------------


def _date(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x).cast("date")


# ---- splits -------------------------------------------------------------------------------

def split_dates(last_day, horizon: int = HORIZON) -> dict[str, Column]:
    """Three-way split ending at ``last_day``: test = last ``horizon`` days, validation =
    the ``horizon`` days before, train = everything up to that."""
    hi = _date(last_day)
    return {"train_end": F.date_sub(hi, 2 * horizon), "val_end": F.date_sub(hi, horizon), "last_day": hi}


def assign_split(df: DataFrame, train_end, val_end) -> DataFrame:
    """``split`` column = train / val / test by date."""
    d = F.col("date")
    return df.withColumn("split", F.when(d <= _date(train_end), "train")
                                   .when(d <= _date(val_end), "val").otherwise("test"))


def day_number(d_col: str = "d") -> Column:
    """``d_123`` -> 123."""
    return F.substring(F.col(d_col), 3, 10).cast("int")


def split_by_day(df: DataFrame, cutoff_day: str | Column, horizon: int = HORIZON) -> tuple[DataFrame, DataFrame]:
    """train = days up to ``cutoff_day`` (a ``d_N`` label, or a column with the number),
    test = the next ``horizon``."""
    n = cutoff_day if isinstance(cutoff_day, Column) else int(cutoff_day.split("_")[1])
    dn = day_number()
    return df.filter(dn <= n), df.filter((dn > n) & (dn <= n + horizon))


def check_horizon(test: DataFrame, horizon: int = HORIZON) -> int:
    """Raise if the test span has fewer than ``horizon`` distinct days (one small action)."""
    n = test.select("d").distinct().count()
    if n < horizon:
        raise ValueError(f"test span has {n} days, fewer than the horizon {horizon}")
    return n


# ---- seasonal naive -----------------------------------------------------------------------

def last_season(panel: DataFrame, cutoff, season: int = SEASON) -> DataFrame:
    """The last ``season`` training rows of each series, with their phase 0..season-1
    (0 = oldest).  The panel is dense, so these are the days (cutoff-season, cutoff]: a
    filter, not a sort of the whole history."""
    cut = _date(cutoff)
    return (panel.filter((F.col("date") > F.date_sub(cut, season)) & (F.col("date") <= cut))
                 .select("id", "date", "sales",
                         (F.datediff(F.col("date"), cut) + F.lit(season - 1)).alias("phase")))


def seasonal_naive(panel: DataFrame, cutoff, horizon: int = HORIZON, season: int = SEASON):
    """M1: tile each series' last season over the horizon, clipped at 0.

    Returns ``(forecasts, failed)``: forecasts (id, h, date, yhat) for every series with a
    full season; failed (id, n_days, error) for every other series with a past, also one that
    ended before the last season (n_days 0).  Each of
    the ``season`` rows emits its own horizon steps h = phase+1, phase+1+season, ...:
    no join, no per-series loop.
    """
    cut = _date(cutoff)
    past = panel.filter(F.col("date") <= cut)
    last = last_season(panel, cut, season).withColumn("n_days", F.count("*").over(Window.partitionBy("id")))
    ok = last.filter(F.col("n_days") == season)
    steps = F.when(F.col("phase") + 1 <= horizon, F.sequence(F.col("phase") + 1, F.lit(horizon), F.lit(season)))
    fc = (ok.select("id", F.explode(steps).alias("h"), clip_at_zero(F.col("sales").cast("double")).alias("yhat"))
            .withColumn("date", F.date_add(cut, F.col("h")))
            .select("id", "h", "date", "yhat"))
    recent = F.count_if(F.col("date") > F.date_sub(cut, season))
    failed = (past.groupBy("id").agg(recent.alias("n_days")).filter(F.col("n_days") < season)
                  .withColumn("error", F.lit(f"not all of the last {season} days are present")))
    return fc, failed


def forecast_wide(fc: DataFrame, horizon: int = HORIZON, value: str = "yhat") -> DataFrame:
    """Long (id, h, yhat) -> one row per id with ``F1..Fh`` (pivot values listed, so no
    extra distinct job)."""
    wide = fc.groupBy("id").pivot("h", list(range(1, horizon + 1))).agg(F.first(value))
    return wide.select("id", *[F.col(str(h)).alias(f"F{h}") for h in range(1, horizon + 1)])


def scored_frame(fc: DataFrame, panel: DataFrame, cutoff=None, horizon: int | None = None) -> DataFrame:
    """Forecast rows with the actual sales of the same (id, date) and the series' groups.

    With ``cutoff``/``horizon`` the panel is first restricted to the forecast days, so only
    series x horizon rows take part in the join instead of the whole history.
    """
    src = panel
    if cutoff is not None and horizon is not None:
        cut = _date(cutoff)
        src = panel.filter((F.col("date") > cut) & (F.col("date") <= F.date_add(cut, horizon)))
    actual = src.select("id", "date", F.col("sales").cast("double").alias("actual"),
                        "store_id", "cat_id", "dept_id", "state_id", "item_id")
    return fc.join(actual, ["id", "date"])


def mean_forecast_by_horizon(fc: DataFrame, panel_series: DataFrame, by: str = "store_id") -> DataFrame:
    """Mean over the series of a group of each horizon step's forecast."""
    return (fc.join(panel_series.select("id", by).distinct(), "id")
              .groupBy(by, "h").agg(F.avg("yhat").alias("mean_yhat")))


# ---- dashboard display band ---------------------------------------------------------------

def store_day_panel(panel: DataFrame, by: str = "store_id") -> DataFrame:
    """Total, mean, std and count of sales per (day, store)."""
    return (panel.groupBy("date", by)
                 .agg(F.sum("sales").cast("long").alias("total_sales"),
                      F.avg("sales").alias("avg_sales"),
                      F.stddev_samp("sales").alias("std_sales"),
                      F.count("*").alias("n_items")))


def display_band(panel: DataFrame, stores: list[str] | None = None, days: int = DISPLAY_DAYS,
                 span: int = EWM_SPAN, z: float = BAND_Z) -> DataFrame:
    """Per store, the last ``days`` days of total sales, smoothed by an adjusted
    exponential mean (span ``span``), with a band of +-z * mean daily std, rounded
    half-even; the lower bound is clipped at 0.

    The adjusted EWM  sum_j a^(t-j) x_j / sum_j a^(t-j)  is computed as the ratio of two
    running sums of a^(-j) x_j and a^(-j) over the ``days``-row frame (a = 1 - 2/(span+1)),
    so it stays a built-in window aggregate; ``days`` is small, so a^(-j) stays finite.
    """
    a = 1.0 - 2.0 / (span + 1.0)
    src = panel if not stores else panel.filter(F.col("store_id").isin(stores))
    daily = store_day_panel(src)
    recent = (daily.withColumn("rn", F.row_number().over(Window.partitionBy("store_id").orderBy(F.col("date").desc())))
                   .filter(F.col("rn") <= days)
                   .withColumn("j", F.lit(days) - F.col("rn")))  # 0 = oldest of the window
    w = Window.partitionBy("store_id").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    wt = F.pow(F.lit(a), -F.col("j"))
    ewm = F.sum(wt * F.col("total_sales")).over(w) / F.sum(wt).over(w)
    sd = F.avg("std_sales").over(Window.partitionBy("store_id"))
    out = recent.withColumns({"predicted": F.bround(ewm, 0), "_sd": sd})
    return out.select("store_id", "date", F.col("total_sales").alias("actual"), "predicted",
                      F.bround(F.greatest(F.col("predicted") - F.lit(z) * F.col("_sd"), F.lit(0.0)), 0).alias("lower_bound"),
                      F.bround(F.col("predicted") + F.lit(z) * F.col("_sd"), 0).alias("upper_bound"))
