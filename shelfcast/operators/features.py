"""Feature matrix.

All per-series windows share one spec ``partition by id order by date``; on a panel that
is already hash-partitioned by ``id`` (``build_panel``) Catalyst adds no exchange and one
sort for all of them.  The department-day mean price and the three encodings are small
aggregates joined back by broadcast after a row-count check, so the panel itself is
shuffled at most once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions import calendar as cal_fn
from shelfcast.functions import events as ev_fn
from shelfcast.functions.numeric import PRICE_EPS, guarded_ratio, log1p_or_zero
from shelfcast.plans.panel import series_window
from shelfcast.sources.sinks import materialize
from shelfcast.sources.tables import sized_broadcast

# ---- fixed values (feature definitions that must equal the reference's) -------------
LAG_DAYS = [7, 14, 21, 28, 56]
ROLLING_WINDOWS = [7, 28, 56]
BURN_IN_DAYS = 56
# Columns never used as model inputs (ids, target, raw strings, raw flags, stockout).
EXCLUDED_COLUMNS = {
    "id", "item_id", "dept_id", "cat_id", "store_id", "state_id",
    "sales", "date", "d", "wm_yr_wk", "weekday",
    "event_name_1", "event_name_2", "event_type_1", "event_type_2",
    "snap_CA", "snap_TX", "snap_WI", "is_stockout",
}
# ---------------------------------------------------------------------------------------

ENCODING_LEVELS = {
    "item_store_enc": ["item_id", "store_id"],
    "dept_store_enc": ["dept_id", "store_id"],
    "cat_store_enc": ["cat_id", "store_id"],
}


def add_lag_features(df: DataFrame, lags=LAG_DAYS, col: str = "sales", min_lag: int = 1) -> DataFrame:
    """``sales_lag_k`` = value k rows earlier in the same series.  ``min_lag`` leaves out
    lags that are not known that many days ahead."""
    w = series_window()
    return df.withColumns({f"{col}_lag_{k}": F.lag(col, k).over(w) for k in lags if k >= min_lag})


def add_rolling_features(df: DataFrame, windows=ROLLING_WINDOWS, col: str = "sales", min_lag: int = 1) -> DataFrame:
    """Trailing mean and sample std over the k rows before today (today excluded);
    std is 0 where fewer than two values exist.  With ``min_lag`` the k rows end that many
    days before today, and the names say so."""
    w = series_window()
    out = {}
    ahead = "" if min_lag == 1 else f"_from_{min_lag}"
    for k in windows:
        frame = w.rowsBetween(1 - k - min_lag, -min_lag)
        out[f"{col}_roll_mean_{k}{ahead}"] = F.avg(col).over(frame)
        out[f"{col}_roll_std_{k}{ahead}"] = F.coalesce(F.stddev_samp(col).over(frame), F.lit(0.0))
    return df.withColumns(out)


def add_calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """F1-F5 (month and year are recomputed from the date, as the reference does)."""
    d = F.col(date)
    dow = cal_fn.day_of_week(d)
    month = F.month(d)
    return df.withColumns({
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(d),
        "month": month,
        "year": F.year(d),
        "is_weekend": cal_fn.is_weekend(d),
        "is_month_start": cal_fn.is_month_start(d),
        "is_month_end": cal_fn.is_month_end(d),
        "dow_sin": cal_fn.cyclic_sin(dow, 7),
        "dow_cos": cal_fn.cyclic_cos(dow, 7),
        "month_sin": cal_fn.cyclic_sin(month, 12),
        "month_cos": cal_fn.cyclic_cos(month, 12),
    })


def add_event_features(df: DataFrame) -> DataFrame:
    """F6/F7."""
    return df.withColumns({
        "has_event": ev_fn.has_event("event_name_1"),
        "has_two_events": ev_fn.has_event("event_name_2"),
        "event_type_1_enc": ev_fn.event_type_code("event_type_1"),
        "event_type_2_enc": ev_fn.event_type_code("event_type_2"),
    })


def add_benefit_flag(df: DataFrame) -> DataFrame:
    """F8: the benefit-day flag of the series' own state."""
    return df.withColumn("is_snap_day", ev_fn.own_state_flag("state_id"))


def department_day_price(df: DataFrame) -> DataFrame:
    """Mean listed price per (store, dept, day) — within a store (trap D2)."""
    return (df.groupBy("store_id", "dept_id", "date")
              .agg(F.avg("sell_price").alias("_dept_mean")))


def add_price_features(df: DataFrame, source: DataFrame | None = None,
                       dept_means: DataFrame | None = None) -> DataFrame:
    """F9, W5, W6.

    The department mean is a (store x dept x day) aggregate (``dept_means``, or computed
    from ``source`` / ``df``): far smaller than the panel, broadcast only after a row-count
    check, otherwise joined by shuffle.
    """
    if dept_means is not None:
        dept = sized_broadcast(dept_means)
    else:
        dept = sized_broadcast(department_day_price(source if source is not None else df), derived=True)
    w = series_window()
    prev_week = F.lag("sell_price", 7).over(w)
    df = df.withColumns({
        "log_price": log1p_or_zero("sell_price"),
        "price_momentum": guarded_ratio(F.col("sell_price") - prev_week, prev_week, PRICE_EPS),
    })
    df = df.join(dept, ["store_id", "dept_id", "date"], "left")
    return (df.withColumn("price_vs_dept_mean", guarded_ratio("sell_price", "_dept_mean", PRICE_EPS))
              .drop("_dept_mean"))


def target_encoding_stats(df: DataFrame, until=None) -> dict[str, DataFrame]:
    """Mean sales per (item, store), (dept, store), (cat, store).

    One GROUPING SETS aggregate computes all three levels in a single scan of the panel
    (partial aggregation before the shuffle); each level is a filter of it.  ``until``
    (a date or Column) restricts the rows to the training span; ``None`` uses every date,
    test days included, which is what the reference does (trap D3).
    """
    src = df if until is None else df.filter(F.col("date") <= (until if isinstance(until, Column) else F.lit(until).cast("date")))
    keys = ["item_id", "dept_id", "cat_id", "store_id"]
    sets = [ENCODING_LEVELS[name] for name in ENCODING_LEVELS]
    # checkpointed (one row per key of each level): the three levels and their size checks read
    # one computation of it; a cache is not found again by the joins of the levels
    allstats = materialize(src.groupingSets(sets, *keys)
                              .agg(F.avg("sales").alias("enc"), F.grouping_id().alias("_gid")))
    out = {}
    for name, level_keys in ENCODING_LEVELS.items():
        gid = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in level_keys)
        out[name] = allstats.filter(F.col("_gid") == gid).select(*level_keys, F.col("enc").alias(name))
    return out


def apply_target_encoding(df: DataFrame, stats: dict[str, DataFrame]) -> DataFrame:
    """Three left joins; unseen keys give NULL.  Each table has one row per key of its
    level (bounded by the series count), broadcast after the row-count check."""
    for name, keys in ENCODING_LEVELS.items():
        df = df.join(sized_broadcast(stats[name]), keys, "left")
    return df


def feature_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are not ids, target or raw inputs."""
    return [f.name for f in df.schema.fields
            if f.name not in EXCLUDED_COLUMNS and isinstance(f.dataType, T.NumericType)]


def panel_statistics(panel: DataFrame, until=None) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Department-day mean price (J3) and the three encodings (A19) in one pass over the
    panel: a single checkpointed GROUPING SETS aggregate; the encodings average only the rows up
    to ``until`` (all rows when ``None``), the department mean uses every day."""
    keys = ["item_id", "dept_id", "cat_id", "store_id", "date"]
    dept_keys = ["store_id", "dept_id", "date"]
    sets = [ENCODING_LEVELS[name] for name in ENCODING_LEVELS] + [dept_keys]
    cut = None if until is None else (until if isinstance(until, Column) else F.lit(until).cast("date"))
    enc_sales = F.col("sales") if cut is None else F.when(F.col("date") <= cut, F.col("sales"))
    allstats = materialize(panel.groupingSets(sets, *keys)
                                .agg(F.avg(enc_sales).alias("enc"), F.avg("sell_price").alias("_dept_mean"),
                                     F.grouping_id().alias("_gid")))

    def gid(level_keys):
        return sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in level_keys)

    stats = {name: allstats.filter(F.col("_gid") == gid(level_keys)).select(*level_keys, F.col("enc").alias(name))
             for name, level_keys in ENCODING_LEVELS.items()}
    dept = allstats.filter(F.col("_gid") == gid(dept_keys)).select(*dept_keys, "_dept_mean")
    return dept, stats


def build_features(panel: DataFrame, stats: dict[str, DataFrame] | None = None, until=None,
                   min_date=None, is_train: bool = True, min_lag: int = 1) -> DataFrame:
    """Feature matrix: the seven feature groups, burn-in (P5) and longest-lag filter.

    ``stats`` are reused encodings (inference); when absent they are computed from the
    panel up to ``until``, in the same pass as the department-day mean price.  With
    ``min_lag`` = the horizon no feature uses sales of the horizon's own days, so one model
    forecasts all of them directly.
    """
    dept, own_stats = panel_statistics(panel, until)
    stats = stats or own_stats
    df = add_lag_features(panel, min_lag=min_lag)
    df = add_rolling_features(df, min_lag=min_lag)
    df = add_calendar_features(df)
    df = add_event_features(df)
    df = add_benefit_flag(df)
    df = add_price_features(df, dept_means=dept)
    df = apply_target_encoding(df, stats)
    if is_train and min_date is not None:
        df = df.filter(F.col("date") >= F.lit(min_date).cast("date"))
    return df.dropna(subset=[f"sales_lag_{max(LAG_DAYS)}"])


def burn_in_start(first_date: Column, days: int = BURN_IN_DAYS) -> Column:
    return F.date_add(first_date, days)
