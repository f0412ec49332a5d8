"""Exploratory aggregates over the panel.

Each function is a grouped aggregate or window over the whole panel: partial
aggregation before every shuffle, results are small tables.  Per-day totals (A6) are
one row per day, so every later step on them (quantiles, event windows, ACF) works on a
table bounded by the calendar, never by the number of sales rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions import events as ev_fn
from shelfcast.functions.numeric import pct_change
from shelfcast.plans.panel import series_window
from shelfcast.schemas import ID_COLUMNS
from shelfcast.sources.tables import sized_broadcast

# ---- fixed values -----------------------------------------------------------------
INTERMITTENT_ZERO_SHARE = 0.5
TOP_EVENTS = 20
EVENT_WINDOW_DAYS = 7
CORR_LAGS = [1, 7, 14, 21, 28, 56]
QUARTILES = [0.25, 0.5, 0.75]
# -------------------------------------------------------------------------------------


# ---- filters (P8, P9) ----------------------------------------------------------------------

def filter_panel(panel: DataFrame, store: str = "All", category: str = "All",
                 id_contains: str | None = None) -> DataFrame:
    """Dashboard pickers: 'All' means no filter; the category test is a substring test
    (NULL counts as no match); optional id substring test."""
    df = panel
    if id_contains:
        df = df.filter(F.coalesce(F.col("id").contains(id_contains), F.lit(False)))
    if store != "All":
        df = df.filter(F.col("store_id") == store)
    if category != "All":
        df = df.filter(F.coalesce(F.col("cat_id").contains(category), F.lit(False)))
    return df


# ---- profile and counts (A1, A2) ---------------------------------------------------------------

def series_table(panel: DataFrame) -> DataFrame:
    """One row per series with its row count and span (partial aggregation first)."""
    return panel.groupBy(*ID_COLUMNS).agg(F.count("*").alias("n_obs"),
                                         F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def dataset_profile(panel: DataFrame) -> DataFrame:
    """A1: series, distinct items / stores / depts / categories / states, days, rows, span.
    Distinct counts run over the small series table, not over the panel."""
    s = series_table(panel).agg(
        F.count("*").alias("n_series"),
        F.countDistinct("item_id").alias("n_items"), F.countDistinct("store_id").alias("n_stores"),
        F.countDistinct("dept_id").alias("n_depts"), F.countDistinct("cat_id").alias("n_cats"),
        F.countDistinct("state_id").alias("n_states"), F.sum("n_obs").alias("n_obs"),
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        F.lit(1).alias("_k"))
    days = (panel.select("date").distinct().agg(F.count("*").alias("n_days"))
                 .withColumn("_k", F.lit(1)))
    return s.join(days, "_k").drop("_k")


def series_counts(panel: DataFrame) -> DataFrame:
    """A2: series per store, per category and per department in one GROUPING SETS pass."""
    s = panel.select("id", "store_id", "cat_id", "dept_id").distinct()
    g = (s.groupingSets([["store_id"], ["cat_id"], ["dept_id"]], "store_id", "cat_id", "dept_id")
          .agg(F.count("*").alias("n_series"), F.grouping_id().alias("gid")))
    level = (F.when(F.col("gid") == 3, "store_id").when(F.col("gid") == 5, "cat_id").otherwise("dept_id"))
    return g.select(level.alias("level"), F.coalesce("store_id", "cat_id", "dept_id").alias("value"), "n_series")


# ---- zeros (A3-A5) -----------------------------------------------------------------------------

def _is_zero() -> Column:
    return (F.col("sales") == 0).cast("double")


def zero_rate(panel: DataFrame, by=None) -> DataFrame:
    """A3/A4: zero rows and their share in percent (overall or per group)."""
    cols = [F.sum(_is_zero()).cast("long").alias("zero_rows"), F.count("*").alias("n_rows"),
            (F.avg(_is_zero()) * 100).alias("zero_pct")]
    return panel.groupBy(by).agg(*cols) if by else panel.agg(*cols)


def series_zero_rates(panel: DataFrame) -> DataFrame:
    """Per-series share of zero days."""
    return panel.groupBy("id").agg(F.avg(_is_zero()).alias("zero_rate"))


def intermittency(panel: DataFrame, threshold: float = INTERMITTENT_ZERO_SHARE) -> DataFrame:
    """A5: number and share of series with more than ``threshold`` zero days; mean rate."""
    z = series_zero_rates(panel)
    return z.agg(F.sum((F.col("zero_rate") > threshold).cast("int")).alias("n_intermittent"),
                 F.count("*").alias("n_series"),
                 (F.avg((F.col("zero_rate") > threshold).cast("double")) * 100).alias("intermittent_pct"),
                 (F.avg("zero_rate") * 100).alias("mean_zero_pct"))


# ---- daily totals and calendar patterns (A6-A10, J5, J7) ------------------------------------

def daily_totals(panel: DataFrame) -> DataFrame:
    """A6 + J5: total units per day with weekday (0 = Monday), month, year, ISO week and
    the day's events.  Calendar attributes ride along as group keys (they are functions
    of the date), so no join back is needed."""
    keys = ["date", "event_name_1", "event_type_1", "event_name_2", "event_type_2"]
    return (panel.groupBy(*keys).agg(F.sum("sales").cast("long").alias("total_sales"))
                 .withColumns({"dow": F.weekday("date"), "month": F.month("date"),
                               "year": F.year("date"), "week": F.weekofyear("date"),
                               "has_event": F.col("event_name_1").isNotNull()}))


def weekday_box(daily: DataFrame) -> DataFrame:
    """Min, quartiles (linear interpolation) and max of daily totals per weekday."""
    q = F.percentile(F.col("total_sales").cast("double"), QUARTILES)
    return (daily.groupBy("dow")
                 .agg(F.min("total_sales").alias("min"), q.alias("_q"), F.max("total_sales").alias("max"))
                 .select("dow", "min", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                         F.col("_q")[2].alias("q3"), "max"))


def month_mean(daily: DataFrame) -> DataFrame:
    """Mean daily total per calendar month."""
    return daily.groupBy("month").agg(F.avg("total_sales").alias("avg_total_sales"))


def event_describe(daily: DataFrame) -> DataFrame:
    """Count, mean, std, min, quartiles, max of daily totals, event vs non-event days."""
    x = F.col("total_sales").cast("double")
    q = F.percentile(x, QUARTILES)
    return (daily.groupBy("has_event")
                 .agg(F.count("*").alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                      F.min(x).alias("min"), q.alias("_q"), F.max(x).alias("max"))
                 .select("has_event", "count", "mean", "std", "min", F.col("_q")[0].alias("p25"),
                         F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"), "max"))


def event_lift(daily: DataFrame, top: int = TOP_EVENTS) -> DataFrame:
    """A10 + F15: mean total on each event's days relative to the non-event mean, percent,
    largest first (top-k report).  The baseline is a one-row aggregate joined on a
    constant key."""
    base = (daily.filter(~F.col("has_event")).agg(F.avg("total_sales").alias("baseline"))
                 .withColumn("_k", F.lit(1)))
    ev = (daily.filter(F.col("has_event")).groupBy("event_name_1")
               .agg(F.avg("total_sales").alias("event_mean")).withColumn("_k", F.lit(1)))
    out = ev.join(F.broadcast(base), "_k").select(
        "event_name_1", ((F.try_divide(F.col("event_mean"), F.col("baseline")) - 1) * 100).alias("lift_pct"))
    return out.orderBy(F.col("lift_pct").desc(), "event_name_1").limit(top)


def event_window_effect(daily: DataFrame, window: int = EVENT_WINDOW_DAYS) -> DataFrame:
    """For every event, mean daily total at each offset -window..window around its
    dates; days outside the calendar are skipped.  The range condition becomes an equi
    join on ``date + offset`` (explode the offsets on the small event side)."""
    ev = (daily.filter(F.col("event_name_1").isNotNull())
               .select("event_name_1", F.col("date").alias("event_date"),
                       F.explode(F.sequence(F.lit(-window), F.lit(window))).alias("offset"))
               .withColumn("date", F.date_add("event_date", F.col("offset"))))
    return (ev.join(daily.select("date", "total_sales"), "date")
              .groupBy("event_name_1", "offset").agg(F.avg("total_sales").alias("avg_sales"),
                                                     F.count("*").alias("n_days")))


# ---- prices (A11, A12, J6, W7, A20) ----------------------------------------------------------

def prices_with_hierarchy(prices: DataFrame, panel: DataFrame) -> DataFrame:
    """Weekly prices + (dept, cat) of the series; the hierarchy is deduplicated first."""
    hier = panel.select("item_id", "store_id", "dept_id", "cat_id").dropDuplicates()
    return prices.join(hier, ["item_id", "store_id"], "left")


def price_range_by_dept(prices_h: DataFrame) -> DataFrame:
    """Min / mean / max weekly price per department."""
    return prices_h.groupBy("dept_id").agg(F.min("sell_price").alias("min_price"),
                                           F.avg("sell_price").alias("mean_price"),
                                           F.max("sell_price").alias("max_price"))


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """Counts in ``bins`` equal-width bins between the (group's) min and max; the last
    bin is closed on the right.  Bounds are a small aggregate joined back by key."""
    keys = [by] if by else []
    src = df.filter(F.col(col).isNotNull())
    if not keys:
        src = src.withColumn("_k", F.lit(1))
        keys = ["_k"]
    bounds = src.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    x = F.col(col)
    width = F.col("_hi") - F.col("_lo")
    idx = F.coalesce(F.floor(F.try_divide((x - F.col("_lo")) * F.lit(bins), width)), F.lit(0))
    b = F.least(idx, F.lit(bins - 1)).cast("int")
    # one row per group: broadcast after the size check, so a hot group never meets its
    # bounds in a single shuffle task
    out = (src.join(F.broadcast(bounds) if by is None else sized_broadcast(bounds, derived=True), keys)
              .groupBy(*keys, b.alias("bin"))
              .agg(F.count("*").alias("n"), F.first("_lo").alias("lo"), F.first("_hi").alias("hi")))
    out = out.withColumn("bin_start", F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(bins))
    return out.drop("_k", "lo", "hi")


def price_sales_changes(panel: DataFrame, periods: int = 7) -> DataFrame:
    """``periods``-step percent change of price and of sales per series (NULL on a zero
    or missing base; no forward fill, trap D15)."""
    w = series_window()
    return panel.withColumns({
        "price_change": pct_change("sell_price", F.lag("sell_price", periods).over(w)),
        "sales_change": pct_change(F.col("sales").cast("double"), F.lag("sales", periods).over(w).cast("double")),
    })


def price_sales_correlation(panel: DataFrame, by: str = "cat_id") -> DataFrame:
    """A20 + P12: Pearson correlation of price change and sales change per group over the
    complete pairs."""
    ch = price_sales_changes(panel).dropna(subset=["price_change", "sales_change"])
    return ch.groupBy(by).agg(F.corr("price_change", "sales_change").alias("elasticity_proxy"),
                              F.count("*").alias("n_pairs"))


# ---- benefit days (A13, A14, J8, F10) ---------------------------------------------------------

def benefit_lift_own_state(panel: DataFrame) -> DataFrame:
    """Per (state, category) mean sales on the state's own benefit days vs other days,
    lift in percent; only where both kinds of day exist."""
    flag = ev_fn.own_state_flag("state_id")
    g = panel.groupBy("state_id", "cat_id").agg(
        F.avg(F.when(flag == 1, F.col("sales"))).alias("mean_benefit"),
        F.avg(F.when(flag == 0, F.col("sales"))).alias("mean_other"))
    g = g.filter(F.col("mean_benefit").isNotNull() & F.col("mean_other").isNotNull())
    return g.withColumn("lift_pct", (F.try_divide(F.col("mean_benefit"), F.col("mean_other")) - 1) * 100)


def benefit_uplift_any_state(panel: DataFrame, store: str = "All", category: str = "All") -> DataFrame:
    """Dashboard uplift per category using the any-state flag (trap D10):
    (mean on flagged days - mean otherwise) / mean otherwise * 100, 0 when the base is not
    positive, then max(0, round half-even to 1 place)."""
    df = filter_panel(panel, store, category)
    flag = ev_fn.any_state_flag() == 1
    g = df.groupBy("cat_id").agg(F.avg(F.when(flag, F.col("sales"))).alias("snap_mean"),
                                 F.avg(F.when(~flag, F.col("sales"))).alias("no_snap_mean"))
    uplift = F.when(F.col("no_snap_mean") > 0,
                    (F.col("snap_mean") - F.col("no_snap_mean")) / F.col("no_snap_mean") * 100).otherwise(F.lit(0.0))
    return g.select(F.col("cat_id").alias("Category"),
                    F.greatest(F.lit(0.0), F.bround(uplift, 1)).alias("Avg_Uplift_pct"))


# ---- weekday and store summaries (A15, A16) --------------------------------------------------

def weekday_pattern(panel: DataFrame) -> DataFrame:
    """Mean, sum and count of sales per weekday, labelled from the date (trap D8)."""
    return (panel.groupBy(F.weekday("date").alias("dow"), F.date_format("date", "E").alias("Day"))
                 .agg(F.avg("sales").alias("Avg_Sales"), F.sum("sales").cast("long").alias("total"),
                      F.count("*").alias("n")))


def store_ranking(panel: DataFrame, top: int = 5) -> DataFrame:
    """Mean, std and sum of sales per store; top ``top`` by mean (top-k report)."""
    return (panel.groupBy("store_id")
                 .agg(F.avg("sales").alias("Avg_Sales"), F.stddev_samp("sales").alias("Volatility"),
                      F.sum("sales").cast("long").alias("total"))
                 .orderBy(F.col("Avg_Sales").desc(), "store_id").limit(top))


# ---- top series, lag correlation, sample (T2, W12, A21, T7, A23) ------------------------------

def series_totals(panel: DataFrame) -> DataFrame:
    return panel.groupBy("id").agg(F.sum("sales").cast("long").alias("total"))


def top_series(panel: DataFrame, n: int = 1) -> DataFrame:
    """The highest-volume series (ties broken by id)."""
    return series_totals(panel).orderBy(F.col("total").desc(), "id").limit(n)


def lag_matrix(series: DataFrame, lags=CORR_LAGS) -> DataFrame:
    """Sales and its lags for one or more series, complete rows only."""
    w = series_window()
    df = series.select("id", "date", F.col("sales").cast("double").alias("sales"))
    df = df.withColumns({f"lag_{k}": F.lag("sales", k).over(w) for k in lags})
    return df.dropna()


def lag_correlation(panel: DataFrame, lags=CORR_LAGS) -> DataFrame:
    """Pearson matrix of sales and its lags for the top series, as long (a, b, r).
    The top id is a scalar subquery, so only that series is windowed."""
    top_id = top_series(panel).select("id").scalar()
    m = lag_matrix(panel.filter(F.col("id") == top_id), lags)
    names = ["sales"] + [f"lag_{k}" for k in lags]
    pairs = [(a, b) for a in names for b in names]
    r = m.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}__{b}").alias("r"))
                      for a, b in pairs])
    return r.select(F.inline(cells))


def sample_series(panel: DataFrame, n: int = 50, seed: int = 42) -> DataFrame:
    """Reproducible sample of ``n`` series: order by md5(id || seed), keep ``n``.
    Stable however the data is partitioned (a sampling operator: the limit is the feature)."""
    s = panel.select(*ID_COLUMNS).distinct()
    return s.orderBy(F.md5(F.concat(F.col("id"), F.lit(str(seed)))), "id").limit(n)


def sample_composition(sample: DataFrame) -> DataFrame:
    """Category x store counts of a sample, largest first."""
    return sample.groupBy("cat_id", "store_id").count().orderBy(F.col("count").desc(), "cat_id", "store_id")
