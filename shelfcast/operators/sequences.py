"""Encoder/decoder training windows for sequence models (M9, P10).

One row per anchor day: the ``encoder`` past target values (anchor included), the
``decoder`` future target values and known-in-advance inputs, the static ids, an integer
time index and the series' target mean / std (group normaliser).  Windows come from
``collect_list`` over fixed row frames of the shared per-series window, so each list is
bounded by the frame, never by the series; only full windows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.plans.panel import series_window

# ---- fixed values ----
ENCODER_DAYS = 56
DECODER_DAYS = 28
KNOWN_INPUTS = ["day_of_week", "is_snap_day", "has_event", "month"]
STATIC_INPUTS = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
# -----------------------


def time_index(df: DataFrame) -> DataFrame:
    """P10: days since the first date of the whole frame (a scalar subquery)."""
    first = df.agg(F.min("date")).scalar()
    return df.withColumn("time_idx", F.datediff(F.col("date"), first))


def sequence_windows(features: DataFrame, target: str = "sales", encoder: int = ENCODER_DAYS,
                     decoder: int = DECODER_DAYS, known=KNOWN_INPUTS, static=STATIC_INPUTS) -> DataFrame:
    w = series_window()
    per_series = Window.partitionBy("id")
    y = F.col(target).cast("double")
    missing = [c for c in known if c not in features.columns]
    if missing:
        raise ValueError(f"known inputs are not in the frame: {', '.join(missing)}")
    df = time_index(features).withColumns({
        "encoder_target": F.collect_list(y).over(w.rowsBetween(-(encoder - 1), 0)),
        "decoder_target": F.collect_list(y).over(w.rowsBetween(1, decoder)),
        "decoder_known": F.collect_list(F.struct(*[F.col(c) for c in known])).over(w.rowsBetween(1, decoder)),
        "target_mean": F.avg(y).over(per_series),
        "target_std": F.coalesce(F.stddev_samp(y).over(per_series), F.lit(0.0)),
    })
    full = (F.size("encoder_target") == encoder) & (F.size("decoder_target") == decoder)
    return df.filter(full).select("id", "date", "time_idx", *[c for c in static if c in df.columns],
                                  "encoder_target", "decoder_target", "decoder_known", "target_mean", "target_std")


# ---- windows on read -------------------------------------------------------------------------

# ---- fixed values: inputs of the deep model ----
KNOWN_AHEAD = ["dow_sin", "dow_cos", "month_sin", "month_cos", "is_weekend", "is_month_start", "is_month_end",
               "has_event", "is_snap_day", "log_price"]
PAST_ONLY = ["sales", "sales_lag_7", "sales_lag_14", "sales_lag_28", "sales_roll_mean_7", "sales_roll_mean_28",
             "sales_roll_std_7", "sales_roll_std_28", "price_momentum", "price_vs_dept_mean"]
STATIC_GROUPS = ["store_id", "cat_id", "dept_id", "state_id"]
STATIC_NUMBERS = ["item_store_enc", "dept_store_enc"]
# ------------------------------------------------


def series_arrays(features: DataFrame, target: str = "sales", known=KNOWN_AHEAD, past=PAST_ONLY,
                  groups=STATIC_GROUPS, numbers=STATIC_NUMBERS) -> DataFrame:
    """One row per series: its dates and inputs as arrays in date order, the static inputs,
    the target's mean and std, and ``first_idx``, days from the first date of the frame.

    A value is stored once, so the table is as large as the frame; the windows that overlap it
    up to 84 times are cut when it is read (``windows_on_read``).  A row holds one series,
    bounded by the calendar.  NULL inputs stay NULL; static inputs are those of the first day.
    """
    inputs = list(dict.fromkeys([*known, *past, target]))
    missing = [c for c in [*inputs, *groups, *numbers] if c not in features.columns]
    if missing:
        raise ValueError(f"inputs are not in the frame: {', '.join(missing)}")
    y = F.col(target).cast("double")
    row = F.struct("date", *[F.col(c).cast("double").alias(c) for c in inputs])
    origin = features.agg(F.min("date")).scalar()
    per = features.groupBy("id").agg(
        F.sort_array(F.collect_list(row)).alias("_rows"), F.avg(y).alias("target_mean"),
        F.coalesce(F.stddev_samp(y), F.lit(0.0)).alias("target_std"),
        *[F.min_by(c, "date").alias(c) for c in [*groups, *numbers]])
    return per.select("id", *groups, *numbers, "target_mean", "target_std", F.col("_rows.date").alias("dates"),
                      F.datediff(F.col("_rows")[0]["date"], origin).alias("first_idx"),
                      *[F.col(f"_rows.{c}").alias(f"x_{c}") for c in inputs])


def windows_on_read(series: DataFrame, target: str = "sales", encoder: int = ENCODER_DAYS, decoder: int = DECODER_DAYS,
                    known=KNOWN_AHEAD, past=PAST_ONLY, stride: int = 1) -> DataFrame:
    """Every full window of a table of ``series_arrays``: the anchor's date and ``time_idx``,
    the static inputs, ``encoder_<input>`` (the past days, the anchor included) of known and
    past-only inputs, ``decoder_<input>`` (the days after it) of known ones, and
    ``decoder_target``.  Series shorter than a window give none; ``stride`` keeps every so
    many anchors.  Windows are slices made row by row: no shuffle, and nothing is kept."""
    n = F.size("dates")
    anchors = F.when(n >= encoder + decoder, F.sequence(F.lit(encoder), n - decoder, F.lit(stride)))
    at = series.withColumn("_at", F.explode(anchors))
    back = lambda c: F.slice(c, F.col("_at") - (encoder - 1), F.lit(encoder))
    ahead = lambda c: F.slice(c, F.col("_at") + 1, F.lit(decoder))
    inputs = list(dict.fromkeys([*known, *past]))
    static = [c for c in series.columns if not c.startswith("x_") and c not in ("dates", "first_idx")]
    day = F.element_at("dates", F.col("_at"))
    return at.select(*static, day.alias("date"), (F.col("first_idx") + F.datediff(day, F.col("dates")[0])).alias("time_idx"),
                     *[back(f"x_{c}").alias(f"encoder_{c}") for c in inputs],
                     *[ahead(f"x_{c}").alias(f"decoder_{c}") for c in known], ahead(f"x_{target}").alias("decoder_target"))
