"""Recursive forecasts of a one-step tree model (E7): each step's forecast is a lag of the next.

The state of a series is the array of its last 56 sales; what is known ahead (calendar,
events, prices, encodings) comes as one array per horizon day.  Both are collected per
series (bounded: 56 numbers and horizon x features), so a batch of series is rolled out by
array arithmetic, one ensemble evaluation per step for all its series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.boosting import Ensemble
from shelfcast.operators.features import LAG_DAYS, ROLLING_WINDOWS
from shelfcast.session import ship_package


def lag_features(recent: np.ndarray, names: list[str]) -> dict[int, np.ndarray]:
    """{place in ``names``: values} of the lag and rolling features of the day after the
    last column of ``recent`` (series x days)."""
    out = {}
    for i, name in enumerate(names):
        kind, _, k = name.rpartition("_")
        if kind == "sales_lag":
            out[i] = recent[:, -int(k)]
        elif kind == "sales_roll_mean":
            out[i] = recent[:, -int(k):].mean(axis=1)
        elif kind == "sales_roll_std":
            out[i] = recent[:, -int(k):].std(axis=1, ddof=1)
    return out


def roll_out(features: DataFrame, ensemble: Ensemble, cutoff: Column, horizon: int) -> DataFrame:
    """(id, h, date, yhat) for the ``horizon`` days after ``cutoff``.

    ``features`` is the one-step feature frame with ``sales``; of the horizon's days only
    what is known ahead is read, of the past the last days of ``sales``.  Series without all
    these days are left out.
    """
    ship_package(features.sparkSession)
    names = ensemble.columns
    own = [n for n in names if n.rpartition("_")[0] in ("sales_lag", "sales_roll_mean", "sales_roll_std")]
    known = [n for n in names if n not in own]
    past_days = max([*LAG_DAYS, *ROLLING_WINDOWS])
    d = F.col("date")
    rows = features.filter((d > F.date_sub(cutoff, past_days)) & (d <= F.date_add(cutoff, horizon)))
    rows, ahead = rows.withColumn("_ahead", d > cutoff), F.col("_ahead")
    per = rows.groupBy("id").agg(
        F.sort_array(F.collect_list(F.when(~ahead, F.struct(d, F.col("sales").cast("double").alias("y"))))).alias("past"),
        F.sort_array(F.collect_list(F.when(ahead, F.struct(d, F.array(*[F.col(c).cast("double") for c in known]).alias("x"))))).alias("next"))
    per = per.filter((F.size("past") == past_days) & (F.size("next") == horizon))
    ready = per.select("id", F.col("past.y").alias("past"), F.flatten("next.x").alias("next"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            recent = np.array(frame["past"].tolist(), float)
            given = np.array(frame["next"].tolist(), float).reshape(len(frame), horizon, len(known))
            x = np.empty((len(frame), len(names)))
            places = [names.index(c) for c in known]
            out = np.empty((len(frame), horizon))
            for h in range(horizon):
                x[:, places] = given[:, h]
                for i, values in lag_features(recent, names).items():
                    x[:, i] = values
                out[:, h] = np.maximum(ensemble.score(x), 0.0)
                recent = np.concatenate([recent[:, 1:], out[:, h:h + 1]], axis=1)
            yield pd.DataFrame({"id": np.repeat(frame["id"].to_numpy(), horizon),
                                "h": np.tile(np.arange(1, horizon + 1), len(frame)), "yhat": out.ravel()})

    rolled = ready.mapInPandas(run, "id string, h int, yhat double")
    return rolled.select("id", "h", F.date_add(cutoff, F.col("h")).alias("date"), "yhat")
