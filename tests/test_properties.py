"""Property tests on random small panels: the distributed operators equal direct numpy
evaluations of the same definitions."""
import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfcast.operators import forecast as fcst
from shelfcast.operators import metrics as met

START = dt.date(2021, 3, 1)
panels = st.lists(st.lists(st.integers(0, 40), min_size=63, max_size=63), min_size=1, max_size=3)
SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _panel(spark, series):
    rows = [(f"s{i}", START + dt.timedelta(days=t), int(v)) for i, vals in enumerate(series) for t, v in enumerate(vals)]
    return spark.createDataFrame(rows, "id string, date date, sales int")


@settings(**SETTINGS)
@given(series=panels, horizon=st.integers(1, 28))
def test_naive_is_tiled_last_week(spark, series, horizon):
    cut = START + dt.timedelta(days=34)
    fc, failed = fcst.seasonal_naive(_panel(spark, series), cut, horizon)
    got = {(r["id"], r["h"]): r["yhat"] for r in fc.collect()}
    assert failed.count() == 0
    for i, vals in enumerate(series):
        last = np.array(vals[28:35], dtype=float)
        exp = np.tile(last, 5)[:horizon]
        assert [got[(f"s{i}", h)] for h in range(1, horizon + 1)] == list(exp)


@settings(**SETTINGS)
@given(series=panels)
def test_wrmsse_matches_direct_formula(spark, series):
    h = 7
    cut = START + dt.timedelta(days=55)
    panel = _panel(spark, series)
    hist = panel.filter(f"date <= DATE'{cut}'")
    rng = np.random.default_rng(len(series))
    fut = []
    for i, vals in enumerate(series):
        for k in range(1, h + 1):
            fut.append((f"s{i}", cut + dt.timedelta(days=k), float(vals[55 + k]), float(rng.integers(0, 40))))
    scored = spark.createDataFrame(fut, "id string, date date, actual double, yhat double")
    got = met.wrmsse(scored, hist, cut, horizon=h).first()["WRMSSE"]
    train = np.array([v[:56] for v in series], dtype=float)
    act = np.array([[f[2] for f in fut if f[0] == f"s{i}"] for i in range(len(series))])
    frc = np.array([[f[3] for f in fut if f[0] == f"s{i}"] for i in range(len(series))])
    scale = np.mean((train[:, -h:] - train[:, -2 * h:-h]) ** 2, axis=1) + 1e-8
    rmsse = np.sqrt(np.mean((act - frc) ** 2, axis=1) / scale)
    tot = train[:, -h:].sum(axis=1)
    w = tot / (tot.sum() + 1e-8)
    assert got == pytest.approx(float(np.sum(w * rmsse)), rel=1e-9, abs=1e-9)
