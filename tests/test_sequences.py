"""Windows cut on read against slices of a pandas frame."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest

from shelfcast.operators import sequences as seqs


def frame(spark, lengths):
    rng = np.random.default_rng(2)
    inputs = list(dict.fromkeys(seqs.KNOWN_AHEAD + seqs.PAST_ONLY))
    parts = []
    for k, n in enumerate(lengths):
        part = pd.DataFrame(rng.normal(size=(n, len(inputs))), columns=inputs)
        part["sales"] = rng.integers(0, 9, n).astype(float)
        part.loc[part.index % 11 == 3, "price_momentum"] = None
        part["id"], part["date"] = f"s{k}", [dt.date(2020, 1, 1 + k) + dt.timedelta(days=i) for i in range(n)]
        part = part.assign(store_id="S", cat_id="C", dept_id="D", state_id="CA", item_store_enc=float(k), dept_store_enc=2.0)
        parts.append(part)
    pdf = pd.concat(parts).sample(frac=1, random_state=1)
    schema = ", ".join(f"{c} double" for c in inputs) + ", id string, date date, store_id string, cat_id string, dept_id string, state_id string, item_store_enc double, dept_store_enc double"
    rows = [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in pdf.itertuples(index=False, name=None)]
    return pdf.sort_values(["id", "date"]), spark.createDataFrame(rows, schema).repartition(3)


@pytest.mark.parametrize("stride", [1, 5])
def test_windows_on_read(spark, tmpdir_path, stride):
    pdf, df = frame(spark, [100, 84, 83, 90])
    stored = seqs.series_arrays(df)
    stored.write.parquet(f"{tmpdir_path}/series")
    assert stored.count() == 4
    out = seqs.windows_on_read(spark.read.parquet(f"{tmpdir_path}/series"), stride=stride).collect()
    want = {}
    for sid, part in pdf.groupby("id"):
        for at in range(55, len(part) - 28, stride):
            want[sid, part["date"].iloc[at]] = (part.iloc[at - 55:at + 1], part.iloc[at + 1:at + 29], part)
    assert len(out) == len(want) == len({(r["id"], r["date"]) for r in out})
    none = lambda values: [None if np.isnan(x) else x for x in values]
    for r in out:
        back, ahead, part = want[r["id"], r["date"]]
        assert r["time_idx"] == (r["date"] - dt.date(2020, 1, 1)).days
        for c in dict.fromkeys(seqs.KNOWN_AHEAD + seqs.PAST_ONLY):
            assert r[f"encoder_{c}"] == none(back[c].tolist())
        for c in seqs.KNOWN_AHEAD:
            assert r[f"decoder_{c}"] == none(ahead[c].tolist())
        assert r["decoder_target"] == ahead["sales"].tolist() and not any(f"decoder_{c}" in r.asDict() for c in seqs.PAST_ONLY)
        assert r["target_mean"] == pytest.approx(part["sales"].mean()) and r["target_std"] == pytest.approx(part["sales"].std(ddof=1))
        assert r["item_store_enc"] == float(r["id"][1:]) and r["state_id"] == "CA"


def test_missing_inputs_are_named(spark):
    _, df = frame(spark, [90])
    with pytest.raises(ValueError, match="log_price"):
        seqs.series_arrays(df.drop("log_price"))
