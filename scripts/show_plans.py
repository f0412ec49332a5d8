"""Print the physical plans of the headline operators (``explain("formatted")`` tree part
only), for reviewing exchanges, sorts, broadcasts and pushed-down scans.

usage: python scripts/show_plans.py [--sf /root/testdata/sf0.01] [--full]
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.operators import explore as ex  # noqa: E402
from shelfcast.operators import features as feat  # noqa: E402
from shelfcast.operators import forecast as fcst  # noqa: E402
from shelfcast.operators import metrics as met  # noqa: E402
from shelfcast.operators import tsa  # noqa: E402
from shelfcast.plans.panel import build_panel, date_bounds  # noqa: E402
from shelfcast.session import get_spark  # noqa: E402
from shelfcast.sources.sinks import materialize  # noqa: E402


def plan_text(df, full: bool) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text if full else text.split("\n\n\n")[0]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--full", action="store_true")
    args = ap.parse_args()
    spark = get_spark("shelfcast-plans", cores=4)
    _, hi = date_bounds(spark, args.sf)
    cut = fcst.split_dates(hi)
    panel = build_panel(spark, args.sf)
    stored = materialize(panel)
    fc, _ = fcst.seasonal_naive(stored, cut["val_end"])
    plans = {
        "dense panel": panel,
        "feature matrix (on the checkpointed panel)": feat.build_features(stored, until=cut["train_end"]),
        "naive MASE per store": met.mase(fcst.scored_frame(fc, stored, cut["val_end"], 28),
                                         stored.filter(stored.date <= cut["val_end"]), "store_id"),
        "event window effect": ex.event_window_effect(ex.daily_totals(stored)),
        "decomposition": tsa.decompose(stored),
    }
    for name, df in plans.items():
        print(f"===== {name} =====")
        print(plan_text(df, args.full))
        print()


if __name__ == "__main__":
    main()
