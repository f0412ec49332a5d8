"""The registered search draws as many trials as the library's default."""
import inspect

from conftest import SF001
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from shelfcast.operators import boosting
from shelfcast.plans import queries_models


def test_registered_search_draws_the_default_number_of_trials(spark, monkeypatch):
    default = inspect.signature(queries_models.mdl.halving_search).parameters["n_trials"].default
    fitted = []

    def boost(rows, columns, quantile, rounds, params, begin, seed):
        if begin is None:
            fitted.append(params)
        made = boosting.Ensemble(quantile, columns, params, trees=(begin.trees if begin else []) + [None] * rounds)
        made.losses.append(params["stepSize"])
        return made

    monkeypatch.setattr(boosting, "boost", boost)
    assert default == 50 and queries_models.q_tuning(spark, SF001).count() == 5
    assert len(fitted) == default == len({p["stepSize"] for p in fitted})


def test_draws_share_the_start_and_large_leaves_take_one_pass(spark, monkeypatch):
    rows = spark.range(30_000).selectExpr("array(cast(id % 97 as double), cast(id % 13 as double)) AS a", "cast(id * 7919 % 30011 as double) AS y",
                                          "id % 5 = 0 AS is_val", "xxhash64(id) AS pick")
    rows = rows.select(array_to_vector("a").alias("x"), "y", "is_val", "pick").checkpoint()
    starts, found = [], boosting.exact_quantiles
    monkeypatch.setattr(boosting, "exact_quantiles", lambda df, group, *rest: starts.append(group) or found(df, group, *rest))
    draws = [{"maxDepth": 2, "stepSize": s, "minInstancesPerNode": 10} for s in (0.1, 0.2, 0.3)]
    out = boosting.successive_halving(rows, ["a", "b"], draws, 1.0, last_rounds=3)
    assert len(out) == 3 and starts.count("g") == 1

    select, scans = DataFrame.select, []
    monkeypatch.setattr(DataFrame, "select", lambda df, *c: scans.append(c) or select(df, *c))
    value, _ = found(rows.withColumn("g", F.lit(0)), "g", "y", 0.5)
    assert value[0] == sorted(r["y"] for r in rows.collect())[14_999]
    assert len(scans) == 1  # one scan after the aggregate; bins over the whole range take two
