"""M6, distributed: the same coefficients as the grouped fit, whatever the tasks, and no group that holds a series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from daycast.operators import pooled as PL
from daycast.operators import ridge as RG
from daycast.plans import stages as P

from conftest import SMALL


@pytest.fixture(scope="module")
def design(spark):
    from daycast.session import stage

    return stage(P.ridge_design(P.full_data(spark, SMALL)), "pooled_design")


def table(df):
    return {r["series_id"]: r for r in df.collect()}


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_equals_the_grouped_fit(design, mode):
    params = {**RG.DEFAULT_PARAMS, "seasonality_mode": mode}
    want, got = table(RG.fit(design, params)), table(PL.fit_pooled(design.repartition(13), params))
    assert want.keys() == got.keys() and len(want) >= 5
    for k, w in want.items():
        g = got[k]
        assert g["mode_used"] == w["mode_used"] and abs(g["out_scale"] - w["out_scale"]) <= 1e-9 * w["out_scale"]
        assert np.abs(np.array(g["coef"]) - w["coef"]).max() < 1e-6 * max(1, np.abs(w["coef"]).max())


def test_parameters_per_series(design, spark):
    keys = sorted(table(RG.fit(design, RG.DEFAULT_PARAMS)))
    rows = [(keys[0], 0.5, 0.001, 3.0, 7.0, "multiplicative"), (keys[1], None, 0.009, 3.0, 7.0, "additive")]
    best = spark.createDataFrame(rows, "series_id string, score double, changepoint_prior_scale double, seasonality_prior_scale double, "
                                       "holidays_prior_scale double, seasonality_mode string")
    want, got = table(RG.fit(design, best)), table(PL.fit_pooled(design, best))
    assert {k: (r["mode_used"], r["status"]) for k, r in want.items()} == {k: (r["mode_used"], r["status"]) for k, r in got.items()}
    assert got[keys[0]]["status"] == "tuned" and got[keys[1]]["status"] == "default"
    for k in want:
        assert np.abs(np.array(got[k]["coef"]) - want[k]["coef"]).max() < 1e-6


def test_one_pool_of_all_rows(spark, monkeypatch):
    """A single key over many tasks; sums equal the whole matrix, lots and flushes do not matter."""
    monkeypatch.setattr(PL, "LOTS", 3)
    monkeypatch.setattr(PL, "HELD", 1)
    rng = np.random.default_rng(1)
    x, y = rng.standard_normal((500, 4)), rng.standard_normal(500) + 3
    keys = ["a", "b", None]
    rows = [(keys[i % 3], "train" if i % 7 else "test", [float(v) for v in x[i]], float(y[i]) if i % 11 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "series_id string, split string, x array<double>, y double").repartition(9)
    got = {r["series_id"]: r for r in PL.normal_sums(df).collect()}
    assert set(got) == set(keys)
    for k in keys:
        at = [i for i in range(500) if keys[i % 3] == k and i % 7 and i % 11]
        m, t = x[at], y[at]
        assert got[k]["n"] == len(at) and got[k]["n_positive"] == (t > 0).sum() and np.isclose(got[k]["top"], np.abs(t).max())
        assert np.allclose(got[k]["gram"], (m.T @ m)[np.triu_indices(4)]) and np.allclose(got[k]["xty"], m.T @ t)
        assert np.allclose(got[k]["xtl"], m[t > 0].T @ np.log(t[t > 0]))


def test_no_group_holds_a_series(design, spark):
    """Grouped tasks get records of sums, at most one per task and key: the rows stay where they were read."""
    plan = PL.normal_sums(design)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("FlatMapGroupsInPandas") == 2 and plan.index("MapInArrow") > plan.rindex("FlatMapGroupsInPandas")
    parts = PL._partial(design.repartition(6), "series_id").groupBy("series_id").count()
    assert parts.agg(F.max("count")).first()[0] <= 6


def test_empty_and_all_zero_targets(spark):
    schema = "series_id string, split string, x array<double>, y double"
    assert PL.fit_pooled(spark.createDataFrame([], schema), RG.DEFAULT_PARAMS).collect() == []
    zeros = spark.createDataFrame([("z", "train", [1.0, float(i)], 0.0) for i in range(5)], schema)
    out = PL.solve(PL.normal_sums(zeros), {**RG.DEFAULT_PARAMS, "seasonality_mode": "multiplicative"}, penalty=lambda _p: [1.0, 1.0]).first()
    assert out["mode_used"] == "fallback_additive" and out["out_scale"] == 1.0 and out["coef"] == [0.0, 0.0]
