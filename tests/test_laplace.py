"""Laplace prior on the changepoints: sparse hinges, soft thresholds, never a rising objective, the same by distributed sums."""

import datetime as dt

import numpy as np
import pytest

from daycast.operators import pooled as PL
from daycast.operators import ridge as RG

HINGES = [i for i, (_t, b) in enumerate(RG.terms()) if b == "changepoint"]


def planted(n=900, at=10, seed=1):
    """Rows of the whole design with one break of the trend at a hinge."""
    rng = np.random.default_rng(seed)
    t = np.arange(n) / (n - 1)
    x = np.zeros((n, len(RG.terms())))
    x[:, 0], x[:, 1] = 1.0, t
    for k, i in enumerate(HINGES, 1):
        x[:, i] = np.maximum(t - 0.8 * k / len(HINGES), 0.0)
    place = 0.8 * at / len(HINGES)
    y = 3 + t + 6 * np.maximum(t - place, 0) + rng.normal(0, 0.02, n)
    return x, y


def test_one_break_gives_few_hinges():
    x, y = planted()
    params = RG.DEFAULT_PARAMS
    for prior, few in (("laplace", True), ("gaussian", False)):
        coef, mode, scale = RG.Ridge(prior=prior).fit(RG.Ridge(prior=prior).prepare(x, y), params)
        size = np.abs(coef[HINGES])
        assert ((size > 0.01 * size.max()).sum() < 4) == few
        assert np.abs(x @ coef * scale - y).mean() < 0.1
    with pytest.raises(ValueError):
        RG.Ridge(prior="cauchy")


def test_soft_threshold_and_descent():
    rng = np.random.default_rng(2)
    square, side, weight = np.diag(rng.uniform(1, 5, 6)), rng.normal(0, 3, 6), np.full(6, 1.5)
    got = RG.solve_laplace(square, side, np.zeros(6), weight)
    want = np.sign(side) * np.maximum(np.abs(side) - 1.5, 0) / np.diag(square)
    assert np.abs(got - want).max() < 1e-6 and (want == 0).any() and (want != 0).any()

    x, y = planted(300)
    pen, w = RG.penalties(RG.DEFAULT_PARAMS), RG.laplace_weights(RG.DEFAULT_PARAMS)
    pen = np.where(w > 0, 0.0, pen)
    g, s = x.T @ x, x.T @ (y / y.max())
    objective = lambda b: b @ g @ b / 2 - s @ b + pen @ b ** 2 / 2 + w @ np.abs(b)
    best = RG.solve_laplace(g, s, pen, w)
    for _ in range(200):  # no better point near by
        assert objective(best) <= objective(best + rng.normal(0, 10.0 ** rng.uniform(-8, -1), len(best))) + 1e-9


def test_distributed_equals_grouped(spark):
    x, y = planted(400)
    day = dt.date(2024, 1, 1)
    rows = [("s", day + dt.timedelta(days=i), float(y[i]), "train", [float(v) for v in x[i]]) for i in range(len(y))]
    design = spark.createDataFrame(rows, "series_id string, ds date, y double, split string, x array<double>").repartition(5)
    a, b = RG.fit(design, RG.DEFAULT_PARAMS, prior="laplace").first(), PL.fit_pooled(design, RG.DEFAULT_PARAMS, prior="laplace").first()
    assert np.abs(np.array(a["coef"]) - b["coef"]).max() < 1e-6
    assert (np.array(a["coef"])[HINGES] == 0).sum() > 15
