"""Seasonal regression, fitted per series.

Model form after Taylor & Letham (2018): intercept + linear trend with 25
changepoint hinges + weekly/yearly Fourier terms + holiday indicators +
standardised regressors.  Gaussian priors with block scales become a ridge
penalty ``sigma^2 / scale^2`` per coefficient, on the target scaled by its
training max (additive) or on ``log y`` (multiplicative, when all y > 0).

Split of work:
* design columns, holiday lookup, scoring, bounds: JVM column expressions;
* per-series solve (and the whole parameter search, ``tune.py``): one
  ``applyInPandas`` group per series, where ``X'X`` is formed once and only the
  diagonal penalty changes between trials.  A group holds one row per day of one
  series, so its size is bounded by the calendar.
"""

from __future__ import annotations

import functools
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.functions import calendar as CAL
from daycast.functions import design as D
from daycast.operators.tune import fit_best

# Default prior scales and noise level of the fit.
DEFAULT_PARAMS = {"changepoint_prior_scale": 0.05, "seasonality_prior_scale": 10.0,
                  "holidays_prior_scale": 10.0, "seasonality_mode": "additive"}
REGRESSOR_PRIOR_SCALE = 10.0
NOISE_VAR = 0.01
BASE_PENALTY = 1e-6
REGRESSORS = ["HDD", "CDD"]
PUBLIC_HOLIDAY_NAMES = [n for _m, _d, n in CAL.FR_FIXED_HOLIDAYS] + [n for _o, n in CAL.FR_EASTER_HOLIDAYS]
# one indicator per (holiday, offset inside its window): public holidays act on
# -1..+1 days, bridge and school days on the day itself
HOLIDAY_TERMS = [(n, o) for n in PUBLIC_HOLIDAY_NAMES for o in range(CAL.PUBLIC_WINDOW[0], CAL.PUBLIC_WINDOW[1] + 1)] + \
    [(CAL.BRIDGE_NAME, 0), (CAL.SCHOOL_NAME, 0)]

# Search space of the tuner.
SEARCH_SPACE = {"changepoint_prior_scale": (0.0005, 0.01), "seasonality_prior_scale": (1.0, 20.0),
                "holidays_prior_scale": (5, 50), "seasonality_mode": ("additive", "multiplicative")}
N_TRIALS = 50


def terms() -> list[tuple[str, str]]:
    """(term, block) in design order."""
    out = [("intercept", "base"), ("t", "base")]
    out += [(c, "changepoint") for c in D.hinge_names()]
    out += [(c, "seasonality") for c in D.fourier_names()]
    out += [(f"hol{i:02d}", "holidays") for i in range(len(HOLIDAY_TERMS))]
    out += [(f"{r}_z", "regressor") for r in REGRESSORS]
    return out


def design(prepared_split: DataFrame, holidays: DataFrame, by: str = "series_id") -> DataFrame:
    """``series_id, ds, y, split, x array<double>`` (y NULL on future rows).

    ``prepared_split`` has ``series_id, ds, y, HDD, CDD, split`` where split is
    ``train``, ``test``, ``holdout`` or ``future``; trend time and regressor
    scaling use the train rows only.  Rows without a regressor are left out (see
    :func:`incomplete`).  The holiday lookup (about a dozen days a year) is
    broadcast.
    """
    fit = F.col("split") == "train"
    complete = prepared_split.filter(functools.reduce(lambda a, b: a & b, [F.col(r).isNotNull() for r in REGRESSORS]))
    df = D.with_trend_time(complete, by, fit_mask=fit)
    df = D.standardize(df, REGRESSORS, by, fit_mask=fit)
    per_day = CAL.holiday_effect_days(holidays).groupBy(F.col("day").alias("ds")).agg(
        F.collect_set(F.concat_ws("|", "holiday", F.col("offset").cast("string"))).alias("_hol"))
    df = df.join(F.broadcast(per_day), "ds", "left")
    active = F.coalesce("_hol", F.array().cast("array<string>"))
    hol = [F.when(F.array_contains(active, f"{n}|{o}"), 1.0).otherwise(0.0) for n, o in HOLIDAY_TERMS]
    four = D.fourier_columns()
    hinge = D.hinge_columns()
    x = F.array(F.lit(1.0), F.col("t"), *hinge.values(), *[four[c] for c in D.fourier_names()], *hol,
                *[F.col(f"{r}_z") for r in REGRESSORS])
    return df.select(by, "ds", "y", "split", x.alias("x"))


def incomplete(rows: DataFrame) -> DataFrame:
    """Rows that cannot enter a design: a regressor is missing (they are rejected, never filled)."""
    return rows.filter(functools.reduce(lambda a, b: a | b, [F.col(r).isNull() for r in REGRESSORS]))


def penalties(params: dict) -> np.ndarray:
    scale = {"base": None, "changepoint": float(params["changepoint_prior_scale"]),
             "seasonality": float(params["seasonality_prior_scale"]),
             "holidays": float(params["holidays_prior_scale"]), "regressor": REGRESSOR_PRIOR_SCALE}
    return np.array([BASE_PENALTY if scale[b] is None else NOISE_VAR / scale[b] ** 2 for _t, b in terms()])


def _solve(G: np.ndarray, Xty: np.ndarray, pen: np.ndarray) -> np.ndarray:
    return np.linalg.solve(G + np.diag(pen), Xty)


#: Rounds of reweighting, at most; change (against the largest coefficient) at which they end; where a coefficient counts as zero.
LAPLACE_ROUNDS, LAPLACE_END, LAPLACE_ZERO = 500, 1e-10, 1e-12


def laplace_weights(params: dict) -> np.ndarray:
    """Weight of ``|b|`` per term under a Laplace prior on the changepoints (noise over scale), 0 elsewhere."""
    scale = float(params["changepoint_prior_scale"])
    return np.array([NOISE_VAR / scale if b == "changepoint" else 0.0 for _t, b in terms()])


def solve_laplace(G: np.ndarray, side: np.ndarray, pen: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Minimum of ``b'Gb/2 - side'b + pen'b^2/2 + weight'|b|`` by iteratively reweighted ridge.

    ``|b|`` is bounded by the parabola that touches it at the last ``b``, so
    each round is a ridge with the penalty ``weight / |b|`` and the objective
    never rises.  Only the sums ``G`` and ``side`` are needed, no rows.
    """
    sparse = weight > 0
    start = np.where(sparse, np.maximum(pen, BASE_PENALTY), pen)
    b = _solve(G, side, start)
    for _ in range(LAPLACE_ROUNDS):
        size = np.maximum(np.abs(b), LAPLACE_ZERO)
        new = _solve(G, side, np.where(sparse, weight / size, pen))
        top = max(float(np.abs(new).max(initial=0.0)), LAPLACE_ZERO)
        done = np.abs(new - b).max(initial=0.0) <= LAPLACE_END * top
        b = new
        if done:
            break
    return np.where(sparse & (np.abs(b) <= 1e-9 * max(float(np.abs(b).max(initial=0.0)), LAPLACE_ZERO)), 0.0, b)


class _Fitter:
    """Per-series state reused across trials: X'X and X'y for both target forms."""

    def __init__(self, X: np.ndarray, y: np.ndarray, prior: str = "gaussian"):
        self.prior = prior
        self.X = X
        self.G = X.T @ X
        self.scale = float(np.max(np.abs(y))) if len(y) and np.max(np.abs(y)) > 0 else 1.0
        self.Xty = X.T @ (y / self.scale)
        self.positive = bool(len(y) and np.all(y > 0))
        self.Xtl = X.T @ np.log(y) if self.positive else None

    def coef(self, params: dict) -> tuple[np.ndarray, str, float]:
        """(coefficients, mode actually used, output scale)."""
        pen = penalties(params)
        solve = _solve if self.prior == "gaussian" else lambda g, s, p: solve_laplace(g, s, p, laplace_weights(params))
        if params["seasonality_mode"] == "multiplicative":
            if self.positive:
                return solve(self.G, self.Xtl, pen), "multiplicative", 1.0
            return solve(self.G, self.Xty, pen), "fallback_additive", self.scale
        return solve(self.G, self.Xty, pen), "additive", self.scale


# ------------------------------------------------------------------ trials
def trial_params(df: DataFrame, seed: int = 42) -> DataFrame:
    """Add the four parameters of trial ``trial_id`` (reproducible random search).

    Each parameter draws its own uniform from ``md5(seed|trial|name)``:
    log-uniform changepoint scale, uniform seasonality scale, integer holiday
    scale, and one of the two modes.  A pure function of ``trial_id``, so the
    same trial has the same parameters for every series and every run.
    """
    def u(name):
        h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("trial_id").cast("string"), F.lit(name)).cast("binary"))
        return (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)

    lo, hi = SEARCH_SPACE["changepoint_prior_scale"]
    slo, shi = SEARCH_SPACE["seasonality_prior_scale"]
    hlo, hhi = SEARCH_SPACE["holidays_prior_scale"]
    modes = SEARCH_SPACE["seasonality_mode"]
    return df.withColumns({
        "changepoint_prior_scale": F.exp(F.lit(math.log(lo)) + u("changepoint_prior_scale") *
                                         (math.log(hi) - math.log(lo))),
        "seasonality_prior_scale": F.lit(slo) + u("seasonality_prior_scale") * (shi - slo),
        "holidays_prior_scale": (F.lit(hlo) + F.floor(u("holidays_prior_scale") * (hhi - hlo + 1))).cast("int"),
        "seasonality_mode": F.when(u("seasonality_mode") < 0.5, modes[0]).otherwise(modes[1]),
    })


def series_trials(series: DataFrame, n_trials: int = N_TRIALS, seed: int = 42, by: str = "series_id") -> DataFrame:
    """Every trial for every series, by a generator (no join)."""
    s = series.select(by).distinct().select(by, F.explode(F.sequence(F.lit(1), F.lit(n_trials))).alias("trial_id"))
    return trial_params(s, seed)


class Ridge:
    """The seasonal ridge as a model of the search (X1); ``prior`` of the changepoints: ``gaussian`` or ``laplace`` (sparse)."""

    def __init__(self, seed: int = 42, prior: str = "gaussian") -> None:
        if prior not in ("gaussian", "laplace"):
            raise ValueError(f"unknown changepoint prior {prior!r}; use 'gaussian' or 'laplace'")
        self.seed, self.prior = seed, prior

    def space(self, trials: DataFrame) -> DataFrame:
        return trial_params(trials, self.seed)

    def prepare(self, x: np.ndarray, y: np.ndarray) -> _Fitter:
        return _Fitter(x, y, self.prior)

    def fit(self, state: _Fitter, params: dict) -> tuple[np.ndarray, str, float]:
        return state.coef(params)

    def predict(self, x: np.ndarray, fitted: tuple[np.ndarray, str, float]) -> np.ndarray:
        b, mode, scale = fitted
        z = x @ b
        return np.exp(z) if mode == "multiplicative" else z * scale


COEF_SCHEMA = "series_id string, mode_used string, out_scale double, coef array<double>, status string"


def fit(design_df: DataFrame, params: DataFrame | dict, by: str = "series_id", prior: str = "gaussian") -> DataFrame:
    """Fit on the train rows with one parameter set per series
    (``params`` as a dict for all series, or a per-series DataFrame such as the
    best trials).  Returns the coefficient table (one row per series)."""
    if isinstance(params, dict):
        params = design_df.select(by).distinct().withColumns({"score": F.lit(0.0), **{k: F.lit(v) for k, v in params.items()}})
    return fit_best(design_df, Ridge(prior=prior), params, list(DEFAULT_PARAMS), DEFAULT_PARAMS, by)


def predict(design_df: DataFrame, coef: DataFrame, by: str = "series_id") -> DataFrame:
    """M8: ``yhat`` as a dot product in column expressions (no Python in scoring); NULL for a series without a fit."""
    j = design_df.join(coef, by, "left")
    dot = F.aggregate(F.zip_with("x", "coef", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    yhat = F.when(F.col("mode_used") == "multiplicative", F.exp(dot)).otherwise(dot * F.col("out_scale"))
    return j.withColumn("yhat", yhat).drop("coef", "out_scale", "status")


# ------------------------------------------------------------------ persistence
def coefficients_table(coef: DataFrame, model_name: str, by: str = "series_id") -> DataFrame:
    """Tall table ``(model_name, series_id, k, term, coef, mode_used, out_scale)``."""
    names = F.array(*[F.lit(t) for t, _b in terms()])
    return coef.select(F.lit(model_name).alias("model_name"), by, "mode_used", "out_scale", "status",
                       F.posexplode(F.arrays_zip(names.alias("term"), F.col("coef").alias("coef"))).alias("k", "tc")
                       ).select("model_name", by, "k", "tc.term", "tc.coef", "mode_used", "out_scale", "status")


def coefficients_from_table(table: DataFrame, by: str = "series_id") -> DataFrame:
    """M11 load: back to one row per series with the coefficient array in term order
    (a group holds one row per term)."""
    g = table.groupBy(by).agg(F.first("mode_used").alias("mode_used"), F.first("out_scale").alias("out_scale"), F.first("status").alias("status"),
                              F.sort_array(F.collect_list(F.struct("k", "coef"))).alias("_kc"))
    return g.select(by, "mode_used", "out_scale", F.transform("_kc", lambda s: s["coef"]).alias("coef"), "status")
