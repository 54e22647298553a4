"""Parameter search (A7, M12-M14): score every trial of every series, pick the best.

The search takes any :class:`Model`, any metric (a name or a function) and
either direction.  A task gets one series (one row per day), prepares it once,
and tries all parameter sets on that; only the parameter table, whose size is
the number of trials, goes through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.functions.metrics import ARRAY_METRICS
from daycast.session import ship_package


class Model(Protocol):
    """What the search needs of a model.  Arrays hold the rows of one series in day order."""

    def space(self, trials: DataFrame) -> DataFrame:
        """Adds the parameters of each ``trial_id`` as columns."""

    def prepare(self, x: np.ndarray, y: np.ndarray) -> Any:
        """What all trials of a series share (train rows)."""

    def fit(self, state: Any, params: dict) -> tuple[np.ndarray, str, float]:
        """Coefficients, mode and output scale of one parameter set."""

    def predict(self, x: np.ndarray, fitted: tuple[np.ndarray, str, float]) -> np.ndarray:
        """Forecast of rows."""


def key_type(df: DataFrame, by: str) -> str:
    return f"`{by}` {df.schema[by].dataType.simpleString()}"


def trial_table(spark, model: Model, n_trials: int) -> DataFrame:
    """The parameter sets of trials 1..n (a small table of fixed size)."""
    return model.space(spark.range(1, n_trials + 1).select(F.col("id").cast("int").alias("trial_id")))


def search(design: DataFrame, model: Model, n_trials: int, metric: str | Callable = "mase", by: str = "series_id") -> DataFrame:
    """``by, trial_id, <parameters>, mode_used, score`` for every series and trial.

    Fitted on the ``train`` rows, scored on the ``test`` rows.  A score that is
    undefined (no test rows, a constant target) is NULL; the series stays.
    """
    ship_package(design.sparkSession)
    score = ARRAY_METRICS[metric] if isinstance(metric, str) else metric
    trials = trial_table(design.sparkSession, model, n_trials)
    names = [f.name for f in trials.schema.fields if f.name != "trial_id"]
    schema = ", ".join([key_type(design, by), *[f"`{f.name}` {f.dataType.simpleString()}" for f in trials.schema.fields],
                        "mode_used string", "score double"])
    sets = trials.orderBy("trial_id").toPandas().to_dict("records")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        x, y = np.vstack(pdf["x"].to_numpy()), pdf["y"].to_numpy(dtype="float64")
        train = (pdf["split"] == "train").to_numpy()
        state = model.prepare(x[train], y[train]) if train.any() else None
        out = []
        for p in sets:
            fitted = model.fit(state, p) if state is not None else None
            s = score(y[~train], model.predict(x[~train], fitted)) if fitted else float("nan")
            out.append((pdf[by].iloc[0], p["trial_id"], *[p[c] for c in names], fitted[1] if fitted else None,
                        None if s is None or math.isnan(s) else float(s)))
        return pd.DataFrame(out, columns=[by, "trial_id", *names, "mode_used", "score"])

    return design.filter(F.col("split").isin("train", "test")).groupBy(by).applyInPandas(run, schema)


def fit_best(design: DataFrame, model: Model, best: DataFrame, params: list[str], default: dict, by: str = "series_id") -> DataFrame:
    """One fit per series on its train rows, with its best parameters.

    A series without a defined score (or missing in ``best``) is fitted with
    ``default``; ``status`` tells ``tuned`` from ``default``.
    """
    ship_package(design.sparkSession)
    chosen = best.select(by, "score", *params)
    rows = design.filter(F.col("split") == "train").join(chosen, by, "left").withColumns(
        {"status": F.when(F.col("score").isNotNull(), "tuned").otherwise("default"),
         **{c: F.when(F.col("score").isNotNull(), F.col(c)).otherwise(F.lit(default[c])) for c in params}})

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        state = model.prepare(np.vstack(pdf["x"].to_numpy()), pdf["y"].to_numpy(dtype="float64"))
        coef, mode, scale = model.fit(state, {c: pdf[c].iloc[0] for c in params})
        return pd.DataFrame({by: [pdf[by].iloc[0]], "mode_used": [mode], "out_scale": [scale],
                             "coef": [np.asarray(coef, dtype="float64").tolist()], "status": [pdf["status"].iloc[0]]})

    return rows.groupBy(by).applyInPandas(
        run, f"{key_type(design, by)}, mode_used string, out_scale double, coef array<double>, status string")


def best_trial(scores: DataFrame, params: list[str], by: str = "series_id", score: str = "score",
               direction: str = "minimize") -> DataFrame:
    """Best trial per series; ties go to the lowest ``trial_id``.

    NULL scores never win; a series that has no other keeps a row whose score
    and trial are NULL (``fit_best`` then takes the defaults).
    """
    value = F.col(score) if direction == "minimize" else -F.col(score)
    key = F.struct(F.col(score).isNull().alias("none"), value.alias("s"), F.col("trial_id"))
    g = scores.groupBy(by).agg(F.min_by(F.struct("trial_id", score, *params), key).alias("_b"))
    keep = F.col(f"_b.{score}").isNotNull()
    return g.select(by, *[F.when(keep, F.col(f"_b.{c}")).alias(c) for c in ["trial_id", score] + params])


def naive_lag_scores(split: DataFrame, lags: list[int], by: str = "series_id", y: str = "y") -> DataFrame:
    """Score table ``(series_id, trial_id, lag, score)``: the naive forecast
    ``lag`` rows back, scored by MAE on the test rows.  One window pass for all
    lags, one aggregate, then ``stack`` -- no row fan-out per trial."""
    w = Window.partitionBy(by).orderBy("ds")
    lagged = split.withColumns({f"_l{k}": F.lag(y, k).over(w) for k in lags})
    test = F.col("split") == "test"
    agg = lagged.groupBy(by).agg(*[F.avg(F.when(test, F.abs(F.col(y) - F.col(f"_l{k}")))).alias(f"_s{k}")
                                   for k in lags])
    stack = "stack({n}, {rows}) as (trial_id, lag, score)".format(
        n=len(lags), rows=", ".join(f"{i}, {k}, _s{k}" for i, k in enumerate(lags, 1)))
    return agg.selectExpr(by, stack)
