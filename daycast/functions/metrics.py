"""Metric builders (X2): a name maps to an aggregate Column builder.

All metrics are aggregates over the scored rows of one group, so they run
as partial + final aggregation keyed by the series (and trial) columns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def mae(y: str = "y", yhat: str = "yhat") -> Column:
    """A4: mean absolute error."""
    return F.avg(F.abs(F.col(y) - F.col(yhat)))


def mase(y: str = "y", yhat: str = "yhat", naive: str = "naive", pos: str = "pos", season: int = 7) -> Column:
    """MAE of the model over rows ``season+1..n`` divided by the MAE of the
    seasonal naive (value ``season`` rows earlier) over the same rows; NULL when
    the naive error is 0 or there is no pair (rule N6)."""
    keep = F.col(pos) > season
    num = F.avg(F.when(keep, F.abs(F.col(y) - F.col(yhat))))
    den = F.avg(F.when(keep, F.abs(F.col(y) - F.col(naive))))
    return F.try_divide(num, den)


METRICS = {"mae": mae, "mase": mase}


def mae_array(y: np.ndarray, yhat: np.ndarray) -> float:
    return float(np.mean(np.abs(y - yhat))) if len(y) else float("nan")


def mase_array(y: np.ndarray, yhat: np.ndarray, season: int = 7) -> float:
    """E2 on arrays: model MAE over rows season+1..n over the naive MAE there."""
    if len(y) <= season:
        return float("nan")
    den = np.mean(np.abs(y[season:] - y[:-season]))
    return float(np.mean(np.abs(y[season:] - yhat[season:])) / den) if den else float("nan")


#: The same metrics inside a fitting task: name -> f(y, yhat), NaN where undefined.
ARRAY_METRICS = {"mae": mae_array, "mase": mase_array}


def metric(name: str, **kw) -> Column:
    try:
        return METRICS[name](**kw)
    except KeyError:
        raise ValueError(f"unknown metric {name!r}; known: {sorted(METRICS)}") from None
