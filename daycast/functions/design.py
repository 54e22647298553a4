"""Design columns of the seasonal regression (M1, M2, M4).

Model form after Taylor & Letham (2018): piecewise-linear trend with
changepoints, Fourier seasonality (weekly order 3, yearly order 10) and
standardised extra regressors.  All terms are plain column expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Seasonalities (period in days, Fourier order) and changepoints.
SEASONALITIES = [("weekly", 7.0, 3), ("yearly", 365.25, 10)]
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
EPOCH = "1970-01-01"


def epoch_days(ds: str = "ds") -> Column:
    return F.datediff(F.col(ds), F.lit(EPOCH).cast("date")).cast("double")


def fourier_names() -> list[str]:
    out = []
    for name, _p, order in SEASONALITIES:
        for k in range(1, order + 1):
            out += [f"{name}_sin{k}", f"{name}_cos{k}"]
    return out


def angular(period: float, k: int) -> float:
    """The constant ``2*pi*k/period`` (written once so engines agree bit for bit)."""
    return 2.0 * math.pi * k / period


def fourier_columns(ds: str = "ds") -> dict[str, Column]:
    t = epoch_days(ds)
    cols = {}
    for name, period, order in SEASONALITIES:
        for k in range(1, order + 1):
            w = angular(period, k)
            cols[f"{name}_sin{k}"] = F.sin(F.lit(w) * t)
            cols[f"{name}_cos{k}"] = F.cos(F.lit(w) * t)
    return cols


def changepoints() -> list[float]:
    """Changepoints evenly spread over the first ``CHANGEPOINT_RANGE`` of the history."""
    return [CHANGEPOINT_RANGE * j / N_CHANGEPOINTS for j in range(1, N_CHANGEPOINTS + 1)]


def with_trend_time(df: DataFrame, by: str = "series_id", ds: str = "ds", fit_mask: Column | None = None) -> DataFrame:
    """M1: ``t = (ds - first) / (last - first)`` with first/last over the fit rows of each series."""
    d = F.datediff(F.col(ds), F.lit(EPOCH).cast("date"))
    sel = d if fit_mask is None else F.when(fit_mask, d)
    w = Window.partitionBy(by)
    lo, hi = F.min(sel).over(w), F.max(sel).over(w)
    span = F.when(hi > lo, (hi - lo).cast("double")).otherwise(F.lit(1.0))
    return df.withColumn("t", (d - lo).cast("double") / span)


def hinge_names() -> list[str]:
    return [f"cp{j:02d}" for j in range(1, N_CHANGEPOINTS + 1)]


def hinge_columns(t: str = "t") -> dict[str, Column]:
    """M1: ``max(t - c_j, 0)`` for each changepoint (t is never NULL here)."""
    return {n: F.greatest(F.col(t) - F.lit(c), F.lit(0.0)) for n, c in zip(hinge_names(), changepoints())}


def standardize(df: DataFrame, cols: list[str], by: str = "series_id", fit_mask: Column | None = None,
                suffix: str = "_z") -> DataFrame:
    """M4: ``(x - mean) / std`` with mean and sample std over the fit rows only
    (no leakage from the test part); a zero or undefined std counts as 1."""
    w = Window.partitionBy(by)
    out = {}
    for c in cols:
        x = F.col(c) if fit_mask is None else F.when(fit_mask, F.col(c))
        mu = F.avg(x).over(w)
        sd = F.stddev_samp(x).over(w)
        sd = F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)
        out[c + suffix] = (F.col(c) - mu) / sd
    return df.withColumns(out)
