"""Joins of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def series_calendar(series: DataFrame, lo, hi, by: str = "series_id") -> DataFrame:
    """Every day ``lo..hi`` for every series, by a generator (no cross join).

    ``lo``/``hi`` are Columns (scalar subqueries or per-row bounds).
    """
    return series.select(by, F.explode(F.sequence(lo, hi)).alias("ds"))


def require_keys(inputs: dict[str, DataFrame], keys: list[str]) -> None:
    """Every input must carry the join keys; the error names every faulty
    input (a schema check on the driver, no job)."""
    bad = [f"{name} (missing {[k for k in keys if k not in df.columns]})"
           for name, df in inputs.items() if any(k not in df.columns for k in keys)]
    if bad:
        raise ValueError(f"join key(s) {keys} missing in: {', '.join(bad)}")


def weather_left_target(target: DataFrame, weather: DataFrame, by: str = "series_id") -> DataFrame:
    """All weather days for each series, target left-joined (future days keep NULL y).

    The spine is generated per series from the weather bounds (one scalar
    subquery returning both).  The weather holds one row per calendar day, so it
    is bounded like the holidays and broadcast; the spine (series x days) never is.
    """
    require_keys({"target": target, "weather": weather}, ["ds"])
    require_keys({"target": target}, [by])
    bounds = weather.select(F.struct(F.min("ds").alias("lo"), F.max("ds").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    series = target.select(by).distinct()
    spine = series_calendar(series, lo, hi, by).join(F.broadcast(weather), "ds", "inner")
    return spine.join(target, [by, "ds"], "left")


def inner_on_day(left: DataFrame, right: DataFrame, by: str = "series_id") -> DataFrame:
    """Inner join on ``(series_id, ds)`` (never on row position)."""
    return left.join(right, [by, "ds"], "inner")
