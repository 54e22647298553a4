"""Serving views over forecasts and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HISTORY_DAYS = 70


def forecast_with_actuals(forecast: DataFrame, actuals: DataFrame, by: str = "series_id") -> DataFrame:
    """J4 + P8: forecast columns inner-joined to actuals on ``ds = date``; both keys kept."""
    f = forecast.select(by, "ds", "yhat", "yhat_lower", "yhat_upper")
    a = actuals.select(F.col(by).alias("_s"), F.col("ds").alias("date"), F.col("y").alias("daily_conso_kwh"))
    return f.join(a, (f[by] == a["_s"]) & (f["ds"] == a["date"]), "inner").drop("_s")


def history_view(fa: DataFrame, days: int = HISTORY_DAYS, by: str = "series_id",
                 actual: str = "daily_conso_kwh") -> DataFrame:
    """Y1 (A6 + W8 + W7): up to the last observed day, then the last ``days`` days."""
    w = Window.partitionBy(by)
    last_obs = F.max(F.when(F.col(actual).isNotNull(), F.col("ds"))).over(w)
    capped = fa.withColumn("_last", last_obs).filter(F.col("ds") <= F.col("_last")).drop("_last")
    return capped.withColumn("_m", F.max("ds").over(w)).filter(
        F.col("ds") >= F.date_sub(F.col("_m"), days)).drop("_m")


def sort_days(df: DataFrame, by: str = "series_id", day: str = "ds") -> DataFrame:
    """Final-output order by series then day, missing days last.  A global
    sort is a range shuffle; use it on served views, not on intermediates."""
    return df.orderBy(F.col(by).asc_nulls_last(), F.col(day).asc_nulls_last())


def axis_bounds(view: DataFrame, by: str = "series_id", actual: str = "daily_conso_kwh") -> DataFrame:
    """NULL-skipping min/max over several columns, scaled by 0.95 / 1.05."""
    lo_cols = [actual, "yhat"] + (["yhat_lower"] if "yhat_lower" in view.columns else [])
    hi_cols = [actual, "yhat"] + (["yhat_upper"] if "yhat_upper" in view.columns else [])
    return view.groupBy(by).agg((F.min(F.least(*lo_cols)) * 0.95).alias("y_min"),
                                (F.max(F.greatest(*hi_cols)) * 1.05).alias("y_max"))


def append_history(history: DataFrame | None, run: DataFrame, dedup_on: list[str] | None = None,
                   order: str = "run_order") -> DataFrame:
    """Old history (empty if none) followed by the run rows.

    No dedup by default (a rerun appends again, as the reference does);
    ``dedup_on`` keeps one row per key, the one with the highest ``order``
    (an aggregation, so a heavily repeated key is collapsed map-side).
    """
    out = run if history is None else history.unionByName(run, allowMissingColumns=True)
    if not dedup_on:
        return out
    rest = [c for c in out.columns if c not in dedup_on]
    g = out.groupBy(*dedup_on).agg(F.max_by(F.struct(*rest), F.struct(F.col(order), F.struct(*rest))).alias("_r"))
    return g.select(*dedup_on, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*out.columns)


def scorecard(history: DataFrame, by: str = "series_id", order: str = "run_order") -> DataFrame:
    """Latest row per (model, series) of the metric history."""
    cols = [c for c in history.columns if c not in (by, "model_name", order)]
    # latest run first; equal runs resolved by the row itself (deterministic on recompute)
    g = history.groupBy("model_name", by).agg(
        F.max_by(F.struct(*cols), F.struct(F.col(order), F.struct(*cols))).alias("_r"))
    return g.select("model_name", by, *[F.col(f"_r.{c}").alias(c) for c in cols])
