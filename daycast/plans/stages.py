"""The pipeline stages (ingest -> clean -> merge -> features -> split -> fit
-> score -> evaluate -> decide) as lazy DataFrames.

Two boundaries are written as tables in the shared checkpoint folder, as the
reference writes its processed files: the raw daily weather (the one pass over
lineitem) and the full data, one row per series and day, which split, fit, score
and evaluation all read.  Up to there Catalyst sees the
whole chain, prunes columns, pushes filters into the scans and reuses the
exchanges behind the daily rollups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.functions.columns import cooling_degree_days, heating_degree_days
from daycast.operators.clean import repair_zeros
from daycast.operators.daily import daily_totals
from daycast.operators.evaluate import chronological_split, should_retrain, window_report
from daycast.operators.joins import weather_left_target
from daycast.operators.model import fit_trend_weekday, predict_trend_weekday
from daycast.operators.weather import keep_first_per_day, union_sources
from daycast.session import stage
from daycast.sources.fixtures import SEGMENT, order_readings, table, weather_daily

MODEL_TREND_WEEKDAY = "trend_weekday"


def daily_target(spark: SparkSession, sf_dir: str, series_cols: tuple[str, ...] = SEGMENT) -> DataFrame:
    """Daily target per series: totals rounded to cents, zeros repaired."""
    d = daily_totals(order_readings(spark, sf_dir, series_cols)).withColumn("y", F.round("y", 2))
    return repair_zeros(d).select("series_id", "ds", "jour", "y")


def weather_sources(spark: SparkSession, sf_dir: str, cut) -> tuple[DataFrame, DataFrame]:
    """Archive (days <= ``cut``, the last target day) and forecast (days >= it):
    one day overlaps.  The forecast copy carries temperatures +0.5 so that
    keep-first (archive wins) is visible in the output."""
    w = stage(weather_daily(spark, sf_dir), "weather_raw")  # one pass over lineitem for both
    archive = w.filter(F.col("ds") <= cut)
    forecast = w.filter(F.col("ds") >= cut).select(
        "ds", *[(F.col(c) + 0.5).alias(c) for c in ("temperature_max", "temperature_min", "temperature_mean")])
    return archive, forecast


def weather(spark: SparkSession, sf_dir: str, target: DataFrame | None = None) -> DataFrame:
    """Archive then forecast, first row per day kept: ``ds, temps..., src``.

    The cut is the last target day: from the target when given, else the last
    day of ``orders`` alone (no join for one date).
    """
    if target is not None:
        cut = target.select(F.max("ds")).scalar()
    else:
        cut = table(spark, sf_dir, "orders").select(F.max(F.to_date("o_orderdate"))).scalar()
    archive, forecast = weather_sources(spark, sf_dir, cut)
    u = union_sources(("archive", archive), ("forecast", forecast))
    return keep_first_per_day(u, cols=["temperature_max", "temperature_min", "temperature_mean", "src"])


def with_degree_days(df: DataFrame, temp: str = "temperature_mean") -> DataFrame:
    return df.withColumn("HDD", heating_degree_days(temp)).withColumn("CDD", cooling_degree_days(temp))


def staged_target(spark: SparkSession, sf_dir: str, series_cols: tuple[str, ...] = SEGMENT) -> DataFrame:
    """The daily target as a table, for consumers that read it more than once."""
    return stage(daily_target(spark, sf_dir, series_cols), "daily_target")


def full_data(spark: SparkSession, sf_dir: str, staged: bool = True,
              series_cols: tuple[str, ...] = SEGMENT) -> DataFrame:
    """J1 + F1/F2: every weather day per series, target NULL on future days.

    Written to the shared checkpoint folder for consumers that read it several
    times (split, fit, score, evaluate); ``staged=False`` leaves it lazy.
    """
    target = daily_target(spark, sf_dir, series_cols)
    wx = weather(spark, sf_dir, target)
    full = with_degree_days(weather_left_target(target, wx)).select(
        "series_id", "ds", "temperature_max", "temperature_min", "temperature_mean", "y", "HDD", "CDD")
    return stage(full, "full_data") if staged else full


def prepared_train(full: DataFrame) -> DataFrame:
    """P6 + P7: training rows ``series_id, ds, y, HDD, CDD``."""
    return full.filter(F.col("y").isNotNull()).select("series_id", "ds", "y", "HDD", "CDD")


def prepared_forecast(full: DataFrame) -> DataFrame:
    """Forecast rows (all days, target dropped) ``series_id, ds, HDD, CDD``."""
    return full.select("series_id", "ds", "HDD", "CDD")


def trend_weekday_scored(prepared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split, fit on the train part, score every prepared row."""
    split = chronological_split(prepared)
    coef = fit_trend_weekday(split.filter(F.col("split") == "train"))
    return predict_trend_weekday(split, coef), coef


def retrain_decision(spark: SparkSession, sf_dir: str, series_cols: tuple[str, ...] = SEGMENT) -> DataFrame:
    """Flagship: last-60-day MAE / MASE of the fitted model against the 7-day
    naive, per series, and the retrain flag (MASE > 0.95)."""
    prepared = prepared_train(full_data(spark, sf_dir, series_cols=series_cols))
    scored, _ = trend_weekday_scored(prepared)
    report = window_report(scored, MODEL_TREND_WEEKDAY)
    return report.withColumn("should_retrain", should_retrain(report))


def naive_scored(prepared: DataFrame, season: int = 7) -> DataFrame:
    """The seasonal naive used as a model (``yhat`` = value ``season`` rows earlier)."""
    from daycast.operators.evaluate import seasonal_naive

    return seasonal_naive(prepared, season).withColumnRenamed("naive", "yhat")


def forecast_frame(full: DataFrame) -> DataFrame:
    """Trend-weekday forecast for every day of ``full`` (history and future) with
    80 % residual bounds from the training part."""
    from daycast.operators.model import residual_bounds, with_bounds

    prepared = prepared_train(full)
    scored, coef = trend_weekday_scored(prepared)
    bounds = residual_bounds(scored.filter(F.col("split") == "train"))
    fc = predict_trend_weekday(full.select("series_id", "ds"), coef)
    return with_bounds(fc, bounds)


MODEL_RIDGE = "seasonal_ridge"


def ridge_design(full: DataFrame, holdout: int = 0) -> DataFrame:
    """Design rows for every day of ``full``: train/test(/holdout) by the
    chronological split of the observed rows, ``future`` for days without a target."""
    from daycast.functions.calendar import holiday_table, years_of
    from daycast.operators.ridge import design

    split = chronological_split(prepared_train(full), holdout=holdout)
    future = full.filter(F.col("y").isNull()).select("series_id", "ds", "y", "HDD", "CDD").withColumn(
        "split", F.lit("future"))
    rows = split.unionByName(future)
    return design(rows, holiday_table(years_of(full, "ds")))


def ridge_scored(design_df: DataFrame, coef: DataFrame) -> DataFrame:
    """Scores + 80 % residual bounds from the train rows."""
    from daycast.operators.model import residual_bounds, with_bounds
    from daycast.operators.ridge import predict

    scored = predict(design_df, coef)
    bounds = residual_bounds(scored.filter(F.col("split") == "train"))
    return with_bounds(scored, bounds)


def ridge_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5/M6/M8/M9 with the default prior scales."""
    from daycast.operators.ridge import DEFAULT_PARAMS, fit

    d = ridge_design(full_data(spark, sf_dir))
    return ridge_scored(d, fit(d, DEFAULT_PARAMS))


def tuned(spark: SparkSession, sf_dir: str, n_trials: int = 50, holdout: int = 0):
    """Random search scored by test MASE, best trial per series
    (ties -> lowest trial id), refit on the train rows, scored everywhere.
    A series without a defined score is fitted with the defaults."""
    from daycast.operators.ridge import DEFAULT_PARAMS, Ridge, fit
    from daycast.operators.tune import best_trial, search

    d = stage(ridge_design(full_data(spark, sf_dir), holdout), "design")
    best = stage(best_trial(search(d, Ridge(), n_trials), [*DEFAULT_PARAMS, "mode_used"]), "best")
    return ridge_scored(d, fit(d, best)).join(
        best.select("series_id", "trial_id", F.col("score").alias("test_mase")), "series_id", "left"), best
