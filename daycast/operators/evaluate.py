"""Evaluation and decision."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.functions.metrics import mae, mase

# Evaluation settings of the reference pipeline.
WINDOW_SIZE = 60
SEASON = 7
RETRAIN_THRESHOLD = 0.95
TRAIN_SHARE = 0.8


def seasonal_naive(df: DataFrame, season: int = SEASON, by: str = "series_id", order: str = "ds",
                   value: str = "y") -> DataFrame:
    """The value ``season`` rows earlier (rows, not days, as in the reference)."""
    w = Window.partitionBy(by).orderBy(order)
    return df.withColumn("naive", F.lag(value, season).over(w))


def last_n(df: DataFrame, n: int = WINDOW_SIZE, by: str = "series_id", order: str = "ds") -> DataFrame:
    """The last ``n`` rows of each series, with their position ``pos`` (1 = oldest)."""
    w = Window.partitionBy(by).orderBy(order)  # one sort serves position and count
    rn, size = F.row_number().over(w), F.count(F.lit(1)).over(Window.partitionBy(by))
    return (df.withColumns({"_rn": rn, "_n": size}).withColumn("pos", F.col("_rn") - F.greatest(F.col("_n") - n, F.lit(0)))
            .filter(F.col("pos") >= 1).drop("_rn", "_n"))


def chronological_split(df: DataFrame, share: float = TRAIN_SHARE, by: str = "series_id",
                        order: str = "ds", holdout: int = 0) -> DataFrame:
    """First ``floor(n * share)`` rows of each series are ``train``, the rest ``test``.

    ``holdout > 0`` first sets the last ``holdout`` rows aside as ``holdout``
    (never seen by tuning) and splits the rest; the default reproduces the
    reference, whose last-60 evaluation overlaps its tuning test part.
    """
    w = Window.partitionBy(by).orderBy(order)
    n = F.count(F.lit(1)).over(Window.partitionBy(by)) - F.lit(holdout)
    rn = F.col("_rn")
    return df.withColumn("_rn", F.row_number().over(w)).withColumn(
        "split", F.when(rn > n, F.lit("holdout"))
        .when(rn <= F.floor(n * F.lit(float(share))), F.lit("train")).otherwise(F.lit("test"))
    ).drop("_rn")


def window_report(scored: DataFrame, model_name: str, window_size: int = WINDOW_SIZE,
                  season: int = SEASON, by: str = "series_id", y: str = "y", yhat: str = "yhat",
                  places: int = 4) -> DataFrame:
    """MAE over the last ``window_size`` rows and MASE (against the naive
    ``season`` rows earlier, inside the window), both rounded.

    ``scored`` holds observed rows only (``y`` not NULL) with a prediction.
    Window sizes beyond the available rows are echoed as given.
    """
    last = last_n(scored.filter(F.col(y).isNotNull()), window_size, by)
    last = last.withColumn("naive", F.lag(y, season).over(Window.partitionBy(by).orderBy("pos")))
    return last.groupBy(by).agg(
        F.round(mae(y, yhat), places).alias("mae_window"),
        F.round(mase(y, yhat, "naive", "pos", season), places).alias("mase_window"),
    ).select(by, F.lit(model_name).alias("model_name"), F.lit(window_size).alias("window_size"),
             F.lit(f"naive_{season}_days").alias("baseline"), "mae_window", "mase_window")


def should_retrain(metrics: DataFrame, metric_key: str = "mase_window", threshold: float = RETRAIN_THRESHOLD):
    """E4 as a column: ``metric > threshold`` (strict); a NULL score means retrain;
    an unknown metric name is an error."""
    if metric_key not in metrics.columns:
        raise ValueError(f"cannot compute retrain flag: missing metric {metric_key!r}")
    return F.coalesce(F.col(metric_key) > F.lit(threshold), F.lit(True))


def retrain_flag(metrics: DataFrame, metric_key: str = "mase_window",
                 threshold: float = RETRAIN_THRESHOLD, by: str = "series_id") -> DataFrame:
    """``series_id[, model_name], metric_value, should_retrain``."""
    flag = should_retrain(metrics, metric_key, threshold)
    keep = [c for c in (by, "model_name") if c in metrics.columns]
    return metrics.select(*keep, F.col(metric_key).alias("metric_value"), flag.alias("should_retrain"))


def flags_with_default(series: DataFrame, flags: DataFrame | None, by: str = "series_id") -> DataFrame:
    """Every series gets a flag; absent file, row or key -> ``True``."""
    s = series.select(by).distinct()
    if flags is None or "should_retrain" not in flags.columns:
        return s.withColumn("should_retrain", F.lit(True))
    # a flag that is no boolean counts as absent; of several flags any True wins
    f = flags.groupBy(by).agg(F.bool_or(F.col("should_retrain").cast("string").try_cast("boolean")).alias("_f"))
    return s.join(f, by, "left").select(by, F.coalesce("_f", F.lit(True)).alias("should_retrain"))


def train_flagged_only(train: DataFrame, flags: DataFrame, by: str = "series_id") -> DataFrame:
    """Keep the training rows of series whose flag says retrain (semi join)."""
    return train.join(flags.filter(F.col("should_retrain")).select(by), by, "left_semi")


def gate(df: DataFrame, report_flags: DataFrame, by: str = "series_id") -> tuple[DataFrame, DataFrame]:
    """E5: rows of valid series go on; all others go to a rejects frame, those that the report does not name included."""
    ok = report_flags.filter(F.col("is_valid")).select(by)
    return df.join(ok, by, "left_semi"), df.join(ok, by, "left_anti")
