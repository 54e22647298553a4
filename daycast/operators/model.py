"""Forecast model, SQL-expressible tier.

``trend_weekday``: ordinary least squares trend on the day number plus the
mean residual by weekday.  Fit, scoring and bounds are aggregates and joins
keyed by ``series_id`` -- no Python in the path.  The coefficient table has
one row per series, so joining it back to the design rows is cheap; AQE
broadcasts it when it is small and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def day_number(ds: str = "ds"):
    return F.datediff(F.col(ds), F.lit(EPOCH).cast("date")).cast("double")


def fit_trend_weekday(train: DataFrame, by: str = "series_id", y: str = "y") -> DataFrame:
    """M7 fit -> ``series_id, intercept, slope, wd_effect map<int,double>``."""
    t = train.filter(F.col(y).isNotNull()).select(by, "ds", y, day_number().alias("t"),
                                                  F.weekday("ds").alias("wd"))
    lin = t.groupBy(by).agg(F.regr_intercept(y, "t").alias("intercept"), F.regr_slope(y, "t").alias("slope"))
    res = t.join(lin, by).withColumn("r", F.col(y) - (F.col("intercept") + F.col("slope") * F.col("t")))
    wd = res.groupBy(by, "wd").agg(F.avg("r").alias("eff")).groupBy(by).agg(
        F.map_from_entries(F.collect_list(F.struct("wd", "eff"))).alias("wd_effect"))
    return lin.join(wd, by, "left")


def predict_trend_weekday(rows: DataFrame, coef: DataFrame, by: str = "series_id") -> DataFrame:
    """M8 for M7: ``yhat = intercept + slope * t + weekday effect`` (0 for an unseen
    weekday; NULL for a series without a fit, which then has to be trained)."""
    j = rows.join(coef, by, "left")
    yhat = F.col("intercept") + F.col("slope") * day_number() + \
        F.coalesce(F.element_at("wd_effect", F.weekday("ds")), F.lit(0.0))
    return j.withColumn("yhat", yhat).drop("intercept", "slope", "wd_effect")


def residual_bounds(scored_train: DataFrame, lower: float = 0.1, upper: float = 0.9,
                    by: str = "series_id", y: str = "y") -> DataFrame:
    """M9: per-series residual quantiles on training rows (exact ``percentile``;
    a group holds one value per training day)."""
    r = scored_train.filter(F.col(y).isNotNull()).withColumn("_res", F.col(y) - F.col("yhat"))
    return r.groupBy(by).agg(F.percentile("_res", lower).alias("q_lo"), F.percentile("_res", upper).alias("q_hi"))


def with_bounds(scored: DataFrame, bounds: DataFrame, by: str = "series_id") -> DataFrame:
    return scored.join(bounds, by, "left").withColumn("yhat_lower", F.col("yhat") + F.col("q_lo")).withColumn(
        "yhat_upper", F.col("yhat") + F.col("q_hi")).drop("q_lo", "q_hi")


def coefficients_long(coef: DataFrame, model_name: str, by: str = "series_id") -> DataFrame:
    """The coefficient table in tall form ``(model_name, series_id, term, coef)``."""
    base = coef.select(by, F.explode(F.map_concat(
        F.create_map(F.lit("intercept"), F.col("intercept"), F.lit("slope"), F.col("slope")),
        F.transform_keys("wd_effect", lambda k, v: F.concat(F.lit("wd"), k.cast("string"))),
    )).alias("term", "coef"))
    return base.select(F.lit(model_name).alias("model_name"), by, "term", "coef")


def coefficients_wide(long: DataFrame, by: str = "series_id") -> DataFrame:
    """Inverse of :func:`coefficients_long` (M11 load)."""
    g = long.groupBy("model_name", by).agg(F.map_from_entries(F.collect_list(F.struct("term", "coef"))).alias("m"))
    wd = F.map_from_entries(F.filter(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda d: F.struct(
        d.alias("wd"), F.element_at("m", F.concat(F.lit("wd"), d.cast("string"))).alias("eff"))),
        lambda s: s["eff"].isNotNull()))
    return g.select("model_name", by, F.element_at("m", F.lit("intercept")).alias("intercept"),
                    F.element_at("m", F.lit("slope")).alias("slope"), wd.alias("wd_effect"))


def model_fallback(primary: DataFrame, fallback: DataFrame, series: DataFrame, by: str = "series_id") -> DataFrame:
    """Per series, the primary (registry) model if present, else the local
    one; series with neither are listed with ``source = NULL``."""
    p = primary.select(by, F.struct(*[c for c in primary.columns if c != by]).alias("_p"))
    f = fallback.select(by, F.struct(*[c for c in fallback.columns if c != by]).alias("_f"))
    j = series.select(by).distinct().join(p, by, "left").join(f, by, "left")
    return j.select(by, F.when(F.col("_p").isNotNull(), F.lit("primary"))
                    .when(F.col("_f").isNotNull(), F.lit("fallback")).alias("source"),
                    F.coalesce("_p", "_f").alias("model"))
