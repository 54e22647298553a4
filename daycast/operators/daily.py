"""Remote-side query rebuilt over raw readings (B1-B7) and fetch modes.

The heavy step of the whole engine is here: raw readings -> one row per
(series, day).  It is a plain grouping, so Catalyst plans a partial
(map-side) aggregate before the shuffle; a hot series or a hot day is
collapsed inside each map task and never reaches one reducer whole.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def time_filter(df: DataFrame, start=None, end=None, ts: str = "ts") -> DataFrame:
    """B1: half-open ``start <= ts < end``; either bound may be omitted.

    Literal bounds keep the predicate pushable into the Parquet scan.
    """
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(ts) < F.lit(end))
    return df.filter(cond)


def facet_filter(df: DataFrame, facets: dict | None) -> DataFrame:
    """B2: AND of equality facets (``refine[k] = v``)."""
    if not facets:
        return df
    cond = reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in facets.items()])
    return df.filter(cond)


def fetch_window(readings: DataFrame, mode: str = "full", as_of=None, start=None,
                 ts: str = "ts") -> DataFrame:
    """``full`` = everything from ``start``; ``daily`` = ``[as_of - 1 day, as_of)``.

    ``as_of`` is an argument (rule N8), never the wall clock.
    """
    if mode == "full":
        return time_filter(readings, start=start, ts=ts)
    if mode == "daily":
        if as_of is None:
            raise ValueError("mode='daily' needs as_of")
        day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])
        lo = _dt.datetime.combine(day - _dt.timedelta(days=1), _dt.time())
        hi = _dt.datetime.combine(day, _dt.time())
        return time_filter(readings, start=lo, end=hi, ts=ts)
    raise ValueError(f"unknown fetch mode {mode!r}; use 'full' or 'daily'")


def daily_totals(readings: DataFrame, by: str = "series_id", ts: str = "ts",
                 value: str = "value") -> DataFrame:
    """``series_id, ds, jour = min(ts), y = sum(value), n_readings``.

    ``jour`` is the first reading of the bucket, not the bucket start (B4).
    Days without readings produce no row; gaps are reported by validation.
    """
    return readings.groupBy(by, F.to_date(ts).alias("ds")).agg(
        F.min(ts).alias("jour"),
        F.sum(value).alias("y"),
        F.count(F.lit(1)).alias("n_readings"),
    )


def tumbling_day(readings: DataFrame, by: str = "series_id", ts: str = "ts",
                 value: str = "value") -> DataFrame:
    """B3 through Spark's ``window`` (same buckets as the streaming form Z1)."""
    return readings.groupBy(by, F.window(F.col(ts).cast("timestamp"), "1 day").alias("w")).agg(
        F.min(ts).alias("jour"), F.sum(value).alias("y"), F.count(F.lit(1)).alias("n_readings"),
    ).select(by, F.to_date("w.start").alias("day_start"), F.to_date("w.end").alias("day_end"),
             "jour", "y", "n_readings")


def first_n(daily: DataFrame, n: int, by: str = "series_id", order: str = "jour") -> DataFrame:
    """One sort of all rows by ``jour`` ascending (NULLs last), the first ``n`` of them.

    Planned as a top-n: each task keeps ``n`` rows, so nothing is sorted whole.
    """
    return daily.orderBy(F.col(order).asc_nulls_last(), F.col("ds").asc_nulls_last(), by).limit(n)


def first_n_days(daily: DataFrame, n: int, by: str = "series_id", order: str = "jour") -> DataFrame:
    """B6-B7 per series: order by ``jour`` ascending (NULLs last), keep the first ``n`` of each.

    A per-series row_number over daily rows: the window input per series is
    bounded by the number of days, whatever the raw volume.
    """
    w = Window.partitionBy(by).orderBy(F.col(order).asc_nulls_last(), F.col("ds").asc_nulls_last())
    return daily.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def ingest_profile(daily: DataFrame, series: DataFrame | None = None, by: str = "series_id") -> DataFrame:
    """A1: rows, first and last day per series.  With a series list, series with
    no rows appear with ``n_rows = 0`` (the empty-input warning)."""
    prof = daily.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.min("ds").alias("first_day"),
                                 F.max("ds").alias("last_day"))
    if series is None:
        return prof
    return series.select(by).distinct().join(prof, by, "left").select(
        by, F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "first_day", "last_day",
        (F.coalesce("n_rows", F.lit(0)) == 0).alias("is_empty"))
