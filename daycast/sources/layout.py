"""Readings laid out by day (S4, S5, B1): a folder per day, bounded files, pruned fetches.

``daily`` mode fetches one day of a table that keeps growing.  Over one folder
per day the filter on the day is a partition filter: Spark lists and reads that
folder alone.  A day delivered again replaces its folder and no other.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.operators.daily import fetch_window

DAY = "reading_day"
#: Rows in a file, at most.
FILE_ROWS = 4_000_000


def write_days(readings: DataFrame, path: str, ts: str = "ts", rows: int = FILE_ROWS) -> None:
    """Writes ``readings`` under a folder per day; days present replace their folders, all others stay.

    Rows of a day are dealt to as many tasks as it has files (counted first, one
    row per day, so a day that holds a third of all rows is no single task).
    Rows without a time go to a folder of their own and are never fetched.
    """
    dated = readings.withColumn(DAY, F.to_date(ts))
    files = dated.groupBy(DAY).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("_files")).withColumnRenamed(DAY, "_day")
    lot = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c, t in readings.dtypes if not t.startswith("map")]), F.col("_files"))
    # one row per calendar day: bounded by the calendar, so it is sent to all tasks
    dealt = dated.join(F.broadcast(files), F.col(DAY).eqNullSafe(F.col("_day"))).withColumn("_lot", lot)
    (dealt.repartition(DAY, "_lot").sortWithinPartitions(DAY, ts).drop("_lot", "_files", "_day")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows).partitionBy(DAY).parquet(path))


def fetch_days(spark: SparkSession, path: str, mode: str = "full", as_of=None, start=None, ts: str = "ts") -> DataFrame:
    """S4 over the layout: the window of :func:`fetch_window`, with the days it spans as a partition filter."""
    df = spark.read.parquet(path)
    df = df.withColumn(DAY, F.col(DAY).cast("date"))
    out = fetch_window(df, mode, as_of=as_of, start=start, ts=ts)
    if mode == "daily":
        day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])
        out = out.filter(F.col(DAY) == F.lit((day - _dt.timedelta(days=1)).isoformat()).cast("date"))
    elif start is not None:
        out = out.filter(F.col(DAY) >= F.lit(str(start)[:10]).cast("date"))
    return out.drop(DAY)
