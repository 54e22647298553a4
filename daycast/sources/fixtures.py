"""Driver tables standing in for the domain data (see FIXTURES.md §3).

* readings      <- events                  series = event_type
* order readings <- orders JOIN customer   series = c_mktsegment
* weather       <- lineitem by ship day    max / min / avg of l_quantity

Every function returns a lazy DataFrame; Catalyst prunes the Parquet scan to the
columns actually used and pushes filters into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.functions.columns import nan_to_null


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-daily readings: ``series_id, event_id, ts, value, props``.

    ``event_id`` is the ingest ordinal used as the tie-breaker (rule N3).
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_type").alias("series_id"),
        "event_id",
        "ts",
        nan_to_null("value").alias("value"),
        "props",
    )


SEGMENT = ("c_mktsegment",)
SEGMENT_NATION = ("c_mktsegment", "c_nationkey")


def order_readings(spark: SparkSession, sf_dir: str, series_cols: tuple[str, ...] = SEGMENT) -> DataFrame:
    """Orders as readings of their customer's series (market segment by
    default; several customer columns give ``a|b`` series keys).

    ``orders`` is the fact side; ``customer`` contributes two columns.  The
    join is left to the planner: AQE turns it into a broadcast join only when
    the runtime size of the customer side is under the broadcast threshold,
    and splits a hot ``o_custkey`` partition (skew join) otherwise.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", *series_cols)
    sid = F.col(series_cols[0]) if len(series_cols) == 1 else \
        F.concat_ws("|", *[F.col(x).cast("string") for x in series_cols])
    return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        sid.alias("series_id"),
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderdate").alias("ts"),
        nan_to_null("o_totalprice").alias("value"),
    )


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ship day: ``ds, temperature_max, temperature_min, temperature_mean``.

    A grouping on the day with partial aggregation: the shuffle carries one
    row per (map task, day), so its size is bounded by the calendar.
    """
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", nan_to_null("l_quantity").alias("q"))
    return li.groupBy(F.to_date("l_shipdate").alias("ds")).agg(
        F.max("q").alias("temperature_max"),
        F.min("q").alias("temperature_min"),
        F.avg("q").alias("temperature_mean"),
    )
