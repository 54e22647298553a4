"""Stored split points: one busy day over several tasks, the same neighbours as a plain window."""

import datetime as dt
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daycast.operators import sequence as SQ
from daycast.operators.clean import repair_zeros_raw
from daycast.session import checkpoint_dir, drop_stage

DAY = dt.datetime(2024, 3, 31)  # clocks change on this day in many zones
ORDER = ["ts", "event_id"]


def readings(spark, n=3000):
    """One series, one day; a third of the rows at one instant; a second, small series; a NULL key and NULL instants."""
    rows = [("a", i, DAY + dt.timedelta(seconds=0 if i % 3 == 0 else (i * 7919) % 86400), 0.0 if i % 7 == 0 else float(i)) for i in range(n)]
    rows += [("b", 10_000 + i, DAY + dt.timedelta(hours=i), float(i % 2)) for i in range(20)]
    rows += [(None, 20_000 + i, DAY + dt.timedelta(minutes=i % 5), float(i)) for i in range(400)]
    rows += [("a", 30_000 + i, None, 1.0) for i in range(3)]
    return spark.createDataFrame(rows, "series_id string, event_id long, ts timestamp_ntz, value double").repartition(7)


def plain(df):
    w = Window.partitionBy("series_id").orderBy(*ORDER)
    return df.withColumns({**{f"value_prev{j}": F.lag("value", j).over(w) for j in (1, 2)}, **{f"value_next{j}": F.lead("value", j).over(w) for j in (1, 2)}})


def rows_of(df):
    return sorted((tuple(r) for r in df.select("series_id", "event_id", "ts", "value", "value_prev1", "value_prev2", "value_next1", "value_next2").collect()), key=str)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_equals_the_plain_window(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = readings(spark)
        points = SQ.split_points(df, "series_id", ORDER, rows=100, parts=16)
        got = SQ.ordered_neighbors(df, "series_id", ORDER, "value", before=2, after=2, points=points)
        assert rows_of(got) == rows_of(plain(df))
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")


def test_a_hot_day_spreads(spark):
    """No part of the day holds more than a few times its share, the instant with a third of the rows included."""
    df = readings(spark)
    points = SQ.split_points(df, "series_id", ORDER, rows=100, parts=16)
    assert sorted((r["series_id"] is None, len(r["_cuts"]) > 3, len(r["_ties"]) > 0) for r in points.collect()) == [(False, True, True), (True, True, True)]
    p = points.withColumnRenamed("series_id", "_pk")
    parts = df.withColumn("_b0", SQ.bucket_of(df, "ts")).join(p, ["_b0"], "inner").filter("series_id <=> _pk and ts is not null").withColumn("part", SQ._part(df, ORDER))
    counts = {r["part"]: r["count"] for r in parts.filter("series_id = 'a'").groupBy("part").count().collect()}
    assert len(counts) >= 24 and max(counts.values()) <= 2 * 3000 / 16
    # parts follow the order
    along = [r["part"] for r in parts.filter("series_id = 'a'").orderBy(*ORDER).collect()]
    assert along == sorted(along)


def test_small_buckets_have_no_points(spark):
    df = readings(spark)
    points = SQ.split_points(df, "series_id", ORDER)
    assert points.count() == 0
    got = SQ.ordered_neighbors(df, "series_id", ORDER, "value", before=2, after=2, points=points)
    assert rows_of(got) == rows_of(plain(df))


def test_one_order_column_and_integer_buckets(spark):
    df = spark.range(2000).select(F.lit("s").alias("series_id"), F.col("id").alias("event_id"), (F.col("id") % 5).cast("double").alias("value"))
    points = SQ.split_points(df, "series_id", ["event_id"], rows=50, parts=8)
    got = SQ.ordered_neighbors(df, "series_id", ["event_id"], "value", before=1, after=1, points=points)
    w = Window.partitionBy("series_id").orderBy("event_id")
    want = df.withColumns({"value_prev1": F.lag("value", 1).over(w), "value_next1": F.lead("value", 1).over(w)})
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_repair_over_a_split_day(spark):
    df = readings(spark).filter("ts is not null")
    points = SQ.split_points(df, "series_id", ORDER, rows=100, parts=16)
    got = repair_zeros_raw(df, "series_id", ORDER, "value", points=points)
    w = Window.partitionBy("series_id").orderBy(*ORDER).rowsBetween(-2, 2)
    want = df.withColumn("value", F.when(F.col("value") == 0, F.avg(F.nullif("value", F.lit(0.0))).over(w)).otherwise(F.col("value")))
    key = lambda d: {r["event_id"]: r["value"] for r in d.collect()}
    a, b = key(got), key(want)
    assert a.keys() == b.keys() and all(a[i] == b[i] or abs(a[i] - b[i]) < 1e-9 for i in a if a[i] is not None or b[i] is not None)


def test_the_sketch_is_written_once(spark):
    df = readings(spark)
    points = SQ.split_points(df, "series_id", ORDER, rows=100, parts=16)
    folder = points._daycast_stage
    assert folder.startswith(checkpoint_dir(spark)) and os.path.isdir(folder)
    got = SQ.ordered_neighbors(df, "series_id", ORDER, "value", before=1, points=points)
    assert "percentile" not in got._jdf.queryExecution().optimizedPlan().toString()  # read back, not sketched again by a branch
    drop_stage(points)
    assert not os.path.isdir(folder)
