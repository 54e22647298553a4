"""Sortedness by summaries, gaps without a calendar, duplicates by fingerprints, the gate: against plain windows and groupings."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daycast.operators import validate as V
from daycast.operators.evaluate import gate

from conftest import SMALL, rows


def readings(spark, n=600, seed=1):
    rng = random.Random(seed)
    out = []
    for key in ("a", "b", None):
        day = dt.date(2024, 1, 1)
        for i in range(n if key == "a" else 80):
            day += dt.timedelta(days=rng.choice([0, 0, 1, 1, -1]) if key == "a" else 1)
            out.append((key, i * 3 - 40, None if rng.random() < 0.05 and key == "a" else day))
    rng.shuffle(out)
    return spark.createDataFrame(out, "series_id string, seq long, ds date")


def plain(df):
    w = Window.partitionBy("series_id").orderBy("seq")
    bad = F.col("ds").isNull() | (F.lag("ds").over(w) > F.col("ds"))
    return df.withColumn("bad", F.coalesce(bad, F.lit(False))).groupBy("series_id").agg(F.count_if("bad").alias("n_inversions")).withColumn(
        "is_sorted", F.col("n_inversions") == 0)


@pytest.mark.parametrize("bits", [2, 5, 40])
@pytest.mark.parametrize("deal", ["shuffled", "in order", "one"])
def test_sortedness_equals_the_plain_window(spark, monkeypatch, bits, deal):
    monkeypatch.setattr(V, "ID_BITS", bits)
    df = readings(spark)
    df = {"shuffled": df.repartition(7), "in order": df.repartitionByRange(6, "seq"), "one": df.coalesce(1)}[deal]
    assert sorted(rows(V.sortedness(df, "seq", "ds")), key=str) == sorted(rows(plain(df)), key=str)


def test_sortedness_over_batch_boundaries(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = readings(spark, seed=2)
        assert sorted(rows(V.sortedness(df, "seq", "ds")), key=str) == sorted(rows(plain(df)), key=str)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_no_window_over_raw_rows(spark):
    """Windows see summaries only: everything under one comes from the written parts or an Arrow summary."""
    df = readings(spark)
    text = V.sortedness(df, "seq", "ds")._jdf.queryExecution().optimizedPlan().toString()
    windows = [ln for ln in text.splitlines() if "Window [" in ln]
    assert windows and all("last_seq" in ln or "last_day" in ln for ln in windows)


def test_sortedness_of_no_rows(spark):
    assert V.sortedness(readings(spark).filter("false"), "seq", "ds").count() == 0


def test_missing_days_have_no_generator_and_no_join(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, d)) for d in (1, 2, 5, 5, 9, 10)] + [("t", dt.date(2024, 1, 1)), ("t", None), (None, dt.date(2024, 1, 1)),
                               (None, dt.date(2024, 1, 3)), ("u", None)], "series_id string, ds date")
    out = V.missing_days_report(df)
    assert sorted(rows(out), key=str) == [("s", 5, "2024-01-03 to 2024-01-08"), ("t", 0, None), (None, 1, "2024-01-02 to 2024-01-02")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


WIDE = "series_id string, a double, b string, c array<int>, d struct<x:int,y:string>"


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_fingerprints_equal_the_grouping(spark, monkeypatch, limit):
    """Many copies of one row, NULLs in other places, -0.0 and NaN; few repeated fingerprints are sent, many are joined."""
    monkeypatch.setattr(V, "SENT_FINGERPRINTS", limit)
    nan = float("nan")
    data = [("s", 1.0, "x", [1, None], (1, None))] * 50 + [("s", None, "x", None, None), ("s", 1.0, None, None, None), ("s", 0.0, "z", [], (None, "q")),
            ("s", -0.0, "z", [], (None, "q")), ("t", nan, None, None, None), ("t", nan, None, None, None), ("t", 2.0, None, None, None),
            (None, 1.0, "x", [1], None), (None, 1.0, "x", [1], None), ("u", 5.0, "only", None, None)]
    df = spark.createDataFrame(data, WIDE).repartition(5)
    assert sorted(rows(V.duplicate_rows_wide(df)), key=str) == sorted(rows(V.duplicate_rows(df)), key=str)
    assert {k: n for k, n in rows(V.duplicate_rows_wide(df))} == {"s": 50, "t": 1, None: 1, "u": 0}


def test_collisions_count_for_nothing(spark, monkeypatch):
    """All fingerprints alike: the rows themselves decide."""
    monkeypatch.setattr(V.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    df = spark.createDataFrame([("s", 1), ("s", 2), ("s", 2), ("t", 1)], "series_id string, v int")
    assert {k: n for k, n in rows(V.duplicate_rows_wide(df))} == {"s": 1, "t": 0}


def test_duplicates_shuffle_a_fraction(spark):
    """Wide rows without copies: fingerprints are shuffled, the rows are not."""
    df = spark.range(20_000).select(F.lit("s").alias("series_id"), *[F.concat(F.lit("some text "), F.md5(F.concat("id", F.lit(i)))).alias(f"c{i}") for i in range(12)])

    lines = V.duplicate_rows_wide(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    wide = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln and "c11" in ln]
    join = [i for i, ln in enumerate(lines) if "BroadcastHashJoin [_f" in ln and "LeftSemi" in ln]
    # what is regrouped as a whole has gone through the semi join with the repeated fingerprints first
    assert len(wide) == 1 and len(join) == 1 and wide[0] < join[0]


def test_every_series_passes_or_is_rejected(spark):
    """Three series, one without any target: each is in exactly one frame."""
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("b", dt.date(2024, 1, 1), None), ("c", dt.date(2024, 1, 1), 2.0),
                                ("c", dt.date(2024, 1, 3), 2.0)], "series_id string, ds date, y double")
    report = V.validation_report(df)
    flags = {r["series_id"]: (r["n_rows"], r["is_valid"]) for r in report.collect()}
    assert flags == {"a": (1, True), "b": (0, False), "c": (2, False)}
    ok, bad = gate(df, report)
    assert sorted(rows(ok, "series_id")) == [("a",)] and sorted(rows(bad, "series_id")) == [("b",), ("c",), ("c",)]
    # a report that does not name a series, and rows without one
    more = df.unionByName(spark.createDataFrame([("d", None, 1.0), (None, None, 1.0)], df.schema))
    ok, bad = gate(more, report)
    assert ok.count() + bad.count() == more.count() and {r[0] for r in rows(bad, "series_id")} == {"b", "c", "d", None}
