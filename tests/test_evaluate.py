"""Metrics, split, retrain decision (E1-E6, W2-W4) on synthetic frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from daycast.operators import evaluate as EV


def _series(spark, values, sid="s"):
    d0 = dt.date(2024, 1, 1)
    return spark.createDataFrame([(sid, d0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)],
                                 "series_id string, ds date, y double")


def test_naive_scored_by_mase_is_one(spark):
    vals = [((i * 37) % 23) + i * 0.5 for i in range(100)]
    naive = EV.seasonal_naive(_series(spark, vals)).withColumnRenamed("naive", "yhat").filter("yhat is not null")
    rep = rows(EV.window_report(naive, "naive"), "mase_window")
    assert rep == [(1.0,)]


def test_constant_series_gives_null_mase(spark):
    df = _series(spark, [5.0] * 30).withColumn("yhat", F.lit(6.0))
    (mae, mase), = rows(EV.window_report(df, "m"), "mae_window", "mase_window")
    assert mae == 1.0 and mase is None


@pytest.mark.parametrize("n", [0, 1, 7, 8, 59, 60, 61])
def test_window_report_sizes(spark, n):
    vals = [float(i % 9) for i in range(n)]
    df = _series(spark, vals).withColumn("yhat", F.col("y") + 1.0) if n else \
        spark.createDataFrame([], "series_id string, ds date, y double, yhat double")
    rep = rows(EV.window_report(df, "m"), "window_size", "mae_window", "mase_window")
    if n == 0:
        assert rep == []
        return
    (ws, mae, mase), = rep
    assert ws == 60 and mae == 1.0
    if n <= 7:
        assert mase is None


def test_split_partitions_input(spark):
    df = _series(spark, range(101))
    s = EV.chronological_split(df)
    assert s.filter("split = 'train'").count() == 80
    assert s.count() == 101
    assert s.filter("split = 'train'").agg(F.max("ds")).first()[0] < s.filter("split = 'test'").agg(F.min("ds")).first()[0]


def test_retrain_flag_strict_and_null_default(spark):
    m = spark.createDataFrame([("a", 0.95), ("b", 0.9501), ("c", None)], "series_id string, mase_window double")
    assert sorted(rows(EV.retrain_flag(m), "series_id", "should_retrain")) == [("a", False), ("b", True), ("c", True)]
    with pytest.raises(ValueError):
        EV.retrain_flag(m, "not_a_metric")


def test_flags_default_true(spark):
    series = spark.createDataFrame([("a",), ("b",), ("c",)], "series_id string")
    flags = spark.createDataFrame([("a", False), ("b", None)], "series_id string, should_retrain boolean")
    assert sorted(rows(EV.flags_with_default(series, flags))) == [("a", False), ("b", True), ("c", True)]
    assert sorted(rows(EV.flags_with_default(series, None))) == [("a", True), ("b", True), ("c", True)]
    no_key = spark.createDataFrame([("a", "x")], "series_id string, other string")
    assert all(r[1] for r in rows(EV.flags_with_default(series, no_key)))


def test_train_flagged_only_semi_join(spark):
    train = _series(spark, range(5), "a").unionByName(_series(spark, range(3), "b"))
    flags = spark.createDataFrame([("a", True), ("b", False)], "series_id string, should_retrain boolean")
    out = EV.train_flagged_only(train, flags)
    assert out.count() == 5 and {r[0] for r in rows(out, "series_id")} == {"a"}


def test_history_append_and_optional_dedup(spark):
    from daycast.operators.serve import append_history

    run = spark.createDataFrame([("m", "s", 0.5, 1)], "model_name string, series_id string, mase double, run_order int")
    rerun = run.withColumn("run_order", F.lit(2)).withColumn("mase", F.lit(0.6))
    h = append_history(append_history(None, run), rerun)
    assert h.count() == 2
    d = append_history(append_history(None, run), rerun, dedup_on=["model_name", "series_id"])
    assert rows(d, "mase", "run_order") == [(0.6, 2)]


def test_split_with_disjoint_holdout(spark):
    s = EV.chronological_split(_series(spark, range(110)), holdout=10)
    counts = {r[0]: r[1] for r in s.groupBy("split").count().collect()}
    assert counts == {"train": 80, "test": 20, "holdout": 10}
    assert s.filter("split = 'holdout'").agg(F.min("ds")).first()[0] > s.filter("split = 'test'").agg(F.max("ds")).first()[0]
