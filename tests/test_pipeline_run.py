"""End-to-end run twice into one artifact folder (decide -> train -> evaluate -> flag)."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from daycast.operators import ridge as RG
from daycast.plans import stages as P
from daycast.plans.run import run_pipeline
from daycast.session import scratch_path
from daycast.sources import sinks as SK


GAP_FREE = "/root/testdata/sf0.1"


def test_gate_rejects_series_with_missing_days(spark):
    root = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    out = run_pipeline(spark, SMALL, root, "2026-01-01T00:00:00", n_trials=2)
    bad = {r["series_id"] for r in out["report"].filter("not is_valid").collect()}
    assert bad and {r["series_id"] for r in out["rejected"].select("series_id").distinct().collect()} == bad
    assert out["metrics"].join(out["rejected"], "series_id", "left_semi").count() == 0


def test_two_runs(spark):
    root = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    out1 = run_pipeline(spark, GAP_FREE, root, "2026-01-01T00:00:00", n_trials=6)
    m1 = out1["metrics"].collect()
    assert len(m1) >= 1 and all(r["window_size"] == 60 for r in m1)
    assert out1["unavailable"].count() == 0
    out2 = run_pipeline(spark, GAP_FREE, root, "2026-01-02T00:00:00", n_trials=6)
    assert out2["metrics"].count() == len(m1)
    hist = SK.read_artifact(spark, root, "metrics_history")
    assert hist.count() == 2 * len(m1)  # appended, not deduplicated (as the reference)
    flags = SK.read_artifact(spark, root, "retrain_flag")
    assert set(flags.columns) >= {"date", "series_id", "should_retrain"}
    fc = SK.read_artifact(spark, root, "forecast")
    assert fc.filter(F.col("yhat_lower") > F.col("yhat_upper")).count() == 0


def test_coefficient_table_round_trip(spark):
    design = P.ridge_design(P.full_data(spark, SMALL))
    coef = RG.fit(design, RG.DEFAULT_PARAMS)
    assert RG.predict(design, coef).filter(F.col("yhat").isNull()).count() == 0
    back = RG.coefficients_from_table(RG.coefficients_table(coef, "m"))
    a = {r["series_id"]: r["coef"] for r in coef.collect()}
    b = {r["series_id"]: r["coef"] for r in back.collect()}
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k]) for k in a)


def test_partial_runs_leave_other_series(spark):
    """300 stored series, 3 of them rewritten: all 300 are there, for every artifact."""
    root = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    def frame(n, v):
        return spark.range(n).select(F.concat(F.lit("s"), "id").alias("series_id"), F.lit(v).alias("yhat"))

    for n, v in ((300, 1.0), (3, 2.0)):
        SK.save_forecast(frame(n, v), root, "m")
        SK.save_flags(frame(n, v).select("series_id", (F.col("yhat") > 1.5).alias("should_retrain")), root, "2026-01-01")
        SK.save_metrics(frame(n, v).select("series_id", F.lit("m").alias("model_name"), F.col("yhat").alias("mae_window")), root, "2026-01-01")
    for name, new in (("forecast", "yhat = 2"), ("retrain_flag", "should_retrain"), ("metrics", "mae_window = 2")):
        got = SK.read_artifact(spark, root, name)
        assert (got.count(), got.select("series_id").distinct().count(), got.filter(new).count()) == (300, 300, 3), name


def test_history_of_a_missing_or_empty_run(spark, caplog):
    root = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    with pytest.raises(ValueError, match="no metrics"):
        SK.append_metrics_history(None, root)
    SK.append_metrics_history(spark.createDataFrame([], "series_id string"), root)
    assert "no metrics" in caplog.text and not SK.has_artifact(spark, root, "metrics_history")


def test_partial_retrain_keeps_other_fits(spark):
    root = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    run_pipeline(spark, GAP_FREE, root, "2026-01-01T00:00:00", n_trials=3)
    series = sorted(r[0] for r in SK.read_artifact(spark, root, "model").select("series_id").distinct().collect())
    assert len(series) == 5
    flags = spark.createDataFrame([(s, s == series[0]) for s in series], "series_id string, should_retrain boolean")
    SK.save_flags(flags, root, "2026-01-01T00:00:00")
    out = run_pipeline(spark, GAP_FREE, root, "2026-01-02T00:00:00", n_trials=3)
    after = SK.read_artifact(spark, root, "model")
    assert sorted(r[0] for r in after.select("series_id").distinct().collect()) == series
    assert after.groupBy("series_id").count().filter("count != 90").count() == 0  # one row per term
    assert out["unavailable"].count() == 0


def test_forecast_gate(spark):
    """A series whose future regressors are missing validates for training but gets no forecast."""
    from daycast.plans.run import default_preparator

    def preparator(full, is_training):
        series = sorted(r[0] for r in full.select("series_id").distinct().collect())
        if not is_training:
            full = full.withColumn("HDD", F.when((F.col("series_id") != series[0]) | F.col("y").isNotNull(), F.col("HDD")))
        return default_preparator(full, is_training)

    root = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    out = run_pipeline(spark, GAP_FREE, root, "2026-01-01T00:00:00", n_trials=2, preparator=preparator)
    rejected = {r[0] for r in out["rejected_forecast"].select("series_id").distinct().collect()}
    forecast = {r[0] for r in SK.read_artifact(spark, root, "forecast").select("series_id").distinct().collect()}
    assert len(rejected) == 1 and len(forecast) == 4 and not rejected & forecast
