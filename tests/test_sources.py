"""Readers and sinks: required columns, artifact names, flags default."""

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from daycast.operators.clean import require_columns
from daycast.operators.daily import fetch_window
from daycast.session import scratch_path
from daycast.sources import sinks as SK
from daycast.sources.fixtures import event_readings, table


def test_required_columns(spark):
    ev = table(spark, SMALL, "events")
    assert require_columns(ev, ["event_id", "ts"]).columns == ["event_id", "ts"]
    with pytest.raises(KeyError):
        require_columns(ev, ["event_id", "nope"])


def test_fetch_modes(spark):
    r = event_readings(spark, SMALL)
    assert fetch_window(r, "full").count() == r.count()
    d = fetch_window(r, "daily", as_of="2024-01-10")
    assert {x[0] for x in rows(d.select(F.to_date("ts").alias("d")).distinct())} == {
        __import__("datetime").date(2024, 1, 9)}
    with pytest.raises(ValueError):
        fetch_window(r, "weekly")
    with pytest.raises(ValueError):
        fetch_window(r, "daily")


def test_artifact_names_and_flags(spark):
    root = scratch_path(spark, f"art-{uuid.uuid4().hex}")
    with pytest.raises(ValueError):
        SK.artifact_path(root, "dashboard")
    assert SK.read_flags(spark, root) is None
    flags = spark.createDataFrame([("a", False)], "series_id string, should_retrain boolean")
    SK.save_flags(flags, root, "2026-01-01T00:00:00")
    back = SK.read_artifact(spark, root, "retrain_flag", view="flags_view")
    assert rows(spark.table("flags_view"), "series_id", "should_retrain") == [("a", False)]
    assert back.columns[0] == "date"


def test_forecast_sink_is_bucketed_and_prunable(spark):
    import contextlib
    import io

    root = scratch_path(spark, f"fc-{uuid.uuid4().hex}")
    fc = spark.range(200).select((F.col("id") % 50).cast("string").alias("series_id"),
                                 F.col("id").cast("double").alias("yhat"))
    SK.save_forecast(fc, root, "m")
    import os

    version = next(f for f in os.listdir(os.path.join(root, "forecasts")) if f.startswith(SK.FOLDER))
    folders = os.listdir(os.path.join(root, "forecasts", version, "model_name=m"))
    assert 1 < len([f for f in folders if f.startswith("series_bucket=")]) <= SK.SERIES_BUCKETS
    one = SK.read_series(spark, root, "forecast", "7", "m")
    assert one.count() == 4
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain("formatted")
    pf = [ln for ln in buf.getvalue().splitlines() if "PartitionFilters" in ln][0]
    assert "(series_bucket#" in pf and "(model_name#" in pf  # both folder levels pruned


def test_tumbling_windows_equal_day_rollup(spark):
    from daycast.operators.daily import daily_totals, tumbling_day

    r = event_readings(spark, SMALL)
    a = sorted(rows(tumbling_day(r).select("series_id", "day_start", F.round("y", 6).alias("y"), "n_readings")))
    b = sorted(rows(daily_totals(r).select("series_id", "ds", F.round("y", 6).alias("y"), "n_readings")))
    assert a == b


def test_ingest_profile_lists_empty_series(spark):
    from daycast.operators.daily import daily_totals, ingest_profile

    d = daily_totals(event_readings(spark, SMALL)).filter("series_id != 'click'")
    series = event_readings(spark, SMALL).select("series_id")
    prof = {r[0]: (r[1], r[2]) for r in rows(ingest_profile(d, series), "series_id", "n_rows", "is_empty")}
    assert prof["click"] == (0, True) and all(v[0] > 0 for k, v in prof.items() if k != "click")
