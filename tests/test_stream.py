"""Streaming daily totals equal the batch totals of the closed days."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL, rows
from daycast.operators.daily import daily_totals
from daycast.sources.fixtures import event_readings


def test_stream_closed_days_equal_batch(spark):
    st = E.queries()["stream_daily_totals"](spark, SMALL)
    ev = event_readings(spark, SMALL)
    wm = ev.agg(F.max("ts")).first()[0]
    import datetime as dt

    closed_before = (wm - dt.timedelta(days=2))
    batch = daily_totals(ev).filter(F.date_add("ds", 1).cast("timestamp_ntz") <= F.lit(closed_before))
    a = sorted(rows(st.select("series_id", "day_start", F.round("y", 2).alias("y"), "n_readings")))
    b = sorted(rows(batch.select("series_id", "ds", F.round("y", 2).alias("y"), "n_readings")))
    assert a == b and len(a) > 0


def test_replay_dedup_keeps_totals(spark):
    a = sorted(rows(E.queries()["stream_dedup"](spark, SMALL)))
    b = sorted(rows(E.queries()["stream_daily_totals"](spark, SMALL)))
    assert a == b


def test_restart_resumes_from_checkpoint(spark):
    """A second run on the same checkpoint finds no new files: nothing is emitted twice."""
    import uuid

    from daycast.session import scratch_path
    from daycast.streaming import daily_stream as ZS

    base = scratch_path(spark, f"restart-{uuid.uuid4().hex}")
    for _ in range(2):
        agg = ZS.daily_totals_stream(ZS.readings_stream(spark, SMALL, "events.parquet"))
        ZS.run_to_table(agg, base + "/out", base + "/_checkpoint")
    out = spark.read.parquet(base + "/out")
    assert out.count() == out.select("series_id", "w").distinct().count() > 0
