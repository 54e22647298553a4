"""Physical-plan properties that matter at scale."""

import contextlib
import io

import __spark_entry__ as E
from conftest import SMALL
from daycast.operators.daily import daily_totals, fetch_window
from daycast.sources.fixtures import event_readings


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_daily_totals_partial_aggregation(spark):
    p = plan(daily_totals(event_readings(spark, SMALL)))
    assert "partial_sum" in p and "partial_min" in p
    assert p.index("partial_sum") > p.index("Exchange")  # partial agg sits below the exchange (printed later)


def test_scan_is_pruned_and_filter_pushed(spark):
    df = daily_totals(fetch_window(event_readings(spark, SMALL), "daily", as_of="2024-01-15"))
    p = plan(df)
    schema = [ln for ln in p.splitlines() if "ReadSchema" in ln][0]
    assert "props" not in schema and "user_id" not in schema and "event_id" not in schema
    pushed = [ln for ln in p.splitlines() if "PushedFilters" in ln][0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_no_single_partition_window(spark):
    for key in ["retrain_decision", "retrain_decision_by_nation", "zero_repair", "validation_report",
                "forecast_with_actuals", "sorted_check"]:
        p = plan(E.queries()[key](spark, SMALL))
        assert "SinglePartition" not in p, key


def test_holiday_side_is_broadcast(spark):
    p = plan(E.queries()["holiday_windows"](spark, SMALL))
    assert "BroadcastHashJoin" in p


def test_zero_repair_deals_rows_by_series_and_day(spark):
    p = plan(E.queries()["zero_repair"](spark, SMALL))
    assert "rangepartitioning" not in p.lower() and "hashpartitioning(series_id" in p


def executed(df) -> str:
    """The plan as it ran (joins and reuse as adaptive execution chose them)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_weather_is_the_broadcast_side(spark):
    """The calendar-bounded weather is sent out, never the spine of series and days."""
    p = plan(E.queries()["weather_left_target"](spark, SMALL))
    joins = [ln for ln in p.splitlines() if "BroadcastHashJoin Inner" in ln]
    assert joins and all("BuildLeft" not in ln for ln in joins)


def test_weather_cut_reads_orders_alone(spark):
    p = plan(E.queries()["degree_days"](spark, SMALL))
    assert "orders.parquet" in p and "customer.parquet" not in p


def test_flagship_runs_few_jobs(spark):
    sc = spark.sparkContext
    sc.setJobGroup("flagship", "jobs of the flagship")
    try:
        E.queries()["retrain_decision"](spark, SMALL).collect()
        jobs = sc.statusTracker().getJobIdsForGroup("flagship")
    finally:
        sc._jsc.clearJobGroup()
    assert len(jobs) <= 26, len(jobs)  # one per exchange under adaptive execution


def test_caller_session_zone_is_left_alone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        q = E.queries()["daily_totals"](spark, SMALL)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo" and q.count() > 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_both_branches_have_rows(spark):
    """Queries whose condition could be vacuous: rows on either side of it at sf0.01."""
    sf = "/root/testdata/sf0.01"
    qs = E.queries()
    assert {r.status for r in qs["gated_series"](spark, sf).collect()} == {"passed", "rejected"}
    assert {r.source for r in qs["model_fallback"](spark, sf).collect()} == {"primary", "fallback"}
    trained = qs["train_flagged_only"](spark, sf).select("series_id").distinct().count()
    assert 0 < trained < qs["retrain_flag"](spark, sf).count()
    assert qs["holidays_fr"](spark, sf).filter("holiday = 'school_holiday'").count() == 6
    assert qs["ordered_limit"](spark, sf).count() == 100 < qs["tumbling_day"](spark, sf).count()
    assert {r.is_sorted for r in qs["validation_report"](spark, sf).collect()} == {True, False}
    assert {(r.shape, r.kind) for r in qs["json_rejects"](spark, sf).collect()} == {
        (a, b) for a in ("records", "arrays") for b in ("rows", "rejects")}
