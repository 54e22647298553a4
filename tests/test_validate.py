"""Validation checks on the fixture frames of the reference tests (FIXTURES §2)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from daycast.operators import validate as V

D = dt.datetime


def _multi_fault(spark):
    # one day absent (Jan 3), one day twice with other values, one NULL temp, one negative target
    data = [("s", D(2025, 1, 1), 100, 20.0), ("s", D(2025, 1, 2), 110, None), ("s", D(2025, 1, 2), -5, 12.0),
            ("s", D(2025, 1, 4), 120, 5.0)]
    return spark.createDataFrame(data, "series_id string, date timestamp, target long, temp double")


def test_multi_fault_report(spark):
    df = _multi_fault(spark).withColumn("date", F.to_date("date"))
    assert rows(V.duplicate_rows(df), "duplicated_rows") == [(0,)]
    nulls = dict(rows(V.null_counts(df), "column", "null_count"))
    assert nulls == {"date": 0, "target": 0, "temp": 1}
    assert rows(V.missing_days_report(df, "date")) == [("s", 1, "2025-01-03 to 2025-01-03")]
    rules = {"target": {"allow_negative": False, "min_value": 0}, "regressors": {"temp": {"min_value": 10},
                                                                                   "absent": {"min_value": 1}}}
    got = sorted(rows(V.rule_violations(df, rules, "target"), "scope", "column", "rule", "violations"))
    assert got == [("regressors", "temp", "below_min", 1), ("target", "target", "below_min", 1),
                   ("target", "target", "negative_values", 1)]
    rep = V.validation_report(df.withColumnRenamed("date", "ds").withColumnRenamed("target", "y"), rules=None)
    (valid,), = [(r["is_valid"],) for r in rep.collect()]
    assert valid is False


def test_duplicates_count_equal_rows(spark):
    df = spark.createDataFrame([("s", "2024-01-01", 1, None), ("s", "2024-01-01", 1, None)],
                               "series_id string, ds string, a long, b long")
    assert rows(V.duplicate_rows(df), "duplicated_rows") == [(1,)]


def test_sortedness(spark):
    df = spark.createDataFrame([("s", 1, dt.date(2024, 1, 2)), ("s", 2, dt.date(2024, 1, 1)),
                                ("t", 1, dt.date(2024, 1, 1)), ("t", 2, dt.date(2024, 1, 1)),
                                ("u", 1, None)], "series_id string, seq long, ds date")
    got = sorted(rows(V.sortedness(df, "seq", "ds"), "series_id", "is_sorted"))
    assert got == [("s", False), ("t", True), ("u", False)]


def test_schema_checks(spark):
    ok = spark.createDataFrame([(D(2024, 1, 1), 1, 2)], "date timestamp, target long, temp long")
    assert all(r["passed"] for r in V.schema_checks(ok, "date", "target"))
    missing = ok.drop("target")
    res = {r["check"]: r for r in V.schema_checks(missing, "date", "target")}
    assert not res["required_columns"]["passed"] and "target" in res["required_columns"]["detail"]
    text = spark.createDataFrame([("2024-01-01", 1, "x")], "date string, target long, temp string")
    res = {r["check"]: r["passed"] for r in V.schema_checks(text, "date", "target")}
    assert res == {"required_columns": True, "date_type": False, "numeric_types": False}


def test_rules_zero_violations_left_out(spark):
    df = spark.createDataFrame([("s", 5.0)], "series_id string, y double")
    assert V.rule_violations(df, {"target": {"min_value": 1.0}}).count() == 0
    wider = V.rule_violations(df, {"target": {"min_value": 0.0}}).count()
    assert wider == 0


def test_merge_names_every_input_without_key(spark):
    import pytest

    from daycast.operators.joins import weather_left_target

    t = spark.createDataFrame([("s", 1.0)], "series_id string, y double")
    w = spark.createDataFrame([(1.0,)], "temperature_mean double")
    with pytest.raises(ValueError) as e:
        weather_left_target(t, w)
    assert "target" in str(e.value) and "weather" in str(e.value)


def test_report_document_shape(spark):
    df = _multi_fault(spark).withColumn("ds", F.to_date("date")).drop("date").withColumnRenamed("target", "y")
    rep = V.validation_report(df, rules=None)
    doc = V.report_document(rep, V.null_counts(df), V.data_types(df), "2026-01-01T00:00:00").first()
    assert doc["data_types"]["y"] == "bigint" and doc["missing_values"]["temp"] == 1
    assert doc["date_report"]["missing_dates"]["count"] == 1
    assert doc["date_report"]["missing_dates"]["range"] == "2025-01-03 to 2025-01-03"
    assert doc["is_valid"] is False


def test_empty_single_and_all_null_inputs(spark):
    schema = "series_id string, ds date, y double, HDD double"
    empty = spark.createDataFrame([], schema)
    rules = {"target": {"min_value": 0.0}}
    assert V.validation_report(empty, rules=rules).count() == 0
    assert V.null_counts(empty).count() == 0
    assert V.missing_days_report(empty).count() == 0
    assert V.rule_violations(empty, rules).count() == 0
    one = spark.createDataFrame([("s", dt.date(2024, 1, 1), 5.0, None)], schema)
    (r,) = V.validation_report(one, rules=rules).collect()
    assert (r["n_rows"], r["missing_count"], r["null_cells"], r["is_valid"]) == (1, 0, 1, False)
    all_null = spark.createDataFrame([("s", dt.date(2024, 1, d), None, 1.0) for d in (1, 2)], schema)
    # training mode drops NULL-target rows first: nothing left to validate
    assert V.validation_report(all_null, rules=rules).count() == 0
    (f,) = V.validation_report(all_null, is_training=False, rules=rules).collect()
    assert f["null_cells"] == 2 and f["is_valid"] is False


def test_schema_faults_reach_the_flag(spark):
    ok = spark.createDataFrame([("s", dt.date(2024, 1, d), float(d), 1.0) for d in (1, 2)], "series_id string, ds date, y double, HDD double")
    rules = {"target": {"min_value": 0.0}}
    assert V.validation_report(ok, rules=rules).first()["is_valid"] is True
    for broken in (ok.withColumn("y", F.col("y").cast("string")), ok.drop("y"), ok.drop("ds"), ok.withColumn("ds", F.col("ds").cast("string")),
                   ok.withColumn("HDD", F.lit("x"))):
        r = V.validation_report(broken, rules=rules).first()
        assert (r["schema_ok"], r["is_valid"]) == (False, False)


def test_duplicates_flag_the_input_and_are_reported_by_day(spark):
    """Two readings of one day with equal values: no duplicates as they came, one after cutting the date."""
    df = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, h), 5.0) for h in (1, 2)] + [("t", dt.datetime(2024, 1, 1), 5.0)] * 2,
                               "series_id string, ds timestamp_ntz, y double")
    got = {r["series_id"]: (r["duplicated_rows"], r["is_valid"]) for r in V.validation_report(df).collect()}
    assert got == {"s": (1, True), "t": (1, False)}


def test_unsorted_input_is_invalid_when_its_order_is_given(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, 2), 1.0, 1), ("s", dt.date(2024, 1, 1), 1.0, 2), ("t", dt.date(2024, 1, 1), 1.0, 1)],
                               "series_id string, ds date, y double, seq long")
    got = {r["series_id"]: (r["is_sorted"], r["is_valid"]) for r in V.validation_report(df, seq="seq").collect()}
    assert got == {"s": (False, False), "t": (True, True)}
    assert V.validation_report(df.drop("seq")).first()["is_sorted"] is None


def test_nested_business_rules(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, 1), -5.0, 30.0), ("s", dt.date(2024, 1, 2), 50.0, 1.0), ("t", dt.date(2024, 1, 1), 3.0, 3.0)],
                               "series_id string, ds date, y double, HDD double")
    rules = {"target": {"allow_negative": False, "max_value": 10.0}, "regressors": {"HDD": {"min_value": 2.0, "max_value": 20.0}, "none": {"min_value": 1}}}
    got = {r["series_id"]: r for r in V.validation_report(df, rules=rules).collect()}
    assert got["s"]["business_rules"].asDict(True) == {"target": {"negative_values": 1, "above_max": 1},
                                                       "regressors": {"HDD": {"below_min": 1, "above_max": 1}}}
    assert got["t"]["business_rules"].asDict(True) == {"target": {}, "regressors": {}} and got["s"]["rule_violations"] == 4
    assert got["s"]["is_valid"]  # rules are reported, they do not flip the flag


def test_flags_default_and_repeat(spark):
    from daycast.operators.evaluate import flags_with_default

    series = spark.createDataFrame([(s,) for s in "abcd"], "series_id string")
    flags = spark.createDataFrame([("a", "false"), ("b", "perhaps"), ("c", "false"), ("c", "true")], "series_id string, should_retrain string")
    got = sorted(rows(flags_with_default(series, flags)))
    assert got == [("a", False), ("b", True), ("c", True), ("d", True)]
