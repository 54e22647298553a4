"""Spine join, availability cap and ordered first-n on small frames."""

import datetime as dt

from conftest import rows
from daycast.operators.clean import availability_cap
from daycast.operators.daily import first_n_days
from daycast.operators.joins import inner_on_day, weather_left_target

D = dt.date


def _frames(spark):
    target = spark.createDataFrame([("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 2), 2.0), ("b", D(2024, 1, 2), 5.0)],
                                   "series_id string, ds date, y double")
    weather = spark.createDataFrame([(D(2024, 1, d), float(d)) for d in (1, 2, 3)], "ds date, temperature_mean double")
    return target, weather


def test_every_weather_day_for_every_series(spark):
    target, weather = _frames(spark)
    got = sorted(rows(weather_left_target(target, weather), "series_id", "ds", "y"))
    assert got == [("a", D(2024, 1, 1), 1.0), ("a", D(2024, 1, 2), 2.0), ("a", D(2024, 1, 3), None),
                   ("b", D(2024, 1, 1), None), ("b", D(2024, 1, 2), 5.0), ("b", D(2024, 1, 3), None)]


def test_weather_gap_days_are_not_invented(spark):
    target, weather = _frames(spark)
    gappy = weather.filter("ds != date'2024-01-02'")
    got = {r[0] for r in rows(weather_left_target(target, gappy), "ds")}
    assert got == {D(2024, 1, 1), D(2024, 1, 3)}


def test_availability_cap(spark):
    target, weather = _frames(spark)
    full = weather_left_target(target, weather)
    capped = sorted(rows(availability_cap(full), "series_id", "ds"))
    assert capped == [("a", D(2024, 1, 1)), ("a", D(2024, 1, 2)), ("b", D(2024, 1, 1)), ("b", D(2024, 1, 2))]
    fixed = sorted(rows(availability_cap(full, cap="2024-01-01"), "series_id", "ds"))
    assert fixed == [("a", D(2024, 1, 1)), ("b", D(2024, 1, 1))]


def test_inner_on_day_keeps_matching_days(spark):
    target, weather = _frames(spark)
    full = weather_left_target(target, weather).select("series_id", "ds", "temperature_mean")
    got = inner_on_day(target, full).count()
    assert got == 3


def test_first_n_days_orders_by_first_reading(spark):
    daily = spark.createDataFrame(
        [("a", D(2024, 1, 3), dt.datetime(2024, 1, 3, 1)), ("a", D(2024, 1, 1), dt.datetime(2024, 1, 1, 5)),
         ("a", D(2024, 1, 2), None), ("b", D(2024, 1, 1), dt.datetime(2024, 1, 1))],
        "series_id string, ds date, jour timestamp_ntz")
    got = sorted(rows(first_n_days(daily, 2), "series_id", "ds"))
    assert got == [("a", D(2024, 1, 1)), ("a", D(2024, 1, 3)), ("b", D(2024, 1, 1))]  # NULL jour sorts last
