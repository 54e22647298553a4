"""Holiday calendar (C1-C5) and design columns."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from daycast.functions import calendar as CAL
from daycast.functions import design as D


def _years(spark, lo, hi):
    return spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("year"))


def test_easter_known_years(spark):
    got = dict(rows(_years(spark, 2022, 2026).select("year", CAL.easter_sunday(F.col("year")).alias("e"))))
    assert got == {2022: dt.date(2022, 4, 17), 2023: dt.date(2023, 4, 9), 2024: dt.date(2024, 3, 31),
                   2025: dt.date(2025, 4, 20), 2026: dt.date(2026, 4, 5)}


def test_public_holidays_and_bridges(spark):
    pub = CAL.public_holidays(_years(spark, 2022, 2026))
    assert pub.count() == 55
    br = {r[0] for r in rows(CAL.bridge_days(pub), "ds")}
    # Ascension is always a Thursday; 2026-01-01 is a Thursday
    assert dt.date(2026, 1, 2) in br and dt.date(2025, 5, 30) in br
    table = CAL.holiday_table(_years(spark, 2022, 2025))
    assert table.filter("holiday = 'school_holiday'").count() == 6


def test_holiday_effect_window(spark):
    h = spark.createDataFrame([(dt.date(2024, 7, 14), "x", -1, 1)], "ds date, holiday string, lower_window int, upper_window int")
    got = sorted(rows(CAL.holiday_effect_days(h), "day", "offset"))
    assert got == [(dt.date(2024, 7, 13), -1), (dt.date(2024, 7, 14), 0), (dt.date(2024, 7, 15), 1)]


def test_future_calendar(spark):
    hist = spark.createDataFrame([("s", dt.date(2024, 1, 1)), ("s", dt.date(2024, 1, 3))], "series_id string, ds date")
    fut = CAL.future_calendar(hist, 2)
    assert sorted(rows(fut, "ds", "is_future")) == [(dt.date(2024, 1, 1), False), (dt.date(2024, 1, 3), False),
                                                    (dt.date(2024, 1, 4), True), (dt.date(2024, 1, 5), True)]


def test_missing_days_of_no_rows(spark):
    from daycast.operators.validate import missing_days_report

    empty = spark.createDataFrame([], "series_id string, ds date")
    assert missing_days_report(empty).count() == 0


def test_fourier_and_hinges(spark):
    df = spark.createDataFrame([("s", dt.date(2024, 1, d)) for d in range(1, 11)], "series_id string, ds date")
    f = df.withColumns(D.fourier_columns())
    assert len(D.fourier_names()) == 26
    r = f.select(F.max(F.abs("weekly_sin1")), F.max(F.abs("yearly_cos10"))).first()
    assert r[0] <= 1.0 and r[1] <= 1.0
    t = D.with_trend_time(df).withColumns(D.hinge_columns())
    (t_min, t_max, h), = rows(t.agg(F.min("t"), F.max("t"), F.max("cp25")))
    assert (t_min, t_max) == (0.0, 1.0) and abs(h - 0.2) < 1e-12
