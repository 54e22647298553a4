"""Calendar generators (C1-C5) as column expressions.

Holidays are generated for a *years* DataFrame, so the table grows with the
span of the data and stays tiny (about a dozen rows a year): it is the one
side of the engine that is safe to broadcast by construction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public holidays of metropolitan France, names as published,
# fixed-date ones as (month, day, name) and Easter-relative ones as (offset, name).
FR_FIXED_HOLIDAYS = [
    (1, 1, "Jour de l'an"),
    (5, 1, "Fête du Travail"),
    (5, 8, "Fête de la Victoire"),
    (7, 14, "Fête nationale"),
    (8, 15, "Assomption"),
    (11, 1, "Toussaint"),
    (11, 11, "Armistice"),
    (12, 25, "Noël"),
]
FR_EASTER_HOLIDAYS = [
    (1, "Lundi de Pâques"),
    (39, "Ascension"),
    (50, "Lundi de Pentecôte"),
]
# Simplified school-holiday boundary days (window 0).
SCHOOL_HOLIDAY_DAYS = ["2023-02-18", "2023-03-06", "2023-04-15", "2023-05-01", "2023-07-08", "2023-09-03"]
PUBLIC_WINDOW = (-1, 1)
BRIDGE_NAME = "bridge_day"
SCHOOL_NAME = "school_holiday"
THURSDAY = 3  # Spark weekday(): Monday = 0


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus) for an int column."""
    y = year.cast("int")
    a = y % 19
    b = F.floor(y / 100).cast("int")
    c = y % 100
    d = F.floor(b / 4).cast("int")
    e = b % 4
    f = F.floor((b + 8) / 25).cast("int")
    g = F.floor((b - f + 1) / 3).cast("int")
    h = (19 * a + b - d - g + 15) % 30
    i = F.floor(c / 4).cast("int")
    k = c % 4
    l_ = (32 + 2 * e + 2 * i - h - k) % 7
    m = F.floor((a + 11 * h + 22 * l_) / 451).cast("int")
    s = h + l_ - 7 * m + 114
    return F.make_date(y, F.floor(s / 31).cast("int"), (s % 31) + 1)


def years_of(df: DataFrame, day: str) -> DataFrame:
    """One row per calendar year spanned by ``day`` (``year int``).

    The span is one scalar subquery: every consumer of the years table reuses
    the same subquery result instead of re-aggregating ``df``.
    """
    span = df.select(F.struct(F.year(F.min(day)).alias("lo"), F.year(F.max(day)).alias("hi"))).scalar()
    return df.sparkSession.range(1).select(F.explode(F.sequence(span["lo"], span["hi"])).alias("year"))


def public_holidays(years: DataFrame) -> DataFrame:
    """``ds, holiday, lower_window, upper_window`` for every year."""
    fixed = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(n).alias("name"))
                      for m, d, n in FR_FIXED_HOLIDAYS])
    moving = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(n).alias("name")) for o, n in FR_EASTER_HOLIDAYS])
    a = years.select(F.explode(fixed).alias("h"), "year").select(
        F.make_date("year", "h.m", "h.d").alias("ds"), F.col("h.name").alias("holiday"))
    b = years.select(easter_sunday(F.col("year")).alias("easter"), F.explode(moving).alias("h")).select(
        F.date_add("easter", F.col("h.o")).alias("ds"), F.col("h.name").alias("holiday"))
    lo, hi = PUBLIC_WINDOW
    return a.unionByName(b).select("ds", "holiday", F.lit(lo).alias("lower_window"), F.lit(hi).alias("upper_window"))


def bridge_days(public: DataFrame) -> DataFrame:
    """A public holiday on a Thursday makes the Friday a bridge day (window 0)."""
    return public.filter(F.weekday("ds") == THURSDAY).select(
        F.date_add("ds", 1).alias("ds"), F.lit(BRIDGE_NAME).alias("holiday"),
        F.lit(0).alias("lower_window"), F.lit(0).alias("upper_window"))


def school_days(years: DataFrame) -> DataFrame:
    """The listed school-holiday boundary days falling in the given years."""
    days = F.array(*[F.lit(d).cast("date") for d in SCHOOL_HOLIDAY_DAYS])
    return years.select(F.explode(days).alias("ds"), "year").filter(F.year("ds") == F.col("year")).select(
        "ds", F.lit(SCHOOL_NAME).alias("holiday"), F.lit(0).alias("lower_window"), F.lit(0).alias("upper_window"))


def holiday_table(years: DataFrame) -> DataFrame:
    """Public + bridge + school holidays."""
    pub = public_holidays(years)
    return pub.unionByName(bridge_days(pub)).unionByName(school_days(years))


def holiday_effect_days(holidays: DataFrame) -> DataFrame:
    """Each holiday acts on ``ds + lower .. ds + upper``: ``day, holiday, offset``."""
    return holidays.select("holiday", "ds", F.explode(F.sequence("lower_window", "upper_window")).alias("offset")) \
        .select(F.date_add("ds", F.col("offset")).alias("day"), "holiday", "offset")


def future_calendar(history: DataFrame, periods: int, by: str = "series_id", day: str = "ds") -> DataFrame:
    """The history days plus ``periods`` days after the last one (``is_future``)."""
    hist = history.select(by, day).distinct().withColumn("is_future", F.lit(False))
    last = history.groupBy(by).agg(F.max(day).alias("_last"))
    fut = last.select(by, F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", periods))).alias(day)) \
        .withColumn("is_future", F.lit(True))
    return hist.unionByName(fut)
