"""Projection, filter and cleaning operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycast.operators.sequence import ordered_neighbors

# Raw target column names and their canonical names.
TARGET_RENAMES = {"jour": "date", "conso_jour": "daily_conso_kwh"}
WEATHER_RENAMES = {
    "time": "date",
    "temperature_2m_max": "temperature_max",
    "temperature_2m_min": "temperature_min",
    "temperature_2m_mean": "temperature_mean",
}
DEBUG_COLUMN = "range(date_heure,1day)"


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """``drop(errors='ignore')`` -- Spark's ``drop`` already ignores absent names."""
    return df.drop(*names)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename by map; keys that are not columns are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


# Fixed value: a trailing zone designator of ISO-8601 text.
ZONE_SUFFIX = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def parse_wall_clock(c) -> "F.Column":
    """ISO text -> TIMESTAMP_NTZ keeping the local wall clock (the zone is
    dropped, not applied): ``2024-01-01T00:30:00+01:00`` -> ``2024-01-01 00:30``."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_timestamp_ntz(F.regexp_replace(c, ZONE_SUFFIX, ""))


def parse_day(c, df_type: str = "string") -> "F.Column":
    """Text (zone dropped, wall clock kept) or timestamp -> calendar day."""
    c = F.col(c) if isinstance(c, str) else c
    if df_type == "string":
        return F.to_date(parse_wall_clock(c))
    return F.to_date(c)


def require_columns(df: DataFrame, cols: list[str], what: str = "input") -> DataFrame:
    """Column check on the schema only (no job), then a pruned select."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing required columns in {what}: {missing}")
    return df.select(*cols)


def repair_zeros(df: DataFrame, by: str = "series_id", order: str = "ds", value: str = "y",
                 half_width: int = 2) -> DataFrame:
    """W1 + P9 + P10 + N9 on a daily series.

    Zeros count as missing; a zero is replaced by the mean of the non-missing
    values among the ``2*half_width+1`` rows centred on it (edges shortened,
    NULL if none).  Other rows, including NULL ones, are unchanged.  The window
    holds one row per day, so a partition is bounded by the calendar length.
    """
    y = F.col(value).cast("double")
    w = Window.partitionBy(by).orderBy(order).rowsBetween(-half_width, half_width)
    m = F.avg(F.nullif(y, F.lit(0.0))).over(w)
    return df.withColumn(value, F.when(y == 0, m).otherwise(y))


def repair_zeros_raw(df: DataFrame, by: str, order: list[str], value: str,
                     half_width: int = 2, bucket=None, points: DataFrame | None = None) -> DataFrame:
    """The same repair over raw, unbounded rows (ordered by ``order``).

    Uses bucketed neighbours instead of one window per series, so a series
    that holds most of the rows is still spread over many tasks; ``points``
    (``sequence.split_points``) also splits a single day that holds them.
    """
    nz = "_nz"
    base = df.withColumn(value, F.col(value).cast("double")).withColumn(nz, F.nullif(F.col(value), F.lit(0.0)))
    nb = ordered_neighbors(base, by, order, nz, before=half_width, after=half_width, bucket=bucket, points=points)
    parts = [F.col(nz)] + [F.col(f"{nz}_prev{j}") for j in range(1, half_width + 1)] + \
            [F.col(f"{nz}_next{j}") for j in range(1, half_width + 1)]
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0.0)))
    n = sum((F.when(p.isNotNull(), 1).otherwise(0) for p in parts[1:]),
            F.when(parts[0].isNotNull(), 1).otherwise(0))
    mean = F.when(n > 0, total / n)
    drop = [nz] + [f"{nz}_prev{j}" for j in range(1, half_width + 1)] + \
           [f"{nz}_next{j}" for j in range(1, half_width + 1)]
    return nb.withColumn(value, F.when(F.col(value) == 0, mean).otherwise(F.col(value))).drop(*drop)


def availability_cap(df: DataFrame, cap=None, by: str = "series_id", target: str = "y") -> DataFrame:
    """Keep days up to the last day that has a target (or a given cap)."""
    last = F.max(F.when(F.col(target).isNotNull(), F.col("ds"))).over(Window.partitionBy(by))
    bound = F.coalesce(F.lit(cap).cast("date"), last) if cap is not None else last
    return df.withColumn("_cap", bound).filter(F.col("ds") <= F.col("_cap")).drop("_cap")
