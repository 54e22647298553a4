"""Weather sources: union of archive and forecast, keep-first per day (U1, U3), S3."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEMPERATURES = ["temperature_max", "temperature_min", "temperature_mean"]


def union_sources(*sources: tuple[str, DataFrame]) -> DataFrame:
    """Union by name; each source gets its rank (list order) and name."""
    out = None
    for rank, (name, df) in enumerate(sources):
        tagged = df.withColumn("src_rank", F.lit(rank)).withColumn("src", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def keep_first_per_day(unioned: DataFrame, key: str = "ds", cols: list[str] | None = None) -> DataFrame:
    """One row per day, taken from the lowest-ranked source.

    The first row wins even when its temperatures are NULL (``min_by`` keeps
    the whole struct).  It is an aggregation, so it is planned as partial +
    final hash aggregate: no sort and a shuffle of one row per (task, day).
    """
    cols = cols or [c for c in unioned.columns if c not in (key, "src_rank")]
    # source rank first, then the ingest ordinal when there is one; the row
    # itself breaks any remaining tie, so a recomputed task picks the same row
    order = F.struct("src_rank", *(["seq"] if "seq" in unioned.columns else []), F.struct(*cols))
    picked = unioned.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias("_r"))
    return picked.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols if c != "seq"])


def select_weather(weather: DataFrame, variables: list[str] | None = None, start=None, end=None,
                   point: tuple[float, float] | None = None) -> DataFrame:
    """S3: variable selection, an optional location (``lat``/``lon`` equality,
    for tables that hold several points) and an inclusive day range, each bound
    optional (archive: a range; forecast: none)."""
    variables = variables or TEMPERATURES
    if point is not None:
        weather = weather.filter((F.col("lat") == F.lit(point[0])) & (F.col("lon") == F.lit(point[1])))
    out = weather.select("ds", *variables)
    if start is not None:
        out = out.filter(F.col("ds") >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col("ds") <= F.lit(end).cast("date"))
    return out
