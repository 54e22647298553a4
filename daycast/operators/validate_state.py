"""Validation over increments (A2, A3, V4, V5, V7-V10): a stored state that grows by deliveries.

What the checks need of a day is a handful of counters, and a day's rows are
complete in one delivery, so the state is a row per (series, day): rows, NULL
cells per column, violations per rule, extra copies.  Deliveries touch only
the months of their days; the report of all days ever delivered is a sum over
the state and reads no reading again.  A day delivered again replaces its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.operators.validate import _rule_items, missing_days_report
from daycast.sources import sinks as SK

ARTIFACT = "validation_state"


def day_state(df: DataFrame, date_col: str = "ds", target: str = "y", rules: dict | None = None, by: str = "series_id", as_of: str = "") -> DataFrame:
    """``by, day, day_key, n_rows, nulls, rules, copies`` of an increment, one row per series and day.

    Copies of a row share its day, so they are collapsed map-side per (series,
    day) and counted here; a hot day shuffles one record per task and distinct
    row.  Rows without a date belong to the delivery: their key names ``as_of``.
    """
    columns = [c for c in df.columns if c != by]
    items = _rule_items(df, rules, target)
    once = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    day = F.to_date(date_col)
    count = lambda cond: F.sum(F.when(cond, F.col("_n")).otherwise(0))
    no_counts = F.create_map().cast("map<string,bigint>")
    nulls = F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*[count(F.col(f"`{c}`").isNull()) for c in columns])) if columns else no_counts
    broken = F.map_from_arrays(F.array(*[F.lit("|".join(i[:3])) for i in items]), F.array(*[count(i[3]) for i in items])) if items else no_counts
    return once.groupBy(by, day.alias("day")).agg(F.sum("_n").alias("n_rows"), nulls.alias("nulls"), broken.alias("rules"), F.sum(F.col("_n") - 1).alias("copies")).select(
        by, "day", F.coalesce(F.col("day").cast("string"), F.lit(f"undated {as_of}")).alias("day_key"), "n_rows", "nulls", "rules", "copies")


def deliver(df: DataFrame, root: str, as_of: str, date_col: str = "ds", target: str = "y", rules: dict | None = None, by: str = "series_id") -> DataFrame:
    """Adds an increment of whole days to the state under ``root`` and returns the state of all deliveries.

    Every day present in ``df`` replaces what was stored for that day, for all series.
    """
    spark = df.sparkSession
    state = day_state(df, date_col, target, rules, by, as_of).withColumn("month", F.coalesce(F.date_format("day", "yyyy-MM"), F.lit("undated")))
    SK.merge_artifact(state, root, ARTIFACT, ["day_key"], ["month"])
    return read_state(spark, root)


def read_state(spark: SparkSession, root: str) -> DataFrame:
    return SK.read_artifact(spark, root, ARTIFACT).drop("month")


def _sums(state: DataFrame, column: str, by: str) -> DataFrame:
    return state.select(by, F.explode(column).alias("_name", "_n")).groupBy(by, "_name").agg(F.sum("_n").alias("_n"))


def null_counts(state: DataFrame, by: str = "series_id") -> DataFrame:
    """A2/V4 from the state: ``by, column, null_count``."""
    return _sums(state, "nulls", by).select(by, F.col("_name").alias("column"), F.col("_n").alias("null_count"))


def rule_violations(state: DataFrame, by: str = "series_id") -> DataFrame:
    """A3/V8-V10 from the state: ``by, scope, column, rule, violations``, without the zeros."""
    part = F.split("_name", r"\|")
    return _sums(state, "rules", by).filter("_n > 0").select(by, part[0].alias("scope"), part[1].alias("column"), part[2].alias("rule"),
                                                             F.col("_n").alias("violations"))


def report(state: DataFrame, by: str = "series_id") -> DataFrame:
    """``by, n_rows, null_cells, duplicated_rows, rule_violations, missing_count, missing_range`` over all deliveries."""
    cells = lambda c: F.aggregate(F.map_values(c), F.lit(0).cast("bigint"), lambda a, v: a + v)
    sums = state.groupBy(by).agg(F.sum("n_rows").alias("n_rows"), F.sum(cells("nulls")).alias("null_cells"), F.sum("copies").alias("duplicated_rows"),
                                 F.sum(cells("rules")).alias("rule_violations"))
    gaps = missing_days_report(state.select(by, "day"), "day", by).withColumnRenamed(by, "_k")
    return sums.join(gaps, F.col(by).eqNullSafe(F.col("_k")), "left").drop("_k").withColumn("missing_count", F.coalesce("missing_count", F.lit(0).cast("bigint")))
