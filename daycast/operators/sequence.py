"""Row-order neighbours over raw rows without a per-series single task.

A window ``partitionBy(series)`` over raw readings puts a whole series in
one task; if one series holds a third of all rows, that task holds a third of
the data.  ``ordered_neighbors`` gives exactly the same ``lag``/``lead``
values but deals the rows by *bucket*, a fixed function of the first order
column (a day, or a run of ids), so every branch of the plan agrees on it:

1. one shuffle and one sort of the rows by ``(key, bucket)``; inside a bucket
   the ordinary window gives lags and leads;
2. the first and last ``k`` values of each bucket are a small side table, on
   which each bucket gets the last ``k`` values before it and the first ``k``
   after it, from however many buckets that takes;
3. that table (one row per bucket) is joined back, and the rows at a bucket's
   ends take from it what their window could not see.

A bucket that holds very many rows (one series with one busy day) is split at
stored points: :func:`split_points` sketches the order column of such buckets
once, writes the quantiles as a table, and every branch of the plan cuts at the
same ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.session import drop_stage, stage

#: Rows from which a bucket is split, and the parts it is split into (a hot order value again into as many).
SPLIT_ROWS, SPLIT_PARTS = 1 << 18, 256

#: Bucket of an integer order column: runs of ``2**ID_BITS`` ids.
ID_BITS = 16


def bucket_of(df: DataFrame, column: str) -> Column:
    """Bucket of an order column, increasing with it: its day, or its run of ids."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.datediff(F.to_date(column), F.lit("1970-01-01").cast("date")).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return F.shiftright(F.col(column).cast("bigint"), ID_BITS)
    raise TypeError(f"no default bucket for {column!r} of type {kind.simpleString()}; pass one")


def as_number(df: DataFrame, column: str) -> Column:
    """An order column as a long, increasing with it: days, microseconds, or the integer itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):  # wall clock, without a zone
        return F.unix_micros(F.to_timestamp(F.lit("1970-01-01 00:00:00")) + (F.col(column) - F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))
                             ) - F.unix_micros(F.to_timestamp(F.lit("1970-01-01 00:00:00")))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    raise TypeError(f"no number for {column!r} of type {kind.simpleString()}")


def split_points(df: DataFrame, key: str, order: list[str], bucket: Column | None = None,
                 rows: int = SPLIT_ROWS, parts: int = SPLIT_PARTS) -> DataFrame:
    """Written table ``key, _b0, _cuts, _ties``: where the buckets of more than ``rows`` rows are split.

    ``_cuts`` are quantiles of the first order column (a mergeable sketch, so no
    task sees a whole bucket); a value that fills several parts by itself has, in
    ``_ties``, quantiles of the second order column among its rows.  Small
    buckets have no row.  Remove the table with ``drop_stage`` when done.
    """
    base = df.select(F.col(key).alias("_k"), (bucket_of(df, order[0]) if bucket is None else bucket).alias("_b0"), as_number(df, order[0]).alias("_v"),
                     *([as_number(df, order[1]).alias("_w")] if len(order) > 1 else []))
    share = [i / parts for i in range(1, parts)]
    hot = base.groupBy("_k", "_b0").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows).drop("_n")
    mine = base.join(hot.toDF("k", "b"), F.col("_k").eqNullSafe(F.col("k")) & F.col("_b0").eqNullSafe(F.col("b")), "left_semi")
    found = stage(mine.groupBy("_k", "_b0").agg(F.percentile_approx("_v", share, 16 * parts).alias("_q")), "split_cuts")
    cuts = found.select("_k", "_b0", F.array_distinct("_q").alias("_cuts"))
    if len(order) < 2:
        out = stage(cuts.withColumn("_ties", F.create_map().cast("map<bigint,array<bigint>>")).withColumnRenamed("_k", key), "split_points")
        drop_stage(found)
        return out
    # a value that is two quantiles or more: its rows are split by the second order column
    heavy = found.select("_k", "_b0", F.explode("_q").alias("_v")).groupBy("_k", "_b0", "_v").count().filter("count > 1").drop("count")
    h = heavy.toDF("k", "b", "v")
    tied = base.join(h, F.col("_k").eqNullSafe(F.col("k")) & F.col("_b0").eqNullSafe(F.col("b")) & (F.col("_v") == F.col("v")), "left_semi")
    ties = tied.groupBy("_k", "_b0", "_v").agg(F.array_distinct(F.percentile_approx("_w", share, 16 * parts)).alias("_t"))
    per = ties.groupBy("_k", "_b0").agg(F.map_from_entries(F.collect_list(F.struct("_v", "_t"))).alias("_ties")).toDF("k", "b", "_ties")
    joined = cuts.join(per, F.col("_k").eqNullSafe(F.col("k")) & F.col("_b0").eqNullSafe(F.col("b")), "left").select(
        "_k", "_b0", "_cuts", F.coalesce("_ties", F.create_map().cast("map<bigint,array<bigint>>")).alias("_ties"))
    out = stage(joined.withColumnRenamed("_k", key), "split_points")
    drop_stage(found)
    return out


def _part(df: DataFrame, order: list[str]) -> Column:
    """Part of a split bucket, increasing along the order (0 where the bucket is whole)."""
    v = as_number(df, order[0])
    below = 2 * F.size(F.filter("_cuts", lambda c: c < v)) + F.array_contains("_cuts", v).cast("int")
    within = F.lit(0)
    if len(order) > 1:
        w = as_number(df, order[1])
        within = F.coalesce(F.size(F.filter(F.try_element_at("_ties", v), lambda c: c <= w)), F.lit(0))
    return F.when(F.col("_cuts").isNull() | v.isNull(), F.lit(0).cast("bigint")).otherwise(
        below.cast("bigint") * F.lit(1 << 20) + F.greatest(within, F.lit(0)))


def ordered_neighbors(df: DataFrame, key: str, order: list[str], value: str,
                      before: int = 0, after: int = 0, bucket: Column | None = None, points: DataFrame | None = None) -> DataFrame:
    """Add ``{value}_prev{j}`` (j=1..before) and ``{value}_next{j}`` (j=1..after).

    Equivalent to ``lag(value, j)`` / ``lead(value, j)`` over
    ``partitionBy(key).orderBy(order)``; ``order`` must be unique within a key
    and ``bucket`` (default: :func:`bucket_of` the first order column) must not
    decrease along it.  ``points`` (from :func:`split_points` with the same
    arguments) splits buckets of very many rows; without it a bucket is one task.
    """
    k = max(before, after, 1)
    bucketed = df.withColumn("_b", bucket_of(df, order[0]) if bucket is None else bucket)
    if points is not None:
        p = points.withColumnsRenamed({key: "_pk"})
        bucketed = (bucketed.join(p, F.col(key).eqNullSafe(F.col("_pk")) & F.col("_b").eqNullSafe(F.col("_b0")), "left")
                    .withColumn("_b", F.struct(F.col("_b").alias("b"), _part(df, order).alias("part"))).select(*df.columns, "_b"))
    w = Window.partitionBy(key, "_b").orderBy(*order)
    cols = {"_pos": F.row_number().over(w), "_cnt": F.count(F.lit(1)).over(Window.partitionBy(key, "_b"))}
    for j in range(1, before + 1):
        cols[f"{value}_prev{j}"] = F.lag(value, j).over(w)
    for j in range(1, after + 1):
        cols[f"{value}_next{j}"] = F.lead(value, j).over(w)
    local = bucketed.withColumns(cols)

    # ends of the buckets: at most 2k small rows each, in order
    ends = local.filter((F.col("_pos") <= k) | (F.col("_pos") > F.col("_cnt") - k)).groupBy(key, "_b").agg(
        # whole rows, so that this branch and the rows read one exchange
        F.sort_array(F.collect_list(F.struct("_pos", F.col(value).alias("v"), *[F.col(c).alias(f"c_{c}") for c in df.columns]))).alias("_e"))
    last = F.slice("_e", F.greatest(F.size("_e") - k + 1, F.lit(1)), k)
    along = Window.partitionBy(key).orderBy("_b")
    # k neighbouring buckets hold k values at least, so they are all that is needed
    near = ends.withColumns({
        "_before": F.flatten(F.collect_list(last).over(along.rowsBetween(-k, -1))),
        "_after": F.flatten(F.collect_list(F.slice("_e", 1, k)).over(along.rowsBetween(1, k)))}).select(
        key, "_b", F.transform("_before", lambda s: s["v"]).alias("_before"), F.transform("_after", lambda s: s["v"]).alias("_after"))
    out = local.alias("l").join(near.alias("n"), F.col(f"l.{key}").eqNullSafe(F.col(f"n.{key}")) &
                                F.col("l._b").eqNullSafe(F.col("n._b"))).select("l.*", "_before", "_after")
    fixed = {}
    for j in range(1, before + 1):
        c = f"{value}_prev{j}"
        fixed[c] = F.when(F.col("_pos") > j, F.col(c)).otherwise(
            F.get("_before", F.size("_before") - (F.lit(j) - F.col("_pos") + 1)))
    for j in range(1, after + 1):
        c = f"{value}_next{j}"
        fixed[c] = F.when(F.col("_pos") + j <= F.col("_cnt"), F.col(c)).otherwise(
            F.get("_after", F.col("_pos") + j - F.col("_cnt") - 1))
    return out.withColumns(fixed).drop("_b", "_pos", "_cnt", "_before", "_after")
