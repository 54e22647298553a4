"""Data validation (V1-V12) as a tall report ``(series_id, check, column, metric, value)``.

Row checks (NULLs, rules) are one aggregate over the rows; duplicates are a
grouping on all columns (partial aggregation, so a hot duplicate group is
counted map-side; fingerprints first where rows are wide); missing days come
from neighbouring observed days; sortedness folds summaries of ingest runs.
Only schema checks run on the driver, and they read the schema, not the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.operators.sequence import ID_BITS, as_number
from daycast.operators.tune import key_type
from daycast.session import ship_package, stage

DATETIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


# ------------------------------------------------------------------ schema
def schema_checks(df: DataFrame, date_col: str, target_col: str | None, required: list[str] | None = None,
                  exempt: tuple[str, ...] = ("series_id",)) -> list[dict]:
    """Driver-side checks on the schema only; returns rows ``check, passed, detail``."""
    out = []
    req = list(required or [c for c in (date_col, target_col) if c])
    missing = [c for c in req if c not in df.columns]
    out.append({"check": "required_columns", "passed": not missing,
                "detail": f"missing columns: {missing}" if missing else ""})
    if date_col in df.columns:
        ok = isinstance(df.schema[date_col].dataType, DATETIME_TYPES)
        out.append({"check": "date_type", "passed": ok,
                    "detail": "" if ok else f"column {date_col!r} is {df.schema[date_col].dataType.simpleString()}"})
    bad = [f.name for f in df.schema.fields if f.name != date_col and f.name not in exempt
           and not isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    out.append({"check": "numeric_types", "passed": not bad, "detail": f"non-numeric columns: {bad}" if bad else ""})
    return out


def data_types(df: DataFrame) -> dict[str, str]:
    """Column -> type name."""
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


# ------------------------------------------------------------------ row checks
def null_counts(df: DataFrame, cols: list[str] | None = None, by: str = "series_id") -> DataFrame:
    """A2/V4: NULL count per column, one pass, returned tall."""
    cols = cols or [c for c in df.columns if c != by]
    wide = df.groupBy(by).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = "stack({n}, {pairs}) as (column, null_count)".format(
        n=len(cols), pairs=", ".join(f"'{c}', `{c}`" for c in cols))
    return wide.selectExpr(by, stack)


def duplicate_rows(df: DataFrame, by: str = "series_id") -> DataFrame:
    """U4/V5: extra copies of fully equal rows (NULL equals NULL, as grouping does)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.groupBy(by).agg(F.sum(F.col("_n") - 1).alias("duplicated_rows"))


#: Repeated fingerprints (16 bytes and some) that are sent to all tasks, at most; more are joined by shuffle.
SENT_FINGERPRINTS = 1 << 20


def duplicate_rows_wide(df: DataFrame, by: str = "series_id") -> DataFrame:
    """:func:`duplicate_rows` for wide raw rows: 128-bit fingerprints are counted first, and only rows
    whose fingerprint repeats are regrouped as a whole, so a collision counts for nothing.

    Equal rows have equal fingerprints (NULLs are marked; 0.0 and -0.0, and all
    NaNs, hash alike); a copy that fills a third of the table is collapsed before
    either shuffle.
    """
    marks = [F.col(f"`{c}`").isNull() for c in df.columns]
    cells = [F.col(f"`{c}`") for c in df.columns]
    prints_f, prints_g = F.xxhash64(F.lit(1), *cells, *marks), F.xxhash64(F.lit("2"), *marks, *cells)
    prints = df.select(prints_f.alias("_f"), prints_g.alias("_g"))
    repeated = stage(prints.groupBy("_f", "_g").count().filter("count > 1").select("_f", "_g"), "fingerprints")
    few = repeated.limit(SENT_FINGERPRINTS + 1).count() <= SENT_FINGERPRINTS
    some = df.select(*cells, prints_f.alias("_f"), prints_g.alias("_g")).join(F.broadcast(repeated) if few else repeated, ["_f", "_g"], "left_semi").select(*cells)
    copies = duplicate_rows(some, by).withColumnRenamed(by, "_k")
    series = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    return series.join(copies, F.col(by).eqNullSafe(F.col("_k")), "left").select(
        by, F.coalesce("duplicated_rows", F.lit(0)).cast("bigint").alias("duplicated_rows"))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``key, bucket, seq, day`` sorted by them -> one row per run of equal (key, bucket):
    first and last of ``seq`` and ``day``, rows that are out of order (a NULL day, or a day before the one above)."""
    open_run: dict | None = None
    schema = None

    def put(run: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([run["key"], *(pa.array([run[c]], pa.int64()) for c in (
            "bucket", "first_seq", "last_seq", "first_day", "last_day", "bad"))], names=schema)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key, bucket, seq, day = batch.columns
        schema = [batch.schema.names[0], "bucket", "first_seq", "last_seq", "first_day", "last_day", "bad"]
        codes = key.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        buckets, seqs = (c.fill_null(-(1 << 62)).to_numpy(zero_copy_only=False) for c in (bucket, seq))
        missing, days = day.is_null().to_numpy(zero_copy_only=False), day.fill_null(0).to_numpy(zero_copy_only=False)
        edge = np.r_[True, (codes[1:] != codes[:-1]) | (buckets[1:] != buckets[:-1])]
        after = np.r_[False, ~edge[1:] & ~missing[:-1] & (days[:-1] > days[1:])]
        bad = missing | after
        starts = np.flatnonzero(edge).tolist()
        sums = np.add.reduceat(bad.astype(np.int64), starts).tolist()
        for p, q, wrong in zip(starts, [*starts[1:], n], sums):
            day_of = lambda i: None if missing[i] else int(days[i])
            run = {"key": key.slice(p, 1), "bucket": int(buckets[p]), "first_seq": int(seqs[p]), "last_seq": int(seqs[q - 1]),
                   "first_day": day_of(p), "last_day": day_of(q - 1), "bad": wrong}
            if open_run is not None and p == 0 and open_run["bucket"] == run["bucket"] and open_run["key"].equals(run["key"]):
                before, now = open_run["last_day"], run["first_day"]
                run["bad"] += open_run["bad"] + int(before is not None and now is not None and before > now)
                run["first_seq"], run["first_day"] = open_run["first_seq"], open_run["first_day"]
            elif open_run is not None:
                yield put(open_run)
            open_run = run
    if open_run is not None:
        yield put(open_run)


def sortedness(df: DataFrame, seq: str, day: str, by: str = "series_id") -> DataFrame:
    """In ingest order ``seq``, is ``day`` non-decreasing?  A NULL day
    counts as unsorted.  Inversions are counted, not just detected.

    Each task sorts what it read and sums up every (series, run of ingest
    numbers) as first, last and inversions; these rows, not the readings, are
    shuffled and folded in order.  Where the parts of a run from several tasks
    interleave, the rows of that run alone are dealt anew and summed up again.
    """
    ship_package(df.sparkSession)
    rows = df.select(by, F.shiftright(as_number(df, seq), ID_BITS).alias("bucket"), as_number(df, seq).alias("seq"), as_number(df, day).alias("day"))
    schema = f"{key_type(df, by)}, bucket long, first_seq long, last_seq long, first_day long, last_day long, bad long"
    order = [by, "bucket", "seq"]
    parts = stage(rows.sortWithinPartitions(*order).mapInArrow(_summaries, schema), "sorted_parts")
    # parts are cut to their bucket, so only parts of one bucket can interleave
    along = Window.partitionBy(by, "bucket").orderBy("first_seq")
    mixed = parts.withColumn("_over", F.col("first_seq") <= F.max("last_seq").over(along.rowsBetween(Window.unboundedPreceding, -1)))
    clash = mixed.groupBy(by, "bucket").agg(F.bool_or(F.coalesce("_over", F.lit(False))).alias("_over")).filter("_over").select(
        F.col(by).alias("_k"), F.col("bucket").alias("_b"))
    match = F.col(by).eqNullSafe(F.col("_k")) & F.col("bucket").eqNullSafe(F.col("_b"))
    again = rows.join(clash, match, "left_semi").repartition(by, "bucket").sortWithinPartitions(*order).mapInArrow(_summaries, schema)
    clean = parts.join(clash, match, "left_anti").unionByName(again)
    step = F.lag("last_day").over(Window.partitionBy(by).orderBy("bucket", "first_seq")) > F.col("first_day")
    out = clean.withColumn("_step", F.coalesce(step, F.lit(False)).cast("long"))
    return out.groupBy(by).agg(F.sum(F.col("bad") + F.col("_step")).alias("n_inversions")).withColumn("is_sorted", F.col("n_inversions") == 0)


def missing_days_report(df: DataFrame, day: str = "ds", by: str = "series_id") -> DataFrame:
    """V7 (C4 + J6): count of calendar days absent between first and last day,
    and the text ``'first to last'`` of the missing ones (NULL if none).

    A gap lies between two neighbouring observed days, so one lead over the
    distinct days gives it; no calendar is made.
    """
    obs = df.select(by, F.to_date(day).alias("_d")).filter(F.col("_d").isNotNull()).distinct()
    gaps = obs.withColumn("_next", F.lead("_d").over(Window.partitionBy(by).orderBy("_d")))
    gaps = gaps.withColumn("_gap", F.coalesce(F.datediff("_next", "_d") - 1, F.lit(0)))
    some = F.col("_gap") > 0
    lo, hi = F.min(F.when(some, F.date_add("_d", 1))), F.max(F.when(some, F.date_sub("_next", 1)))
    return gaps.groupBy(by).agg(F.sum(F.greatest("_gap", F.lit(0))).cast("bigint").alias("missing_count"), lo.alias("_lo"), hi.alias("_hi")).select(
        by, "missing_count", F.when(F.col("missing_count") > 0, F.concat_ws(" to ", F.col("_lo").cast("string"), F.col("_hi").cast("string")))
        .alias("missing_range"))


def _rule_items(df: DataFrame, rules: dict | None, target: str) -> list[tuple]:
    """(scope, column, rule, predicate) for every rule on a present column."""
    items = []
    rules = rules or {}
    tr = rules.get("target", {})
    if target not in df.columns:
        tr = {}
    if not tr.get("allow_negative", True):
        items.append(("target", target, "negative_values", F.col(target) < 0))
    if "min_value" in tr:
        items.append(("target", target, "below_min", F.col(target) < F.lit(float(tr["min_value"]))))
    if "max_value" in tr:
        items.append(("target", target, "above_max", F.col(target) > F.lit(float(tr["max_value"]))))
    for c, r in rules.get("regressors", {}).items():
        if c not in df.columns:
            continue
        if "min_value" in r:
            items.append(("regressors", c, "below_min", F.col(c) < F.lit(float(r["min_value"]))))
        if "max_value" in r:
            items.append(("regressors", c, "above_max", F.col(c) > F.lit(float(r["max_value"]))))
    return items


def _rules_tall(wide: DataFrame, items: list[tuple], by: str) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(s).alias("scope"), F.lit(c).alias("column"), F.lit(r).alias("rule"),
                                 F.col(f"_v{i}").cast("bigint").alias("violations"))
                        for i, (s, c, r, _) in enumerate(items)])
    return wide.select(by, F.inline(entries)).filter(F.col("violations") > 0)


def type_rows(df: DataFrame, name: str) -> DataFrame:
    """V1-V3, V11 from the data: one row per column of a frame with its type, rows and NULLs."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(f"_n{i}").alias("n_null"))
                        for i, (c, t) in enumerate(df.dtypes)])
    wide = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)])
    return wide.select(F.lit(name).alias("frame"), "n_rows", F.inline(entries))


def rule_violations(df: DataFrame, rules: dict | None, target: str = "y", by: str = "series_id") -> DataFrame:
    """V8-V10 (X4): business rules as ``count_if`` columns in one pass, returned
    tall; zero-violation entries are left out; rules on absent columns are skipped.

    ``rules = {"target": {"allow_negative": False, "min_value": .., "max_value": ..},
               "regressors": {col: {"min_value": .., "max_value": ..}}}``
    """
    items = _rule_items(df, rules, target)
    if not items:
        return df.sparkSession.createDataFrame(
            [], f"{by} string, scope string, column string, rule string, violations bigint")
    wide = df.groupBy(by).agg(*[F.count_if(p).alias(f"_v{i}") for i, (_, _, _, p) in enumerate(items)])
    return _rules_tall(wide, items, by)


# ------------------------------------------------------------------ assembly
def validation_report(df: DataFrame, date_col: str = "ds", target_col: str | None = "y", is_training: bool = True,
                      seq: str | None = None, rules: dict | None = None, by: str = "series_id") -> DataFrame:
    """One row per series with every check and ``is_valid``.

    Flag-raising checks: schema (required columns, a date type, numeric types),
    NULLs (in training after dropping rows without a target; a missing target
    column is an error of the schema), duplicated rows (of the input as it came;
    reported after the date is cut to its day), unsorted input (in ingest order
    ``seq``, when given) and missing days.  Rule violations are reported
    (``business_rules``, nested) but do not flip the flag.  A forecast frame
    (``is_training=False``) has no target (``target_col=None``).
    """
    checks = schema_checks(df, date_col, target_col, exempt=(by, *([seq] if seq else [])))
    schema_ok = all(c["passed"] for c in checks)
    dated = date_col in df.columns and isinstance(df.schema[date_col].dataType, DATETIME_TYPES)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    value_cols = [c for c in df.columns if c not in (by, seq)]
    items = [i for i in _rule_items(df, rules, target_col or "") if i[1] in numeric]
    # one aggregate pass: row count, NULL cells and every rule counter
    counted = F.col(target_col).isNotNull() if is_training and target_col in df.columns else F.lit(True)
    rep = df.groupBy(by).agg(
        F.count_if(counted).alias("n_rows"),
        sum((F.count_if(counted & F.col(c).isNull()) for c in value_cols), F.lit(0)).cast("bigint").alias("null_cells"),
        *[F.count_if(p).cast("bigint").alias(f"_v{i}") for i, (_, _, _, p) in enumerate(items)])
    rep = rep.withColumns({
        "rule_violations": sum((F.col(f"_v{i}") for i in range(len(items))), F.lit(0)).cast("bigint"),
        "business_rules": _rules_nested(items)}).drop(*[f"_v{i}" for i in range(len(items))])
    given = duplicate_rows(df.select(by, *value_cols), by).withColumnRenamed("duplicated_rows", "_given")
    cut = df.withColumn(date_col, F.to_date(date_col)) if dated else df
    # a date column has no time of day to cut: one grouping serves both points
    timed = dated and not isinstance(df.schema[date_col].dataType, T.DateType)
    dups = duplicate_rows(cut.select(by, *value_cols), by) if timed else given.withColumnRenamed("_given", "duplicated_rows")
    rep = rep.join(dups, by, "left")
    rep = rep.join(given, by, "left") if timed else rep.withColumn("_given", F.col("duplicated_rows"))
    if dated:
        rep = rep.join(missing_days_report(cut, date_col, by), by, "left")
    else:
        rep = rep.withColumns({"missing_count": F.lit(None).cast("bigint"), "missing_range": F.lit(None).cast("string")})
    if seq is not None and dated:
        rep = rep.join(sortedness(df, seq, date_col, by).select(by, "is_sorted"), by, "left")
    else:
        rep = rep.withColumn("is_sorted", F.lit(None).cast("boolean"))  # no ingest order, no statement
    dup = F.coalesce("duplicated_rows", F.lit(0)).cast("bigint")
    # a training series without any target stays in the report, and is not valid
    valid = F.lit(schema_ok) & (F.col("n_rows") > 0) & (F.col("null_cells") == 0) & (F.coalesce("_given", F.lit(0)) == 0) & \
        F.coalesce("is_sorted", F.lit(True)) & (F.coalesce("missing_count", F.lit(0)) == 0)
    return rep.select(by, F.lit(schema_ok).alias("schema_ok"), "n_rows", "null_cells", dup.alias("duplicated_rows"),
                      "missing_count", "missing_range", "is_sorted", "rule_violations", "business_rules",
                      valid.alias("is_valid"))


def _rules_nested(items: list[tuple]):
    """``target`` (rule -> violations) and ``regressors`` (column -> rule -> violations), without the zeros."""
    def rules_of(pairs):
        some = F.filter(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"_v{i}").alias("n")) for i, r in pairs]) if pairs
                        else F.array().cast("array<struct<rule:string,n:bigint>>"), lambda x: x["n"] > 0)
        return F.map_from_entries(some)

    target = rules_of([(i, r) for i, (s, _, r, _) in enumerate(items) if s == "target"])
    columns = list(dict.fromkeys(c for s, c, _, _ in items if s == "regressors"))
    each = [F.struct(F.lit(c).alias("column"), rules_of([(i, r) for i, (s, k, r, _) in enumerate(items) if s != "target" and k == c])
                     .alias("rules")) for c in columns]
    some = F.filter(F.array(*each) if each else F.array().cast("array<struct<column:string,rules:map<string,bigint>>>"),
                    lambda x: F.size(x["rules"]) > 0)
    return F.struct(target.alias("target"), F.map_from_entries(some).alias("regressors"))


def report_document(report: DataFrame, null_tall: DataFrame, types: dict[str, str], as_of: str,
                    by: str = "series_id") -> DataFrame:
    """Nested form of the report (as the JSON artifact): maps and structs per series."""
    nm = null_tall.groupBy(by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("column", "null_count"))))
                                   .alias("missing_values"))
    tmap = F.create_map(*[x for k, v in types.items() for x in (F.lit(k), F.lit(v))])
    return report.join(nm, by, "left").select(
        by, F.lit(as_of).alias("date"), tmap.alias("data_types"), "missing_values", "duplicated_rows",
        F.struct("is_sorted", F.struct(F.col("missing_count").alias("count"),
                                       F.col("missing_range").alias("range")).alias("missing_dates"))
        .alias("date_report"), "business_rules", "is_valid")
