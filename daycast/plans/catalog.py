"""Query registry: one entry per operator group of SURVEY §2.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
columns match the oracle SQL of the same key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.functions import calendar as CAL
from daycast.functions import design as D
from daycast.functions.columns import rounded
from daycast.operators import clean, daily, joins
from daycast.operators import evaluate as EV
from daycast.operators import model as M
from daycast.operators import pooled as PL
from daycast.operators import ridge as RG
from daycast.operators import sequence as SQ
from daycast.operators import serve as S
from daycast.operators import validate as V
from daycast.operators import validate_state as VS
from daycast.operators import weather as W
from daycast.plans import stages as P
from daycast.session import scratch_path, stage
from daycast.sources import fixtures as FX
from daycast.sources import landing as LD
from daycast.sources import layout as LY
from daycast.sources import payloads
from daycast.sources import sinks as SK
from daycast.streaming import daily_stream as ZS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    """Register a query.  Days are cut from timestamps without a zone, so the
    caller's session zone is neither needed nor changed."""
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


@register("retrain_decision")
def q_retrain_decision(spark, sf):
    """Flagship (B3-B5, J1, F1/F2, W4, M7, E1-E4): per-segment last-60 MAE/MASE and retrain flag."""
    return P.retrain_decision(spark, sf)


@register("retrain_decision_by_nation")
def q_retrain_decision_by_nation(spark, sf):
    """The flagship over many series: one per (segment, nation), 125 keys."""
    return P.retrain_decision(spark, sf, FX.SEGMENT_NATION)


# ====================================================================== helpers


def _r(df: DataFrame, places: dict[str, int]) -> DataFrame:
    """Round double outputs (summation order differs between engines)."""
    return df.withColumns({c: rounded(c, p) for c, p in places.items()})


TEMPS = {"temperature_max": 6, "temperature_min": 6, "temperature_mean": 6}

# Fixed parameters of the registered queries.
AS_OF_DAILY = "2024-01-15"
FACETS = {"series_id": "purchase"}
ROW_CAP = 100
WEATHER_RANGE = ("1996-01-01", "1996-12-31")


# ====================================================================== S1-S6, B1-B7, A1
@register("json_records_flatten")
def q_json_records_flatten(spark, sf):
    """Events served as record-envelope pages, parsed back to rows."""
    pl = payloads.envelope_payloads(FX.event_readings(spark, sf))
    rows, _rejects = payloads.flatten_records(pl, keep=["page"])
    return _r(rows.select("page", clean.parse_day("jour").alias("ds"), "jour", "conso_jour"), {"conso_jour": 6})


@register("json_rejects")
def q_json_rejects(spark, sf):
    """S1/S2 rejects: event values as payloads, every third cut short (no JSON),
    every fifth weather payload without one of its arrays; rows and rejects counted."""
    ev = FX.event_readings(spark, sf)
    whole = F.to_json(F.struct(F.array(F.struct(F.date_format("ts", "yyyy-MM-dd").alias("jour"), F.col("value").alias("conso_jour")))
                               .alias("records")))
    text = F.when(F.col("event_id") % 3 == 0, F.substring(whole, 1, 20)).otherwise(whole)
    rows, bad = payloads.flatten_records(ev.select("series_id", text.alias("payload")), keep=["series_id"])
    arrays = {v: F.array(F.col("value")) for v in payloads.WEATHER_VARS}
    gap = payloads.WEATHER_VARS[-1]
    part = F.struct(F.array(F.date_format("ts", "yyyy-MM-dd")).alias("time"), *[c.alias(v) for v, c in arrays.items() if v != gap])
    full = F.struct(F.array(F.date_format("ts", "yyyy-MM-dd")).alias("time"), *[c.alias(v) for v, c in arrays.items()])
    pay = F.when(F.col("event_id") % 5 == 0, F.to_json(F.struct(part.alias("daily")))).otherwise(F.to_json(F.struct(full.alias("daily"))))
    wrows, wbad = payloads.flatten_arrays(ev.select("series_id", pay.alias("payload")), keep=["series_id"])
    count = lambda d, s, k: d.groupBy("series_id").agg(F.count(F.lit(1)).alias("n")).withColumns(
        {"shape": F.lit(s), "kind": F.lit(k)})
    return (count(rows, "records", "rows").unionByName(count(bad, "records", "rejects"))
            .unionByName(count(wrows, "arrays", "rows")).unionByName(count(wbad, "arrays", "rejects")))


@register("json_arrays_flatten")
def q_json_arrays_flatten(spark, sf):
    """Daily weather served as monthly parallel-array payloads, zipped back to rows."""
    pl = payloads.weather_payloads(FX.weather_daily(spark, sf))
    rows, _rejects = payloads.flatten_arrays(pl, keep=["month"])
    return _r(rows, {v: 6 for v in payloads.WEATHER_VARS})


@register("props_json")
def q_props_json(spark, sf):
    """JSON text column of events parsed with a declared schema."""
    r = FX.event_readings(spark, sf)
    return r.select("series_id", "event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@register("fetch_window_daily_mode")
def q_fetch_window_daily_mode(spark, sf):
    """S4/B1: 'daily' fetch window [as_of - 1 day, as_of) then daily totals."""
    win = daily.fetch_window(FX.event_readings(spark, sf), "daily", as_of=AS_OF_DAILY)
    return _r(daily.daily_totals(win), {"y": 2})


@register("fetch_day_layout")
def q_fetch_day_layout(spark, sf):
    """Readings laid out by day, then the 'daily' window from its one folder, rolled up."""
    path = scratch_path(spark, f"days-{uuid.uuid4().hex}")
    LY.write_days(FX.event_readings(spark, sf).drop("props"), path)
    return _r(daily.daily_totals(LY.fetch_days(spark, path, "daily", as_of=AS_OF_DAILY)), {"y": 2})


#: Fixed parameter of the query: records in a landed file.
LANDED_PAGE = 1_000


@register("landing_records")
def q_landing_records(spark, sf):
    """S1 from files: pages of events land as JSON files in two deliveries, each file is read once, rows carry their page."""
    base = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    pages = stage(payloads.envelope_payloads(FX.event_readings(spark, sf), LANDED_PAGE), "landing_pages")
    for part in (0, 1):
        some = pages.filter(F.col("page") % 2 == part).repartition("page")
        some.write.mode("append").partitionBy("page").text(base + "/in")
        LD.ingest(spark, base + "/in", base)
    rows, _rejects = LD.landed(spark, base)
    page = F.regexp_extract("file", "page=([0-9]+)", 1).cast("bigint").alias("page")
    return _r(rows.select(page, clean.parse_day("jour").alias("ds"), "jour", "conso_jour"), {"conso_jour": 6})


@register("facet_filter")
def q_facet_filter(spark, sf):
    """B2: equality facets, then daily totals."""
    r = daily.facet_filter(FX.event_readings(spark, sf), FACETS)
    return _r(daily.daily_totals(r), {"y": 2})


@register("ordered_limit")
def q_ordered_limit(spark, sf):
    """Daily totals ordered by first reading, the first 100 of all."""
    d = daily.daily_totals(FX.event_readings(spark, sf))
    return _r(daily.first_n(d, ROW_CAP).select("series_id", "ds", "jour", "y"), {"y": 2})


@register("daily_totals")
def q_daily_totals(spark, sf):
    """Orders per segment and day: first reading, sum, count."""
    return _r(daily.daily_totals(FX.order_readings(spark, sf)), {"y": 2})


@register("tumbling_day")
def q_tumbling_day(spark, sf):
    """B3 through 1-day tumbling windows on events."""
    return _r(daily.tumbling_day(FX.event_readings(spark, sf)), {"y": 2})


@register("ingest_profile")
def q_ingest_profile(spark, sf):
    """A1: rows, first and last day per segment; empty segments listed."""
    d = P.daily_target(spark, sf)
    segs = FX.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("series_id"))
    return daily.ingest_profile(d, segs)


@register("required_columns_scan")
def q_required_columns_scan(spark, sf):
    """Required-column check, then a pruned scan."""
    ev = FX.table(spark, sf, "events")
    return clean.require_columns(ev, ["event_id", "event_type", "ts", "value"], "events")


@register("clean_projection")
def q_clean_projection(spark, sf):
    """Drop debug column, rename, parse the day."""
    raw = daily.daily_totals(FX.event_readings(spark, sf)).select(
        "series_id", F.date_format("jour", "yyyy-MM-dd'T'HH:mm:ss").alias("jour"),
        F.col("y").alias("conso_jour"), F.date_format("ds", "yyyy-MM-dd").alias(clean.DEBUG_COLUMN))
    df = clean.rename(clean.drop_if_present(raw, clean.DEBUG_COLUMN, "not_a_column"), clean.TARGET_RENAMES)
    df = df.withColumn("date", clean.parse_day("date"))
    return _r(df, {"daily_conso_kwh": 2})


@register("zero_repair")
def q_zero_repair(spark, sf):
    """P9/P10/W1 over raw event readings (bucketed neighbours); every seventh reading counts as a zero."""
    value = F.when(F.col("event_id") % 7 == 0, 0.0).otherwise(F.col("value"))
    r = FX.event_readings(spark, sf).select("series_id", "event_id", "ts", value.alias("value"))
    return _r(clean.repair_zeros_raw(r, "series_id", ["ts", "event_id"], "value"), {"value": 6})


#: Fixed parameter of the query: rows from which a day is split (production: ``sequence.SPLIT_ROWS``).
HOT_DAY_ROWS = 200


@register("zero_repair_hot_day")
def q_zero_repair_hot_day(spark, sf):
    """P9/P10/W1 where one series has all readings on one day, many of them at one instant: the day is split at stored points."""
    ev = FX.event_readings(spark, sf)
    instant = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.pmod(F.col("event_id") * 7919, F.lit(86_400)))
    r = ev.select(F.lit("all").alias("series_id"), "event_id",
                  (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=instant)).alias("ts"),
                  F.when(F.col("event_id") % 7 == 0, 0.0).otherwise(F.col("value")).alias("value"))
    points = SQ.split_points(r, "series_id", ["ts", "event_id"], rows=HOT_DAY_ROWS, parts=32)
    return _r(clean.repair_zeros_raw(r, "series_id", ["ts", "event_id"], "value", points=points), {"value": 6})


# ====================================================================== U1/U3, J1, P6/P7/P11, F1/F2, S3
@register("weather_union_first")
def q_weather_union_first(spark, sf):
    """Archive then forecast, first row per day."""
    return _r(P.weather(spark, sf), TEMPS)


@register("weather_left_target")
def q_weather_left_target(spark, sf):
    """J1 + F1/F2: every weather day for every segment, target left-joined."""
    return _r(P.full_data(spark, sf, staged=False), {**TEMPS, "y": 2, "HDD": 6, "CDD": 6})


@register("availability_cap")
def q_availability_cap(spark, sf):
    """Days up to the last day with a target."""
    full = P.full_data(spark, sf, staged=False)
    return _r(clean.availability_cap(full).select("series_id", "ds", "y", "temperature_mean"),
              {"y": 2, "temperature_mean": 6})


@register("prepared_train")
def q_prepared_train(spark, sf):
    """Training rows."""
    return _r(P.prepared_train(P.full_data(spark, sf, staged=False)), {"y": 2, "HDD": 6, "CDD": 6})


@register("prepared_forecast")
def q_prepared_forecast(spark, sf):
    """Forecast rows (target dropped)."""
    return _r(P.prepared_forecast(P.full_data(spark, sf, staged=False)), {"HDD": 6, "CDD": 6})


@register("degree_days")
def q_degree_days(spark, sf):
    """F1/F2 on the merged weather."""
    w = P.with_degree_days(P.weather(spark, sf)).select("ds", "temperature_mean", "HDD", "CDD")
    return _r(w, {"temperature_mean": 6, "HDD": 6, "CDD": 6})


@register("weather_select")
def q_weather_select(spark, sf):
    """S3: variable selection and an inclusive day range."""
    w = W.select_weather(P.weather(spark, sf), ["temperature_max", "temperature_mean"], *WEATHER_RANGE)
    return _r(w, {"temperature_max": 6, "temperature_mean": 6})


# ====================================================================== C1-C5, J3, J7, M3

HORIZON = 7
RULES = {
    "target": {"allow_negative": False, "min_value": 10000.0, "max_value": 2000000.0},
    "regressors": {"HDD": {"max_value": 2.0}, "CDD": {"min_value": 0.5, "max_value": 12.0},
                   "temperature_mean": {"min_value": 10.0}},
}


def _years(spark, sf):
    """Years from the first order to the last event."""
    days = FX.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("ds")).unionByName(
        FX.table(spark, sf, "events").select(F.to_date("ts").alias("ds")))
    return CAL.years_of(days, "ds")


@register("holidays_fr")
def q_holidays_fr(spark, sf):
    """Holiday table for the years spanned by orders and events."""
    return CAL.holiday_table(_years(spark, sf))


@register("bridge_days")
def q_bridge_days(spark, sf):
    """Friday after a Thursday public holiday."""
    return CAL.bridge_days(CAL.public_holidays(_years(spark, sf)))


@register("holiday_windows")
def q_holiday_windows(spark, sf):
    """Target days inside each holiday's window, with the offset."""
    eff = CAL.holiday_effect_days(CAL.holiday_table(_years(spark, sf)))
    t = P.staged_target(spark, sf).select("series_id", "ds")
    # the holiday side is about a dozen rows a year: bounded by construction
    return t.join(F.broadcast(eff), t.ds == eff.day, "inner").select("series_id", "ds", "holiday", "offset")


@register("future_calendar")
def q_future_calendar(spark, sf):
    """History days plus 7 days after the last one."""
    return CAL.future_calendar(P.prepared_train(P.full_data(spark, sf)), HORIZON)


@register("future_regressors")
def q_future_regressors(spark, sf):
    """Future calendar inner-joined with the regressors."""
    full = P.full_data(spark, sf)
    cal = CAL.future_calendar(P.prepared_train(full), HORIZON)
    return _r(joins.inner_on_day(cal, full.select("series_id", "ds", "HDD", "CDD")), {"HDD": 6, "CDD": 6})


# ====================================================================== V1-V12
@register("missing_days")
def q_missing_days(spark, sf):
    """V7 (C4 + J6): missing days per segment, count and range."""
    return V.missing_days_report(P.staged_target(spark, sf))


@register("null_counts")
def q_null_counts(spark, sf):
    """A2/V4: NULL count per column, tall."""
    return V.null_counts(P.full_data(spark, sf, staged=False))


@register("duplicate_rows")
def q_duplicate_rows(spark, sf):
    """U4/V5: extra copies of equal rows, where every eleventh reading came twice."""
    ev = FX.event_readings(spark, sf)
    return V.duplicate_rows_wide(ev.unionByName(ev.filter(F.col("event_id") % 11 == 0)))


@register("sorted_check")
def q_sorted_check(spark, sf):
    """Is the order day non-decreasing in order-key order."""
    return V.sortedness(FX.order_readings(spark, sf), "event_id", "ts")


@register("business_rules")
def q_business_rules(spark, sf):
    """Rule violations, zero entries left out."""
    return V.rule_violations(P.prepared_train(P.full_data(spark, sf, staged=False)), RULES)


def _gate_rows(spark, sf):
    """Order series (with gap days on small fixtures, some in reverse ingest
    order) beside event series (gap-free): rows for the checks and the gate."""
    day = F.datediff("ds", F.lit("1970-01-01").cast("date")).cast("bigint")
    orders = P.prepared_train(P.full_data(spark, sf, staged=False)).withColumn(
        "seq", F.when(F.length("series_id") % 2 == 0, day).otherwise(-day))
    ev = daily.daily_totals(FX.event_readings(spark, sf)).select(
        "series_id", "ds", "y", F.lit(0.0).alias("HDD"), F.lit(0.0).alias("CDD"), day.alias("seq"))
    return orders.unionByName(ev)


def _gate_report(spark, sf):
    rows = stage(_gate_rows(spark, sf), "gate_rows")
    return rows, V.validation_report(rows, seq="seq", rules=RULES)


def _ruled(rep):
    """The nested rules as text."""
    return rep.withColumns({"business_rules": F.concat_ws(";", F.array_join(F.transform(
        F.map_entries("business_rules.target"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","),
        F.array_join(F.transform(F.map_entries("business_rules.regressors"), lambda e: F.concat(
            e["key"], F.lit(":"), F.array_join(F.transform(F.map_entries(e["value"]), lambda r: F.concat_ws(
                "=", r["key"], r["value"].cast("string"))), ","))), "|"))})


@register("validation_report")
def q_validation_report(spark, sf):
    """One row per segment with every check and the flag."""
    return _ruled(_gate_report(spark, sf)[1])


INCREMENT_RULES = {"target": {"allow_negative": False, "min_value": 20.0, "max_value": 90.0}, "regressors": {"event_id": {"min_value": 50}}}


@register("validation_increments")
def q_validation_increments(spark, sf):
    """A2/A3/V4/V5/V7-V10 over four deliveries (one of them again): NULL values, rules, copies and gap days from the stored state."""
    ev = FX.event_readings(spark, sf)
    rows = ev.filter(F.dayofmonth("ts") % 9 != 4).select("series_id", "event_id", F.to_date("ts").alias("ds"),
                                                         F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("y"))
    rows = rows.unionByName(rows.filter("event_id % 11 = 0"))
    root = scratch_path(spark, f"state-{uuid.uuid4().hex}")
    for run, part in enumerate((0, 1, 2, 1)):
        state = VS.deliver(rows.filter(F.dayofmonth("ds") % 3 == part), root, str(run), rules=INCREMENT_RULES)
    return VS.report(state)


@register("validation_document")
def q_validation_document(spark, sf):
    """The nested report (type map, NULL map, date report) per series."""
    rows, rep = _gate_report(spark, sf)
    rows = rows.drop("seq")
    doc = V.report_document(rep, V.null_counts(rows), V.data_types(rows), RUN_AS_OF)
    return doc.select("series_id", F.to_json(F.struct(*[c for c in doc.columns if c not in ("series_id", "business_rules")]),
                                             {"ignoreNullFields": "false"}).alias("document"),
                      F.map_entries("business_rules.target").cast("string").alias("target_rules"),
                      F.size("business_rules.regressors").alias("n_regressors_ruled"))


# ====================================================================== W4, M1, M2, M4, M7, M9
@register("chronological_split")
def q_chronological_split(spark, sf):
    """First 80 % of each series is train."""
    prepared = P.prepared_train(P.full_data(spark, sf, staged=False))
    return _r(EV.chronological_split(prepared), {"y": 2, "HDD": 6, "CDD": 6})


@register("fourier_terms")
def q_fourier_terms(spark, sf):
    """M2: weekly (3) and yearly (10) Fourier terms."""
    p = P.prepared_train(P.full_data(spark, sf, staged=False)).select("series_id", "ds")
    return _r(p.withColumns(D.fourier_columns()), {c: 6 for c in D.fourier_names()})


@register("trend_hinges")
def q_trend_hinges(spark, sf):
    """M1: trend time over the train rows and 25 changepoint hinges."""
    prepared = P.prepared_train(P.full_data(spark, sf, staged=False))
    s = EV.chronological_split(prepared).select("series_id", "ds", "split")
    t = D.with_trend_time(s, fit_mask=F.col("split") == "train")
    h = t.withColumns(D.hinge_columns()).drop("split")
    return _r(h, {c: 6 for c in ["t"] + list(D.hinge_columns())})


@register("scaled_regressors")
def q_scaled_regressors(spark, sf):
    """M4: HDD/CDD standardised on train rows."""
    prepared = P.prepared_train(P.full_data(spark, sf, staged=False))
    s = EV.chronological_split(prepared).select("series_id", "ds", "split", "HDD", "CDD")
    z = D.standardize(s, ["HDD", "CDD"], fit_mask=F.col("split") == "train").drop("HDD", "CDD")
    return _r(z, {"HDD_z": 6, "CDD_z": 6})


@register("trend_weekday_forecast")
def q_trend_weekday_forecast(spark, sf):
    """M7/M8: OLS trend plus weekday effect, scored on every prepared row."""
    scored, _ = P.trend_weekday_scored(P.prepared_train(P.full_data(spark, sf)))
    return _r(scored.select("series_id", "ds", "y", "split", "yhat"), {"y": 2, "yhat": 4})


@register("residual_bounds")
def q_residual_bounds(spark, sf):
    """M9: 10 % / 90 % residual quantiles of the train rows."""
    scored, _ = P.trend_weekday_scored(P.prepared_train(P.full_data(spark, sf)))
    b = M.residual_bounds(scored.filter(F.col("split") == "train"))
    return _r(b, {"q_lo": 4, "q_hi": 4})


# ====================================================================== E1-E6, S12, A7, M11

NAIVE_TRIALS = list(range(1, 15))


def _report(spark, sf, prepared=None):
    prepared = prepared if prepared is not None else P.prepared_train(P.full_data(spark, sf))
    scored, _ = P.trend_weekday_scored(prepared)
    return EV.window_report(scored, P.MODEL_TREND_WEEKDAY)


def _median_flags(rep):
    """Flags with the median score as threshold: about half of the series on either side."""
    return EV.retrain_flag(rep, threshold=rep.agg(F.percentile("mase_window", 0.5)).scalar())


@register("seasonal_naive")
def q_seasonal_naive(spark, sf):
    """Value 7 rows earlier."""
    p = P.prepared_train(P.full_data(spark, sf, staged=False)).select("series_id", "ds", "y")
    return _r(EV.seasonal_naive(p), {"y": 2, "naive": 2})


@register("mase")
def q_mase(spark, sf):
    """Tuning metric: MASE of the model on the test part (scaled in-window)."""
    scored, _ = P.trend_weekday_scored(P.prepared_train(P.full_data(spark, sf)))
    test = scored.filter(F.col("split") == "test")
    rep = EV.window_report(test, P.MODEL_TREND_WEEKDAY, window_size=1 << 30)
    return rep.select("series_id", F.col("mae_window").alias("mae"), F.col("mase_window").alias("mase"))


@register("last60_report")
def q_last60_report(spark, sf):
    """Last-60 MAE and MASE."""
    return _report(spark, sf)


@register("retrain_flag")
def q_retrain_flag(spark, sf):
    """MASE > 0.95, NULL means retrain."""
    return _r(EV.retrain_flag(_report(spark, sf)), {"metric_value": 4})


@register("retrain_default")
def q_retrain_default(spark, sf):
    """Every series gets a flag, default True."""
    flags = EV.retrain_flag(_report(spark, sf)).select("series_id", "should_retrain")
    series = FX.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("series_id")).unionByName(
        FX.table(spark, sf, "events").select(F.col("event_type").alias("series_id")))
    return EV.flags_with_default(series, flags)


@register("gated_series")
def q_gated_series(spark, sf):
    """E5: rows of valid series pass, the rest are rejected."""
    prepared, rep = _gate_report(spark, sf)
    ok, bad = EV.gate(prepared, rep)
    cnt = lambda d, s: d.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "status", F.lit(s))
    return cnt(ok, "passed").unionByName(cnt(bad, "rejected"))


@register("train_flagged_only")
def q_train_flagged_only(spark, sf):
    """Training rows of series flagged for retraining (those above the median score)."""
    prepared = P.prepared_train(P.full_data(spark, sf))
    split = EV.chronological_split(prepared)
    flags = _median_flags(_report(spark, sf, prepared))
    train = split.filter(F.col("split") == "train").select("series_id", "ds", "y")
    return _r(EV.train_flagged_only(train, flags), {"y": 2})


@register("best_trial")
def q_best_trial(spark, sf):
    """A7 over a score table: seasonal-naive lags 1..14 scored by test MAE."""
    from daycast.operators.tune import best_trial, naive_lag_scores

    split = EV.chronological_split(P.prepared_train(P.full_data(spark, sf)))
    scores = naive_lag_scores(split, NAIVE_TRIALS)
    return _r(best_trial(scores, ["lag"]).select("series_id", "trial_id", "score"), {"score": 4})


@register("model_fallback")
def q_model_fallback(spark, sf):
    """Registry model (fit on the first half, kept for series not flagged
    for retraining, here the better half) first, the freshly trained local model second."""
    prepared = P.prepared_train(P.full_data(spark, sf))
    half = EV.chronological_split(prepared, 0.5)
    registry = M.fit_trend_weekday(half.filter(F.col("split") == "train"))
    _, local = P.trend_weekday_scored(prepared)
    flags = _median_flags(_report(spark, sf, prepared))
    registry = registry.join(flags.filter(~F.col("should_retrain")).select("series_id"), "series_id", "left_semi")
    m = M.model_fallback(registry.select("series_id", "intercept", "slope"),
                         local.select("series_id", "intercept", "slope"),
                         prepared)
    return _r(m.select("series_id", "source", F.col("model.intercept").alias("intercept"),
                       F.col("model.slope").alias("slope")), {"intercept": 4, "slope": 6})


# ====================================================================== S9, Y1-Y4, J4
def _history(spark, sf):
    prepared = P.prepared_train(P.full_data(spark, sf))
    naive = EV.window_report(P.naive_scored(prepared).filter(F.col("yhat").isNotNull()), "naive_7_days")
    tw = _report(spark, sf, prepared)
    h = S.append_history(None, naive.withColumn("run_order", F.lit(1)))
    h = S.append_history(h, tw.withColumn("run_order", F.lit(2)))
    return S.append_history(h, tw.withColumn("run_order", F.lit(3)))  # a rerun appends again


@register("metrics_history")
def q_metrics_history(spark, sf):
    """Naive run, model run and a rerun appended."""
    return _history(spark, sf)


@register("scorecard")
def q_scorecard(spark, sf):
    """Latest history row per model and series."""
    return S.scorecard(_history(spark, sf))


@register("forecast_with_actuals")
def q_forecast_with_actuals(spark, sf):
    """Forecast with bounds, inner-joined to actuals on the day."""
    full = P.full_data(spark, sf)
    fa = S.forecast_with_actuals(P.forecast_frame(full), full)
    return _r(fa, {"yhat": 4, "yhat_lower": 4, "yhat_upper": 4, "daily_conso_kwh": 2})


@register("history_view_70d")
def q_history_view_70d(spark, sf):
    """Y1 (A6, W7, W8): up to the last observed day, last 70 days."""
    full = P.full_data(spark, sf)
    v = S.history_view(S.forecast_with_actuals(P.forecast_frame(full), full))
    return S.sort_days(_r(v.select("series_id", "ds", "yhat", "yhat_lower", "yhat_upper", "daily_conso_kwh"),
                          {"yhat": 4, "yhat_lower": 4, "yhat_upper": 4, "daily_conso_kwh": 2}))


@register("axis_bounds")
def q_axis_bounds(spark, sf):
    """NULL-skipping min/max over several columns, scaled."""
    full = P.full_data(spark, sf)
    v = S.history_view(S.forecast_with_actuals(P.forecast_frame(full), full))
    return _r(S.axis_bounds(v), {"y_min": 4, "y_max": 4})


# ====================================================================== S5, S7, S8, S10-S14, M10


RUN_AS_OF = "2001-08-02T00:00:00"


@register("artifact_roundtrip")
def q_artifact_roundtrip(spark, sf):
    """Write metrics, flags, report, forecast and model under a fresh folder of
    the shared checkpoint dir, then read them back by artifact name."""
    from daycast.operators.model import residual_bounds, with_bounds

    root = scratch_path(spark, f"artifacts-{uuid.uuid4().hex}")
    full = P.full_data(spark, sf)
    prepared = P.prepared_train(full)
    scored, coef = P.trend_weekday_scored(prepared)
    scored, coef = stage(scored, "tw_scored"), stage(coef, "tw_coef")  # reused by four sinks
    report = EV.window_report(scored, P.MODEL_TREND_WEEKDAY)
    SK.save_metrics(report, root, RUN_AS_OF)
    SK.save_flags(EV.retrain_flag(report).select("series_id", "should_retrain"), root, RUN_AS_OF)
    SK.save_report(V.validation_report(prepared, rules=RULES).drop("business_rules"), root)
    bounds = residual_bounds(scored.filter(F.col("split") == "train"))
    SK.save_forecast(with_bounds(M.predict_trend_weekday(full.select("series_id", "ds"), coef), bounds), root,
                     P.MODEL_TREND_WEEKDAY)
    SK.save_model(M.coefficients_long(coef, P.MODEL_TREND_WEEKDAY), root)
    met = SK.read_artifact(spark, root, "metrics")
    flags = EV.flags_with_default(met, SK.read_flags(spark, root))
    dq = SK.read_artifact(spark, root, "data_quality").select("series_id", "is_valid")
    fc = SK.read_artifact(spark, root, "forecast").groupBy("series_id").agg(F.count(F.lit(1)).alias("n_forecast"))
    mod = M.coefficients_wide(SK.read_artifact(spark, root, "model"))
    return (met.join(flags, "series_id").join(dq, "series_id").join(fc, "series_id")
            .join(mod.select("series_id", "intercept"), "series_id")
            .select("series_id", "model_name", "timestamp_utc", "window_size", "baseline", "mae_window",
                    "mase_window", "should_retrain", "is_valid", "n_forecast",
                    rounded("intercept", 4).alias("intercept")))


@register("artifact_versions")
def q_artifact_versions(spark, sf):
    """A full run, a run over some series, and one that dies before its pointer moves; then what readers see."""
    root = scratch_path(spark, f"artifacts-{uuid.uuid4().hex}")
    daily_rows = stage(daily.daily_totals(FX.event_readings(spark, sf)).select("series_id", "ds", "y"), "versions_daily")
    run = lambda d, factor: d.select("series_id", "ds", (F.col("y") * factor).alias("yhat"))
    SK.save_forecast(run(daily_rows, 1.0), root, "m")
    SK.save_forecast(run(daily_rows.filter(F.length("series_id") % 2 == 0), 2.0), root, "m")
    path, fmt = SK.artifact_path(root, "forecast")
    lost = run(daily_rows, 3.0).withColumns({"model_name": F.lit("m"), "series_bucket": SK.series_bucket("series_id")})
    SK.write_version(lost, path, fmt, ["model_name", "series_bucket"])  # never committed
    return _r(SK.read_artifact(spark, root, "forecast").select("series_id", "ds", "model_name", "yhat"), {"yhat": 2})


@register("schema_checks")
def q_schema_checks(spark, sf):
    """Columns, types, rows and NULLs of the raw and the prepared frames, and which schema checks they pass."""
    frames = {
        "events": (FX.table(spark, sf, "events").drop("event_type"), "ts", "value"),
        "orders": (FX.order_readings(spark, sf), "ts", "value"),
        "prepared": (P.prepared_train(P.full_data(spark, sf, staged=False)), "ds", "y"),
        "weather_undated": (P.weather(spark, sf).drop("ds", "src"), "ds", "temperature_mean"),
    }
    out = None
    for name, (df, day, target) in frames.items():
        passed = {c["check"]: c["passed"] for c in V.schema_checks(df, day, target)}
        t = V.type_rows(df, name).withColumns({k: F.lit(passed.get(k)).cast("boolean")
                                               for k in ("required_columns", "date_type", "numeric_types")})
        out = t if out is None else out.unionByName(t)
    return out


# ====================================================================== Z1, Z2

LATENESS = "2 days"


def _stream_out(spark, agg):
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    ZS.run_to_table(agg, base + "/out", base + "/_checkpoint")
    out = spark.read.parquet(base + "/out")
    return out.select("series_id", F.to_date("w.start").alias("day_start"),
                      F.col("jour").cast("timestamp_ntz").alias("jour"), rounded("y", 2).alias("y"), "n_readings")


@register("stream_daily_totals")
def q_stream_daily_totals(spark, sf):
    """Closed 1-day windows from the events file stream."""
    s = ZS.readings_stream(spark, sf, "events.parquet")
    return _stream_out(spark, ZS.daily_totals_stream(s, LATENESS))


@register("stream_dedup")
def q_stream_dedup(spark, sf):
    """Replay: the same readings arrive twice; dedup inside the watermark keeps totals unchanged."""
    s = ZS.readings_stream(spark, sf, "events.parquet").unionByName(ZS.readings_stream(spark, sf, "events.parquet"))
    return _stream_out(spark, ZS.daily_totals_stream(ZS.dedup_readings(s, LATENESS), None))


# ====================================================================== M5, M6, M8, M12-M14 (rows-only)


@register("trial_space")
def q_trial_space(spark, sf):
    """The 50 seeded parameter sets for every series."""
    return _r(RG.series_trials(FX.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("series_id"))),
              {"changepoint_prior_scale": 9, "seasonality_prior_scale": 9})


@register("ridge_fixed_scores")
def q_ridge_fixed_scores(spark, sf):
    """M1-M5, M8: the whole design scored with a fixed coefficient table."""
    d = P.ridge_design(P.full_data(spark, sf))
    fixed = F.transform(F.sequence(F.lit(0), F.lit(len(RG.terms()) - 1)), lambda k: ((k * 37) % 11 - 5) / F.lit(100.0))
    coef = d.select("series_id").distinct().withColumns(
        {"mode_used": F.lit("additive"), "out_scale": F.lit(1.0), "coef": fixed, "status": F.lit("fixed")})
    return _r(RG.predict(d, coef).select("series_id", "ds", "split", "yhat"), {"yhat": 5})


@register("ridge_normal_equations")
def q_ridge_normal_equations(spark, sf):
    """M6: the fit solves its equations, (X'X + P) b = X'y: largest residual against the largest side, per series."""
    import numpy as np
    import pandas as pd

    d = P.ridge_design(P.full_data(spark, sf)).filter(F.col("split") == "train")
    pen = np.diag(RG.penalties(RG.DEFAULT_PARAMS))

    def check(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y, b = np.vstack(pdf["x"]), pdf["y"].to_numpy(float) / pdf["out_scale"].iloc[0], np.asarray(pdf["coef"].iloc[0])
        side = x.T @ y
        gap = np.abs((x.T @ x + pen) @ b - side).max() / np.abs(side).max()
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[:1], "n_train": [len(y)], "residual": [round(gap, 6) + 0.0]})

    return d.join(RG.fit(d, RG.DEFAULT_PARAMS), "series_id").groupBy("series_id").applyInPandas(
        check, "series_id string, n_train long, residual double")


@register("ridge_forecast")
def q_ridge_forecast(spark, sf):
    """M5/M6/M8/M9: seasonal ridge with default prior scales."""
    return _r(P.ridge_forecast(spark, sf).select("series_id", "ds", "split", "y", "yhat", "yhat_lower", "yhat_upper"),
              {"y": 2, "yhat": 4, "yhat_lower": 4, "yhat_upper": 4})


@register("tuned_report")
def q_tuned_report(spark, sf):
    """L3 for the tuned model: last-60 MAE / MASE against the naive and the flag."""
    fc, _best = P.tuned(spark, sf)
    rep = EV.window_report(fc.filter(F.col("y").isNotNull()), P.MODEL_RIDGE)
    return rep.withColumn("should_retrain", EV.should_retrain(rep))


@register("tuned_forecast")
def q_tuned_forecast(spark, sf):
    """50-trial search, best per series, refit, scored with bounds."""
    fc, _best = P.tuned(spark, sf)
    return _r(fc.select("series_id", "ds", "split", "y", "yhat", "yhat_lower", "yhat_upper", "trial_id", "test_mase"),
              {"y": 2, "yhat": 4, "yhat_lower": 4, "yhat_upper": 4, "test_mase": 4})


# ====================================================================== M6, distributed

#: Fixed parameter of the two-term fit: the ridge added to both terms.
TREND_RIDGE = 0.5


def _pool(spark, sf):
    """The whole design, every series in one pool."""
    return P.ridge_design(P.full_data(spark, sf)).withColumn("series_id", F.lit("all"))


@register("pooled_normal_sums")
def q_pooled_normal_sums(spark, sf):
    """M6: X'X and X'y of the pool of all series over the 90 design terms, from merged partial sums."""
    sums = stage(PL.normal_sums(_pool(spark, sf)), "normal_sums")
    p = len(RG.terms())
    pairs = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda i: F.transform(
        F.sequence(i, F.lit(p - 1)), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    gram = sums.select("n", F.inline(F.arrays_zip(pairs.alias("at"), F.col("gram").alias("value")))).select("n", "at.i", "at.j", "value")
    side = sums.select("n", F.posexplode(F.transform("xty", lambda v: v / F.col("top"))).alias("i", "value")).select(
        "n", "i", F.lit(-1).alias("j"), "value")
    return _r(gram.unionByName(side), {"value": 4})


@register("pooled_trend_fit")
def q_pooled_trend_fit(spark, sf):
    """M6: intercept and trend of every series by the distributed fit (a ridge of 0.5 on both), from raw train rows."""
    prepared = P.prepared_train(P.full_data(spark, sf))
    d = D.with_trend_time(EV.chronological_split(prepared), fit_mask=F.col("split") == "train")
    d = d.select("series_id", "ds", "y", "split", F.array(F.lit(1.0), F.col("t")).alias("x"))
    fitted = PL.solve(PL.normal_sums(d), RG.DEFAULT_PARAMS, penalty=lambda _params: [TREND_RIDGE, TREND_RIDGE])
    return _r(fitted.select("series_id", "mode_used", "out_scale", F.col("coef")[0].alias("intercept"), F.col("coef")[1].alias("slope")),
              {"out_scale": 2, "intercept": 6, "slope": 6})


#: Fixed parameters of the one-hinge fit: its place in trend time and the weight of its absolute value.
HINGE_AT, HINGE_WEIGHT = 0.4, 40.0


@register("laplace_hinge")
def q_laplace_hinge(spark, sf):
    """M5/M6: one hinge under a Laplace prior per (segment, nation), by reweighted ridge; its minimum is a soft threshold."""
    prepared = P.prepared_train(P.full_data(spark, sf, series_cols=FX.SEGMENT_NATION))
    d = D.with_trend_time(EV.chronological_split(prepared), fit_mask=F.col("split") == "train")
    d = d.select("series_id", "ds", "y", "split", F.array(F.greatest(F.col("t") - HINGE_AT, F.lit(0.0))).alias("x"))
    fitted = PL.solve(PL.normal_sums(d), RG.DEFAULT_PARAMS, penalty=lambda _params: [0.0], laplace=lambda _params: [HINGE_WEIGHT])
    return _r(fitted.select("series_id", F.col("coef")[0].alias("slope")), {"slope": 5})
