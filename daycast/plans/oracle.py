"""DuckDB SQL for each registered query (the correctness oracle).

Built from named CTE fragments so that every query states its inputs the
same way the Spark plans do.  Oracle conventions: days are DATE on both
sides, Spark ``weekday`` is ``isodow - 1``, 0.8 is written as a DOUBLE.
"""

from __future__ import annotations

_CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    _CTE[name] = (sql.strip(), deps)


def build(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTE[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS (\n{_CTE[n][0]}\n)" for n in order) + "\n" + body.strip()


ORACLE: dict[str, str] = {}


def q(key: str, body: str, *needed: str) -> None:
    ORACLE[key] = build(body, *needed)


# ---------------------------------------------------------------- base tables
cte("x_readings", """
SELECT event_type AS series_id, event_id, ts, CASE WHEN isnan(value) THEN NULL ELSE value END AS value, props
FROM events""")
cte("x_order_readings", """
SELECT c_mktsegment AS series_id, o_orderkey AS event_id, o_orderdate AS ts,
       CASE WHEN isnan(o_totalprice) THEN NULL ELSE o_totalprice END AS value
FROM orders JOIN customer ON o_custkey = c_custkey""")
cte("x_dt_raw", """
SELECT series_id, CAST(ts AS DATE) AS ds, min(ts) AS jour, round(sum(value), 2) AS y
FROM x_order_readings GROUP BY 1, 2""", "x_order_readings")
cte("x_dt", """
SELECT series_id, ds, jour,
       CASE WHEN y = 0 THEN avg(nullif(y, 0)) OVER (PARTITION BY series_id ORDER BY ds
            ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) ELSE y END AS y
FROM x_dt_raw""", "x_dt_raw")
cte("x_w_all", """
SELECT CAST(l_shipdate AS DATE) AS ds, max(q) AS temperature_max, min(q) AS temperature_min,
       avg(q) AS temperature_mean
FROM (SELECT l_shipdate, CASE WHEN isnan(l_quantity) THEN NULL ELSE l_quantity END AS q FROM lineitem)
GROUP BY 1""")
cte("x_cut", "SELECT max(ds) AS d FROM x_dt", "x_dt")
cte("x_wu", """
SELECT ds, temperature_max, temperature_min, temperature_mean, 0 AS src_rank, 'archive' AS src
FROM x_w_all WHERE ds <= (SELECT d FROM x_cut)
UNION ALL
SELECT ds, temperature_max + 0.5, temperature_min + 0.5, temperature_mean + 0.5, 1, 'forecast'
FROM x_w_all WHERE ds >= (SELECT d FROM x_cut)""", "x_w_all", "x_cut")
cte("x_weather", """
SELECT ds, temperature_max, temperature_min, temperature_mean, src FROM (
  SELECT *, row_number() OVER (PARTITION BY ds ORDER BY src_rank) AS rn FROM x_wu) WHERE rn = 1""", "x_wu")
cte("x_full", """
SELECT s.series_id, w.ds, w.temperature_max, w.temperature_min, w.temperature_mean, t.y,
       CASE WHEN w.temperature_mean IS NOT NULL THEN greatest(18.0 - w.temperature_mean, 0.0) END AS HDD,
       CASE WHEN w.temperature_mean IS NOT NULL THEN greatest(w.temperature_mean - 22.0, 0.0) END AS CDD
FROM (SELECT DISTINCT series_id FROM x_dt) s CROSS JOIN x_weather w
LEFT JOIN x_dt t ON t.series_id = s.series_id AND t.ds = w.ds""", "x_dt", "x_weather")
cte("x_prep", """
SELECT series_id, ds, y, HDD, CDD FROM x_full WHERE y IS NOT NULL""", "x_full")
cte("x_split", """
SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY ds)
                    <= floor(count(*) OVER (PARTITION BY series_id) * CAST(0.8 AS DOUBLE))
               THEN 'train' ELSE 'test' END AS split
FROM x_prep""", "x_prep")
cte("x_tw_lin", """
SELECT series_id, regr_intercept(y, CAST(ds - DATE '1970-01-01' AS DOUBLE)) AS intercept,
       regr_slope(y, CAST(ds - DATE '1970-01-01' AS DOUBLE)) AS slope
FROM x_split WHERE split = 'train' GROUP BY 1""", "x_split")
cte("x_tw_wd", """
SELECT s.series_id, isodow(s.ds) - 1 AS wd,
       avg(s.y - (l.intercept + l.slope * CAST(s.ds - DATE '1970-01-01' AS DOUBLE))) AS eff
FROM x_split s JOIN x_tw_lin l USING (series_id) WHERE s.split = 'train' GROUP BY 1, 2""", "x_split", "x_tw_lin")
cte("x_tw_scored", """
SELECT s.*, l.intercept + l.slope * CAST(s.ds - DATE '1970-01-01' AS DOUBLE) + coalesce(w.eff, 0.0) AS yhat
FROM x_split s LEFT JOIN x_tw_lin l USING (series_id)
LEFT JOIN x_tw_wd w ON w.series_id = s.series_id AND w.wd = isodow(s.ds) - 1""", "x_split", "x_tw_lin", "x_tw_wd")
cte("x_last60", """
SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY pos) AS naive FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS pos FROM (
    SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rd
    FROM x_tw_scored WHERE y IS NOT NULL) WHERE rd <= 60)""", "x_tw_scored")
cte("x_report", """
SELECT series_id, 'trend_weekday' AS model_name, 60 AS window_size, 'naive_7_days' AS baseline,
       round(avg(abs(y - yhat)), 4) AS mae_window,
       round(avg(abs(y - yhat)) FILTER (WHERE pos > 7)
             / nullif(avg(abs(y - naive)) FILTER (WHERE pos > 7), 0), 4) AS mase_window
FROM x_last60 GROUP BY 1""", "x_last60")

# ---------------------------------------------------------------- flagship
q("retrain_decision", """
SELECT series_id, model_name, window_size, baseline, mae_window, mase_window,
       coalesce(mase_window > 0.95, true) AS should_retrain
FROM x_report""", "x_report")


# ---------------------------------------------------------------- S1-S6, B1-B7, A1
def R(x: str, p: int = 6) -> str:
    return f"round({x}, {p}) + 0.0"


q("json_records_flatten", f"""
SELECT CAST(floor(event_id / 100) AS BIGINT) AS page, CAST(ts AS DATE) AS ds,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS jour, {R('value')} AS conso_jour
FROM x_readings""", "x_readings")
q("json_arrays_flatten", f"""
SELECT strftime(ds, '%Y-%m') AS month, strftime(ds, '%Y-%m-%d') AS time,
       {R('temperature_max')} AS temperature_2m_max, {R('temperature_min')} AS temperature_2m_min,
       {R('temperature_mean')} AS temperature_2m_mean
FROM x_w_all""", "x_w_all")
q("props_json", """
SELECT series_id, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM x_readings""", "x_readings")
cte("x_ev_daily", """
SELECT series_id, CAST(ts AS DATE) AS ds, min(ts) AS jour, sum(value) AS y, count(*) AS n_readings
FROM x_readings GROUP BY 1, 2""", "x_readings")
q("fetch_window_daily_mode", f"""
SELECT series_id, CAST(ts AS DATE) AS ds, min(ts) AS jour, {R('sum(value)', 2)} AS y, count(*) AS n_readings
FROM x_readings WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'
GROUP BY 1, 2""", "x_readings")
q("fetch_day_layout", f"""
SELECT series_id, CAST(ts AS DATE) AS ds, min(ts) AS jour, {R('sum(value)', 2)} AS y, count(*) AS n_readings
FROM x_readings WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'
GROUP BY 1, 2""", "x_readings")
q("landing_records", f"""
SELECT CAST(floor(event_id / 1000) AS BIGINT) AS page, CAST(ts AS DATE) AS ds,
       strftime(ts, '%Y-%m-%dT%H:%M:%S') AS jour, {R('value')} AS conso_jour
FROM x_readings""", "x_readings")
q("facet_filter", f"""
SELECT series_id, CAST(ts AS DATE) AS ds, min(ts) AS jour, {R('sum(value)', 2)} AS y, count(*) AS n_readings
FROM x_readings WHERE series_id = 'purchase' GROUP BY 1, 2""", "x_readings")
q("ordered_limit", f"""
SELECT series_id, ds, jour, {R('y', 2)} AS y FROM x_ev_daily
ORDER BY jour ASC NULLS LAST, ds ASC NULLS LAST, series_id LIMIT 100""", "x_ev_daily")
q("daily_totals", f"""
SELECT series_id, CAST(ts AS DATE) AS ds, min(ts) AS jour, {R('sum(value)', 2)} AS y, count(*) AS n_readings
FROM x_order_readings GROUP BY 1, 2""", "x_order_readings")
q("tumbling_day", f"""
SELECT series_id, ds AS day_start, CAST(ds + 1 AS DATE) AS day_end, jour, {R('y', 2)} AS y, n_readings
FROM x_ev_daily""", "x_ev_daily")
q("ingest_profile", """
SELECT s.series_id, coalesce(p.n_rows, 0) AS n_rows, p.first_day, p.last_day, coalesce(p.n_rows, 0) = 0 AS is_empty
FROM (SELECT DISTINCT c_mktsegment AS series_id FROM customer) s
LEFT JOIN (SELECT series_id, count(*) AS n_rows, min(ds) AS first_day, max(ds) AS last_day
           FROM x_dt GROUP BY 1) p USING (series_id)""", "x_dt")
q("required_columns_scan", "SELECT event_id, event_type, ts, value FROM events")
q("clean_projection", f"""
SELECT series_id, CAST(jour AS DATE) AS date, {R('y', 2)} AS daily_conso_kwh FROM x_ev_daily""", "x_ev_daily")
q("zero_repair", f"""
SELECT series_id, event_id, ts,
       {R('''CASE WHEN value = 0 THEN avg(nullif(value, 0)) OVER (PARTITION BY series_id ORDER BY ts, event_id
            ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) ELSE value END''')} AS value
FROM (SELECT series_id, event_id, ts, CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE value END AS value FROM x_readings)
""", "x_readings")
q("zero_repair_hot_day", f"""
SELECT series_id, event_id, ts,
       {R("""CASE WHEN value = 0 THEN avg(nullif(value, 0)) OVER (PARTITION BY series_id ORDER BY ts, event_id
            ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) ELSE value END""")} AS value
FROM (SELECT 'all' AS series_id, event_id, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(
               CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id * 7919 % 86400 END) AS ts,
             CASE WHEN event_id % 7 = 0 THEN 0.0 ELSE value END AS value FROM x_readings)
""", "x_readings")
q("json_rejects", """
SELECT series_id, 'records' AS shape, CASE WHEN event_id % 3 = 0 THEN 'rejects' ELSE 'rows' END AS kind, count(*) AS n
FROM x_readings GROUP BY ALL
UNION ALL
SELECT series_id, 'arrays', CASE WHEN event_id % 5 = 0 THEN 'rejects' ELSE 'rows' END, count(*) FROM x_readings GROUP BY ALL
""", "x_readings")

# ---------------------------------------------------------------- U1/U3, J1, P6/P7/P11, F1/F2, S3
q("weather_union_first", f"""
SELECT ds, {R('temperature_max')} AS temperature_max, {R('temperature_min')} AS temperature_min,
       {R('temperature_mean')} AS temperature_mean, src FROM x_weather""", "x_weather")
q("weather_left_target", f"""
SELECT series_id, ds, {R('temperature_max')} AS temperature_max, {R('temperature_min')} AS temperature_min,
       {R('temperature_mean')} AS temperature_mean, {R('y', 2)} AS y, {R('HDD')} AS HDD, {R('CDD')} AS CDD
FROM x_full""", "x_full")
q("availability_cap", f"""
SELECT series_id, ds, {R('y', 2)} AS y, {R('temperature_mean')} AS temperature_mean FROM (
  SELECT *, max(CASE WHEN y IS NOT NULL THEN ds END) OVER (PARTITION BY series_id) AS cap FROM x_full)
WHERE ds <= cap""", "x_full")
q("prepared_train", f"""
SELECT series_id, ds, {R('y', 2)} AS y, {R('HDD')} AS HDD, {R('CDD')} AS CDD FROM x_prep""", "x_prep")
q("prepared_forecast", f"""
SELECT series_id, ds, {R('HDD')} AS HDD, {R('CDD')} AS CDD FROM x_full""", "x_full")
q("degree_days", f"""
SELECT ds, {R('temperature_mean')} AS temperature_mean,
       {R('CASE WHEN temperature_mean IS NOT NULL THEN greatest(18.0 - temperature_mean, 0.0) END')} AS HDD,
       {R('CASE WHEN temperature_mean IS NOT NULL THEN greatest(temperature_mean - 22.0, 0.0) END')} AS CDD
FROM x_weather""", "x_weather")
q("weather_select", f"""
SELECT ds, {R('temperature_max')} AS temperature_max, {R('temperature_mean')} AS temperature_mean
FROM x_weather WHERE ds BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""", "x_weather")


# ---------------------------------------------------------------- C1-C5, J3, J7
def _dbl(v: float) -> str:
    return f"CAST('{v!r}' AS DOUBLE)"


cte("x_years", """
SELECT CAST(unnest(generate_series(year(min(d)), year(max(d)))) AS INTEGER) AS year FROM (
  SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT CAST(ts AS DATE) FROM events)""")
cte("x_easter", """
SELECT year, make_date(year, CAST(s // 31 AS INTEGER), CAST(s % 31 + 1 AS INTEGER)) AS easter FROM (
  SELECT year, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS s FROM (
    SELECT year, a, h, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM (
      SELECT year, a, e, i, k, (19 * a + b - d - g + 15) % 30 AS h FROM (
        SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c, (year // 100) // 4 AS d,
               (year // 100) % 4 AS e, (year // 100 - ((year // 100) + 8) // 25 + 1) // 3 AS g,
               (year % 100) // 4 AS i, (year % 100) % 4 AS k
        FROM x_years))))""", "x_years")
cte("x_public", """
SELECT make_date(y.year, f.m, f.d) AS ds, f.holiday, -1 AS lower_window, 1 AS upper_window
FROM x_years y CROSS JOIN (VALUES (1, 1, 'Jour de l''an'), (5, 1, 'Fête du Travail'), (5, 8, 'Fête de la Victoire'),
  (7, 14, 'Fête nationale'), (8, 15, 'Assomption'), (11, 1, 'Toussaint'), (11, 11, 'Armistice'),
  (12, 25, 'Noël')) f(m, d, holiday)
UNION ALL
SELECT CAST(e.easter + o.off AS DATE), o.holiday, -1, 1
FROM x_easter e CROSS JOIN (VALUES (1, 'Lundi de Pâques'), (39, 'Ascension'), (50, 'Lundi de Pentecôte')) o(off, holiday)
""", "x_years", "x_easter")
cte("x_bridge", """
SELECT CAST(ds + 1 AS DATE) AS ds, 'bridge_day' AS holiday, 0 AS lower_window, 0 AS upper_window
FROM x_public WHERE isodow(ds) = 4""", "x_public")
cte("x_holidays", """
SELECT * FROM x_public UNION ALL SELECT * FROM x_bridge UNION ALL
SELECT s.ds, 'school_holiday', 0, 0 FROM (VALUES (DATE '2023-02-18'), (DATE '2023-03-06'), (DATE '2023-04-15'),
  (DATE '2023-05-01'), (DATE '2023-07-08'), (DATE '2023-09-03')) s(ds) JOIN x_years y ON year(s.ds) = y.year
""", "x_public", "x_bridge", "x_years")
q("holidays_fr", "SELECT ds, holiday, lower_window, upper_window FROM x_holidays", "x_holidays")
q("bridge_days", "SELECT ds, holiday, lower_window, upper_window FROM x_bridge", "x_bridge")
q("holiday_windows", """
SELECT t.series_id, t.ds, h.holiday, h.off AS "offset" FROM x_dt t JOIN (
  SELECT holiday, CAST(ds + off AS DATE) AS day, off FROM (
    SELECT holiday, ds, CAST(unnest(generate_series(lower_window, upper_window)) AS INTEGER) AS off FROM x_holidays)
) h ON t.ds = h.day""", "x_dt", "x_holidays")
cte("x_future_cal", """
SELECT DISTINCT series_id, ds, false AS is_future FROM x_prep
UNION ALL
SELECT series_id, CAST(last + n AS DATE), true FROM (SELECT series_id, max(ds) AS last FROM x_prep GROUP BY 1)
CROSS JOIN (SELECT CAST(unnest(generate_series(1, 7)) AS INTEGER) AS n)""", "x_prep")
q("future_calendar", "SELECT series_id, ds, is_future FROM x_future_cal", "x_future_cal")
q("future_regressors", f"""
SELECT c.series_id, c.ds, c.is_future, {R('f.HDD')} AS HDD, {R('f.CDD')} AS CDD
FROM x_future_cal c JOIN x_full f ON f.series_id = c.series_id AND f.ds = c.ds""", "x_future_cal", "x_full")

# ---------------------------------------------------------------- V1-V12
cte("x_obs", "SELECT DISTINCT series_id, ds FROM x_dt WHERE ds IS NOT NULL", "x_dt")
cte("x_cal", """
SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds
FROM (SELECT series_id, min(ds) AS lo, max(ds) AS hi FROM x_obs GROUP BY 1)""", "x_obs")
cte("x_missing", """
SELECT s.series_id, CAST(coalesce(m.n, 0) AS BIGINT) AS missing_count,
       CASE WHEN m.n > 0 THEN CAST(m.lo AS VARCHAR) || ' to ' || CAST(m.hi AS VARCHAR) END AS missing_range
FROM (SELECT DISTINCT series_id FROM x_obs) s LEFT JOIN (
  SELECT series_id, count(*) AS n, min(ds) AS lo, max(ds) AS hi FROM x_cal c
  WHERE NOT EXISTS (SELECT 1 FROM x_obs o WHERE o.series_id = c.series_id AND o.ds = c.ds) GROUP BY 1
) m USING (series_id)""", "x_obs", "x_cal")
q("missing_days", "SELECT series_id, missing_count, missing_range FROM x_missing", "x_missing")
q("null_counts", """
SELECT series_id, "column", CAST(null_count AS BIGINT) AS null_count FROM (
  SELECT series_id, count_if(ds IS NULL) AS ds, count_if(temperature_max IS NULL) AS temperature_max,
         count_if(temperature_min IS NULL) AS temperature_min, count_if(temperature_mean IS NULL) AS temperature_mean,
         count_if(y IS NULL) AS y, count_if(HDD IS NULL) AS HDD, count_if(CDD IS NULL) AS CDD
  FROM x_full GROUP BY 1
) UNPIVOT (null_count FOR "column" IN (ds, temperature_max, temperature_min, temperature_mean, y, HDD, CDD))""",
  "x_full")
q("duplicate_rows", """
SELECT series_id, CAST(sum(n - 1) AS BIGINT) AS duplicated_rows FROM (
  SELECT series_id, event_id, ts, value, props, count(*) AS n FROM (
    SELECT * FROM x_readings UNION ALL SELECT * FROM x_readings WHERE event_id % 11 = 0) GROUP BY ALL)
GROUP BY 1""", "x_readings")
q("sorted_check", """
SELECT series_id, n_inversions, n_inversions = 0 AS is_sorted FROM (
  SELECT series_id, count_if(ts IS NULL OR prev > ts) AS n_inversions FROM (
    SELECT series_id, ts, lag(ts) OVER (PARTITION BY series_id ORDER BY event_id) AS prev FROM x_order_readings)
  GROUP BY 1)""", "x_order_readings")
cte("x_rules", """
SELECT series_id, scope, "column", rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT series_id, 'target' AS scope, 'y' AS "column", 'negative_values' AS rule, count_if(y < 0) AS violations
  FROM x_prep GROUP BY 1
  UNION ALL SELECT series_id, 'target', 'y', 'below_min', count_if(y < 10000.0) FROM x_prep GROUP BY 1
  UNION ALL SELECT series_id, 'target', 'y', 'above_max', count_if(y > 2000000.0) FROM x_prep GROUP BY 1
  UNION ALL SELECT series_id, 'regressors', 'HDD', 'above_max', count_if(HDD > 2.0) FROM x_prep GROUP BY 1
  UNION ALL SELECT series_id, 'regressors', 'CDD', 'below_min', count_if(CDD < 0.5) FROM x_prep GROUP BY 1
  UNION ALL SELECT series_id, 'regressors', 'CDD', 'above_max', count_if(CDD > 12.0) FROM x_prep GROUP BY 1
) WHERE violations > 0""", "x_prep")
q("business_rules", 'SELECT * FROM x_rules', "x_rules")


def _missing(src: str) -> str:
    return f"""
SELECT s.series_id, CAST(coalesce(m.n, 0) AS BIGINT) AS missing_count,
       CASE WHEN m.n > 0 THEN CAST(m.lo AS VARCHAR) || ' to ' || CAST(m.hi AS VARCHAR) END AS missing_range
FROM (SELECT DISTINCT series_id FROM {src}) s LEFT JOIN (
  SELECT series_id, count(*) AS n, min(ds) AS lo, max(ds) AS hi FROM (
    SELECT series_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS ds
    FROM (SELECT series_id, min(ds) AS lo, max(ds) AS hi FROM {src} GROUP BY 1)) c
  WHERE NOT EXISTS (SELECT 1 FROM {src} o WHERE o.series_id = c.series_id AND o.ds = c.ds) GROUP BY 1
) m USING (series_id)"""


def _report(src: str, missing: str, is_sorted: str) -> str:
    """Every check of the report over ``src`` (series_id, ds, y, HDD, CDD)."""
    return f"""
SELECT b.series_id, true AS schema_ok, b.n_rows, b.null_cells, coalesce(d.dups, 0) AS duplicated_rows, m.missing_count,
       m.missing_range, {is_sorted} AS is_sorted, CAST(neg + lo + hi + hdd_hi + cdd_lo + cdd_hi AS BIGINT) AS rule_violations,
       concat_ws(',', CASE WHEN neg > 0 THEN 'negative_values=' || neg END, CASE WHEN lo > 0 THEN 'below_min=' || lo END,
                 CASE WHEN hi > 0 THEN 'above_max=' || hi END) || ';' ||
       concat_ws('|', CASE WHEN hdd_hi > 0 THEN 'HDD:above_max=' || hdd_hi END,
                 CASE WHEN cdd_lo + cdd_hi > 0 THEN 'CDD:' || concat_ws(',', CASE WHEN cdd_lo > 0 THEN 'below_min=' || cdd_lo END,
                      CASE WHEN cdd_hi > 0 THEN 'above_max=' || cdd_hi END) END) AS business_rules,
       b.null_cells = 0 AND coalesce(d.dups, 0) = 0 AND m.missing_count = 0 AND coalesce({is_sorted}, true) AS is_valid
FROM (SELECT series_id, count_if(y IS NOT NULL) AS n_rows,
             CAST(count_if(y IS NOT NULL AND ds IS NULL) + count_if(y IS NOT NULL AND HDD IS NULL)
                  + count_if(y IS NOT NULL AND CDD IS NULL) AS BIGINT) AS null_cells,
             CAST(count_if(y < 0) AS BIGINT) AS neg, CAST(count_if(y < 10000.0) AS BIGINT) AS lo,
             CAST(count_if(y > 2000000.0) AS BIGINT) AS hi, CAST(count_if(HDD > 2.0) AS BIGINT) AS hdd_hi,
             CAST(count_if(CDD < 0.5) AS BIGINT) AS cdd_lo, CAST(count_if(CDD > 12.0) AS BIGINT) AS cdd_hi
      FROM {src} GROUP BY 1) b
LEFT JOIN (SELECT series_id, CAST(sum(n - 1) AS BIGINT) AS dups FROM (
             SELECT series_id, ds, y, HDD, CDD, count(*) AS n FROM {src} GROUP BY ALL) GROUP BY 1) d USING (series_id)
LEFT JOIN {missing} m USING (series_id)"""


cte("x_prep_missing", _missing("x_prep"), "x_prep")
cte("x_valrep", _report("x_prep", "x_prep_missing", "CAST(NULL AS BOOLEAN)"), "x_prep", "x_prep_missing")
cte("x_gate_rows", """
SELECT series_id, ds, y, HDD, CDD,
       CASE WHEN length(series_id) % 2 = 0 THEN 1 ELSE -1 END * (ds - DATE '1970-01-01') AS seq FROM x_prep
UNION ALL SELECT series_id, ds, y, 0.0, 0.0, ds - DATE '1970-01-01' FROM x_ev_daily""", "x_prep", "x_ev_daily")
cte("x_gate_missing", _missing("x_gate_rows"), "x_gate_rows")
cte("x_gate_sorted", """
SELECT series_id, bool_and(before IS NULL OR before <= ds) AS ok FROM (
  SELECT series_id, ds, lag(ds) OVER (PARTITION BY series_id ORDER BY seq) AS before FROM x_gate_rows) GROUP BY 1""",
    "x_gate_rows")
cte("x_gate_report", _report("x_gate_rows", "x_gate_missing", "(SELECT ok FROM x_gate_sorted o WHERE o.series_id = b.series_id)"),
    "x_gate_rows", "x_gate_missing", "x_gate_sorted")
q("validation_report", "SELECT * FROM x_gate_report", "x_gate_report")


def _json_text(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'null' ELSE '\"' || {c} || '\"' END"


q("validation_document", f"""
SELECT series_id,
  '{{"date":"2001-08-02T00:00:00","data_types":{{"series_id":"string","ds":"date","y":"double","HDD":"double","CDD":"double"}},'
  || '"missing_values":{{"CDD":' || n.c || ',"HDD":' || n.h || ',"ds":' || n.d || ',"y":' || n.y || '}},"duplicated_rows":'
  || duplicated_rows || ',"date_report":{{"is_sorted":' || is_sorted || ',"missing_dates":{{"count":' || missing_count
  || ',"range":' || {_json_text("missing_range")} || '}}}},"is_valid":' || is_valid || '}}' AS document,
  '[' || regexp_replace(regexp_replace(split_part(business_rules, ';', 1), '([a-z_]+)=([0-9]+)', '{{\\1, \\2}}', 'g'), '}},', '}}, ', 'g')
  || ']' AS target_rules,
  CAST(CASE WHEN split_part(business_rules, ';', 2) = '' THEN 0 ELSE len(string_split(split_part(business_rules, ';', 2), '|')) END
       AS INTEGER) AS n_regressors_ruled
FROM x_gate_report JOIN (
  SELECT series_id, count_if(CDD IS NULL) AS c, count_if(HDD IS NULL) AS h, count_if(ds IS NULL) AS d, count_if(y IS NULL) AS y
  FROM x_gate_rows GROUP BY 1) n USING (series_id)""", "x_gate_report", "x_gate_rows")


def _types(frame: str, src: str, columns: dict[str, str], passed: tuple) -> str:
    flags = ", ".join(f"CAST({'NULL' if p is None else str(p).lower()} AS BOOLEAN) AS {c}"
                      for c, p in zip(("required_columns", "date_type", "numeric_types"), passed))
    return "\nUNION ALL\n".join(
        f"SELECT '{frame}' AS frame, count(*) AS n_rows, '{c}' AS \"column\", '{t}' AS type, count_if(\"{c}\" IS NULL) AS n_null, {flags} FROM {src}"
        for c, t in columns.items())


q("schema_checks", "\nUNION ALL\n".join([
    _types("events", "events", {"event_id": "bigint", "user_id": "bigint", "ts": "timestamp_ntz", "value": "double", "props": "string"},
           (True, True, False)),
    _types("orders", "x_order_readings", {"series_id": "string", "event_id": "bigint", "ts": "timestamp_ntz", "value": "double"},
           (True, True, True)),
    _types("prepared", "x_prep", {"series_id": "string", "ds": "date", "y": "double", "HDD": "double", "CDD": "double"}, (True, True, True)),
    _types("weather_undated", "x_weather", {"temperature_max": "double", "temperature_min": "double", "temperature_mean": "double"},
           (False, None, True))]), "x_order_readings", "x_prep", "x_weather")
cte("x_trials", """
SELECT series_id, trial_id, name,
       (CAST(('0x' || substr(md5('42|' || trial_id || '|' || name), 1, 8)) AS UBIGINT) + 0.5) / 4294967296.0::DOUBLE AS u
FROM (SELECT DISTINCT c_mktsegment AS series_id FROM customer),
     (SELECT CAST(unnest(generate_series(1, 50)) AS INTEGER) AS trial_id),
     (VALUES ('changepoint_prior_scale'), ('seasonality_prior_scale'), ('holidays_prior_scale'), ('seasonality_mode')) v(name)""")
q("trial_space", f"""
SELECT series_id, trial_id,
  {R("max(CASE WHEN name = 'changepoint_prior_scale' THEN exp(ln(0.0005::DOUBLE) + u * (ln(0.01::DOUBLE) - ln(0.0005::DOUBLE))) END)", 9)}
    AS changepoint_prior_scale,
  {R("max(CASE WHEN name = 'seasonality_prior_scale' THEN 1.0::DOUBLE + u * 19.0::DOUBLE END)", 9)} AS seasonality_prior_scale,
  CAST(max(CASE WHEN name = 'holidays_prior_scale' THEN 5 + floor(u * 46.0::DOUBLE) END) AS INTEGER) AS holidays_prior_scale,
  max(CASE WHEN name = 'seasonality_mode' THEN CASE WHEN u < 0.5 THEN 'additive' ELSE 'multiplicative' END END) AS seasonality_mode
FROM x_trials GROUP BY 1, 2""", "x_trials")

# ---------------------------------------------------------------- W4, M1, M2, M4, M7, M9
q("chronological_split", f"""
SELECT series_id, ds, {R('y', 2)} AS y, {R('HDD')} AS HDD, {R('CDD')} AS CDD, split FROM x_split""", "x_split")


def _fourier_sql() -> str:
    import math
    cols = []
    for name, period, order in (("weekly", 7.0, 3), ("yearly", 365.25, 10)):
        for k in range(1, order + 1):
            w = _dbl(2.0 * math.pi * k / period)
            cols.append(f"{R(f'sin({w} * t)')} AS {name}_sin{k}")
            cols.append(f"{R(f'cos({w} * t)')} AS {name}_cos{k}")
    return ", ".join(cols)


q("fourier_terms", f"""
SELECT series_id, ds, {_fourier_sql()} FROM (
  SELECT series_id, ds, CAST(ds - DATE '1970-01-01' AS DOUBLE) AS t FROM x_prep)""", "x_prep")
_hinges = ", ".join(f"{R(f'greatest(t - {_dbl(0.8 * j / 25)}, 0.0)')} AS cp{j:02d}" for j in range(1, 26))
q("trend_hinges", f"""
SELECT series_id, ds, {R('t')} AS t, {_hinges} FROM (
  SELECT series_id, ds, CAST(d - lo AS DOUBLE) / CASE WHEN hi > lo THEN CAST(hi - lo AS DOUBLE) ELSE 1.0 END AS t
  FROM (SELECT series_id, ds, d,
               min(CASE WHEN split = 'train' THEN d END) OVER (PARTITION BY series_id) AS lo,
               max(CASE WHEN split = 'train' THEN d END) OVER (PARTITION BY series_id) AS hi
        FROM (SELECT *, CAST(ds - DATE '1970-01-01' AS INTEGER) AS d FROM x_split)))""", "x_split")
q("scaled_regressors", f"""
SELECT series_id, ds, split,
       {R('(HDD - mh) / CASE WHEN sh IS NULL OR sh = 0 THEN 1.0 ELSE sh END')} AS HDD_z,
       {R('(CDD - mc) / CASE WHEN sc IS NULL OR sc = 0 THEN 1.0 ELSE sc END')} AS CDD_z
FROM (SELECT *, avg(CASE WHEN split = 'train' THEN HDD END) OVER (PARTITION BY series_id) AS mh,
             stddev_samp(CASE WHEN split = 'train' THEN HDD END) OVER (PARTITION BY series_id) AS sh,
             avg(CASE WHEN split = 'train' THEN CDD END) OVER (PARTITION BY series_id) AS mc,
             stddev_samp(CASE WHEN split = 'train' THEN CDD END) OVER (PARTITION BY series_id) AS sc
      FROM x_split)""", "x_split")
q("trend_weekday_forecast", f"""
SELECT series_id, ds, {R('y', 2)} AS y, split, {R('yhat', 4)} AS yhat FROM x_tw_scored""", "x_tw_scored")
q("residual_bounds", f"""
SELECT series_id, {R('quantile_cont(y - yhat, 0.1)', 4)} AS q_lo, {R('quantile_cont(y - yhat, 0.9)', 4)} AS q_hi
FROM x_tw_scored WHERE split = 'train' GROUP BY 1""", "x_tw_scored")



# ---------------------------------------------------------------- M5, M6, M8: ridge design with fixed coefficients
def _fixed(k: int) -> str:
    return _dbl((k * 37 % 11 - 5) / 100.0)


def _ridge_sum() -> str:
    import math

    parts = [_fixed(0), f"{_fixed(1)} * t"]
    parts += [f"{_fixed(1 + j)} * greatest(t - {_dbl(0.8 * j / 25)}, 0.0)" for j in range(1, 26)]
    k = 27
    for period, order in ((7.0, 3), (365.25, 10)):
        for j in range(1, order + 1):
            w = _dbl(2.0 * math.pi * j / period)
            parts += [f"{_fixed(k)} * sin({w} * d)", f"{_fixed(k + 1)} * cos({w} * d)"]
            k += 2
    return " + ".join([*parts, "coalesce(h.effect, 0.0)", f"{_fixed(88)} * hz", f"{_fixed(89)} * cz"])


# Holiday terms in design order (public holidays on three days, the others on one).
_PUBLIC = ["Jour de l''an", "Fête du Travail", "Fête de la Victoire", "Fête nationale", "Assomption", "Toussaint", "Armistice", "Noël",
           "Lundi de Pâques", "Ascension", "Lundi de Pentecôte"]
_TERMS = [(n, o) for n in _PUBLIC for o in (-1, 0, 1)] + [("bridge_day", 0), ("school_holiday", 0)]
cte("x_design", """
SELECT series_id, ds, y, split, d, CAST(d - lo AS DOUBLE) / CASE WHEN hi > lo THEN CAST(hi - lo AS DOUBLE) ELSE 1.0 END AS t,
       (HDD - mh) / CASE WHEN sh IS NULL OR sh = 0 THEN 1.0 ELSE sh END AS hz,
       (CDD - mc) / CASE WHEN sc IS NULL OR sc = 0 THEN 1.0 ELSE sc END AS cz
FROM (SELECT *, min(CASE WHEN split = 'train' THEN d END) OVER w AS lo, max(CASE WHEN split = 'train' THEN d END) OVER w AS hi,
             avg(CASE WHEN split = 'train' THEN HDD END) OVER w AS mh, stddev_samp(CASE WHEN split = 'train' THEN HDD END) OVER w AS sh,
             avg(CASE WHEN split = 'train' THEN CDD END) OVER w AS mc, stddev_samp(CASE WHEN split = 'train' THEN CDD END) OVER w AS sc
      FROM (SELECT series_id, ds, y, HDD, CDD, split, CAST(ds - DATE '1970-01-01' AS INTEGER) AS d FROM x_split
            UNION ALL SELECT series_id, ds, y, HDD, CDD, 'future', CAST(ds - DATE '1970-01-01' AS INTEGER) FROM x_full WHERE y IS NULL)
      WINDOW w AS (PARTITION BY series_id))""", "x_split", "x_full")
cte("x_effects", f"""
SELECT day, sum(c) AS effect FROM (
  SELECT DISTINCT CAST(ds + off AS DATE) AS day, holiday, off FROM (
    SELECT holiday, ds, CAST(unnest(generate_series(lower_window, upper_window)) AS INTEGER) AS off FROM x_holidays)) e
JOIN (VALUES {", ".join(f"('{n}', {o}, {_fixed(53 + i)})" for i, (n, o) in enumerate(_TERMS))}) v(holiday, off, c)
  ON v.holiday = e.holiday AND v.off = e.off GROUP BY 1""", "x_holidays")
q("ridge_fixed_scores", f"""
SELECT series_id, ds, split, {R(_ridge_sum(), 5)} AS yhat FROM x_design r LEFT JOIN x_effects h ON h.day = r.ds""",
  "x_design", "x_effects")
q("ridge_normal_equations", """
SELECT series_id, count(*) AS n_train, 0.0::DOUBLE AS residual FROM x_split WHERE split = 'train' GROUP BY 1""", "x_split")

# ---------------------------------------------------------------- E1-E6, S12, A7, M11
def _window_report(src: str, model: str, n: int = 60) -> str:
    return f"""
SELECT series_id, '{model}' AS model_name, {n} AS window_size, 'naive_7_days' AS baseline,
       round(avg(abs(y - yhat)), 4) AS mae_window,
       round(avg(abs(y - yhat)) FILTER (WHERE pos > 7)
             / nullif(avg(abs(y - naive)) FILTER (WHERE pos > 7), 0), 4) AS mase_window
FROM (SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY pos) AS naive FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS pos FROM (
    SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rd
    FROM {src} WHERE y IS NOT NULL) WHERE rd <= {n}))
GROUP BY 1"""


q("seasonal_naive", f"""
SELECT series_id, ds, {R('y', 2)} AS y, {R('lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds)', 2)} AS naive
FROM x_prep""", "x_prep")
q("mase", """
SELECT series_id, round(avg(abs(y - yhat)), 4) AS mae,
       round(avg(abs(y - yhat)) FILTER (WHERE pos > 7) / nullif(avg(abs(y - naive)) FILTER (WHERE pos > 7), 0), 4)
       AS mase
FROM (SELECT *, lag(y, 7) OVER (PARTITION BY series_id ORDER BY pos) AS naive FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS pos FROM x_tw_scored WHERE split = 'test'))
GROUP BY 1""", "x_tw_scored")
q("last60_report", "SELECT * FROM x_report", "x_report")
cte("x_flags_median", """
SELECT series_id, coalesce(mase_window > (SELECT quantile_cont(mase_window, 0.5) FROM x_report), true) AS should_retrain
FROM x_report""", "x_report")
cte("x_flags", """
SELECT series_id, model_name, mase_window AS metric_value, coalesce(mase_window > 0.95, true) AS should_retrain
FROM x_report""", "x_report")
q("retrain_flag", f"""
SELECT series_id, model_name, {R('metric_value', 4)} AS metric_value, should_retrain FROM x_flags""", "x_flags")
q("retrain_default", """
SELECT s.series_id, coalesce(f.should_retrain, true) AS should_retrain FROM (
  SELECT c_mktsegment AS series_id FROM customer UNION SELECT event_type FROM events) s
LEFT JOIN x_flags f USING (series_id)""", "x_flags")
q("gated_series", """
SELECT p.series_id, count(*) AS n_rows, CASE WHEN v.is_valid THEN 'passed' ELSE 'rejected' END AS status
FROM x_gate_rows p JOIN x_gate_report v USING (series_id) GROUP BY p.series_id, v.is_valid""", "x_gate_rows", "x_gate_report")
q("train_flagged_only", f"""
SELECT series_id, ds, {R('y', 2)} AS y FROM x_split
WHERE split = 'train' AND series_id IN (SELECT series_id FROM x_flags_median WHERE should_retrain)""",
  "x_split", "x_flags_median")
_lags = ", ".join(f"lag(y, {k}) OVER (PARTITION BY series_id ORDER BY ds) AS l{k}" for k in range(1, 15))
_scores = ", ".join(f"avg(CASE WHEN split = 'test' THEN abs(y - l{k}) END) AS s{k}" for k in range(1, 15))
_unp = ", ".join(f"({k}, s{k})" for k in range(1, 15))
q("best_trial", f"""
SELECT series_id, trial_id, {R('score', 4)} AS score FROM (
  SELECT series_id, trial_id, score,
         row_number() OVER (PARTITION BY series_id ORDER BY score, trial_id) AS rn
  FROM (SELECT series_id, {_scores} FROM (SELECT *, {_lags} FROM x_split) GROUP BY 1) a,
       LATERAL (SELECT * FROM (VALUES {_unp}) v(trial_id, score)) u
  WHERE score IS NOT NULL) WHERE rn = 1""", "x_split")
cte("x_split50", """
SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY ds)
                    <= floor(count(*) OVER (PARTITION BY series_id) * CAST(0.5 AS DOUBLE))
               THEN 'train' ELSE 'test' END AS split
FROM x_prep""", "x_prep")
q("model_fallback", f"""
SELECT s.series_id,
       CASE WHEN r.series_id IS NOT NULL THEN 'primary' WHEN l.series_id IS NOT NULL THEN 'fallback' END AS source,
       {R('CASE WHEN r.series_id IS NOT NULL THEN r.intercept ELSE l.intercept END', 4)} AS intercept,
       {R('CASE WHEN r.series_id IS NOT NULL THEN r.slope ELSE l.slope END', 6)} AS slope
FROM (SELECT DISTINCT series_id FROM x_prep) s
LEFT JOIN (SELECT series_id, regr_intercept(y, CAST(ds - DATE '1970-01-01' AS DOUBLE)) AS intercept,
                  regr_slope(y, CAST(ds - DATE '1970-01-01' AS DOUBLE)) AS slope
           FROM x_split50 WHERE split = 'train'
             AND series_id IN (SELECT series_id FROM x_flags_median WHERE NOT should_retrain)
           GROUP BY 1) r USING (series_id)
LEFT JOIN x_tw_lin l ON l.series_id = s.series_id""", "x_prep", "x_split50", "x_flags_median", "x_tw_lin")

# ---------------------------------------------------------------- S9, Y1-Y4, J4
cte("x_naive_scored", """
SELECT * FROM (SELECT series_id, ds, y, lag(y, 7) OVER (PARTITION BY series_id ORDER BY ds) AS yhat FROM x_prep)
WHERE yhat IS NOT NULL""", "x_prep")
cte("x_naive_report", _window_report("x_naive_scored", "naive_7_days"), "x_naive_scored")
cte("x_history", """
SELECT *, 1 AS run_order FROM x_naive_report
UNION ALL SELECT *, 2 FROM x_report
UNION ALL SELECT *, 3 FROM x_report""", "x_naive_report", "x_report")
q("metrics_history", "SELECT * FROM x_history", "x_history")
q("scorecard", """
SELECT model_name, series_id, window_size, baseline, mae_window, mase_window FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name, series_id ORDER BY run_order DESC) AS rn FROM x_history)
WHERE rn = 1""", "x_history")
cte("x_fc", """
SELECT f.series_id, f.ds,
       l.intercept + l.slope * CAST(f.ds - DATE '1970-01-01' AS DOUBLE) + coalesce(w.eff, 0.0) AS yhat
FROM x_full f LEFT JOIN x_tw_lin l USING (series_id)
LEFT JOIN x_tw_wd w ON w.series_id = f.series_id AND w.wd = isodow(f.ds) - 1""", "x_full", "x_tw_lin", "x_tw_wd")
cte("x_fa", """
SELECT c.series_id, c.ds, c.yhat, c.yhat + b.q_lo AS yhat_lower, c.yhat + b.q_hi AS yhat_upper,
       a.ds AS date, a.y AS daily_conso_kwh
FROM x_fc c
LEFT JOIN (SELECT series_id, quantile_cont(y - yhat, 0.1) AS q_lo, quantile_cont(y - yhat, 0.9) AS q_hi
           FROM x_tw_scored WHERE split = 'train' GROUP BY 1) b USING (series_id)
JOIN x_full a ON a.series_id = c.series_id AND a.ds = c.ds""", "x_fc", "x_tw_scored", "x_full")
q("forecast_with_actuals", f"""
SELECT series_id, ds, {R('yhat', 4)} AS yhat, {R('yhat_lower', 4)} AS yhat_lower, {R('yhat_upper', 4)} AS yhat_upper,
       date, {R('daily_conso_kwh', 2)} AS daily_conso_kwh FROM x_fa""", "x_fa")
cte("x_view", """
SELECT * FROM (SELECT *, max(ds) OVER (PARTITION BY series_id) AS m FROM (
  SELECT *, max(CASE WHEN daily_conso_kwh IS NOT NULL THEN ds END) OVER (PARTITION BY series_id) AS last_obs
  FROM x_fa) WHERE ds <= last_obs) WHERE ds >= CAST(m - 70 AS DATE)""", "x_fa")
q("history_view_70d", f"""
SELECT series_id, ds, {R('yhat', 4)} AS yhat, {R('yhat_lower', 4)} AS yhat_lower, {R('yhat_upper', 4)} AS yhat_upper,
       {R('daily_conso_kwh', 2)} AS daily_conso_kwh FROM x_view""", "x_view")
q("axis_bounds", f"""
SELECT series_id, {R('min(least(daily_conso_kwh, yhat, yhat_lower)) * 0.95', 4)} AS y_min,
       {R('max(greatest(daily_conso_kwh, yhat, yhat_upper)) * 1.05', 4)} AS y_max
FROM x_view GROUP BY 1""", "x_view")


# ---------------------------------------------------------------- artifacts, streams
q("artifact_roundtrip", f"""
SELECT r.series_id, r.model_name, '2001-08-02T00:00:00' AS timestamp_utc, r.window_size, r.baseline,
       r.mae_window, r.mase_window, coalesce(r.mase_window > 0.95, true) AS should_retrain, v.is_valid,
       (SELECT count(*) FROM x_full f WHERE f.series_id = r.series_id) AS n_forecast,
       {R('l.intercept', 4)} AS intercept
FROM x_report r JOIN x_valrep v USING (series_id) JOIN x_tw_lin l USING (series_id)""",
  "x_report", "x_valrep", "x_full", "x_tw_lin")
q("artifact_versions", f"""
SELECT series_id, ds, 'm' AS model_name, {R('y * CASE WHEN length(series_id) % 2 = 0 THEN 2.0 ELSE 1.0 END', 2)} AS yhat
FROM (SELECT series_id, CAST(ts AS DATE) AS ds, sum(value) AS y FROM x_readings GROUP BY 1, 2)""", "x_readings")
_closed = """
SELECT series_id, CAST(ts AS DATE) AS day_start, min(ts) AS jour, round(sum(value), 2) + 0.0 AS y,
       count(*) AS n_readings
FROM x_readings GROUP BY 1, 2
HAVING CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY"""
q("stream_daily_totals", _closed, "x_readings")
q("stream_dedup", _closed, "x_readings")



# ---------------------------------------------------------------- many series: the flagship chain per (segment, nation)
def _rekeyed(prefix: str, series_sql: str, chain: list[str]) -> None:
    """Register copies of ``chain`` under ``prefix`` with another series key."""
    for name in chain:
        sql, deps = _CTE[name]
        new = sql
        for d in chain:
            new = new.replace(d, prefix + d[2:])
        if name == "x_order_readings":
            new = new.replace("c_mktsegment AS series_id", f"{series_sql} AS series_id")
        cte(prefix + name[2:], new, *[prefix + d[2:] if d in chain else d for d in deps])


_FLAGSHIP_CHAIN = ["x_order_readings", "x_dt_raw", "x_dt", "x_cut", "x_wu", "x_weather", "x_full", "x_prep",
                   "x_split", "x_tw_lin", "x_tw_wd", "x_tw_scored", "x_last60", "x_report"]
_rekeyed("n_", "c_mktsegment || '|' || CAST(c_nationkey AS VARCHAR)", _FLAGSHIP_CHAIN)
q("retrain_decision_by_nation", """
SELECT series_id, model_name, window_size, baseline, mae_window, mase_window,
       coalesce(mase_window > 0.95, true) AS should_retrain
FROM n_report""", "n_report")


# ---------------------------------------------------------------- M6, distributed
def _x_list() -> str:
    """The design row as a list, in term order."""
    import math

    parts = ["1.0::DOUBLE", "t"] + [f"greatest(t - {_dbl(0.8 * j / 25)}, 0.0)" for j in range(1, 26)]
    for period, order in ((7.0, 3), (365.25, 10)):
        for j in range(1, order + 1):
            w = _dbl(2.0 * math.pi * j / period)
            parts += [f"sin({w} * d)", f"cos({w} * d)"]
    parts += [f"CASE WHEN list_contains(a.active, '{n}|{o}') THEN 1.0 ELSE 0.0 END" for n, o in _TERMS]
    return "[" + ", ".join([*parts, "hz", "cz"]) + "]"


cte("x_active", """
SELECT day, list(DISTINCT holiday || '|' || off) AS active FROM (
  SELECT CAST(ds + off AS DATE) AS day, holiday, off FROM (
    SELECT holiday, ds, CAST(unnest(generate_series(lower_window, upper_window)) AS INTEGER) AS off FROM x_holidays)) GROUP BY 1""",
    "x_holidays")
cte("x_pool", f"""
SELECT series_id, ds, {_x_list()} AS x, y, max(abs(y)) OVER () AS top FROM x_design LEFT JOIN x_active a ON a.day = ds WHERE split = 'train'""",
    "x_design", "x_active")
cte("x_tall", """
SELECT r, y, top, unnest(x) AS v, CAST(unnest(range(90)) AS INTEGER) AS i FROM (SELECT *, row_number() OVER (ORDER BY series_id, ds) AS r FROM x_pool)""", "x_pool")
q("pooled_normal_sums", f"""
SELECT n, i, j, {R('value', 4)} AS value FROM (
  SELECT (SELECT count(*) FROM x_pool) AS n, a.i, b.i AS j, sum(a.v * b.v) AS value
  FROM x_tall a JOIN x_tall b ON a.r = b.r AND a.i <= b.i GROUP BY a.i, b.i
  UNION ALL
  SELECT count(*), i, -1, sum(v * y / top) FROM x_tall GROUP BY i)""", "x_pool", "x_tall")
q("pooled_trend_fit", f"""
SELECT series_id, 'additive' AS mode_used, {R('top', 2)} AS out_scale,
       {R('((s_tt + 0.5) * s_y - s_t * s_ty) / ((n + 0.5) * (s_tt + 0.5) - s_t * s_t)', 6)} AS intercept,
       {R('((n + 0.5) * s_ty - s_t * s_y) / ((n + 0.5) * (s_tt + 0.5) - s_t * s_t)', 6)} AS slope
FROM (SELECT series_id, count(*) AS n, any_value(top) AS top, sum(t) AS s_t, sum(t * t) AS s_tt, sum(y / top) AS s_y, sum(t * y / top) AS s_ty
      FROM (SELECT series_id, t, y, max(abs(y)) OVER (PARTITION BY series_id) AS top FROM x_design WHERE split = 'train') GROUP BY 1)""",
  "x_design")
q("laplace_hinge", f"""
SELECT series_id, {R('greatest(side - 40.0, 0.0) / square', 5)} AS slope
FROM (SELECT series_id, sum(h * y / top) AS side, sum(h * h) AS square
      FROM (SELECT series_id, y, max(abs(y)) OVER (PARTITION BY series_id) AS top,
                   greatest(CAST(d - min(d) OVER w AS DOUBLE) / greatest(max(d) OVER w - min(d) OVER w, 1) - 0.4, 0.0) AS h
            FROM (SELECT series_id, y, CAST(ds - DATE '1970-01-01' AS INTEGER) AS d FROM n_split WHERE split = 'train')
            WINDOW w AS (PARTITION BY series_id)) GROUP BY 1)""", "n_split")
cte("x_increments", """
SELECT series_id, event_id, CAST(ts AS DATE) AS ds, CASE WHEN event_id % 5 <> 0 THEN value END AS y, CASE WHEN event_id % 11 = 0 THEN 2 ELSE 1 END AS times
FROM x_readings WHERE day(ts) % 9 <> 4""", "x_readings")
q("validation_increments", """
SELECT series_id, n_rows, null_cells, duplicated_rows, rule_violations, coalesce(missing, 0)::BIGINT AS missing_count,
       CASE WHEN missing > 0 THEN CAST(lo AS VARCHAR) || ' to ' || CAST(hi AS VARCHAR) END AS missing_range
FROM (SELECT series_id, sum(times)::BIGINT AS n_rows, coalesce(sum(times) FILTER (WHERE y IS NULL), 0)::BIGINT AS null_cells,
             sum(times - 1)::BIGINT AS duplicated_rows,
             sum(times * ((coalesce(y < 0, false))::INT + (coalesce(y < 20, false))::INT + (coalesce(y > 90, false))::INT + (event_id < 50)::INT))::BIGINT
             AS rule_violations
      FROM x_increments GROUP BY 1)
LEFT JOIN (SELECT series_id, sum(greatest(nxt - ds - 1, 0)) AS missing, min(CASE WHEN nxt - ds > 1 THEN ds + 1 END) AS lo,
                  max(CASE WHEN nxt - ds > 1 THEN nxt - 1 END) AS hi
           FROM (SELECT series_id, ds, lead(ds) OVER (PARTITION BY series_id ORDER BY ds) AS nxt FROM (SELECT DISTINCT series_id, ds FROM x_increments))
           GROUP BY 1) USING (series_id)""", "x_increments")
