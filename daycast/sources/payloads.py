"""API payloads as JSON text -> rows.

Payloads land as one JSON document per line/row; parsing is ``from_json``
with a declared schema (no inference) and flattening is ``inline`` of an
array of structs, all JVM side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField("jour", T.StringType()), T.StructField("conso_jour", T.DoubleType())])
RECORD_ITEM = T.StructType([T.StructField("record", RECORD), T.StructField("jour", T.StringType()),
                            T.StructField("conso_jour", T.DoubleType())])
ENVELOPE = T.StructType([T.StructField("records", T.ArrayType(RECORD_ITEM)),
                         T.StructField("results", T.ArrayType(RECORD_ITEM))])
WEATHER_VARS = ["temperature_2m_max", "temperature_2m_min", "temperature_2m_mean"]
DAILY = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))] +
                     [T.StructField(v, T.ArrayType(T.DoubleType())) for v in WEATHER_VARS])
WEATHER_PAYLOAD = T.StructType([T.StructField("daily", DAILY)])


def flatten_records(payloads: DataFrame, text: str = "payload", keep: list[str] | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """``records`` wins over ``results`` (even when empty); an item with a
    nested ``record`` is unwrapped, else taken as is, its missing fields NULL;
    neither key -> no rows.  Text that is no JSON object goes to the rejects
    frame (the kept columns and the text)."""
    keep = keep or []
    p = payloads.select(*keep, F.col(text), F.from_json(text, ENVELOPE).alias("_p"),
                        F.coalesce(F.try_parse_json(text).cast("string").startswith("{"), F.lit(False)).alias("_ok"))
    items = F.coalesce(F.col("_p.records"), F.col("_p.results"))
    rows = F.transform(items, lambda r: F.coalesce(
        r["record"], F.struct(r["jour"].alias("jour"), r["conso_jour"].alias("conso_jour"))))
    good = p.filter("_ok").select(*keep, F.inline(F.coalesce(rows, F.array().cast(T.ArrayType(RECORD)))))
    return good, p.filter(~F.col("_ok")).select(*keep, text)


def flatten_arrays(payloads: DataFrame, text: str = "payload", keep: list[str] | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Parallel arrays under ``daily`` -> rows.  Payloads whose arrays have
    unequal lengths or no ``daily`` go to the rejects frame (``arrays_zip``
    would pad them with NULLs silently)."""
    keep = keep or []
    p = payloads.select(*keep, F.col(text), F.from_json(text, WEATHER_PAYLOAD).alias("_p"))
    sizes = [F.size(F.col(f"_p.daily.{v}")) for v in ["time"] + WEATHER_VARS]
    ok = F.col("_p.daily").isNotNull() & F.col("_p.daily.time").isNotNull()
    for s in sizes[1:]:
        ok = ok & (s == sizes[0])
    ok = F.coalesce(ok, F.lit(False))  # a payload without one of the arrays is rejected, not lost
    good = p.filter(ok)
    zipped = F.arrays_zip(*[F.col(f"_p.daily.{v}").alias(v) for v in ["time"] + WEATHER_VARS])
    rows = good.select(*keep, F.inline(zipped))
    return rows, p.filter(~ok).select(*keep, text)


def envelope_payloads(readings: DataFrame, page_size: int = 100) -> DataFrame:
    """Fixture: readings served as API pages of at most ``page_size`` records.

    Pages cycle through the three envelope shapes (nested ``record`` under
    ``records``, flat items under ``results``, flat items under ``records``).
    A page is bounded by construction (``event_id div page_size``).
    """
    page = F.floor(F.col("event_id") / page_size).cast("bigint")
    rec = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("jour"), F.col("value").alias("conso_jour"))
    g = readings.groupBy(page.alias("page")).agg(F.collect_list(rec).alias("items"))
    shape = F.col("page") % 3
    nested = F.to_json(F.struct(F.transform("items", lambda r: F.struct(r.alias("record"))).alias("records")))
    flat_results = F.to_json(F.struct(F.col("items").alias("results")))
    flat_records = F.to_json(F.struct(F.col("items").alias("records")))
    return g.select("page", F.when(shape == 0, nested).when(shape == 1, flat_results).otherwise(flat_records)
                    .alias("payload"))


def weather_payloads(weather: DataFrame) -> DataFrame:
    """Fixture: daily weather served one calendar month per payload (<= 31 days)."""
    month = F.date_format("ds", "yyyy-MM")
    g = weather.groupBy(month.alias("month")).agg(F.array_sort(F.collect_list(F.struct(
        F.date_format("ds", "yyyy-MM-dd").alias("time"),
        F.col("temperature_max").alias("temperature_2m_max"),
        F.col("temperature_min").alias("temperature_2m_min"),
        F.col("temperature_mean").alias("temperature_2m_mean")))).alias("d"))
    def field(v):
        return F.transform("d", lambda r: r[v]).alias(v)

    daily = F.struct(*[field(v) for v in ["time"] + WEATHER_VARS])
    return g.select("month", F.to_json(F.struct(daily.alias("daily"))).alias("payload"))
