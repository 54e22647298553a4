"""Payloads from a landing folder (S1, S2): one JSON document per file, each read once.

A file stream with ``availableNow`` reads what its own log does not name yet
and ends; rows and rejects of a run are committed together with that log, so a
run that dies is repeated without doubling or losing anything.  A second run
over the same folder reads nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daycast.sources.payloads import ENVELOPE, RECORD, WEATHER_PAYLOAD, WEATHER_VARS

#: Files of one micro-batch, at most.
BATCH_FILES = 10_000


def record_items(text: str) -> tuple[Column, Column]:
    """Is the text a JSON object, and its records (``records`` before ``results``, nested or flat)."""
    ok = F.coalesce(F.try_parse_json(text).cast("string").startswith("{"), F.lit(False))
    p = F.from_json(text, ENVELOPE)
    rows = F.transform(F.coalesce(p["records"], p["results"]), lambda r: F.coalesce(
        r["record"], F.struct(r["jour"].alias("jour"), r["conso_jour"].alias("conso_jour"))))
    return ok, F.coalesce(rows, F.array().cast(T.ArrayType(RECORD)))


def array_items(text: str) -> tuple[Column, Column]:
    """Have all arrays under ``daily`` one length, and their rows."""
    p = F.from_json(text, WEATHER_PAYLOAD)["daily"]
    names = ["time", *WEATHER_VARS]
    ok = p.isNotNull() & p["time"].isNotNull()
    for v in WEATHER_VARS:
        ok = ok & (F.size(p[v]) == F.size(p["time"]))
    return F.coalesce(ok, F.lit(False)), F.arrays_zip(*[p[v].alias(v) for v in names])


SHAPES = {"records": record_items, "arrays": array_items}


def ingest(spark: SparkSession, folder: str, root: str, shape: str = "records", batch_files: int = BATCH_FILES) -> int:
    """Reads the files of ``folder`` that no earlier run has read; returns how many payloads that were.

    Results are under ``root``: :func:`landed` gives rows and rejects of all
    runs.  A file that is no JSON of the shape is one reject with its name and
    text; a file without a byte holds no payload; any other is one, whatever
    its length.
    """
    ok, items = SHAPES[shape]("payload")
    files = (spark.readStream.format("binaryFile").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", batch_files)
             .schema("path string, modificationTime timestamp, length long, content binary").load(folder))
    parsed = files.select(F.col("path").alias("file"), F.col("content").cast("string").alias("payload")).withColumns({"_ok": ok, "_items": items})
    kind = F.when(F.col("_ok"), F.lit("row")).otherwise(F.lit("reject"))
    # a payload without items has one line that says so, and no rows
    none = F.size("_items") <= 0
    out = parsed.select("file", F.when(F.col("_ok") & none, F.lit("empty")).otherwise(kind).alias("kind"), F.when(~F.col("_ok"), F.col("payload")).alias("payload"),
                        F.inline_outer(F.when(F.col("_ok") & ~none, F.col("_items"))))
    query = (out.writeStream.format("parquet").option("path", os.path.join(root, "landed")).option("checkpointLocation", os.path.join(root, "log"))
             .partitionBy("kind").outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def landed(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Rows (with ``file``) and rejects (``file, payload``) of all runs so far."""
    df = spark.read.parquet(os.path.join(root, "landed"))
    return df.filter("kind = 'row'").drop("kind", "payload"), df.filter("kind = 'reject'").select("file", "payload")
