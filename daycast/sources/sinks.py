"""Sinks and the named artifact store.

An artifact root is a folder on shared storage (on a cluster: under the
folder named by ``spark.checkpoint.dir`` or any table location).  Writes are
idempotent: a run replaces its own series and leaves the others, whatever
folder they share; the metric history appends (as the reference).

Every write goes to a folder of its own, ``daycast_version=<id>``; a pointer, a small
numbered file that names the folders in force and the schema, is put in place
by one rename at the end.  Readers follow the newest pointer, so a write that
dies half way changes nothing, and two writers at once are an error for the
second.  What no pointer of the last two names is removed after the swap.
"""

from __future__ import annotations

import json
import logging
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

log = logging.getLogger(__name__)

# name -> (sub folder, format)
ARTIFACTS = {
    "forecast": ("forecasts", "parquet"),
    "metrics": ("metrics", "parquet"),
    "metrics_history": ("metrics_history", "parquet"),
    "data_quality": ("data_quality", "json"),
    "retrain_flag": ("retrain_flag", "json"),
    "model": ("models", "parquet"),
    "validation_state": ("validation_state", "parquet"),
}


def artifact_path(root: str, name: str) -> tuple[str, str]:
    """Artifact name -> (path, format); an unknown name is an error."""
    try:
        sub, fmt = ARTIFACTS[name]
    except KeyError:
        raise ValueError(f"unknown artifact {name!r}; known: {sorted(ARTIFACTS)}") from None
    return os.path.join(root, sub), fmt


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _list(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


POINTER, FOLDER = "_pointer-", "daycast_version="


def _pointers(spark: SparkSession, path: str) -> list[str]:
    return [n for n in _list(spark, path) if n.startswith(POINTER)]


def _read_pointer(spark: SparkSession, path: str, name: str) -> dict:
    fs, p = _fs(spark, os.path.join(path, name))
    stream = fs.open(p)  # a few lines; Spark's readers pass over names with an underscore
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def pointer(spark: SparkSession, path: str) -> dict | None:
    """The pointer in force: ``{"schema": .., "parts": [[version, partition folder], ..]}``, None before the first commit."""
    names = _pointers(spark, path)
    return _read_pointer(spark, path, names[-1]) if names else None


def _partitions(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Partition folders of a version, relative to it."""
    found = [""]
    for _ in range(depth):
        found = [os.path.join(f, n) for f in found for n in _list(spark, os.path.join(folder, f)) if "=" in n]
    return found


def write_version(df: DataFrame, path: str, fmt: str, partition_by: list[str] | None = None) -> tuple[str, list[str]]:
    """The rows in a new version folder that nobody reads yet; its name and its partition folders."""
    version = uuid.uuid4().hex
    folder = os.path.join(path, f"{FOLDER}{version}")
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(folder)
    return version, _partitions(df.sparkSession, folder, len(partition_by or []))


def commit(spark: SparkSession, path: str, before: dict | None, after: dict) -> None:
    """Puts the pointer ``after`` in force if ``before`` still is; an error if another writer was faster."""
    names = _pointers(spark, path)
    number = int(names[-1][len(POINTER):]) if names else 0
    if (_read_pointer(spark, path, names[-1]) if names else None) != before:
        raise RuntimeError(f"{path}: another run has committed in the meantime")
    fs, aside = _fs(spark, os.path.join(path, f"_aside-{uuid.uuid4().hex}"))
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(after).encode()))
    out.close()
    if not fs.rename(aside, spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, f"{POINTER}{number + 1:012d}"))):
        fs.delete(aside, False)
        raise RuntimeError(f"{path}: another run has committed in the meantime")
    _remove_old(spark, path)


def _remove_old(spark: SparkSession, path: str) -> None:
    """Removes pointers but the last two, and what neither of them names (readers may still be on the one before)."""
    names = _pointers(spark, path)
    kept = {(v, p) for n in names[-2:] for v, p in _read_pointer(spark, path, n)["parts"]}
    fs, _ = _fs(spark, path)
    for n in names[:-2]:
        for v, p in {tuple(x) for x in _read_pointer(spark, path, n)["parts"]} - kept:
            fs.delete(_fs(spark, os.path.join(path, f"{FOLDER}{v}", p))[1], True)
            if v not in {k[0] for k in kept}:
                fs.delete(_fs(spark, os.path.join(path, f"{FOLDER}{v}"))[1], True)
        fs.delete(_fs(spark, os.path.join(path, n))[1], False)


def write_artifact(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None,
                   mode: str = "overwrite", given: tuple | None = None) -> str:
    """Overwrite (only the partitions present in ``df``) or append; in force when this returns, or not at all.

    ``given`` is ``(pointer,)`` where ``df`` was made from what that pointer names.
    """
    spark = df.sparkSession
    path, fmt = artifact_path(root, name)
    before = given[0] if given else pointer(spark, path)
    version, parts = write_version(df, path, fmt, partition_by)
    old = before["parts"] if before else []
    if mode == "overwrite":  # without partitions every folder is replaced
        old = [[v, p] for v, p in old if p not in set(parts)] if partition_by else []
    commit(spark, path, before, {"schema": df.schema.json(), "parts": old + [[version, p] for p in parts]})
    return path


def read_artifact(spark: SparkSession, root: str, name: str, view: str | None = None, given: tuple | None = None) -> DataFrame:
    """Read by name what the pointer names, optionally as a temp view; a folder without a pointer is read as it is."""
    path, fmt = artifact_path(root, name)
    now = given[0] if given else pointer(spark, path)
    if now is None:
        df = spark.read.format(fmt).load(path)
    else:
        schema = StructType.fromJson(json.loads(now["schema"]))
        folders = [os.path.join(path, f"{FOLDER}{v}", p) for v, p in now["parts"]]
        if folders:
            df = spark.read.format(fmt).schema(schema).option("basePath", path).load(folders).select(*(f"`{c}`" for c in schema.names))
        else:
            df = spark.createDataFrame([], schema)
    if view:
        df.createOrReplaceTempView(view)
    return df


def has_artifact(spark: SparkSession, root: str, name: str) -> bool:
    """Is there anything in force (or a folder that was written without pointers)."""
    path, _ = artifact_path(root, name)
    return any(n.startswith(POINTER) or not n.startswith(("_", ".", FOLDER)) for n in _list(spark, path))


def merge_artifact(df: DataFrame, root: str, name: str, keys: list[str], partition_by: list[str] | None = None) -> str:
    """S7 for a run over part of the series: rows of ``keys`` in ``df`` replace stored ones, all others stay.

    Only the partitions that ``df`` touches are read and written anew; the old
    ones are in force until the pointer moves.
    """
    spark = df.sparkSession
    given = (pointer(spark, artifact_path(root, name)[0]),)
    if has_artifact(spark, root, name):
        old = read_artifact(spark, root, name, given=given)
        if partition_by:
            old = old.join(df.select(*partition_by).distinct(), partition_by, "left_semi")
        df = df.unionByName(old.join(df.select(*keys).distinct(), keys, "left_anti").select(*df.columns))
    return write_artifact(df, root, name, partition_by=partition_by, given=given)


def save_metrics(metrics: DataFrame, root: str, as_of: str) -> str:
    """Metric snapshot with its UTC timestamp first, replaced per model and series."""
    out = metrics.select(F.lit(as_of).alias("timestamp_utc"), *metrics.columns)
    return merge_artifact(out, root, "metrics", ["model_name", "series_id"], ["model_name"])


def append_metrics_history(run: DataFrame | None, root: str) -> str:
    """Append the run rows to the history (no dedup on rerun, as the reference).

    A missing run is an error; an empty one is warned about and appends nothing.
    """
    if run is None:
        raise ValueError("no metrics of this run to append")
    if run.isEmpty():
        log.warning("the run has no metrics; nothing is appended")
        return artifact_path(root, "metrics_history")[0]
    return write_artifact(run, root, "metrics_history", mode="append")


def save_report(report: DataFrame, root: str) -> str:
    """Validation report document as JSON lines."""
    return write_artifact(report, root, "data_quality")


def save_flags(flags: DataFrame, root: str, as_of: str) -> str:
    """``date, should_retrain`` per series as JSON; series not in this run keep theirs."""
    return merge_artifact(flags.select(F.lit(as_of).alias("date"), *flags.columns), root, "retrain_flag", ["series_id"])


def read_flags(spark: SparkSession, root: str) -> DataFrame | None:
    """S12 input: permissive JSON read; a missing artifact gives ``None`` (defaults apply)."""
    if not has_artifact(spark, root, "retrain_flag"):
        return None
    try:
        return read_artifact(spark, root, "retrain_flag")
    except AnalysisException:  # a folder without any file has no schema
        return None


# A folder per series does not survive millions of series; series are hashed
# into a bounded number of partition folders instead (still prunable).
SERIES_BUCKETS = 64


def series_bucket(series_id) -> "F.Column":
    c = F.col(series_id) if isinstance(series_id, str) else series_id
    return F.pmod(F.xxhash64(c), F.lit(SERIES_BUCKETS)).cast("int")


def save_forecast(forecast: DataFrame, root: str, model_name: str) -> str:
    """Forecasts per model, in ``SERIES_BUCKETS`` hashed series folders; other series stay."""
    out = forecast.withColumn("model_name", F.lit(model_name)).withColumn("series_bucket", series_bucket("series_id"))
    return merge_artifact(out, root, "forecast", ["model_name", "series_id"], ["model_name", "series_bucket"])


def read_series(spark: SparkSession, root: str, name: str, series_id: str, model_name: str | None = None) -> DataFrame:
    """One series of a bucketed artifact: the bucket filter prunes the folders read."""
    df = read_artifact(spark, root, name)
    cond = (F.col("series_bucket") == series_bucket(F.lit(series_id))) & (F.col("series_id") == F.lit(series_id))
    if model_name is not None:
        cond = cond & (F.col("model_name") == F.lit(model_name))
    return df.filter(cond)


def save_model(coef_long: DataFrame, root: str) -> str:
    """Coefficient table by model name."""
    return write_artifact(coef_long, root, "model", partition_by=["model_name"])
