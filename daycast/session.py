"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state (open days, dedup keys inside the watermark) off-heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Sizing for a large cluster (hundreds of TB of raw readings): start with many
# shuffle partitions and let AQE coalesce them to ~256 MB each, so a partition
# fits an executor's memory without spilling; read Parquet in 256 MB splits;
# split a partition as skewed when it is 5x the median and over 512 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.task.maxFailures": "8",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "daycast", extra: dict | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    On a cluster ``master`` is left to spark-submit and ``cluster=True`` adds
    :data:`CLUSTER_CONF`; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 -- Spark Connect sessions have no SparkContext
        pass
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; it is read here and never
    changed.  A ``local`` session without the setting (tests, one machine) gets
    one private folder per application; elsewhere a missing setting is an error,
    because executors do not see a folder of the driver's machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        sc = spark.sparkContext
        master, app = sc.master, sc.applicationId
    except Exception as e:  # noqa: BLE001 -- Spark Connect has no SparkContext
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share") from e
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="daycast-local-")
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def stage(df, name: str):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Used at the pipeline's stage boundaries (daily target, weather, full
    data): it cuts the lineage (a lost executor recomputes from the table, not
    from the raw scan), stops a reused sub-plan from being recomputed by each
    consumer, and the read-back still gets column pruning and filter pushdown.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"stage-{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._daycast_stage = path  # for drop_stage
    return out


def drop_stage(df) -> None:
    """Remove the table behind a frame that :func:`stage` returned (nothing may read it afterwards)."""
    path = getattr(df, "_daycast_stage", None)
    if path:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


_SHIPPED: set[str] = set()


def ship_package(spark) -> None:
    """Make ``daycast`` importable by Python workers (``applyInPandas``).

    Zips the package once per application and hands it to ``addPyFile``,
    which distributes it to every executor.  On a cluster that already ships
    the package (``--py-files``, an installed wheel) this is harmless.
    """
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 -- Spark Connect
        sc, app = None, f"connect-{spark.session_id}" if hasattr(spark, "session_id") else "connect"
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = checkpoint_dir(spark)
    if "://" in base and not base.startswith("file:"):
        base = tempfile.mkdtemp(prefix="daycast-pyfiles-")  # zip is built on the driver, Spark ships it
    base = base.replace("file://", "").replace("file:", "")
    folder = os.path.join(base, f"pyfiles-{app}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "daycast.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    if sc is not None:
        sc.addPyFile(path)
    else:
        spark.addArtifacts(path, pyfile=True)
    _SHIPPED.add(app)
