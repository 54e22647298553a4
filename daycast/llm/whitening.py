"""Embedding whitening by a bidiagonal qd solver.

Tasks centre their rows and reduce them, block after block, to one triangular
factor (QR); factors are merged in a tree.  The last one, as large as a vector
is long, is made bidiagonal; its singular values and right directions
(``bidiagonal.py``) are the principal axes, found without ever forming a
covariance matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.bidiagonal import directions
from daycast.session import ship_package

#: Integer grid of the entries: ``floor(SCALE * c) + OFFSET``.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows that enter one QR step, and tasks that merge the factors of all others before the last one.
BLOCK, MERGERS = 4_096, 64
#: Largest absolute entry whose grid value is a long (with room for the offset).
MOST = float(1 << 52)


@dataclass
class Whitening:
    """A fitted whitening: row count, exact sums, axes (columns), their variances, total variance."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        """``sums / n``, rounded once from the exact quotient's integer part and remainder."""
        return np.array([s // self.n + (s % self.n) / self.n for s in self.sums], np.float64)


def usable(vectors: DataFrame, vec: str) -> DataFrame:
    """Rows whose vector is not NULL or empty and holds finite numbers on the grid only."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(MOST)))
    return vectors.filter(F.coalesce(fine & (F.size(vec) > 0), F.lit(False)))


def _grid(col: pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(flat * SCALE).astype(np.int64) + OFFSET
    return x.reshape(len(col), -1) if len(col) else x.reshape(0, 0)


def _sums(good: DataFrame) -> tuple[int, list[int]]:
    """Count and exact sums of the vectors of the commonest length (the shortest of equally common ones)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            col = batch.column(0)
            lengths = np.diff(col.offsets.to_numpy())
            for d in np.unique(lengths):
                x = _grid(col.filter(pa.array(lengths == d)))
                have = held.setdefault(int(d), [0, np.zeros(d, np.int64), np.zeros(d, np.int64)])
                have[0] += len(x)
                have[1] += (x >> 32).sum(0)  # halves: neither sum can overflow in a task
                have[2] += (x & 0xFFFFFFFF).sum(0)
        for d, (n, high, low) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, d, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(np.full(d, n, np.int64)),
                 pa.array(high), pa.array(low)], names=["d", "at", "n", "high", "low"])

    parts = good.mapInArrow(task, "d int, at int, n long, high long, low long")
    big = "decimal(38,0)"
    summed = parts.groupBy("d", "at").agg(F.sum("n").alias("n"), F.sum(F.col("high").cast(big)).alias("high"),
                                          F.sum(F.col("low").cast(big)).alias("low"))
    best = summed.filter("at = 0").orderBy(F.desc("n"), "d").limit(1).select("d")
    rows = summed.join(F.broadcast(best), "d").orderBy("at").collect()  # one row per dimension
    if not rows:
        return 0, []
    return int(rows[0]["n"]), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _reduce(held: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if held is None else np.vstack([held, rows]), mode="r")


def _factor(good: DataFrame, mean: np.ndarray) -> np.ndarray:
    """Triangular factor of all centred rows: blocks within tasks, then a tree over tasks."""
    d = len(mean)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            x = _grid(batch.column(0))
            for a in range(0, len(x), BLOCK):
                held = _reduce(held, x[a:a + BLOCK] - mean)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(held).tobytes()], pa.binary())], names=["r"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                held = _reduce(held, np.frombuffer(raw).reshape(-1, d))
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(held).tobytes()], pa.binary())], names=["r"])

    factors = good.mapInArrow(task, "r binary")
    for tasks in (MERGERS, 1):
        factors = factors.repartition(tasks).mapInArrow(merge, "r binary")
    rows = factors.collect()  # one matrix of the size of a vector's length
    return np.frombuffer(rows[0]["r"]).reshape(-1, d)


def fit(vectors: DataFrame, components: int = COMPONENTS, vec: str = "embedding") -> Whitening | None:
    """Whitening of all usable vectors (None without any); every row counts, repeated rows as often as they occur."""
    ship_package(vectors.sparkSession)
    good = usable(vectors, vec).select(F.col(vec).alias("v"))
    n, sums = _sums(good)
    if not n:
        return None
    model = Whitening(n, sums, np.zeros((len(sums), 0)), np.zeros(0), 0.0)
    r = _factor(good.filter(F.size("v") == len(sums)), model.mean)
    values, kept, axes = directions(r, components)
    return Whitening(n, sums, axes, kept / n, float(np.sum(r * r)) / n)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """``sum((n x - S)^2)`` of each row, exactly."""
    s = np.array(sums, object)
    reach = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums))
    if reach < 1 << 62:
        y = x * np.int64(n) - np.array(sums, np.int64)
        if float(np.abs(y).max(initial=0)) ** 2 * len(sums) < 4e18:
            return (y * y).sum(1).tolist()
        y = y.astype(object)
    else:
        y = x.astype(object) * n - s
    return [int(v) for v in (y * y).sum(1)]


def transform(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained``: a row per usable vector and component.

    ``deviation`` is ``decimal(38,0)``, NULL beyond it.
    """
    spark = vectors.sparkSession
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double"
    if model is None or not len(model.variances):
        return spark.createDataFrame([], schema)
    ship_package(spark)
    n, sums, mean, k = model.n, model.sums, model.mean, len(model.variances)
    scaled = model.axes / np.sqrt(model.variances)
    share = model.variances / model.trace

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(a, BLOCK)
                x = _grid(batch.column(1))
                if not len(x):
                    continue
                far = [Decimal(v) if v < 10 ** 38 else None for v in _deviations(x, n, sums)]
                each = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(len(x) * k, n, np.int64)), pa.array(far, pa.decimal128(38, 0)).take(each),
                     pa.array(((x - mean) @ scaled).ravel()), pa.array(np.tile(share, len(x)))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained"])

    good = usable(vectors, vec).filter(F.size(vec) == len(sums))
    return good.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec).alias("v")).mapInArrow(task, schema)


def identity_error(vectors: DataFrame, model: Whitening | None, vec: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened rows' covariance (divisor n) minus the identity, measured on all rows.

    Whitened rows are centred by the exact sums already, so their own mean is
    rounding; its products are taken off all the same.
    """
    if model is None or not len(model.variances):
        return None
    mean, k, n = model.mean, len(model.variances), model.n
    scaled = model.axes / np.sqrt(model.variances)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            x = _grid(batch.column(0))
            for a in range(0, len(x), BLOCK):
                w = (x[a:a + BLOCK] - mean) @ scaled
                total[:k] += w.T @ w
                total[k] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k + 1, dtype=np.int32), k)),
                                          pa.array(np.tile(np.arange(k, dtype=np.int32), k + 1)), pa.array(total.ravel())],
                                         names=["i", "j", "s"])

    good = usable(vectors, vec).filter(F.size(vec) == len(model.sums)).select(F.col(vec).alias("v"))
    c = np.zeros((k + 1, k))
    for r in good.mapInArrow(task, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        c[r["i"], r["j"]] = r["s"] / n
    return float(np.abs(c[:k] - np.outer(c[k], c[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for the first ``components`` axes.

    Entries are taken on an integer grid (``floor(1024 c) + 100000``), so count,
    sums and ``deviation`` (``sum((n x - S)^2)``, ``decimal(38,0)``, NULL beyond
    it) are exact; covariances have divisor n.  ``whitened`` is the centred row
    on a unit axis over the root of its variance, ``explained`` the axis' share
    of the total variance.

    Vectors that are NULL, empty, hold NULL or non-finite entries or entries
    beyond 2^52, or are not of the commonest length take no part and have no
    rows.  Rows without an id keep a NULL id; repeated rows count and return as
    often as they occur.  Axes along which the vectors do not vary (fewer rows
    than axes, equal rows, constant entries) cannot be whitened and are left
    out, so one row alone gives none.  Equal variances get some orthogonal axes
    of their common space.  Other columns are ignored; an empty table stays
    empty.  The driver holds matrices of the size of one vector's length.
    """
    model = fit(vectors, components, vec)
    error = identity_error(vectors, model, vec)
    return transform(vectors, model, id_col, vec).withColumn("identity_error", F.lit(error).cast("double"))


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """Whitened embeddings; ``deviation`` is NULL where it does not fit a long (``deviation_exact`` has it all the same)."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    out = whiten(vectors).withColumnRenamed("deviation", "deviation_exact")
    return out.select("vec_id", "component", "n", F.expr("try_cast(deviation_exact as bigint)").alias("deviation"), "deviation_exact",
                      "whitened", "explained", "identity_error")
