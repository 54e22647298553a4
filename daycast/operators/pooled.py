"""Distributed ridge fit (M6): one key of any length, no group that holds its rows.

The normal equations need ``X'X``, ``X'y`` and a few scalars only, all of them
sums.  Each task adds up its own rows (a fixed-size record per key, whatever
the number of rows), records are merged in two steps through a bounded number
of lots, and each key's equations are solved once.  The grouped fit
(``ridge.fit``) holds one series in a task; this one also fits a pool of all
series, or one series whose readings were never rolled up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.operators.ridge import DEFAULT_PARAMS, laplace_weights, penalties, solve_laplace
from daycast.operators.tune import key_type
from daycast.session import ship_package

#: Keys whose sums a task holds at a time (some 70 kB each with 90 terms); lots that merge a key's records.
HELD, LOTS = 256, 256
#: Rows whose products are formed together.
CHUNK = 4_096
SUMS = "n long, n_positive long, top double, gram array<double>, xty array<double>, xtl array<double>"


class _Sums:
    """Sums of one key: rows, rows with a positive target, largest |y|, X'X (upper part), X'y, X'log y."""

    __slots__ = ("n", "n_positive", "top", "gram", "xty", "xtl")

    def __init__(self, p: int) -> None:
        self.n = self.n_positive = 0
        self.top = 0.0
        self.gram, self.xty, self.xtl = np.zeros((p, p)), np.zeros(p), np.zeros(p)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        positive = y > 0
        self.n += len(y)
        self.n_positive += int(positive.sum())
        self.top = max(self.top, float(np.abs(y).max(initial=0.0)))
        self.gram += x.T @ x
        self.xty += x.T @ y
        self.xtl += x[positive].T @ np.log(y[positive])

    def row(self) -> tuple:
        return self.n, self.n_positive, self.top, self.gram[np.triu_indices(len(self.xty))], self.xty, self.xtl


def _partial(design: DataFrame, by: str) -> DataFrame:
    """Records of sums, one per task and key (more where a task meets very many keys)."""
    key = design.schema[by].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def flush() -> pa.RecordBatch:
            rows = [s.row() for s in held.values()]
            columns = [pa.array(list(held), keys), *(pa.array([r[i] for r in rows]) for i in range(3)),
                       *(pa.array([r[i] for r in rows], pa.list_(pa.float64())) for i in range(3, 6))]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=[by, "n", "n_positive", "top", "gram", "xty", "xtl"])

        keys = None
        for batch in batches:
            keys = batch.schema.field(0).type
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
            codes = batch.column(0).dictionary_encode() if not pa.types.is_dictionary(keys) else batch.column(0)
            at = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            for code in np.unique(at):
                rows = np.flatnonzero(at == code)
                value = codes.dictionary[int(code)].as_py() if code >= 0 else None
                if value not in held and len(held) >= HELD:
                    yield flush()
                sums = held.setdefault(value, _Sums(x.shape[1]))
                for a in range(0, len(rows), CHUNK):
                    sums.add(x[rows[a:a + CHUNK]], y[rows[a:a + CHUNK]])
        if held:
            yield flush()

    rows = design.filter((F.col("split") == "train") & F.col("y").isNotNull()).select(by, "x", F.col("y").cast("double").alias("y"))
    return rows.mapInArrow(task, f"`{by}` {key}, {SUMS}")


def _merged(pdf: pd.DataFrame) -> tuple:
    """Sum of the records of one key (the largest of ``top``)."""
    return (int(pdf["n"].sum()), int(pdf["n_positive"].sum()), float(pdf["top"].max()),
            *(np.sum(np.stack(pdf[c].to_numpy()), axis=0) for c in ("gram", "xty", "xtl")))


def normal_sums(design: DataFrame, by: str = "series_id") -> DataFrame:
    """``by, n, n_positive, top, gram, xty, xtl`` over the train rows with a target, one row per key.

    ``gram`` is the upper triangle of ``X'X`` row by row.  A key's records are
    merged in ``LOTS`` lots first, so no task gets more than a lot of them.
    """
    ship_package(design.sparkSession)
    schema = f"{key_type(design, by)}, {SUMS}"
    names = [by, "n", "n_positive", "top", "gram", "xty", "xtl"]

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        n, n_positive, top, gram, xty, xtl = _merged(pdf)
        return pd.DataFrame({by: [pdf[by].iloc[0]], "n": [n], "n_positive": [n_positive], "top": [top], "gram": [gram.tolist()],
                             "xty": [xty.tolist()], "xtl": [xtl.tolist()]}, columns=names)

    parts = _partial(design, by).withColumn("_lot", F.pmod(F.spark_partition_id(), F.lit(LOTS)))
    lots = parts.groupBy(by, "_lot").applyInPandas(lambda pdf: merge(pdf), schema)
    return lots.groupBy(by).applyInPandas(merge, schema)


def solve(sums: DataFrame, params: dict | DataFrame, penalty=penalties, by: str = "series_id", laplace=None) -> DataFrame:
    """Coefficients of every key from its sums: ``by, mode_used, out_scale, coef, status``.

    ``params`` are one set for all or a row per key; a key without a row or with
    a NULL ``score`` gets the defaults (``status`` tells).  ``penalty`` maps a
    set to the diagonal added to ``X'X``.  As in the grouped fit the target is
    scaled by its largest absolute value, or its logarithm is fitted
    (``multiplicative``, if every target is positive).  ``laplace`` maps a set to
    the weights of ``|b|`` (``ridge.solve_laplace``); where it is 0 the ridge holds.
    """
    ship_package(sums.sparkSession)
    names = list(DEFAULT_PARAMS)
    if isinstance(params, dict):
        chosen = sums.withColumns({"status": F.lit("tuned"), **{c: F.lit(params[c]) for c in names}})
    else:
        known = F.col("score").isNotNull()
        chosen = sums.join(params.select(by, "score", *names), by, "left").withColumns(
            {"status": F.when(known, "tuned").otherwise("default"),
             **{c: F.when(known, F.col(c)).otherwise(F.lit(DEFAULT_PARAMS[c])) for c in names}})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                p = len(r["xty"])
                gram = np.zeros((p, p))
                gram[np.triu_indices(p)] = r["gram"]
                gram = gram + np.triu(gram, 1).T
                chosen_set = {c: r[c] for c in names}
                pen = np.asarray(penalty(chosen_set), dtype="float64")
                scale = r["top"] if r["top"] > 0 else 1.0
                wanted = r["seasonality_mode"] == "multiplicative"
                log = wanted and r["n_positive"] == r["n"]
                side = np.asarray(r["xtl"]) if log else np.asarray(r["xty"]) / scale
                mode = "multiplicative" if log else "fallback_additive" if wanted else "additive"
                coef = (np.linalg.solve(gram + np.diag(pen), side) if laplace is None
                        else solve_laplace(gram, side, pen, np.asarray(laplace(chosen_set), dtype="float64")))
                out.append((r[by], mode, 1.0 if log else scale, coef.tolist(), r["status"]))
            yield pd.DataFrame(out, columns=[by, "mode_used", "out_scale", "coef", "status"])

    return chosen.mapInPandas(run, f"{key_type(sums, by)}, mode_used string, out_scale double, coef array<double>, status string")


def fit_pooled(design: DataFrame, params: dict | DataFrame, by: str = "series_id", prior: str = "gaussian") -> DataFrame:
    """The coefficient table of ``ridge.fit``, by distributed sums: keys may have any number of rows."""
    return solve(normal_sums(design, by), params, by=by, laplace=laplace_weights if prior == "laplace" else None)
