"""Whitening: the solver against LAPACK, the operator against a plain eigendecomposition, edge rows."""

import numpy as np
import pytest

from daycast.llm import whitening
from daycast.llm.bidiagonal import bidiagonalise, directions, dqds, turn_back

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, whitened string"


def triangles():
    rng = np.random.default_rng(0)
    yield np.linalg.qr(rng.standard_normal((900, 48)), mode="r")
    yield np.triu(rng.standard_normal((20, 20))) * 10.0 ** -np.arange(20)
    x = rng.standard_normal((300, 12))
    x[:, 3], x[:, 5] = 0, x[:, 4]
    yield np.linalg.qr(x, mode="r")
    yield np.linalg.qr(rng.standard_normal((3, 9)), mode="r")
    yield np.eye(6)
    yield np.zeros((4, 4))
    yield np.array([[3.0]])
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    yield np.diag(np.r_[np.full(4, 10.0), np.full(3, 10 * (1 + 1e-14)), 1 + 1e-9 * np.arange(23)]) @ q


@pytest.mark.parametrize("r", list(triangles()), ids=lambda r: "x".join(map(str, r.shape)))
def test_directions(r):
    values, kept, axes = directions(r, 8)
    want = np.zeros(r.shape[1])
    got = np.linalg.svd(r, compute_uv=False) ** 2
    want[:len(got)] = got
    top = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * top
    assert np.abs(axes.T @ axes - np.eye(len(kept))).max(initial=0) < 1e-9
    assert np.abs(r.T @ (r @ axes) - axes * kept).max(initial=0) <= 1e-12 * top
    assert len(kept) == min(8, int((want > 1e-26 * top).sum()) if want[0] else 0)


def test_small_singular_values_keep_their_digits():
    """A graded bidiagonal: dqds finds the smallest value to full relative accuracy."""
    a, b = 10.0 ** -np.arange(0, 40, 4), 10.0 ** -np.arange(0, 36, 4) * 0.5
    values = dqds(a, b)
    assert np.prod(values[:5]) > 0 and np.isclose(np.sum(np.log(values)), 2 * np.sum(np.log(a)), rtol=1e-13)


def test_bidiagonal_has_the_same_gram_matrix():
    r = np.triu(np.random.default_rng(3).standard_normal((9, 9)))
    a, b, right = bidiagonalise(r)
    t = np.diag(a) + np.diag(b, 1)
    v = turn_back(np.eye(9), right)
    assert np.allclose(v @ (t.T @ t) @ v.T, r.T @ r, atol=1e-12)


def plain(ids, m, k=8):
    """Contract by a covariance matrix and ``eigh``; deviations in whole numbers."""
    x = np.floor(np.asarray(m, np.float64) * 1024).astype(np.int64) + 100_000
    n, s = len(x), [int(v) for v in x.sum(0)]
    c = x - np.array([v / n for v in s])
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1], q[:, ::-1]
    dev = [sum((n * int(v) - t) ** 2 for v, t in zip(row, s)) for row in x]
    return e, (c @ q[:, :k]) / np.sqrt(e[:k]), dev


def check(rows, ids, m, k=8):
    e, w, dev = plain(ids, m, k)
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(got) == len(ids) * min(k, m.shape[1])
    for c in range(min(k, m.shape[1])):
        col = np.array([got[i, c + 1]["whitened"] for i in ids])
        sign = 1 if col @ w[:, c] > 0 else -1
        assert np.abs(sign * col - w[:, c]).max() < 1e-6, c
        assert {r["explained"] for r in rows if r["component"] == c + 1} == {got[ids[0], c + 1]["explained"]}
        assert abs(got[ids[0], c + 1]["explained"] / (e[c] / e.sum()) - 1) < 1e-9
    assert [int(got[i, 1]["deviation"]) for i in ids] == dev
    assert {r["n"] for r in rows} == {len(ids)}
    error = {r["identity_error"] for r in rows}
    assert len(error) == 1 and error.pop() < 1e-8


def test_query_against_plain_code(spark):
    src = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(whitening.op11_whitening(spark, SF).collect(), [r["vec_id"] for r in src], np.array([r["embedding"] for r in src]))


def test_blocks_and_merges_do_not_matter(spark, monkeypatch):
    """Tiny QR blocks over many tasks give the same axes."""
    monkeypatch.setattr(whitening, "BLOCK", 7)
    monkeypatch.setattr(whitening, "MERGERS", 3)
    rng = np.random.default_rng(5)
    m = rng.standard_normal((200, 10)) * np.arange(1, 11)
    df = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(m)], SCHEMA).repartition(11)
    check(whitening.whiten(df).collect(), list(range(200)), m)


def test_edges(spark):
    rng = np.random.default_rng(6)
    good = rng.standard_normal((40, 4)).tolist()
    inf, nan = float("inf"), float("nan")
    bad = [None, [], [1.0, None, 0.0, 0.0], [nan, 0.0, 0.0, 0.0], [inf, 0.0, 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0, 0.0]]
    df = spark.createDataFrame([(i, v, "a") for i, v in enumerate(good)] + [(100 + i, v, "b") for i, v in enumerate(bad)], SCHEMA)
    check(whitening.whiten(df).collect(), list(range(40)), np.array(good))
    # zero vectors are vectors; repeated rows return as often as they occur; a NULL id stays
    again = spark.createDataFrame([(7, [0.0, 0.0], "a"), (7, [0.0, 0.0], "a"), (None, [1.0, 2.0], "a"), (3, [4.0, 1.0], "a")], SCHEMA)
    out = whitening.whiten(again).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in out) == sorted(
        [(False, 7, 1)] * 2 + [(False, 7, 2)] * 2 + [(True, 0, 1), (True, 0, 2), (False, 3, 1), (False, 3, 2)])
    assert {r["n"] for r in out} == {4}


def test_directions_without_variance_are_left_out(spark):
    flat = spark.createDataFrame([(i, [float(i), 5.0, 2.0 * i], "a") for i in range(9)], SCHEMA)
    out = whitening.whiten(flat).collect()
    assert {r["component"] for r in out} == {1} and abs(out[0]["explained"] - 1) < 1e-12
    for rows in ([], [(1, [1.0, 2.0], "a")], [(1, None, "a")], [(1, [1.0], "a"), (2, [1.0], "a")]):
        got = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert got.collect() == [] and got.columns[0] == "vec_id"


def test_deviation_beyond_a_long_is_exact(spark):
    """Large entries: whole-number arithmetic in the operator."""
    rows = [(0, [4.0e12, 0.0], "a"), (1, [-4.0e12, 1.0], "a"), (2, [0.5, 3.0e9], "a")]
    out = {r["vec_id"]: r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    x = [[int(np.floor(c * 1024)) + 100_000 for c in v] for _, v, _ in rows]
    s = [sum(c) for c in zip(*x)]
    for i, row in enumerate(x):
        assert int(out[i]["deviation"]) == sum((3 * c - t) ** 2 for c, t in zip(row, s))
