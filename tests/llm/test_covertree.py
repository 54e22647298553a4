"""Cover trees: tree invariants, the dual traversal and the whole operator against brute force."""

import numpy as np
import pytest

from daycast.llm import covertree
from daycast.llm.covertree import CoverTree, Nets, distances, links, near_duplicates, unit

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, n_links string"


def clustered(rng, n, d=16, spread=(0.05, 0.15, 0.22, 0.3)):
    """Places of about twenty points, some tight, some about as wide as the threshold."""
    at = rng.standard_normal((max(2, n // 20), d))
    at /= np.linalg.norm(at, axis=1, keepdims=True)
    return at[rng.integers(len(at), size=n)] + rng.standard_normal((n, d)) * rng.choice(spread, (n, 1)) / np.sqrt(d)


def components_of(adj):
    label = np.arange(len(adj))
    while True:
        low = np.minimum(np.where(adj, label[None], len(adj)).min(1, initial=len(adj)), label)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def brute(rows, threshold=0.95):
    """Contract row by row: all pairs of usable rows by the numbers themselves."""
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    lengths = [len(v) for i, v in rows if i is not None and usable(v)]
    length = max(sorted(set(lengths)), key=lengths.count) if lengths else 0
    take = [k for k, (i, v) in enumerate(rows) if i is not None and usable(v) and len(v) == length]
    m = np.array([rows[k][1] for k in take], np.float64).reshape(len(take), -1)
    raw, m = m, covertree.scaled(m) if len(m) else m  # by powers of two, exactly
    cos = np.array([[x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) for y in m] for x in m]).reshape(len(m), len(m))
    ids = [rows[k][0] for k in take]
    adj = (cos >= threshold) | np.array([[(x == y).all() for y in raw] for x in raw], bool).reshape(len(m), len(m))
    np.fill_diagonal(adj, False)
    label = components_of(adj)
    least = {c: min(i for i, b in zip(ids, label) if b == c) for c in set(label.tolist())}
    out = [(i, 0, i, True) for k, (i, v) in enumerate(rows) if k not in set(take)]
    return sorted(out + [(i, int(a.sum()), least[c], i == least[c]) for i, a, c in zip(ids, adj, label)], key=str)


def got(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_tree_invariants():
    x = unit(clustered(np.random.default_rng(1), 3000))
    t = CoverTree(x, 8)
    assert sorted(t.order.tolist()) == list(range(3000)) and (t.x == x[t.order]).all()
    assert len(t.centre) > 20 and set(t.net) <= {2.0 / 2 ** k for k in range(9)}
    for i, kids in enumerate(t.children):
        assert distances(t.centres[i:i + 1], t.x[t.lo[i]:t.hi[i]]).max() <= t.radius[i] + 1e-12
        assert t.radius[i] <= t.net[i] + 1e-7
        if kids:  # children part the node's points; nets halve, and the node's centre is in the next net
            assert [t.lo[k] for k in kids] + [t.hi[i]] == [t.lo[i]] + [t.hi[k] for k in kids]
            assert {t.net[k] for k in kids} <= {t.net[i], t.net[i] / 2}
    cell, far = Nets(t).place(x)
    assert np.allclose(far, np.linalg.norm(x - t.centres[cell], axis=1), atol=1e-7)
    assert (far <= np.array(t.net)[cell] + 1e-7).all()


@pytest.mark.parametrize("least", [2, 16])
def test_traversal_equals_all_pairs(least):
    rng = np.random.default_rng(2)
    def block(raw):
        t = CoverTree(unit(raw), least)
        return {"tree": t, "raw": raw[t.order], "weight": rng.integers(1, 4, len(raw))[t.order]}
    one, two = clustered(rng, 700), clustered(rng, 500)
    two[:200] = one[:200] + rng.standard_normal((200, 16)) * 0.02
    one[300:500] = one[300] + rng.standard_normal((200, 16)) * 0.01  # linked as a whole
    a, b = block(one), block(two)
    for x, y in ((a, b), (a, None)):
        u, v = x["tree"].x, (y or x)["tree"].x
        hit = u @ v.T >= 0.95
        gain_a, gain_b, label = links(x, y, 0.95)
        assert (gain_a == hit @ (y or x)["weight"] - (0 if y else x["weight"])).all() and gain_a.any()
        assert y is None or (gain_b == x["weight"] @ hit).all()
        n = len(u) + (len(v) if y else 0)
        adj = np.zeros((n, n), bool)
        adj[:len(u), n - len(v):] = hit
        assert (components_of(adj | adj.T) == label).all()


def test_whole_covers_are_not_searched(monkeypatch):
    """A tight place of 4,000 points is linked without measuring its pairs."""
    rng = np.random.default_rng(3)
    raw = rng.standard_normal(32) + rng.standard_normal((4000, 32)) * 0.005
    t = CoverTree(unit(raw), 32)
    seen = []
    real = np.argwhere
    monkeypatch.setattr(covertree.np, "argwhere", lambda m: seen.append(m.size) or real(m))
    gain, _, label = links({"tree": t, "raw": raw[t.order], "weight": np.ones(4000, int)}, None, 0.95)
    assert not seen and (gain == 3999).all() and not label.any()


def test_query_on_the_given_table(spark):
    src = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(covertree.op13_neardups(spark, SF)) == brute(src)


def test_operator_over_many_cells_and_blocks(spark, monkeypatch):
    """Small samples and blocks: cells linked as a whole, split cells, hot copies, all against brute force."""
    monkeypatch.setattr(covertree, "SAMPLE", 150)
    monkeypatch.setattr(covertree, "BLOCK", 40)
    monkeypatch.setattr(covertree, "LEAST", 3)
    rng = np.random.default_rng(4)
    m = clustered(rng, 500)
    m[:170] = m[0]  # a third are copies
    m[170:300] = m[170] + rng.standard_normal((130, 16)) * 0.004  # near copies around one place
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(500) - 100, m)]
    out = got(near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(7)))
    assert out == brute(rows) and len({r[2] for r in out}) > 30


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]), (None, None), (10, [1e300, 1e-300]),
            (11, [2.0, 0.01]), (-4, [0.0, 5.0]), (12, [-1.0, 0.0]), (13, [-0.0, -3.0]), (14, [-1.0, -0.0])]
    want = [r for r in brute([r for r in rows if r[0] is not None])] + [(None, 0, None, True)] * 2
    assert got(near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))) == sorted(want, key=str)
    for few in ([], [(1, None)], [(None, [1.0])], [(3, [2.0])]):
        df = spark.createDataFrame([(*r, "x") for r in few], SCHEMA)
        assert got(near_duplicates(df)) == [(i, 0, i, True) for i, _ in few]


def test_threshold_is_inclusive_at_the_edge(spark):
    """Pairs within rounding of the threshold are judged by the given numbers."""
    c = 0.95
    rows = [(1, [1.0, 0.0]), (2, [c, float(np.sqrt(1 - c * c))]), (3, [c, -float(np.sqrt(1 - (c - 1e-9) ** 2))])]
    assert got(near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))) == brute(rows)
