"""Embedding near-duplicates by a dual traversal of cover trees.

On unit vectors a cosine of ``t`` is a distance of ``sqrt(2 - 2 t)``.  A cover
tree holds nested nets whose radii halve from level to level; every node knows
its covering radius, the distance to its farthest descendant.  Two nodes whose
covers lie farther apart than the distance are dropped with all their pairs, two
whose covers lie within it are linked as a whole, without listing pairs, and only
what is left at the leaves is measured.

A tree over a bounded sample deals all vectors into cells; the cells' pairs are
traversed first, then the pairs of blocks (with a tree each) that stay open.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm.graph import components
from daycast.session import drop_stage, ship_package, stage

THRESHOLD = 0.95
#: Distinct vectors (about) that the tree of the cells is grown on; every vector is dealt and compared.
SAMPLE = 8_192
#: Distinct vectors (about) of a block.
BLOCK = 8_192
#: Points a node of the cells' tree and of a block's tree holds at least; others stay with the parent.
CELL_LEAST, LEAST = 4, 32
#: Centres in a row that cover too few points before the rest of a node is left loose (searched as it is).
LOOSE = 32
#: Levels below the root (radius 2): the last radius is 2 / 2**7.
LEVELS = 7
#: Rows of a product of unit vectors at a time; room for rounding of distances.
CHUNK, MARGIN = 2_048, 1e-6
#: A class of copies with this share of all rows, or more, is sent to all tasks (fewer than 1 / HOT classes).
HOT = 1e-3


def scaled(m: np.ndarray) -> np.ndarray:
    """Rows in double precision, brought near one by a power of two (exactly), so that no square overflows."""
    m = np.asarray(m, np.float64)
    return np.ldexp(m, -np.frexp(np.abs(m).max(-1, keepdims=True))[1])


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of length one."""
    m = scaled(m)
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


class CoverTree:
    """Nested nets over unit vectors; a node's points are ``order[lo:hi]``, its own loose ones a leaf of their own."""

    def __init__(self, x: np.ndarray, least: int) -> None:
        self.least = least
        self.centre: list[int] = []
        self.net: list[float] = []
        self.children: list[list[int]] = []
        self.lo: list[int] = []
        self.hi: list[int] = []
        order: list[np.ndarray] = []
        rng = np.random.default_rng(11)
        first = int(np.argmax(x @ x.mean(0)))
        self._grow(x, first, rng.permutation(len(x)), 0, order, 0)
        self.order = np.concatenate(order)
        self.x = x[self.order]
        self.centres = x[self.centre]
        self.radius = np.array([distances(self.centres[i:i + 1], self.x[a:b]).max() for i, (a, b) in enumerate(zip(self.lo, self.hi))])
        self.first = np.concatenate([[0], np.cumsum([len(c) for c in self.children])])
        self.below = np.array([c for cs in self.children for c in cs], int)
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _node(self, centre: int, net: float, lo: int, hi: int) -> int:
        self.centre.append(centre)
        self.net.append(net)
        self.children.append([])
        self.lo.append(lo)
        self.hi.append(hi)
        return len(self.centre) - 1

    def _grow(self, x: np.ndarray, centre: int, members: np.ndarray, level: int, order: list, at: int) -> int:
        me = self._node(centre, 2.0 / 2 ** level, at, at + len(members))
        if level == LEVELS or len(members) <= 2 * self.least:
            order.append(members)
            return me
        rho, rest, parts, loose, next_centre, poor = 1.0 / 2 ** level, members, [], [], centre, 0
        while len(rest) and poor < LOOSE:
            near = distances(x[rest], x[next_centre:next_centre + 1])[:, 0] <= rho
            covered = rest[near]
            if len(covered) >= self.least:
                parts.append((next_centre, covered))
                poor = 0
            else:
                loose.append(covered)
                poor += 1
            rest = rest[~near]
            next_centre = int(rest[0]) if len(rest) else -1
        loose.append(rest)
        own = np.concatenate(loose)
        if not parts:
            order.append(own)
            return me
        if len(own):
            self.children[me].append(self._node(centre, 2.0 / 2 ** level, at, at + len(own)))
            order.append(own)
            at += len(own)
        for c, covered in parts:
            self.children[me].append(self._grow(x, c, covered, level + 1, order, at))
            at += len(covered)
        return me

    def leaf(self, i: np.ndarray) -> np.ndarray:
        return self.first[i + 1] == self.first[i]

    def expand(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of the nodes ``i``, and which of ``i`` each belongs to."""
        count = self.first[i + 1] - self.first[i]
        which = np.repeat(np.arange(len(i)), count)
        step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        return self.below[self.first[i[which]] + step], which


class Nets:
    """The nets of a sample's tree: every vector goes down as long as a child's net covers it."""

    def __init__(self, tree: CoverTree) -> None:
        self.centres, self.net = tree.centres, np.array(tree.net)
        # a leaf of loose points is no net of its own: what no child covers stays with the node
        self.children = [np.array([c for c in cs if tree.net[c] < tree.net[i]], int) for i, cs in enumerate(tree.children)]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of every row, and its distance to the cell's centre."""
        cell = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            cell[rows] = node
            cs = self.children[node]
            if not len(cs) or not len(rows):
                continue
            d = distances(x[rows], self.centres[cs])
            best = d.argmin(1)
            ok = d[np.arange(len(rows)), best] <= self.net[cs[best]]
            for k in np.unique(best[ok]):
                todo.append((int(cs[k]), rows[ok & (best == k)]))
        return cell, np.sqrt(np.maximum(2 - 2 * (x * self.centres[cell]).sum(1), 0))


def _merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Joins the classes of ``u`` and ``v``; labels are the smallest index of a class."""
    while True:
        a, b = label[u], label[v]
        differ = a != b
        if not differ.any():
            return
        u, v, a, b = u[differ], v[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def links(a: dict, b: dict | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dual traversal of two blocks (or of one with itself, ``b`` None).

    Returns the weight that each point of ``a`` and of ``b`` is linked with, and
    for all points, those of ``a`` first, the smallest index they are connected to.
    """
    s, t = a["tree"], (b or a)["tree"]
    wa, wb = a["weight"], (b or a)["weight"]
    shift = len(wa) if b else 0
    sums_a, sums_b = np.concatenate([[0], np.cumsum(wa)]), np.concatenate([[0], np.cumsum(wb)])
    got_a, got_b = np.zeros(len(wa) + 1, np.int64), np.zeros(len(wb) + 1, np.int64)  # of whole slices, as differences
    one_a, one_b = np.zeros(len(wa), np.int64), np.zeros(len(wb), np.int64)
    label = np.arange(len(wa) + (len(wb) if b else 0))
    joined: set[tuple[int, int]] = set()
    reach = float(np.sqrt(2 - 2 * threshold))
    d = distances(s.centres, t.centres)
    i, j = np.zeros(1, int), np.zeros(1, int)
    exact: list[tuple[np.ndarray, np.ndarray]] = []
    while len(i):
        between, cover = d[i, j], s.radius[i] + t.radius[j]
        far, within = between - cover > reach + MARGIN, between + cover <= reach - MARGIN
        for p, q in zip(i[within].tolist(), j[within].tolist()):
            got_a[s.lo[p]] += sums_b[t.hi[q]] - sums_b[t.lo[q]]
            got_a[s.hi[p]] -= sums_b[t.hi[q]] - sums_b[t.lo[q]]
            got_b[t.lo[q]] += sums_a[s.hi[p]] - sums_a[s.lo[p]]
            got_b[t.hi[q]] -= sums_a[s.hi[p]] - sums_a[s.lo[p]]
            spans = [(s.lo[p], s.hi[p]), (t.lo[q] + shift, t.hi[q] + shift)]
            for span in spans:
                if span not in joined:
                    joined.add(span)
                    rest = np.arange(span[0] + 1, span[1])
                    _merge(label, np.full(len(rest), span[0]), rest)
            _merge(label, np.array([spans[0][0]]), np.array([spans[1][0]]))
        open_ = ~far & ~within
        i, j = i[open_], j[open_]
        ends = s.leaf(i) & t.leaf(j)
        exact.append((i[ends], j[ends]))
        i, j = i[~ends], j[~ends]
        left = ~s.leaf(i) & (t.leaf(j) | (s.radius[i] >= t.radius[j]))
        down_a, of_a = s.expand(i[left])
        down_b, of_b = t.expand(j[~left])
        i, j = np.concatenate([down_a, i[~left][of_b]]), np.concatenate([j[left][of_a], down_b])
    for p, q in zip(np.concatenate([e[0] for e in exact]).tolist(), np.concatenate([e[1] for e in exact]).tolist()):
        for x0 in range(s.lo[p], s.hi[p], CHUNK):
            x1 = min(x0 + CHUNK, s.hi[p])
            for y0 in range(t.lo[q], t.hi[q], CHUNK):
                y1 = min(y0 + CHUNK, t.hi[q])
                cos = s.x[x0:x1] @ t.x[y0:y1].T
                hit = cos >= threshold
                for u, v in np.argwhere(np.abs(cos - threshold) < 1e-12):  # at the edge: by the given numbers themselves
                    m, o = scaled(a["raw"][x0 + u]), scaled((b or a)["raw"][y0 + v])
                    hit[u, v] = m @ o / (np.sqrt(m @ m) * np.sqrt(o @ o)) >= threshold
                u, v = np.nonzero(hit)
                if len(u):
                    one_a[x0:x1] += hit @ wb[y0:y1]
                    one_b[y0:y1] += wa[x0:x1] @ hit
                    _merge(label, u + x0, v + y0 + shift)
    got_a, got_b = one_a + np.cumsum(got_a)[:-1], one_b + np.cumsum(got_b)[:-1]
    return (got_a if b else got_a - wa), got_b, label


def _finite(vec: str) -> Column:
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _open_cells(cells: list, nets: Nets, threshold: float) -> tuple[list, list, np.ndarray]:
    """Pairs of cells to be searched, pairs linked as a whole, and the weight each cell gains from the latter."""
    ids = np.array([c["cell"] for c in cells])
    radius, weight = np.array([c["far"] for c in cells]), np.array([c["weight"] for c in cells])
    reach = float(np.sqrt(2 - 2 * threshold))
    todo, whole, gain = [], [], np.zeros(len(cells), np.int64)
    for k in range(len(cells)):  # a row of the cells' pairs at a time; there are at most SAMPLE / CELL_LEAST cells or so
        d = distances(nets.centres[ids[k]][None], nets.centres[ids])[0]
        cover = radius + radius[k]
        within = d + cover <= reach - MARGIN
        gain[k] = weight[within].sum()
        near = (d - cover <= reach + MARGIN) & (np.arange(len(cells)) >= k)
        whole += [(k, int(m)) for m in np.flatnonzero(within & near)]
        todo += [(k, int(m)) for m in np.flatnonzero(near & ~within)]
    return todo, whole, gain


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``: a row per row of ``vectors``.

    Two vectors are linked at a cosine (double precision, original numbers) of
    ``threshold`` or more, copies included: ``n_links`` counts rows.  The
    component's id is its smallest id, and ``kept`` says that it is the row's own.
    Equal vectors are one class with a weight, collapsed before anything is
    shuffled; pairs are never listed, links inside a task shrink to one edge per
    point.

    Vectors that are NULL, empty, zero, hold NULL or non-finite numbers or are
    not of the commonest length link with nothing and are their own component.
    Rows without an id take no part and are kept (component NULL).  Rows that
    repeat an id and a vector are copies of one another and all kept; one id
    with two vectors is two points with the same id.  Other columns are
    ignored; an empty table stays empty.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec).alias("embedding"))
    good = rows.filter(F.col("vec_id").isNotNull() & _finite("embedding"))
    length = good.agg(F.mode(F.size("embedding"), deterministic=True)).first()[0]  # a number, the same for all that follows
    part = F.col("vec_id").isNotNull() & _finite("embedding") & (F.size("embedding") == F.lit(length or 0))
    rows = rows.withColumn("_part", F.coalesce(part, F.lit(False)))
    good = rows.filter("_part")
    classes = stage(good.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
                    .withColumn("mid", F.monotonically_increasing_id()), "vector_classes")
    n, total = classes.agg(F.count(F.lit(1)), F.sum("weight")).first()
    alone = rows.filter(~F.col("_part")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                                                F.lit(True).alias("kept"))
    if not n:
        return alone
    share = min(1.0, SAMPLE / n)
    picked = classes.filter(F.pmod(F.xxhash64("embedding"), F.lit(1 << 30)) < int(share * (1 << 30))).select("embedding").toArrow()
    if not picked.num_rows:  # a handful of classes, none of them below the mark
        picked = classes.select("embedding").limit(1).toArrow()
    nets = Nets(CoverTree(unit(_matrix(picked.column(0).combine_chunks())), CELL_LEAST))
    nets_b = spark.sparkContext.broadcast(nets)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, far = nets_b.value.place(unit(_matrix(batch.column("embedding"))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=["mid", "id", "weight", "embedding", "cell", "far"])

    element = classes.schema["embedding"].dataType.simpleString()
    placed = stage(classes.select("mid", "id", "weight", "embedding").mapInArrow(
        deal, f"mid long, id long, weight long, embedding {element}, cell int, far double"), "vector_cells")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight"), F.max("far").alias("far"),
                                       F.min(F.struct("id", "mid")).alias("rep")).orderBy("cell").collect()
    todo, whole, gain = _open_cells(cells, nets, threshold)
    blocks = [-(-c["n"] // BLOCK) for c in cells]
    cell_table = spark.createDataFrame([(c["cell"], k, blocks[k], int(gain[k]), c["rep"]["id"], c["rep"]["mid"]) for k, c in enumerate(cells)],
                                       "cell int, k int, blocks int, gain long, rep_id long, rep_mid long")
    dealt = placed.join(F.broadcast(cell_table), "cell").withColumn("i", F.pmod(F.xxhash64("mid"), F.col("blocks")).cast("int"))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        raw = np.array(rows["embedding"].tolist())
        tree = CoverTree(unit(raw), LEAST)
        o = tree.order
        block = {"tree": tree, "raw": raw[o], "weight": rows["weight"].to_numpy(np.int64)[o], "mid": rows["mid"].to_numpy(np.int64)[o],
                 "id": rows["id"].to_numpy(np.int64)[o]}
        return pd.DataFrame({"k": [rows["k"].iloc[0]], "i": [rows["i"].iloc[0]], "block": [pickle.dumps(block, 5)]})

    grown = stage(dealt.select("k", "i", "mid", "id", "weight", "embedding").groupBy("k", "i").applyInPandas(grow, "k int, i int, block binary"),
                  "vector_blocks")
    partners: dict[int, list[int]] = {}
    for k, m in todo:
        partners.setdefault(k, []).append(m)
    pairs = spark.createDataFrame([(k, blocks[k], [(m, blocks[m]) for m in ms]) for k, ms in partners.items()],
                                  "k int, nk int, ms array<struct<m int, nm int>>")
    pairs = (pairs.select("k", "nk", F.explode("ms").alias("p")).select("k", "nk", "p.m", "p.nm")
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("nk") - 1)))
             .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nm") - 1)))
             .filter("k < m or i <= j").select("k", "i", "m", "j"))
    left = pairs.join(grown, ["k", "i"]).select("k", "i", "m", "j", "block").toDF("ak", "ai", "bk", "bi", "block")
    right = (pairs.join(grown.toDF("m", "j", "block"), ["m", "j"]).select("k", "i", "m", "j", "block")
             .toDF("ak2", "ai2", "bk2", "bi2", "block2"))

    def search(key, xs: pd.DataFrame, ys: pd.DataFrame) -> pd.DataFrame:
        a = pickle.loads(xs["block"].iloc[0])
        b = None if key[:2] == key[2:] else pickle.loads(ys["block2"].iloc[0])
        got_a, got_b, label = links(a, b, threshold)
        got = np.concatenate([got_a, got_b]) if b else got_a
        mid, ids = (np.concatenate([a[c], b[c]]) if b else a[c] for c in ("mid", "id"))
        linked = got > 0
        return pd.DataFrame({"mid": mid[linked], "id": ids[linked], "rep_mid": mid[label[linked]], "rep_id": ids[label[linked]], "links": got[linked]})

    found = stage(left.groupBy("ak", "ai", "bk", "bi").cogroup(right.groupBy("ak2", "ai2", "bk2", "bi2")).applyInPandas(
        search, "mid long, id long, rep_mid long, rep_id long, links long"), "vector_links")

    def node(i: str, mid: str) -> Column:  # ordered by id, apart for every class
        return F.col(i).cast("decimal(19,0)") * F.lit(1 << 60).cast("decimal(19,0)") + F.col(mid).cast("decimal(19,0)")

    wholes = spark.createDataFrame(whole, "k int, m int")
    own = wholes.filter("k = m").select("k", F.lit(True).alias("own"))
    # a point is in its own cell's weight if the cell is linked as a whole with itself
    gained = dealt.filter("gain > 0").join(F.broadcast(own), "k", "left").select(
        "mid", "id", "rep_mid", "rep_id", (F.col("gain") - F.when(F.col("own"), F.col("weight")).otherwise(0)).alias("links"))
    reps = cell_table.select("k", "rep_id", "rep_mid")
    between = (wholes.filter("k < m").join(reps, "k").join(reps.toDF("m", "to_id", "to_mid"), "m")
               .select(node("rep_id", "rep_mid").alias("a"), node("to_id", "to_mid").alias("b")))
    edges = (found.select(node("id", "mid").alias("a"), node("rep_id", "rep_mid").alias("b"))
             .union(gained.select(node("id", "mid").alias("a"), node("rep_id", "rep_mid").alias("b"))).union(between))
    comp = components(edges)
    per_class = found.select("mid", "links").union(gained.select("mid", "links")).groupBy("mid").agg(F.sum("links").alias("links"))
    ids = F.floor(F.col("component") / F.lit(1 << 60).cast("decimal(19,0)")).cast("long")
    done = stage(
        classes.withColumn("node", node("id", "mid")).join(per_class, "mid", "left").join(comp, "node", "left")
        .select("embedding", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce(ids, "id").alias("component_id"), (F.col("weight") >= F.lit(max(2, int(total * HOT)))).alias("hot")), "vector_groups")
    for old in (classes, placed, grown, found, comp):
        drop_stage(old)
    hot, rest = done.filter("hot").drop("hot"), done.filter("not hot").drop("hot")
    mine = rows.filter("_part").select("vec_id", "embedding")
    out = mine.join(F.broadcast(hot), "embedding").union(
        mine.join(F.broadcast(hot.select("embedding")), "embedding", "left_anti").join(rest, "embedding"))
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")).union(alone)


def op13_neardups(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
