"""Approximate nearest neighbours with an inverted multi-index.

Both halves of the vectors are quantised by codebooks of their own; a cell is a
pair of centroids.  A query walks the pairs in the order of summed distance (a
heap over the two sorted lists) until the visited cells hold enough distinct
vectors.  How many are enough is measured on each table: the true neighbours of
some queries are sought among all vectors, and the walk goes as far as it takes
to reach them.  Cells lie in tiles (pairs of groups of near centroids); every
vector of a visited cell's tile is measured exactly.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daycast.session import ship_package, stage

#: Vectors the codebooks are fitted on, at most (those with the smallest hash of their id).
SAMPLE = 16_384
ITERATIONS = 12
#: Distinct vectors that a query's visited cells hold at least (all of them where there are fewer).
LEAST_VISIT = 2_000
#: Queries (those with the smallest hash) whose true neighbours are sought among all vectors, and the share of these
#: neighbours that the walks must reach: this sets the number of vectors that the visited cells hold.
TRIALS, TARGET = 256, 0.98
#: Non-empty cells that a walk visits at least: one cell counts for this part of the budget at most.
LEAST_CELLS = 8
#: Cells that a walk takes from the heap; one that goes on sorts all sums.
HEAP_CELLS = 512
#: Distinct vectors (about) of a tile; vectors or queries of a tile that one task takes together.
BLOCK = 4_096
#: Queries that one task walks for.
WALKS = 128
#: Queries, and pairs of a query and a vector, that are measured at a time.
CHUNK, PAIRS = 256, 65_536


def usable(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """Rows whose vector is neither NULL nor zero, and finite throughout, in the table's usual length."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = vectors.filter(F.coalesce(finite, F.lit(False)) & F.exists(vec, lambda x: x != 0))
    length = good.agg(F.mode(F.size(vec), deterministic=True)).scalar()
    return good.filter(F.size(vec) == length)


def _codebook(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from k-means++ seeds; an empty centroid stays where it was."""
    rng = np.random.default_rng(seed)
    centres = [x[rng.integers(len(x))]]
    d = ((x - centres[0]) ** 2).sum(1)
    for _ in range(1, k):
        total = d.sum()
        at = int(np.searchsorted(np.cumsum(d), rng.random() * total)) if total > 0 else int(rng.integers(len(x)))
        centres.append(x[min(at, len(x) - 1)])
        d = np.minimum(d, ((x - centres[-1]) ** 2).sum(1))
    c = np.array(centres)
    for _ in range(ITERATIONS):
        near = _nearest(x, c)
        for i in range(k):
            if (own := x[near == i]).size:
                c[i] = own.mean(0)
    return c


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(x[a:a + 4096], c).argmin(1) for a in range(0, len(x), 4096)]) if len(x) else np.zeros(0, int)


def _matrix(col: pa.Array) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)


def _in_order(d1: np.ndarray, d2: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All cells that are not empty by increasing d1[i] + d2[j]."""
    filled = np.flatnonzero(count)
    return filled[np.argsort(d1[filled // len(d2)] + d2[filled % len(d2)], kind="stable")]


def _most(enough: int) -> int:
    """What a cell counts for in a walk at most."""
    return max(1, -(-enough // LEAST_CELLS))


def walk(d1: np.ndarray, d2: np.ndarray, count: np.ndarray, enough: int) -> list[int]:
    """Cells by increasing d1[i] + d2[j] until they hold ``enough`` vectors (empty cells are passed over).

    However many a cell holds, it counts for an equal share of ``LEAST_CELLS`` at most, so a hot cell cannot end the walk.
    """
    most = _most(enough)
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen, out, held = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}, [], 0
    k2 = len(d2)
    pops = 0
    while heap and held < enough:
        if pops == HEAP_CELLS:
            order = _in_order(d1, d2, count)
            held_by = np.cumsum(np.minimum(count[order], most))
            return order[:np.searchsorted(held_by, enough) + 1].tolist()
        pops += 1
        _, i, j = heapq.heappop(heap)
        cell = int(o1[i]) * k2 + int(o2[j])
        if count[cell]:
            out.append(cell)
            held += min(int(count[cell]), most)
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(o1) and b < k2 and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (d1[o1[a]] + d2[o2[b]], a, b))
    return out


def needed(d1: np.ndarray, d2: np.ndarray, count: np.ndarray, cells: np.ndarray) -> list[int]:
    """For each of ``cells``, the least ``enough`` with which the walk visits it (found by halving)."""
    order = _in_order(d1, d2, count)
    held = count[order]
    place = np.empty(len(count), np.int64)
    place[order] = np.arange(len(order))
    out = {}
    for cell in set(np.asarray(cells).tolist()):
        before = held[:place[cell]]
        low, high = 1, int(before.sum()) + 1
        while low < high:
            mid = (low + high) // 2
            if int(np.minimum(before, _most(mid)).sum()) < mid:
                high = mid
            else:
                low = mid + 1
        out[cell] = low
    return [out[c] for c in np.asarray(cells).tolist()]


def _groups(book: np.ndarray, weight: np.ndarray, g: int) -> np.ndarray:
    """A group for each centroid: halves of about equal weight along the widest axis, again and again, up to ``g`` groups."""
    group, parts = np.zeros(len(book), np.int64), [np.arange(len(book))]
    while len(parts) < g:
        at = max(range(len(parts)), key=lambda p: weight[parts[p]].sum() if len(parts[p]) > 1 else -1)
        own = parts[at]
        if len(own) < 2:
            break
        w = weight[own] + 1e-9
        spread = (w[:, None] * (book[own] - np.average(book[own], axis=0, weights=w)) ** 2).sum(0)
        own = own[np.argsort(book[own, int(spread.argmax())] if book.shape[1] else own, kind="stable")]
        w = np.cumsum(weight[own] + 1e-9)
        cut = min(max(int(np.searchsorted(w, w[-1] / 2)), 1), len(own) - 1)
        parts[at:at + 1] = [own[:cut], own[cut:]]
    for i, own in enumerate(parts):
        group[own] = i
    return group


def closest(m: np.ndarray, ids: np.ndarray, e: np.ndarray, q: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector (rows of ``e`` and ``m``) and distance of the ``top`` nearest of every query; ``ids`` must rise.

    A matrix product with bounds of its rounding drops what cannot be among them; the rest is measured by differences.
    """
    centre = m.mean(0)
    a = m - centre
    a2 = (a * a).sum(1)
    room = 8 * (m.shape[1] + 8) * np.finfo(float).eps
    found = []
    for at in range(0, len(e), CHUNK):
        b = e[at:at + CHUNK] - centre
        b2 = (b * b).sum(1)
        if len(m) > top + 1:
            bound = (-2 * b) @ a.T
            bound += (1 + room) * a2
            bound += (1 + room) * b2[:, None]  # from above
            last = np.partition(bound, top, axis=1)[:, top]  # one more than ``top``: the query's own row may be there
            bound -= 2 * room * a2
            bound -= 2 * room * b2[:, None]  # from below
            rows, cols = np.nonzero(~(bound > last[:, None]))
        else:
            rows, cols = np.divmod(np.arange(len(b) * len(m)), len(m))
        rows += at
        d = np.concatenate([np.sqrt(((m[cols[p:p + PAIRS]] - e[rows[p:p + PAIRS]]) ** 2).sum(1)) for p in range(0, len(rows), PAIRS)])
        own = np.flatnonzero((ids[cols] == q[rows]) & (d == 0))
        d[own[np.unique(rows[own], return_index=True)[1]]] = np.inf  # the query's own row, not its copies
        order = np.lexsort((cols, d, rows))
        order = order[np.isfinite(d[order])]
        first = np.searchsorted(rows[order], rows[order])
        order = order[np.arange(len(order)) - first < top]
        found.append((rows[order], cols[order], d[order]))
    return tuple(np.concatenate(f) for f in zip(*found))


def search(vectors: DataFrame, is_query, top: int = 10, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``top`` nearest vectors of every query, by Euclidean distance.

    ``is_query`` is a condition on ``vectors``; a query's own row is no answer,
    other rows with its id are.  Distances are exact (double precision) on the
    original vectors, ties go to the smaller id.  Vectors that are NULL, zero,
    of another length, or hold NULL or non-finite numbers take no part, nor do
    rows without an id; other columns are ignored; no usable row, no result.

    The index holds every vector; only the codebooks are fitted on a bounded
    sample.  Walks are as long as a bounded number of queries need to reach
    ``TARGET`` of their true neighbours.  Tiles and the queries that visit them
    are dealt in blocks, so a tile that holds a third of all vectors is shared by
    many tasks.  Rows that repeat an id and a vector are queries of their own
    with the same list each.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    good = usable(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec).alias("embedding"),
                                 is_query.alias("is_query")).filter(F.col("vec_id").isNotNull()), "embedding")
    total, n_queries = good.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    sample = good.orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLE).select("embedding").toArrow()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    x = _matrix(sample.column(0))
    k = max(1, min(int(math.sqrt(total) / 4) + 4, 1024, len(x)))
    half = max(1, x.shape[1] // 2)
    centre = x.mean(0)
    x = x - centre
    books = (_codebook(x[:, :half].copy(), k, 1), _codebook(x[:, half:].copy(), k, 2) if x.shape[1] > half else np.zeros((1, 0)))
    k2 = len(books[1])
    books_b = spark.sparkContext.broadcast((centre, *books))
    element = good.schema["embedding"].dataType.simpleString()

    def place(tiles=None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mean, b1, b2 = books_b.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                m = _matrix(batch.column("embedding")) - mean
                cell = _nearest(m[:, :half], b1) * k2 + (_nearest(m[:, half:], b2) if k2 > 1 else 0)
                to = cell if tiles is None else tiles.value[cell]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("embedding"), pa.array(to.astype(np.int32))],
                                                 names=["vec_id", "embedding", "at"])
        return run

    def from_codebooks(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean, b1, b2 = books_b.value
        m = m - mean
        return _squares(m[:, :half], b1), _squares(m[:, half:], b2) if k2 > 1 else np.zeros((len(m), 1))

    placed = good.select("vec_id", "embedding").mapInArrow(place(), f"vec_id long, embedding {element}, at int")
    count, rows = np.zeros(k * k2, np.int64), np.zeros(k * k2, np.int64)
    distinct = placed.groupBy("at", F.xxhash64("embedding").alias("h")).agg(F.count(F.lit(1)).alias("copies"))
    for r in distinct.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.sum("copies").alias("rows")).collect():  # at most 1024 * 1024 cells
        count[r["at"]], rows[r["at"]] = r["n"], r["rows"]
    n = int(count.sum())
    count_b = spark.sparkContext.broadcast(count)

    tiles = -(-n // BLOCK)
    g = math.ceil(math.sqrt(tiles)) if k2 > 1 else tiles
    per_cell = count.reshape(k, k2)
    one, two = _groups(books[0], per_cell.sum(1), g), _groups(books[1], per_cell.sum(0), g)
    tile = (one[:, None] * (two.max() + 1) + two).ravel()
    tile_b = spark.sparkContext.broadcast(tile)
    sizes = spark.createDataFrame([(t, -(-int(r) // BLOCK)) for t, r in enumerate(np.bincount(tile, rows)) if r], "tile int, v_blocks int")

    def trials() -> int:
        """How many distinct vectors the visited cells must hold for ``TARGET`` of the neighbours of some queries."""
        some = good.filter("is_query").orderBy(F.xxhash64(F.lit(1), "vec_id", "embedding")).limit(TRIALS).select("embedding").toArrow()
        if not some.num_rows:
            return 0
        trial_b = spark.sparkContext.broadcast(_matrix(some.column(0)))

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = trial_b.value - books_b.value[0]
            d, at = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int32)
            for batch in batches:
                if not batch.num_rows:
                    continue
                m = _matrix(batch.column("embedding")) - books_b.value[0]
                d = np.concatenate([d, _squares(q, m)], 1)
                at = np.concatenate([at, np.broadcast_to(batch.column("at").to_numpy(), (len(q), len(m)))], 1)
                if d.shape[1] > top + 1:
                    best = np.argpartition(d, top, axis=1)[:, :top + 1]
                    d, at = np.take_along_axis(d, best, 1), np.take_along_axis(at, best, 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(q), dtype=np.int32), d.shape[1])), pa.array(d.ravel()),
                                              pa.array(at.ravel())], names=["trial", "d", "at"])

        def budgets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for i, cells in zip(batch.column("trial").to_pylist(), batch.column("cells").to_pylist()):
                    d1, d2 = from_codebooks(trial_b.value[i:i + 1])
                    out += needed(d1[0], d2[0], count_b.value, np.array(cells, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["enough"])

        order = F.row_number().over(W.partitionBy("trial").orderBy("d", "at"))
        cells = (placed.mapInArrow(nearest, "trial int, d double, at int").withColumn("rank", order)
                 .filter((F.col("rank") > 1) & (F.col("rank") <= top + 1))  # the first is the query's own row, or a copy in its cell
                 .groupBy("trial").agg(F.collect_list("at").alias("cells")))
        enough = cells.mapInArrow(budgets, "enough long").toArrow().column(0).to_numpy()  # TRIALS * top numbers
        return int(np.quantile(enough, TARGET, method="higher")) if len(enough) else 0

    enough = max(trials(), LEAST_VISIT) if n > LEAST_VISIT else LEAST_VISIT

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 64):
                batch = whole.slice(a, 64)
                d1, d2 = from_codebooks(_matrix(batch.column("embedding")))
                to = [np.unique(tile_b.value[walk(d1[i], d2[i], count_b.value, enough)]) for i in range(len(d1))]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t.tolist() for t in to], pa.list_(pa.int32()))],
                                                 names=["query_id", "embedding", "times", "tiles"])

    # equal rows have equal lists: asked once, told as often as they come
    queries = good.filter("is_query").groupBy("vec_id", "embedding").agg(F.count(F.lit(1)).alias("times"))
    walked = stage(queries.repartition(max(1, -(-n_queries // WALKS)), "vec_id").mapInArrow(
        visit, f"query_id long, embedding {element}, times long, tiles array<int>"), "neighbour_walks")
    visits = walked.withColumn("lot", F.xxhash64("query_id", "embedding")).withColumn("tile", F.explode("tiles"))
    tiled = (good.select("vec_id", "embedding").mapInArrow(place(tile_b), f"vec_id long, embedding {element}, tile int")
             .withColumn("lot", F.xxhash64("vec_id", "embedding")))
    # blocks of a tile's vectors meet blocks of its queries
    asked = visits.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("q_blocks"))
    deal = F.broadcast(sizes.join(asked, "tile"))  # a row per tile
    left = (tiled.join(deal, "tile")
            .withColumn("v", F.pmod("lot", F.col("v_blocks")).cast("int"))
            .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)))
            .select("tile", "v", "q", "vec_id", "embedding"))
    right = (visits.join(deal, "tile")
             .withColumn("q", F.pmod("lot", F.col("q_blocks")).cast("int"))
             .withColumn("v", F.explode(F.sequence(F.lit(0), F.col("v_blocks") - 1)))
             .select("tile", "v", "q", "query_id", "embedding", "times", "lot"))

    def measure(vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not (len(vs) and len(qs)):
            return pd.DataFrame({"query_id": [], "lot": [], "times": [], "vec_id": [], "score": []})
        vs = vs.sort_values("vec_id", kind="stable")
        ids, q = vs["vec_id"].to_numpy(), qs["query_id"].to_numpy()
        rows, cols, d = closest(np.array(vs["embedding"].tolist(), np.float64), ids, np.array(qs["embedding"].tolist(), np.float64), q, top)
        return pd.DataFrame({"query_id": q[rows], "lot": qs["lot"].to_numpy()[rows], "times": qs["times"].to_numpy()[rows],
                             "vec_id": ids[cols], "score": d})

    near = left.groupBy("tile", "v", "q").cogroup(right.groupBy("tile", "v", "q")).applyInPandas(
        measure, "query_id long, lot long, times long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id", "lot").orderBy("score", "vec_id"))
    return (near.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= top)
            .withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("query_id", "rank", "vec_id", "score"))


def op8_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, F.col("vec_id") % 100 == 0)
