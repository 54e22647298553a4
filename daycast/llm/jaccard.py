"""Exact Jaccard join of shingle sets as a metric-space join with pivots.

1 - Jaccard is a metric.  Documents meet in cells: a cell is a rare shingle of
their prefixes (two sets with similarity t share one of the first
n - ceil(t n) + 1 shingles in any common order, here rarest first).  A cell is
joined by pivots, at two fixed levels.  One document becomes the pivot and the distance
of the others to it is computed exactly; those linked to it need no more links
among themselves.  What is left of a cell falls apart into regions (components),
each with a pivot of its own.  By the triangle inequality a document outside a
region can only be linked into it if its distance to the pivot exceeds the
region's radius by the link radius at most; such boundary documents are copied
to the region, where windows of the same width pick the pairs that are measured.
The result is components: links inside a component are not all measured.

Equal sets are one class from the start, and a set of which so many shingles
occur nowhere else that no prefix shingle is shared (count-min sketch: never
underestimates) is alone without any shuffle.  Where the table is too large for
the sketch to tell, the rarest shingles of each document, some more than its
prefix, meet in shards as short numbers that are counted exactly: two linked
sets share a known number of them, so a document that repeats fewer is alone.
Only the other documents' sets are ever written or shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm import graph, sketch
from daycast.llm.words import BASES, chunks, find_words, hash_windows, hash_words, mix, text_buffers
from daycast.session import drop_stage, stage

WORDS = 5
#: Similarity in percent: linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
LAST = (1 << 63) - 1
#: How many classes may hold a shingle, in steps: rarer shingles come first in prefixes.
RARITY = (5, 33, 257, 2049)
#: Bits of the two sketches at most (64 MB and 32 MB), and of the filter of the documents that may be linked (32 MB).
ONCE_BITS, RARITY_BITS, NEAR_BITS = 29, 28, 28
#: Documents that hold a common shingle, at least, and as a multiple of what a full sketch counts for any shingle.
COMMON, COMMON_LOAD = 33, 4
#: Counted shingles in a shard, about, and such shingles that a task gathers before it sends them.
SHARD, PIECE = 1 << 19, 1 << 21
#: Bytes of text that are hashed in one go; arrays of some ten times this size come and go.
CHUNK = 1 << 18


def _sets(batch: pa.RecordBatch):
    """Per chunk: first document, documents in chunk, (document, shingle) pairs, distinct, sorted."""
    data, offs = text_buffers(batch.column("text"))
    for a, b in chunks(offs, CHUNK):
        part, o = data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        starts, ends, doc = find_words(part, o)
        words = hash_words(part, starts, ends, lower=True)
        h, at = hash_windows(words, doc, WORDS)
        d = doc[at]
        count = np.bincount(doc, minlength=b - a)
        first = np.cumsum(count) - count
        short = np.flatnonzero((count > 0) & (count < WORDS))
        if len(short):  # the whole sequence is the one shingle
            whole = np.array([_sequence(words[first[i]:first[i] + count[i]]) for i in short], np.uint64)
            h, d = np.concatenate([h, whole]), np.concatenate([d, short])
        order = np.lexsort((h, d))
        h, d = h[order], d[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        yield a, b - a, d[new], h[new]


def _sequence(words: np.ndarray) -> int:
    out = len(words) * 0x9E3779B9
    for w in words.tolist():
        out = (out * BASES[1] + w) & 0xFFFFFFFFFFFFFFFF
    return int(mix(np.array([out], np.uint64))[0])


def _prefix_length(n: np.ndarray) -> np.ndarray:
    return n + (-(PERCENT * n) // 100) + 1


def _slack(n: np.ndarray) -> np.ndarray:
    """How many shingles a document counts beyond its prefix; grows with its size."""
    return n // 8


def _least(n: np.ndarray) -> np.ndarray:
    """How many of the counted shingles a set shares with a linked one, at least.

    Let linked sets count their first prefix + slack shingles of a common order.  The one whose list ends earlier
    holds at most prefix - 1 shingles that the other lacks, so slack + 1 at least stand in both lists; linked sets
    have PERCENT of each other's size at least.
    """
    return _slack(-(-PERCENT * n // 100)) + 1


def _sums(h: np.ndarray, n: np.ndarray, salt: int) -> np.ndarray:
    """A key per document of its shingles, which stand in the documents' order."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(h ^ np.uint64(salt)), dtype=np.uint64)])
    end = np.cumsum(n)
    return mix(total[end] - total[end - n] + n.astype(np.uint64))


def _refs(key: np.ndarray) -> np.ndarray:
    """Short numbers of documents; documents may share one and then count as one that repeats more."""
    return (key >> np.uint64(32)).astype(np.uint32)


COUNTED = "shard int, cells binary, refs binary, docs binary, least binary"
COUNTED_SCHEMA = pa.schema([("shard", pa.int32()), *[(c, pa.binary()) for c in ("cells", "refs", "docs", "least")]])


def _counted(seen: sketch.Counts, bits: int):
    """Task: the rarest shingles of the documents that are not certainly alone, dealt to ``2**bits`` shards by their hashes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, n_docs, d, h in _sets(batch):
                n = np.bincount(d, minlength=n_docs)
                level = seen.level(h)
                open_ = n - np.bincount(d[level > 0], minlength=n_docs) < _prefix_length(n)
                ref = _refs(_sums(h, n, BASES[0]))
                order = np.argsort(d * 4 + level, kind="stable")  # rarest first, then by hash; documents stay in order
                rank = np.arange(len(h)) - (np.cumsum(n) - n)[d]
                take = (level[order] > 0) & open_[d] & (rank < (_prefix_length(n) + _slack(n))[d])
                c = mix(h[order[take]] ^ np.uint64(BASES[1]))
                docs = np.flatnonzero(open_ & (n > 0))
                held.append(((c >> np.uint64(64 - bits)).astype(np.int32), ((c >> np.uint64(32 - bits)) & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                             ref[d[take]], ref[docs], _least(n[docs]).astype(np.uint32)))
                size += len(c) + len(docs)
            if size >= PIECE:
                yield from sent(held)
                held, size = [], 0
        if size:
            yield from sent(held)
        seen.close()

    def sent(held: list) -> Iterator[pa.RecordBatch]:
        shard, cells, refs, docs, least = (np.concatenate(x) for x in zip(*held))
        by, at = np.argsort(shard, kind="stable"), np.argsort(docs & np.uint32((1 << bits) - 1), kind="stable")
        cells, refs, docs, least = cells[by], refs[by], docs[at], least[at]
        every = np.arange((1 << bits) + 1)
        x, y = np.searchsorted(shard[by], every), np.searchsorted(docs & np.uint32((1 << bits) - 1), every)
        some = np.flatnonzero((x[1:] > x[:-1]) | (y[1:] > y[:-1]))
        for i in range(0, len(some), 256):
            part = some[i:i + 256].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), *[pa.array([v[z[k]:z[k + 1]].tobytes() for k in part], pa.binary())
                                               for v, z in ((cells, x), (refs, x), (docs, y), (least, y))]], schema=COUNTED_SCHEMA)

    return task


REPEATED = "ref bigint, repeated bigint, least bigint"


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over rows sorted by shard: how many shingles of a document occur again, and how many would have to."""
    schema = pa.schema([(c, pa.int64()) for c in ("ref", "repeated", "least")])

    def count(rows: list) -> Iterator[pa.RecordBatch]:
        cells, refs, docs, least = (np.frombuffer(b"".join(x), np.uint32) for x in zip(*rows))
        order = np.argsort(cells)
        same = cells[order[1:]] == cells[order[:-1]]
        again = np.zeros(len(cells), bool)
        again[1:] = same
        again[:-1] |= same
        ref, n = np.unique(refs[order[again]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ref, docs]).astype(np.int64)),
                                          pa.array(np.concatenate([n, np.zeros(len(docs), np.int64)])),
                                          pa.array(np.concatenate([np.full(len(ref), LAST), least.astype(np.int64)]))], schema=schema)

    shard, rows = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if r["shard"] != shard and rows:
                yield from count(rows)
                rows = []
            shard = r["shard"]
            rows.append((r["cells"], r["refs"], r["docs"], r["least"]))
    if rows:
        yield from count(rows)


def _near(docs: DataFrame, seen: sketch.Counts, n_hashes: int) -> sketch.Counts:
    """Which documents may be linked with another: a filter of their short numbers, certain in its "no"."""
    bits = min(16, max(6, math.ceil(math.log2(n_hashes / SHARD))))
    met = docs.select("text").mapInArrow(_counted(seen, bits), COUNTED).repartition("shard").sortWithinPartitions("shard")
    found = (met.mapInArrow(_repeated, REPEATED).groupBy("ref").agg(F.sum("repeated").alias("repeated"), F.min("least").alias("least"))
             .filter("repeated >= least").select("ref"))
    return sketch.build(found, lambda batch: [_mixed(batch.column("ref").to_numpy().astype(np.uint32))], docs.count(), (1,), NEAR_BITS)


def _mixed(refs: np.ndarray) -> np.ndarray:
    return mix(refs.astype(np.uint64))


SIGNATURES = "doc_id bigint, tag bigint, n bigint, key bigint, key2 bigint, shared array<bigint>"


def _signatures(seen: sketch.Counts, near: sketch.Counts):
    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("key2", pa.int64()),
                        ("shared", pa.list_(pa.int64()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64())
            for a, n_docs, d, h in _sets(batch):
                n = np.bincount(d, minlength=n_docs)
                keys = [_sums(h, n, salt) for salt in BASES]
                alone = (n == 0) | ~near.may(_mixed(_refs(keys[0])))
                h, d = h[~alone[d]], d[~alone[d]]
                may = seen.may(h)
                # alone as well: prefix shingles enough that occur nowhere else
                alone |= n - np.bincount(d[may], minlength=n_docs) >= _prefix_length(n)
                take = may & ~alone[d]
                size = np.bincount(d[take], minlength=n_docs)
                ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                shared = pa.ListArray.from_arrays(pa.array(ends), pa.array(h[take].view(np.int64)),
                                                  mask=pa.array(alone))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, n_docs), batch.column("tag").slice(a, n_docs), pa.array(n), *[pa.array(k.view(np.int64)) for k in keys], shared], schema=schema)
        seen.close()

    return task


def _cells(rarity: sketch.Counts):
    """Task: the prefix shingles of each class (rarest first) as cells, with their place in the order."""
    schema = pa.schema([("cell", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("after", pa.int64()), ("own", pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, shared in zip(*(batch.column(c) for c in ("node", "n", "shared"))):
                h = np.asarray(shared.values.to_numpy(zero_copy_only=False)).view(np.uint64)
                size = n.as_py()
                alone = size - len(h)  # shingles of no other document come before all others
                p = int(_prefix_length(np.array([size]))[0]) - alone
                order = np.lexsort((h, rarity.level(h)))[:max(p, 0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[order].view(np.int64)), pa.array(np.full(len(order), node.as_py())),
                     pa.array(np.full(len(order), size)), pa.array(size - alone - 1 - np.arange(len(order))),
                     pa.array(np.full(len(order), alone / size))], schema=schema)
        rarity.close()

    return task


def _linked(inter: Column, union: Column) -> Column:
    return 100 * inter >= PERCENT * union


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pivot, node, inter, uni`` for distinct pairs whose sizes allow a distance below 1."""
    x = sets.select("node", F.col("n").alias("xn"), F.col("shared").alias("xs"))
    p = sets.select(F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("shared").alias("ps"))
    inter = F.size(F.array_intersect("xs", "ps")).cast("long")
    return (pairs.join(x, "node").join(p, "pivot").withColumn("inter", inter)
            .select("pivot", "node", "inter", (F.col("xn") + F.col("pn") - F.col("inter")).alias("uni")))


def _possible(n: str, after: str, pn: str, pafter: str) -> Column:
    """May two sets of one cell be linked?  Their sizes (distances to the empty set) must be near, and
    if the cell is their first common shingle, no more than those after it can be common too."""
    n_, pn_ = F.col(n), F.col(pn)
    return ((100 * F.least(n_, pn_) >= PERCENT * F.greatest(n_, pn_))
            & ((100 + PERCENT) * (1 + F.least(F.col(after), F.col(pafter))) >= PERCENT * (n_ + pn_)))


def _join_cells(cells: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, component`` over the links of all cells; ``cells`` rows are (cell, node, n, after, own).

    First every cell has one pivot, the node with the smallest share of shingles
    of its own: what others were copied from, so most of them are linked to it.  Cells that then still hold several
    components fall into regions, one per component, each with a pivot; a node
    stays open against a region if the region's radius and the link radius
    together reach as far as its distance to the pivot.  What is open is
    measured pair by pair inside the window of the region's pivot.
    """
    radius = 1 - PERCENT / 100 + 1e-9
    shared = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("own", "node", "n", "after")).alias("p"))
    shared = shared.filter("c > 1").select("cell", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.after").alias("pafter"))
    dealt = stage(cells.join(shared, "cell"), "cells")
    pairs = dealt.filter("node <> pivot").filter(_possible("n", "after", "pn", "pafter")).select("pivot", "node").distinct()
    first = graph.components(_links(_distances(pairs, sets)))

    # regions: the components inside a cell
    comp = F.coalesce("component", "node").alias("comp")
    rows = dealt.join(first, "node", "left").select("cell", "node", "n", "after", "own", comp)
    several = rows.groupBy("cell").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("cell")
    rows = stage(rows.join(several, "cell"), "regions")
    region = rows.groupBy("cell", "comp").agg(
        F.min(F.struct("own", "node"))["node"].alias("pivot"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("after").alias("reach"))
    region = region.withColumnRenamed("comp", "region")
    open_ = rows.join(region, "cell").filter(F.col("comp") != F.col("region")).filter(
        (100 * F.col("n") >= PERCENT * F.col("least")) & (PERCENT * F.col("n") <= 100 * F.col("most"))
        & ((100 + PERCENT) * (1 + F.least("after", "reach")) >= PERCENT * (F.col("n") + F.col("least"))))
    open_ = stage(open_.select("cell", "node", "n", "after", "region", "pivot"), "open")
    asked = open_.select("cell", F.col("region").alias("comp"), "pivot").distinct()
    inside = rows.join(asked, ["cell", "comp"])
    pairs = open_.select("pivot", "node").union(inside.select("pivot", "node")).filter("pivot <> node").distinct()
    dist = stage(_distances(pairs, sets), "distances")
    d = dist.select("pivot", "node", (1 - F.col("inter") / F.col("uni")).alias("d"))
    inside = inside.join(d, ["pivot", "node"], "left").withColumn("d", F.coalesce("d", F.lit(0.0)))
    wide = inside.groupBy("cell", F.col("comp").alias("region")).agg(F.max("d").alias("radius"))
    boundary = (open_.join(d, ["pivot", "node"]).join(wide, ["cell", "region"])
                .filter((F.col("d") <= F.col("radius") + radius) & (F.col("d") > radius)))  # nearer ones are linked to the pivot
    other = inside.filter("pivot <> node").select("cell", F.col("comp").alias("region"), F.col("node").alias("other"),
                                                  F.col("n").alias("pn"), F.col("after").alias("pafter"), F.col("d").alias("pd"))
    last = (boundary.join(other, ["cell", "region"]).filter(_possible("n", "after", "pn", "pafter") & (F.abs(F.col("d") - F.col("pd")) <= radius))
            .select(F.least("node", "other").alias("pivot"), F.greatest("node", "other").alias("node")).distinct())
    found = _links(dist).union(_links(_distances(last, sets)))
    comps = graph.components(found.union(first.select("node", "component")))
    for x in (first, dealt, rows, open_, dist):
        drop_stage(x)
    return comps


def _links(dist: DataFrame) -> DataFrame:
    return dist.filter(_linked(F.col("inter"), F.col("uni"))).select("pivot", "node")


def components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    ``docs`` needs ``doc_id, text``; other columns are ignored.  Words are
    lower-cased A-Z; the set of a document are its distinct 5-word shingles,
    with fewer words the whole sequence as one; a NULL, empty or blank text has
    no shingles and is linked with nothing.  ``component_id`` is the smallest
    ``doc_id`` reachable by links (NULL ids come last); repeated rows are links
    of their own; an empty table gives no rows.
    """
    return _grouped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(None).cast("bigint").alias("tag"))).drop("tag", "_class")


def _grouped(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, n_shingles, component_id, _class`` of rows ``doc_id, text, tag``.

    ``_class`` is one number per component that holds more than one set or row,
    NULL for a row that is certainly alone.
    """
    n_hashes = sketch.estimate(docs)
    common = max(COMMON, COMMON_LOAD * (n_hashes >> sketch.width(n_hashes, 2, ONCE_BITS)))
    seen = sketch.build(docs.select("text"), lambda batch: (h for *_, h in _sets(batch)), n_hashes, (2, common), ONCE_BITS)
    near = _near(docs, seen, n_hashes)
    seen.beside, near.beside = near.name, seen.name
    signed = stage(docs.mapInArrow(_signatures(seen, near), SIGNATURES), "signatures")
    seen.drop()
    near.drop()
    candidates = signed.filter("shared is not null")
    # a class is a set, told from others by both keys; its node is a number given once
    sets = stage(candidates.groupBy("key", "key2", "n").agg(F.any_value("shared").alias("shared"))
                 .withColumn("node", F.monotonically_increasing_id()), "sets")
    total = int(sets.agg(F.coalesce(F.sum(F.size("shared")), F.lit(0))).first()[0])
    rarity = sketch.build(sets.select("shared"), _all_shared, total + 1, RARITY, RARITY_BITS)
    cells = sets.select("node", "n", "shared").mapInArrow(_cells(rarity), "cell bigint, node bigint, n bigint, after bigint, own double")
    comps = _join_cells(cells, sets.select("node", "n", "shared"))
    rarity.drop()
    classes = stage(sets.select("key", "key2", "n", "node").join(comps, "node", "left")
                    .select("key", "key2", "n", F.coalesce("component", "node").alias("component")), "classes")
    drop_stage(sets)

    ident = F.coalesce(F.col("doc_id"), F.lit(LAST))
    alone = signed.filter("shared is null").select("doc_id", "tag", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                                   F.lit(None).cast("bigint").alias("_class"))
    member = candidates.select("doc_id", "tag", "n", "key", "key2").join(classes, ["key", "key2", "n"])
    smallest = member.groupBy("component").agg(F.min(ident).alias("component_id"))
    member = (member.join(smallest, "component")
              .select("doc_id", "tag", F.col("n").alias("n_shingles"), F.nullif(F.col("component_id"), F.lit(LAST)).alias("component_id"),
                      F.col("component").alias("_class")))
    return alone.union(member)


def _all_shared(batch: pa.RecordBatch):
    col = batch.column("shared")
    yield col.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def op4_jaccard(spark, sf_dir: str) -> DataFrame:
    return components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def stage_dedup(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row of each group stays, the one with the smallest ``doc_id`` (NULL last; ties by a hash of the row).

    Rows without shingles (NULL, empty and blank texts) are linked with nothing
    and all stay.  Of rows that are equal in every column and have shingles one
    stays; columns of ``docs`` pass as they are, whatever their names.
    """
    tag = F.xxhash64(*[F.col(f"`{c}`") for c, t in docs.dtypes if not t.startswith("map")])
    found = _grouped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", tag.alias("tag")))
    least = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "tag"))
    grouped = found.filter("_class is not null").groupBy("_class").agg(least.alias("k")).select(F.col("k.tag").alias("_tag"), F.lit(True).alias("_one"))
    alone = found.filter("_class is null").select(F.col("tag").alias("_tag"), F.lit(False).alias("_one"))
    keep = grouped.union(alone).groupBy("_tag").agg(F.bool_and("_one").alias("_one"))  # a row's number decides for equal rows alike
    names = [f"c{i}" for i in range(len(docs.columns))]
    # equal rows are collapsed with their number before anything is joined
    rows = (docs.select(F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)]).alias("_row"), tag.alias("_tag"))
            .groupBy("_tag", "_row").agg(F.count(F.lit(1)).alias("_n")).join(keep, "_tag"))
    times = F.when(F.col("_one"), F.lit(1).cast("bigint")).otherwise(F.col("_n"))
    rows = rows.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), times)).alias("_nth"))
    return rows.select(*[F.col("_row").getField(n).alias(c) for c, n in zip(docs.columns, names)])


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM w
  UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT r.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM reach r LEFT JOIN sizes z USING (doc_id) GROUP BY 1
"""
