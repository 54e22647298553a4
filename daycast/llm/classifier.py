"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

Terms are hashed byte trigrams, word shapes and repeats inside a text.  Document
frequencies and the term-by-term product matrix are summed over all documents
(a fixed number of terms, so a task's share has a fixed size); the leading
eigenvectors span the latent space.  A bounded sample of labelled vectors is
broadcast, and every document is compared with all of them in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.words import chunks, find_words, hash_windows, hash_words, mix, text_buffers
from daycast.session import drop_stage, ship_package, stage

#: Hashed trigram terms, then the others: words by length, repeated windows, lines.
TRIGRAMS = 448
_LENGTHS, _REPEATS, _MARKS = 24, 16, 24
TERMS = TRIGRAMS + _LENGTHS + _REPEATS + _MARKS
#: Dimensions of the latent space.
LATENT = 48
#: Labelled documents that vote, at most (those with the smallest hash of their id).
LABELLED = 4096
#: Neighbours that vote, and the power that weights their similarity.
VOTERS, POWER = 25, 8
THRESHOLD = 0.3

_MARK = np.full(256, -1, np.int64)
for _i, _c in enumerate("#*$%&|<>{}[]()=_/\\@!?;:"):
    _MARK[ord(_c)] = _i


def term_counts(col: pa.Array) -> np.ndarray:
    """Log-scaled, length-normalised term counts of each text, one row per text (NULL: zeros)."""
    data, offs = text_buffers(col)
    out = np.zeros((len(offs) - 1, TERMS), np.float32)
    for a, b in chunks(offs):
        part, o = data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        n, m = len(part), b - a
        if not n:
            continue
        doc = np.repeat(np.arange(m), np.diff(o))
        x = part.astype(np.uint32)
        counts = np.zeros(m * TERMS, np.int64)

        def add(d: np.ndarray, t: np.ndarray) -> None:
            counts.__iadd__(np.bincount(d * TERMS + t, minlength=m * TERMS))

        if n > 2:
            code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
            code = ((code * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64) % TRIGRAMS
            inside = doc[:-2] == doc[2:]
            add(doc[:-2][inside], code[inside])
        mark = _MARK[part]
        at = np.flatnonzero(mark >= 0)
        add(doc[at], TRIGRAMS + _LENGTHS + _REPEATS + mark[at])
        upper = np.flatnonzero((part >= 65) & (part <= 90))
        add(doc[upper], np.full(len(upper), TERMS - 1))
        starts, ends, word_doc = find_words(part, o)
        add(word_doc, TRIGRAMS + np.minimum(ends - starts, _LENGTHS) - 1)
        h = hash_words(part, starts, ends)
        for k, base in ((1, 0), (3, 8)):  # words and windows that occurred before in the text
            w, first = hash_windows(h, word_doc, k)
            d = word_doc[first]
            order = np.lexsort((w, d))
            again = np.zeros(len(w), bool)
            again[order[1:]] = (w[order[1:]] == w[order[:-1]]) & (d[order[1:]] == d[order[:-1]])
            share = np.bincount(d[again], minlength=m) / np.maximum(np.bincount(d, minlength=m), 1)
            step = np.minimum((share * 8).astype(np.int64), 7)
            some = np.bincount(d, minlength=m) > 0
            total = np.bincount(doc, minlength=m)
            # the step that the share falls in counts like a tenth of the text
            counts[np.flatnonzero(some) * TERMS + TRIGRAMS + _LENGTHS + base + step[some]] += total[some] // 10 + 1
        c = counts.reshape(m, TERMS)
        tf = np.log1p(c / np.maximum(c.sum(1, keepdims=True), 1) * 1000)
        out[a:b] = tf
    return out


def _statistics(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Document frequency and product matrix of the terms over all documents, and their number."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, freq, n = np.zeros((TERMS, TERMS)), np.zeros(TERMS), 0
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                tf = term_counts(batch.column("text").slice(a, 1024))
                gram += tf.T.astype(np.float64) @ tf
                freq += (tf > 0).sum(0)
                n += len(tf)
        if n:
            rows = [*gram, freq, np.full(1, n, float)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array([r.tobytes() for r in rows], pa.binary())],
                                             names=["i", "part"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, p in zip(batch.column("i").to_pylist(), batch.column("part").to_pylist()):
                v = np.frombuffer(p)
                total[i] = total[i] + v if i in total else v
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                             names=["i", "part"])

    parts = docs.select("text").mapInArrow(sums, "i int, part binary").repartition("i").mapInArrow(merge, "i int, part binary")
    gram, freq, n = np.zeros((TERMS, TERMS)), np.zeros(TERMS), 0
    for r in parts.collect():  # TERMS + 2 rows of TERMS numbers
        v = np.frombuffer(r["part"])
        if r["i"] < TERMS:
            gram[r["i"]] = v
        elif r["i"] == TERMS:
            freq = v
        else:
            n = int(v[0])
    return gram, freq, n


def held_out(c: str = "doc_id"):
    """Rows whose labels are never learnt from: crc32 of the id as text divisible by 5."""
    return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents with ``held_out, score, predicted``.

    ``docs`` needs ``doc_id, text``, ``labels`` ``doc_id, quality``; other columns
    of ``docs`` pass (those named like a result are replaced) and are never
    looked at.  Learns from at most ``LABELLED`` labelled documents outside the
    held-out fifth (NULL labels, ids and unmatched labels are left out; a
    repeated id counts once).  Empty and NULL texts score like the labelled
    share of quality 1, as do all documents without any label to learn from;
    equal texts score alike; an empty table stays empty.
    """
    spark = docs.sparkSession
    ship_package(spark)
    keep = [c for c in docs.columns if c not in ("held_out", "score", "predicted")]
    docs = docs.select(*keep)
    gram, freq, n = _statistics(docs)
    idf = np.log((1 + n) / (1 + freq))
    idf = np.maximum(idf, 0.05)
    values, vectors = np.linalg.eigh(gram * idf[:, None] * idf)
    axes = vectors[:, np.argsort(values)[::-1][:LATENT]]
    space = spark.sparkContext.broadcast((idf[:, None] * axes).astype(np.float32))

    def project(col: pa.Array) -> np.ndarray:
        v = term_counts(col) @ space.value
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def latent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("quality").cast(pa.int32()),
                                              pa.array([v.tobytes() for v in project(batch.column("text"))], pa.binary())], names=["quality", "v"])

    learn = (labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality")))
    # ids first: the sample of labels that have a document, then their texts
    ids = (docs.select("doc_id").distinct().join(learn, F.col("doc_id") == F.col("_id")).select("_id", "quality")
           .orderBy(F.xxhash64("_id"), "_id").limit(LABELLED))
    chosen = stage(ids, "labelled")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    rows = texts.select("quality", "text").mapInArrow(latent, "quality int, v binary").collect()  # LABELLED small rows
    drop_stage(chosen)
    voters = np.array([np.frombuffer(r["v"], np.float32) for r in rows], np.float32).reshape(len(rows), axes.shape[1])
    label = np.array([r["quality"] for r in rows], np.float32)
    order = np.lexsort((label, *voters.T[:4])) if len(rows) else []  # one order whatever the tasks' order
    ballot = spark.sparkContext.broadcast((voters[order], label[order]))
    prior = float(label.mean()) if len(label) else 0.5
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, y = ballot.value
        for whole in batches:
            for a in range(0, whole.num_rows, 512):
                batch = whole.slice(a, 512)
                v = project(batch.column("text"))
                got = np.full(len(v), prior)
                some = np.abs(v).sum(1) > 0
                if len(y) and some.any():
                    sim = v[some] @ known.T
                    k = min(VOTERS, len(y))
                    best = np.argpartition(-sim, k - 1, axis=1)[:, :k]
                    w = np.maximum(np.take_along_axis(sim, best, 1), 0) ** POWER + 1e-9
                    got[some] = (w * y[best]).sum(1) / w.sum(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.clip(got, 0, 1).astype(np.float64))], names=[*keep, "score"])

    return (docs.mapInArrow(vote, fields + "score double")
            .withColumn("held_out", held_out()).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def op9_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return score(docs, labels).select("doc_id", "held_out", "score", "predicted")
