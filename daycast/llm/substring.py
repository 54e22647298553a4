"""Exact removal of repeated word windows, prefiltered by a count-min sketch.

Pass one merges partition sketches of all windows (``sketch.py``).  Pass two
draws the windows again, keeps those the sketch cannot rule out, and groups
them exactly by a 96-bit hash.  Inside a task a window that occurs in several
documents is settled at once: only its smallest document goes on, so a passage
that a third of all documents share reaches its group once per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm import sketch
from daycast.llm.carry import packed, unpacked
from daycast.llm.words import chunks, find_words, hash_windows, hash_words, text_buffers

WINDOW = 13
#: Stands for a NULL document id: larger than every other.
LAST = (1 << 63) - 1
#: Windows a task holds before it settles them among themselves.
HELD = 1 << 18


def _windows(batch: pa.RecordBatch, k: int, which: int = 0):
    """Per chunk of documents: first document, window hashes, index of first word, words' documents and places."""
    data, offs = text_buffers(batch.column("text"))
    for a, b in chunks(offs):
        part, o = data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        starts, ends, doc = find_words(part, o)
        h, at = hash_windows(hash_words(part, starts, ends, which), doc, k)
        yield a, h, at, (part, starts, ends, doc)


def _candidates(seen: sketch.Counts, k: int):
    """Task: windows that may repeat, as rows for the exact grouping.

    A row is a window of the smallest document of this task that has it
    (``h1, hs, doc, row``; ``hs`` has the start above the 32 bits of the second hash), or, with ``done`` set, starts that are
    already known to repeat an earlier document of the task.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0
        for batch in batches:
            ids = batch.column("_doc").to_numpy()
            rows = batch.column("_row").to_numpy()
            for a, h1, at, (part, starts, ends, doc) in _windows(batch, k):
                pick = np.flatnonzero(seen.may(h1))
                if not len(pick):
                    continue
                h2, at2 = hash_windows(hash_words(part, starts, ends, 1), doc, k)
                first_word = np.searchsorted(doc, np.arange(doc[-1] + 1))  # index of a document's first word
                d = doc[at[pick]]
                held.append((h1[pick], (h2[pick] >> np.uint64(32)).astype(np.int32), ids[a + d], rows[a + d], at[pick] - first_word[d]))
                n += len(pick)
            if n >= HELD:
                yield from settle(held)
                held, n = [], 0
        if n:
            yield from settle(held)
        seen.close()

    def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        h1, h2, doc, row, start = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, h2, h1))
        s1, s2, sd = h1[order], h2[order], doc[order]
        new = np.concatenate([[True], (s1[1:] != s1[:-1]) | (s2[1:] != s2[:-1])])
        known = np.empty(len(order), bool)
        known[order] = sd > sd[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        # rows go out in the order of the texts, so that ids and places compress
        for a in range(0, len(h1), 1 << 18):
            cut = slice(a, a + (1 << 18))
            go = ~known[cut]
            yield _rows(h1[cut][go], h2[cut][go], doc[cut][go], row[cut][go], start[cut][go])
        yield from _settled(doc[known], row[known], start[known])

    return task


#: Bytes that differ from row to row stand together, which shuffles compress better.
CANDIDATES = "h1 bigint, hs bigint, doc bigint, row bigint, done binary"
_SCHEMA = pa.schema([("h1", pa.int64()), ("hs", pa.int64()), ("doc", pa.int64()), ("row", pa.int64()), ("done", pa.binary())])


def _rows(h1, h2, doc, row, start) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(h1.view(np.int64)), pa.array(start.astype(np.int64) << 32 | h2.view(np.uint32).astype(np.int64)), pa.array(doc),
         pa.array(row), pa.nulls(len(h1), pa.binary())], schema=_SCHEMA)


def _by_document(doc: np.ndarray, row: np.ndarray, start: np.ndarray):
    """Starts gathered per document row: document, row key, starts as packed gaps."""
    order = np.lexsort((start, row, doc))
    doc, row, start = doc[order], row[order], start[order].astype(np.int32)
    if not len(doc):
        return
    first = np.concatenate([[0], np.flatnonzero((doc[1:] != doc[:-1]) | (row[1:] != row[:-1])) + 1])
    # all groups at once: gaps as bytes, 255 carries on, each group begins with its first start
    gaps = np.diff(start, prepend=0)
    gaps[first] = start[first]
    n = gaps // 255 + 1
    ends = np.cumsum(n)
    out = np.full(int(ends[-1]), 255, np.uint8)
    out[ends - 1] = gaps % 255
    data = out.tobytes()
    cuts = np.append(ends[first] - n[first], ends[-1]).tolist()
    yield from zip(doc[first].tolist(), row[first].tolist(), (data[a:b] for a, b in zip(cuts[:-1], cuts[1:])))


def _starts(groups: list[bytes]) -> np.ndarray:
    """The starts in packed groups of one text."""
    raw = np.frombuffer(b"".join(groups), np.uint8)
    size = np.array([len(g) for g in groups])
    total = np.cumsum(raw, dtype=np.int64)
    before = np.concatenate([[0], total[np.cumsum(size)[:-1] - 1]])
    return (total - np.repeat(before, size))[raw != 255]


def _settled(doc: np.ndarray, row: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    rows = [{"h1": r, "hs": 0, "doc": d, "row": r, "done": s} for d, r, s in _by_document(doc, row, start)]
    for a in range(0, len(rows), 4096):
        yield pa.RecordBatch.from_pylist(rows[a:a + 4096], schema=_SCHEMA)


def _group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h1, h2, doc): all but a window's smallest document repeat it."""
    schema = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("starts", pa.binary())])
    last = None  # window and smallest document of the row before
    for batch in batches:
        if not batch.num_rows:
            continue
        done = batch.column("done")
        settled = batch.filter(done.is_valid())
        if settled.num_rows:
            yield pa.RecordBatch.from_arrays([settled.column("doc"), settled.column("row"), settled.column("done")], schema=schema)
        batch = batch.filter(done.is_null())
        n = batch.num_rows
        if not n:
            continue
        h1, hs, doc, row = (batch.column(i).to_numpy() for i in range(4))
        h2, start = hs & 0xFFFFFFFF, hs >> 32
        same = np.zeros(n, bool)
        same[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
        if last and last[:2] == (h1[0], h2[0]):
            same[0] = True
        head = np.maximum.accumulate(np.where(same, -1, np.arange(n)))
        smallest = np.where(head >= 0, doc[np.maximum(head, 0)], last[2] if last else 0)
        hit = doc > smallest
        rows = [{"doc": d, "row": r, "starts": s} for d, r, s in _by_document(doc[hit], row[hit], start[hit])]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
        last = (h1[-1], h2[-1], smallest[-1])


def repeated_starts(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """``doc, row, starts``: first words of windows that an earlier document has (packed, pieces of a document in several rows)."""
    keyed = docs.select(_doc(), _row(), "text")
    seen = sketch.build(docs.select("text"), lambda batch: (h for _, h, _, _ in _windows(batch, k)), sketch.estimate(docs))
    return (keyed.mapInArrow(_candidates(seen, k), CANDIDATES)
            .repartition("h1").sortWithinPartitions("h1", F.col("hs").bitwiseAND(F.lit(0xFFFFFFFF)), "doc")
            .mapInArrow(_group, "doc bigint, row bigint, starts binary"))


def _doc():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_doc")


def _row():
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("_row")


def remove_repeats(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """All documents with ``n_words, n_removed, kept`` (kept words joined by blanks).

    A word goes if a window of ``k`` words over it also starts in a document
    with a smaller ``doc_id``; windows are judged on the input.  NULL texts have
    no words and keep an empty text; a NULL ``doc_id`` counts as larger than all
    others; repeated rows are equal and share a fate; texts of fewer than ``k``
    words lose nothing; other columns pass whatever their names (``n_words``,
    ``n_removed`` and ``kept`` are replaced); an empty table stays empty.
    """
    return unpacked(_without_repeats(packed(docs), k), docs, {c: F.col(c) for c in ("n_words", "n_removed", "kept")})


def _without_repeats(docs: DataFrame, k: int) -> DataFrame:
    keep = docs.columns
    hits = (repeated_starts(docs, k).groupBy("doc", "row")
            .agg(F.collect_list("starts").alias("_starts")))  # all pieces of one text: at most one start a word
    joined = (docs.withColumns({"_doc": _doc(), "_row": _row()}).alias("d")
              .join(hits.alias("h"), (F.col("d._doc") == F.col("h.doc")) & (F.col("d._row") == F.col("h.row")), "left")
              .select("d.*", "_starts").drop("_doc", "_row"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column("_starts").to_pylist()):
                words = text.encode().split() if text else []
                gone = 0
                if starts:
                    s = _starts(starts)
                    step = np.bincount(s, minlength=len(words) + 1) - np.bincount(s + k, minlength=len(words) + 1)
                    stays = np.cumsum(step[:-1]) == 0
                    gone = len(words) - int(stays.sum())
                    n_words.append(len(words))
                    words = [w for w, ok in zip(words, stays.tolist()) if ok]
                else:
                    n_words.append(len(words))
                n_removed.append(gone)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=[*keep, "n_words", "n_removed", "kept"])

    return joined.mapInArrow(cut, fields + "n_words bigint, n_removed bigint, kept string")


def op2_substring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 11, 1))) AS i FROM w)),
earlier AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j
  FROM (SELECT v.doc_id, v.i FROM windows v JOIN earlier e USING (win) WHERE v.doc_id > e.first)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS j FROM w)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM w d LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) g USING (doc_id)
LEFT JOIN (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY 1) k USING (doc_id)
"""
