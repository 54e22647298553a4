"""Count-min sketch of hashes over the whole corpus, built from merged partition sketches.

Two rows of saturating counters answer: may this hash occur so many times or
more?  A counter only ever overestimates, so "no" is certain.  Each task sends
its own sketch in pieces (sorted cell numbers as byte gaps, a shard of cells per
row); pieces of a shard are merged by streaming over them; the merged sketch
holds one bit per cell and threshold.  Its size follows the number of hashes up
to ``MAX_BITS``, which bounds what the driver gathers and broadcasts.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.llm.words import mix
from daycast.session import ship_package

ROWS = 2
#: Cells in one shard (one bit each once merged) and bits of a merged sketch at most (128 MB).
SHARD_BITS = 22
MAX_BITS = 30
#: Cells per expected hash in each row.
LOAD = 4
#: Hashes a task gathers before it sends a piece.
PIECE = 1 << 21
#: Counters stop here.
MOST = 60_000

_SALT = np.uint64(0xD6E8FEB86659FD93)


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    """Cell of each hash in a row of ``2**bits`` cells."""
    if row:
        h = mix(h ^ _SALT)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def pack(numbers: np.ndarray) -> bytes:
    """Increasing numbers, by whichever is shorter: gaps as bytes (255 carries on), or the last
    eight bits as bytes and the rest as a bit string with a one per number (at place number + rest)."""
    gaps = np.diff(numbers, prepend=0)
    n = gaps // 255 + 1
    length, high = int(n.sum()), int(numbers[-1]) >> 8 if len(numbers) else 0
    if length <= len(numbers) + (len(numbers) + high) // 8 + 9:
        out = np.full(length, 255, np.uint8)
        out[np.cumsum(n) - 1] = gaps % 255
        return b"\0" + out.tobytes()
    bits = np.zeros(len(numbers) + high, np.uint8)
    bits[(numbers >> 8) + np.arange(len(numbers))] = 1
    return b"\1" + len(numbers).to_bytes(8, "little") + (numbers & 255).astype(np.uint8).tobytes() + np.packbits(bits).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    if blob[0] == 0:
        raw = np.frombuffer(blob, np.uint8, offset=1)
        return np.cumsum(raw, dtype=np.int64)[raw != 255]
    n = int.from_bytes(blob[1:9], "little")
    places = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, offset=9 + n)))
    return (places - np.arange(n) << 8) + np.frombuffer(blob, np.uint8, n, 9)


PIECES = "row int, shard int, cells binary, more binary, extra binary"


def _pieces(h: np.ndarray, bits: int) -> Iterator[dict]:
    for row in range(ROWS):
        all_cells = np.sort(cells(h, row, bits))
        edge = np.concatenate([[True], all_cells[1:] != all_cells[:-1]])
        distinct = all_cells[edge]
        count = np.diff(np.append(np.flatnonzero(edge), len(all_cells)))
        shard = distinct >> SHARD_BITS
        cuts = np.concatenate([[0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            local = distinct[a:b] - (shard[a] << SHARD_BITS)
            many = count[a:b] > 1
            yield {"row": row, "shard": int(shard[a]), "cells": pack(local), "more": pack(local[many]),
                   "extra": np.minimum(count[a:b][many] - 1, MOST).astype(np.uint16).tobytes()}


def width(n_hashes: int, thresholds: int = 1, most_bits: int = MAX_BITS) -> int:
    """Bits of a row's cell number for so many hashes."""
    need = max(SHARD_BITS, math.ceil(math.log2(max(1, n_hashes) * LOAD)))
    return min(need, most_bits - math.ceil(math.log2(ROWS * thresholds)))


def build(docs: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], n_hashes: int,
          thresholds: tuple[int, ...] = (2,), most_bits: int = MAX_BITS) -> Counts:
    """Sketch of all hashes that ``hashes`` draws from the batches of ``docs``.

    A hash that is to count once for a document must be drawn once for it.
    """
    ship_package(docs.sparkSession)
    bits = width(n_hashes, len(thresholds), most_bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for h in hashes(batch):
                held.append(h)
                n += len(h)
                if n >= PIECE:
                    yield from out(np.concatenate(held))
                    held, n = [], 0
        if n:
            yield from out(np.concatenate(held))

    def out(h: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = []
        for r in _pieces(h, bits):
            rows.append(r)
            if len(rows) == 64:
                yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (row, shard): one shard's counters at a time."""
        key, count = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if (r["row"], r["shard"]) != key:
                    if key:
                        yield bitmap(key, count)
                    key, count = (r["row"], r["shard"]), np.zeros(1 << SHARD_BITS, np.uint16)
                for at, add in ((unpack(r["cells"]), 1), (unpack(r["more"]), np.frombuffer(r["extra"], np.uint16))):
                    count[at] = np.minimum(count[at].astype(np.uint32) + add, MOST)  # 16 bits could wrap
        if key:
            yield bitmap(key, count)

    def bitmap(key: tuple[int, int], count: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"row": pa.array([key[0]], pa.int32()), "shard": pa.array([key[1]], pa.int32()),
             "bits": pa.array([b"".join(np.packbits(count >= t).tobytes() for t in thresholds)], pa.binary())})

    pieces = docs.mapInArrow(send, PIECES).repartition("row", "shard").sortWithinPartitions("row", "shard")
    merged = pieces.mapInArrow(merge, "row int, shard int, bits binary")
    each, row_bytes = 1 << (SHARD_BITS - 3), 1 << (bits - 3)
    full = bytearray(len(thresholds) * ROWS * row_bytes)
    for r in merged.toLocalIterator(prefetchPartitions=False):  # one partition at a time, at most 2**MAX_BITS bits in all
        for i in range(len(thresholds)):
            at = (i * ROWS + r["row"]) * row_bytes + r["shard"] * each
            full[at:at + each] = r["bits"][i * each:(i + 1) * each]
    # few bits are set: sent compressed, it takes a fraction of its size on every disk it passes
    sent = docs.sparkSession.sparkContext.broadcast(pa.compress(pa.py_buffer(full), codec="zstd", asbytes=True))
    return Counts(sent, len(full), bits, len(thresholds))


SCHEMA = pa.schema([("row", pa.int32()), ("shard", pa.int32()), ("cells", pa.binary()), ("more", pa.binary()), ("extra", pa.binary())])


_OPEN: dict[str, np.ndarray] = {}


class Counts:
    """A merged sketch, broadcast."""

    def __init__(self, sent, size: int, bits: int, thresholds: int) -> None:
        self.sent, self.size, self.bits, self.thresholds = sent, size, bits, thresholds
        self.name = uuid.uuid4().hex
        self.beside: str | None = None  # a second sketch that tasks use together with this one

    def drop(self) -> None:
        """Remove the sketch everywhere (no query that uses it may run afterwards)."""
        self.sent.destroy()

    def _flags(self) -> np.ndarray:
        """The bits, unpacked once per worker; a worker keeps one sketch at a time (two, if one is named beside the other)."""
        if self.name not in _OPEN:
            for name in [x for x in _OPEN if x != self.beside]:
                del _OPEN[name]
            _OPEN[self.name] = np.frombuffer(pa.decompress(self.sent.value, decompressed_size=self.size, codec="zstd"), np.uint8)
        return _OPEN[self.name]

    def level(self, h: np.ndarray) -> np.ndarray:
        """Thresholds that each hash may reach (0: certainly below the first)."""
        flags = self._flags()
        level = np.zeros(len(h), np.int64)
        each = [cells(h, row, self.bits) for row in range(ROWS)]
        for i in range(self.thresholds):
            ok = np.ones(len(h), bool)
            for row, c in enumerate(each):
                ok &= (flags[((i * ROWS + row) << (self.bits - 3)) + (c >> 3)] >> (7 - (c & 7)).astype(np.uint8)) & 1 > 0
            level += ok
        return level

    def close(self) -> None:
        """Free the unpacked bits of this worker (a task's end)."""
        _OPEN.clear()
        pa.default_memory_pool().release_unused()

    def may(self, h: np.ndarray) -> np.ndarray:
        """False: the hash certainly stays below the first threshold."""
        return self.level(h) > 0


def estimate(docs: DataFrame, text: str = "text") -> int:
    """Words to expect in a table: a fifth of its characters."""
    return int(docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]) // 5 + 1
