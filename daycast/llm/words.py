"""Words of whole texts: SQL expressions for native operators, array code for Arrow tasks.

A word is a maximal run of characters other than blank and ``\\x09-\\x0D``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"


def text_of(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def word_array(c: str | Column = "text") -> Column:
    """Words of a text, in order; none for NULL."""
    return F.array_remove(F.split(text_of(c), SPLIT), "")


def n_words(c: str | Column = "text") -> Column:
    return F.size(word_array(c)).cast("long")


# ---- array code -----------------------------------------------------------

#: Salts of the two hash families.
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_FACTORS: dict[int, np.ndarray] = {}
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over 64 bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a string column (NULL: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, limit: int = 1 << 20):
    """Ranges of consecutive documents of at most ``limit`` bytes together (or one longer document)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def find_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes) and document index of every word."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    blank = _IS_BLANK[data]
    first = np.zeros(n + 1, bool)
    first[offs] = True
    prev = np.empty(n, bool)
    prev[0] = True
    prev[1:] = blank[:-1]
    nxt = np.empty(n, bool)
    nxt[-1] = True
    nxt[:-1] = blank[1:]
    starts = np.flatnonzero(~blank & (prev | first[:n]))
    ends = np.flatnonzero(~blank & (nxt | first[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def _numbers(salt: int, n: int) -> np.ndarray:
    """The first ``n`` of a fixed sequence of 64-bit numbers per salt, without arithmetic relations between them."""
    have = _FACTORS.get(salt)
    if have is None or len(have) < n:
        have = mix(mix(np.arange(max(n, 1024), dtype=np.uint64) + np.uint64(salt)) ^ np.uint64(salt >> 7))
        if n <= 1 << 21:
            _FACTORS[salt] = have
    return have


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word's bytes: every byte value and every place in a word has a number of its own, their products are added.

    No powers of one base, so no words that agree under every base.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    if lower:
        data = _LOWER[data]
    size = ends - starts
    values = _numbers(BASES[which] ^ 0x5555, 256)[:256] | np.uint64(1)
    factors = _numbers(BASES[which], int(size.max()))
    place = np.zeros(len(data), np.int64)
    place[starts[0]:] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    np.minimum(place, len(factors) - 1, out=place)  # blanks after a word do not count
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * factors[place], out=sums[1:])
    return mix(sums[ends] - sums[starts] + size.astype(np.uint64) * np.uint64(BASES[1 - which]))


def hash_windows(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` consecutive words of one document, and the index of their first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factors = _numbers(BASES[0] ^ 0xAAAA, k) | np.uint64(1)
    w = h[:n] * factors[0]
    for i in range(1, k):
        w += h[i:i + n] * factors[i]
    at = np.flatnonzero(doc[:n] == doc[k - 1:])
    return mix(w[at]), at
