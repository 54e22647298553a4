"""Cross-tokenizer alignment with inverted pair bitmaps.

Two tokenizers cut the same bytes; tokens whose byte ranges overlap are linked.
Every pair of ids that is ever linked gets, per block of documents, a compressed
bitmap of the documents that hold it, in planes: plane ``k`` has the documents
whose number of such links has bit ``k``.  A pair's planes OR-merged and counted
are its documents, their counts weighted by ``2^k`` its links.  The scores of
the pairs then go back along the same postings to the documents.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from daycast.session import ship_package, stage

BYTES_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Postings (document, pair) after which a block of documents is closed; documents of a block at most.
POSTINGS, DOCS = 1 << 20, 1 << 16
#: Characters of the documents aligned together; aligned segments a worker remembers, and their size together.
SLICE, REMEMBERED, REMEMBERED_BYTES = 1 << 20, 1 << 19, 1 << 26

#: A blank where neither tokenizer has a token across: after a character that is no white space,
#: or between other white space and a character that is none; not at the end, where a blank would be alone.
CUT = re.compile(r" (?:(?<=\S )(?!\Z)|(?<=[^\S ] )(?=\S))")


def _byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable Latin-1 as itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Tokenizers:
    """Both vocabularies: encoders, the bytes of every id, and whether texts may be cut at blanks."""

    def __init__(self, first: str, second: bytes) -> None:
        import os

        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=second)
        letters = _byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(s[1:-1], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        or self.b.is_unused(i) else s.replace(BLANK, " ").encode() for i, s in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.bits = max(1, (len(self.b_bytes) - 1).bit_length())  # of an id of b; a pair is a << bits | b
        self.pair_bits = self.bits + max(1, (len(self.a_bytes) - 1).bit_length())
        # decimal ids with what follows them: a comma inside a group's side, then "|" after a and ";" after b
        self.a_text, self.b_text = (np.array([[f"{i}{c}".encode() for i in range(len(t))] for c in "," + end], object)
                                    for t, end in ((self.a_bytes, "|"), (self.b_bytes, ";")))
        pre = json.loads(first).get("pre_tokenizer") or {}
        self.cuts = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not any(BLANK in s.lstrip(BLANK) for s in pieces)

    def segments(self, text: str) -> list[str]:
        """Parts of a text that, each with a blank in front, can be encoded one by one."""
        return CUT.split(text) if self.cuts else [text]

    def encode(self, segments: list[str]) -> tuple[list, list, np.ndarray]:
        """Ids of blank + segment, one after the other, with the number of each, by both tokenizers; and which segments both give back."""
        want = (" " + " ".join(segments)).encode()
        size = pc.binary_length(pa.array(segments, pa.large_string()).cast(pa.large_binary())).to_numpy() + 1
        good = np.ones(len(segments), bool)
        out = []
        for ids, raw, each in ((self.a.encode_batch_fast([" " + s for s in segments], add_special_tokens=False), self.a_bytes, self.a_size),
                               (self.b.encode(segments, num_threads=1), self.b_bytes, self.b_size)):
            if raw is self.a_bytes:
                ids = [e.ids for e in ids]
            count = np.array(list(map(len, ids)))
            flat = list(chain.from_iterable(ids))
            ids = np.array(flat, np.int64)
            made = np.concatenate([[0], np.cumsum(each[ids])])[np.concatenate([[0], np.cumsum(count)])]
            if (np.diff(made) != size).any() or b"".join([raw[i] for i in flat]) != want:  # some bytes differ: which ones
                ends = [0, *np.cumsum(count).tolist()]
                good &= np.array([b"".join([raw[i] for i in flat[p:q]]) == (" " + s).encode() for p, q, s in zip(ends, ends[1:], segments)])
            out.append((ids, count))
        return out[0], out[1], good

    def align(self, segments: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Per segment: tokens of a and b, groups, links (the first is -1 if bytes differ); group text; and by segment
        its linked pairs as ``(segment, pair, times)``.

        Overlapping token pairs are the intervals between neighbouring ends of either tokenizer's tokens.
        """
        (a, n_a), (b, n_b), good = self.encode(segments)
        counts = np.zeros((len(segments), 4), np.int64)
        counts[:, 0] = -1
        text = [b""] * len(segments)
        at = np.flatnonzero(good)
        none = np.zeros(0, np.int64)
        if not len(at):
            return counts, text, none, none, none
        a, b, n_a, n_b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a[good], n_b[good]
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.r_[True, ends[1:] != ends[:-1]]]
        of_a, of_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        both = (end_a[of_a] == ends) & (end_b[of_b] == ends)
        segment_a = np.repeat(np.arange(len(at)), n_a)
        segment = segment_a[of_a]
        counts[at] = np.column_stack([n_a, n_b, np.bincount(segment[both], minlength=len(at)), np.bincount(segment, minlength=len(at))])
        # texts: the tokens of a of each group, then those of b
        last_a, last_b = of_a[both], of_b[both]
        closes_a, closes_b = np.zeros(len(a), int), np.zeros(len(b), int)
        closes_a[last_a], closes_b[last_b] = 1, 1
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        place_a = np.arange(len(a)) + np.r_[0, last_b + 1][group_a]
        place_b = np.arange(len(b)) + (last_a + 1)[group_b]
        parts, size = np.empty(len(a) + len(b), object), np.empty(len(a) + len(b), np.int64)
        parts[place_a], parts[place_b] = self.a_text[closes_a, a], self.b_text[closes_b, b]
        whole = b"".join(parts.tolist())
        size[place_a], size[place_b] = _digits(a) + 1, _digits(b) + 1
        stop = np.cumsum(size)[np.cumsum(n_a + n_b) - 1].tolist()
        for i, p, q in zip(at.tolist(), [0, *stop], stop):
            text[i] = whole[p:q - 1]
        key, times = np.unique(segment << self.pair_bits | a[of_a] << self.bits | b[of_b], return_counts=True)
        return counts, text, at[key >> self.pair_bits], key & (1 << self.pair_bits) - 1, times


def _digits(ids: np.ndarray) -> np.ndarray:
    return np.searchsorted([10 ** k for k in range(1, 19)], ids, "right") + 1


class _Segments(dict):
    """Segment to a number; under the number its counts, group text and linked pairs (with multiplicity)."""

    def __init__(self, tokenizers: Tokenizers) -> None:
        super().__init__()
        self.tokenizers = tokenizers
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.size = 0
        self.counts = np.zeros((0, 4), np.int64)
        self.text: list[bytes] = []
        self.ends = np.zeros(1, np.int64)
        self.pair = self.times = np.zeros(0, np.int64)

    def full(self) -> bool:
        return len(self) > REMEMBERED or self.size > REMEMBERED_BYTES

    def numbers(self, segments: list[str]) -> list[int]:
        found = list(map(self.get, segments))
        if None in found:
            new = list(dict.fromkeys([s for s, n in zip(segments, found) if n is None]))
            counts, text, segment, pair, times = self.tokenizers.align(new)
            self.update(zip(new, range(len(self), len(self) + len(new))))
            self.counts = np.concatenate([self.counts, counts])
            self.text += text
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.bincount(segment, minlength=len(new)))])
            self.pair, self.times = np.concatenate([self.pair, pair]), np.concatenate([self.times, times])
            self.size += sum(map(len, new)) + sum(map(len, text))
            found = list(map(self.__getitem__, segments))
        return found


# ---- compressed bitmaps ------------------------------------------------------


def pack(slots: np.ndarray) -> bytes:
    """A set of document numbers below 2^16 (ascending): a list of them or a bit string, whichever is shorter."""
    top = int(slots[-1]) + 1
    if 2 * len(slots) <= (top + 7) >> 3:
        return b"\0" + slots.astype("<u2").tobytes()
    bits = np.zeros(top, np.uint8)
    bits[slots] = 1
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    if raw[0] == 0:
        return np.frombuffer(raw, "<u2", offset=1)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, offset=1), bitorder="little"))


def planes_of(slots: np.ndarray, times: np.ndarray) -> bytes:
    """Multiplicity planes of one pair: per bit, the length of its bitmap (0: none) and the bitmap."""
    out, bit = [], 0
    while True:
        on = slots if bit == 0 and times.max() == 1 else slots[times >> bit & 1 == 1]
        raw = pack(on) if len(on) else b""
        out.append(len(raw).to_bytes(4, "little") + raw)
        bit += 1
        if not (times >> bit).any():
            return b"".join(out)


def read_planes(raw: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """``(bit, documents)`` of every plane that is not empty."""
    at = bit = 0
    while at < len(raw):
        size = int.from_bytes(raw[at:at + 4], "little")
        if size:
            yield bit, unpack(raw[at + 4:at + 4 + size])
        at, bit = at + 4 + size, bit + 1


def merge(parts: list[bytes]) -> bytes:
    """Planes of disjoint sets of documents of one block, OR-merged plane by plane."""
    held: dict[int, np.ndarray] = {}
    for raw in parts:
        for bit, slots in read_planes(raw):
            held[bit] = np.union1d(held[bit], slots) if bit in held else np.asarray(slots, np.int64)
    out = []
    for bit in range(max(held, default=-1) + 1):
        one = pack(held[bit]) if bit in held else b""
        out.append(len(one).to_bytes(4, "little") + one)
    return b"".join(out)


# ---- tasks -------------------------------------------------------------------

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RESULT = (*COUNTS, "n_best", "count_sum", "groups_sha256")


class _Block:
    """Documents of one block and their postings, until it is closed."""

    def __init__(self, number: int) -> None:
        self.number = number
        self.rows: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.digests: list[str] = []
        self.postings: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, rows: pa.Array, counts: np.ndarray, digests: list[str], postings: tuple) -> None:
        slot, pair, times = postings
        self.postings.append(((slot + len(self.digests)).astype(np.uint16), pair, times))
        self.rows.append(rows)
        self.counts.append(counts)
        self.digests += digests
        self.size += len(pair)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        def put(n: int, **columns: pa.Array) -> pa.RecordBatch:
            columns["block"] = pa.array(np.full(n, self.number, np.int64))
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

        n = len(self.digests)
        counts = np.concatenate(self.counts)
        yield put(n, slot=pa.array(np.arange(n, dtype=np.int32)), row=pa.concat_arrays(self.rows), groups_sha256=pa.array(self.digests, pa.string()),
                  **{c: pa.array(counts[:, i]) for i, c in enumerate(COUNTS)})
        slots, pair, times = (np.concatenate(c) for c in zip(*self.postings))
        order = np.argsort(pair, kind="stable")  # documents of a pair stay ascending
        slots, pair, times = slots[order], pair[order], times[order]
        first = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(pair) else np.zeros(0, int)
        last = np.r_[first[1:], len(pair)]
        links = np.add.reduceat(times, first) if len(first) else times
        for at in range(0, len(first), 8_192):
            to = min(at + 8_192, len(first))
            planes = [planes_of(slots[p:q], times[p:q]) for p, q in zip(first[at:to].tolist(), last[at:to].tolist())]
            yield put(to - at, pair=pa.array(pair[first[at:to]]), docs=pa.array((last - first)[at:to]), links=pa.array(links[at:to]),
                      planes=pa.array(planes, pa.binary()))


def _postings(seen: _Segments, doc: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, pair, times)`` of the segments' occurrences, ascending."""
    bits, spare = seen.tokenizers.pair_bits, 63 - 12 - seen.tokenizers.pair_bits
    key, often = np.unique(doc << 32 | segment, return_counts=True)  # a segment of a document once
    doc, segment = key >> 32, key & 0xFFFFFFFF
    start, size = seen.ends[segment], seen.ends[segment + 1] - seen.ends[segment]
    take = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - start, size)
    key, times = np.repeat(doc << bits, size) | seen.pair[take], seen.times[take] * np.repeat(often, size)
    if spare >= 8 and times.max(initial=0) < 1 << spare:  # sorted as one number, the times in its last bits
        key = np.sort(key << spare | times)
        key, times = key >> spare, key & (1 << spare) - 1
    else:
        order = np.argsort(key)
        key, times = key[order], times[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
    key, times = key[first], np.add.reduceat(times, first) if len(first) else times
    return key >> bits, key & (1 << bits) - 1, times


def _some(seen: _Segments, texts: list[str | None]) -> tuple[np.ndarray, list[str], tuple]:
    """Counts, digests and postings of a few documents (fewer than 2^12)."""
    parts: list[str] = []
    ends = [0]
    for text in texts:
        if text:
            parts += seen.tokenizers.segments(text)
        ends.append(len(parts))
    flat = seen.numbers(parts)
    segment, ends = np.array(flat, np.int64), np.array(ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(ends))
    sums = np.zeros((len(texts), 4), np.int64)
    filled = np.flatnonzero(np.diff(ends))
    good = np.zeros(len(texts), bool)
    if len(filled):
        counts = seen.counts[segment]
        sums[filled] = np.add.reduceat(counts, ends[filled], axis=0)
        good[filled] = np.minimum.reduceat(counts[:, 0], ends[filled]) >= 0
    digests = [hashlib.sha256(b";".join([seen.text[s] for s in flat[p:q]])).hexdigest() if ok else ""
               for p, q, ok in zip(ends[:-1].tolist(), ends[1:].tolist(), good.tolist())]
    keep = good[doc]
    return np.where(good[:, None], sums, 0), digests, _postings(seen, doc[keep], segment[keep])


_LOADED: dict[bytes, _Segments] = {}


def _loaded(first: str, second: bytes) -> _Segments:
    key = hashlib.sha256(first.encode() + b"\0" + second).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = _Segments(Tokenizers(first, second))
    return _LOADED[key]


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of some documents with not too many characters together (or one longer document)."""
    size = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(size):
        reach = np.cumsum(size[at:at + most])
        to = at + max(1, int(np.searchsorted(reach, SLICE, "right")))
        yield at, min(to, at + most, len(size))
        at = min(to, at + most, len(size))


def postings(docs: DataFrame, row: list[str], first: str = BYTES_MODEL, second: str = PIECES_MODEL) -> DataFrame:
    """Rows of documents (the columns ``row``, counts, digest) and rows of pairs (bitmap planes), both by block of documents.

    Lazy; block numbers depend on the tasks, so write the result before reading it twice.
    """
    with open(first, encoding="utf-8") as f, open(second, "rb") as g:
        models = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    given = docs.select(F.col("text").cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in row)).alias("row"))
    schema = StructType([StructField("block", LongType()), StructField("slot", IntegerType()),
                         StructField("row", given.schema["row"].dataType),
                         *(StructField(c, LongType()) for c in COUNTS), StructField("groups_sha256", StringType()),
                         *(StructField(c, LongType()) for c in ("pair", "docs", "links")), StructField("planes", BinaryType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _loaded(*models.value)
        block, out = _Block(TaskContext.get().partitionId() << 32), None
        for whole in batches:
            if out is None:
                types = {"row": whole.schema.field(1).type, "slot": pa.int32(), "groups_sha256": pa.string(), "planes": pa.binary()}
                out = pa.schema([(f.name, types.get(f.name, pa.int64())) for f in schema])
            for p, q in _slices(whole.column(0), 4_000):
                if seen.full():
                    seen.reset()
                found = _some(seen, whole.column(0).slice(p, q - p).to_pylist())
                if block.digests and len(block.digests) + q - p > DOCS:
                    yield from block.batches(out)
                    block = _Block(block.number + 1)
                block.add(whole.column(1).slice(p, q - p), *found)
                if block.size >= POSTINGS:
                    yield from block.batches(out)
                    block = _Block(block.number + 1)
        if block.digests:
            yield from block.batches(out)

    return given.mapInArrow(task, schema)


def pair_scores(table: DataFrame, bits: int) -> DataFrame:
    """``pair, a, b, docs, links, best`` of every id pair: documents, links, and whether no pair of its ``b`` has more links.

    ``bits`` is the width of ``b`` in ``pair``.
    Blocks hold disjoint documents, so the population counts of a pair's merged
    planes add up over blocks; a pair in every document is one row per block.
    """
    counted = table.filter("pair is not null").groupBy("pair").agg(F.sum("docs").alias("docs"), F.sum("links").alias("links"))
    counted = counted.select("pair", F.shiftright("pair", bits).cast("int").alias("a"),
                             F.col("pair").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("b"), "docs", "links")
    top = counted.groupBy("b").agg(F.max("links").alias("most"))
    return counted.join(top, "b").select("pair", "a", "b", "docs", "links", (F.col("links") == F.col("most")).alias("best"))


def _give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of pairs along their postings to the documents.

    Rows come block by block, documents before pairs, a pair's score before its planes.
    """
    names = ["row", *COUNTS, "groups_sha256"]
    current, docs = None, []
    sums = best = np.zeros(0, np.int64)
    score, top = 0, False

    def close() -> pa.RecordBatch:
        columns = [pa.concat_arrays([d.column(c) for d in docs]) for c in names]
        n = len(columns[0])
        return pa.RecordBatch.from_arrays([*columns, pa.array(best[:n]), pa.array(sums[:n])], names=[*names, "n_best", "count_sum"])

    for batch in batches:
        if not batch.num_rows:
            continue
        block, is_pair = batch.column("block").to_numpy(), batch.column("pair").is_valid().to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((block[1:] != block[:-1]) | (is_pair[1:] != is_pair[:-1])) + 1
        for p, q in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            part = batch.slice(p, q - p)
            if block[p] != current:
                if docs:
                    yield close()
                current, docs = block[p], []
                sums, best = np.zeros(DOCS, np.int64), np.zeros(DOCS, np.int64)
            if not is_pair[p]:
                docs.append(part)
                continue
            for raw, given, is_best in zip(part.column("planes").to_pylist(), part.column("score").to_pylist(), part.column("best").to_pylist()):
                if raw is None:
                    score, top = given, is_best
                    continue
                for bit, slots in read_planes(raw):
                    sums[slots] += score << bit
                    if top:
                        best[slots] += 1 << bit
    if docs:
        yield close()


def align(docs: DataFrame, first: str = BYTES_MODEL, second: str = PIECES_MODEL) -> tuple[DataFrame, DataFrame]:
    """Every row of ``docs`` with its alignment, and the pairs' scores (:func:`pair_scores`).

    The rows' columns but ``text`` pass (it need not travel; columns named like
    a result are replaced).  Results: ``n_a, n_b`` (tokens), ``n_groups`` (parts
    between offsets where tokens of both end), ``n_links`` (overlapping pairs of
    tokens), ``n_best`` (links whose pair has the most links of all pairs of its
    ``b``, ties included), ``count_sum`` (the corpus-wide links of its pair,
    summed over the row's links), ``groups_sha256`` (of ``a1,a2|b1;a3|b2``).

    NULL and empty texts, and texts that either tokenizer does not give back
    byte for byte (a U+2581 in the text), have no tokens: zeros and an empty
    digest.  Texts of any length are taken whole, in segments that neither
    tokenizer crosses; repeated rows count as often as they occur; an empty
    table stays empty.  Models are files of the driver, sent to the tasks.  The
    postings are a table in the shared folder.
    """
    ship_package(docs.sparkSession)
    given = [c for c in docs.columns if c not in ("text", *RESULT)]
    table = stage(postings(docs.withColumn("_none", F.lit(None).cast("int")) if not given else docs, given or ["_none"], first, second), "pair_planes")
    with open(first, encoding="utf-8") as f, open(second, "rb") as g:
        bits = Tokenizers(f.read(), g.read()).bits
    scores = stage(pair_scores(table, bits), "pair_scores")
    # scores join the postings' keys alone; the planes move once, to their block
    scored = table.filter("pair is not null").select("block", "pair").join(
        scores.select("pair", F.col("links").alias("score"), "best"), "pair")
    rows = table.select("block", "slot", "row", *COUNTS, "groups_sha256", "pair", "planes")
    mixed = rows.unionByName(scored, allowMissingColumns=True)
    out = (mixed.repartition("block").sortWithinPartitions("block", F.col("slot").asc_nulls_last(), "pair", F.col("planes").isNotNull())
           .mapInArrow(_give_back, StructType([table.schema["row"], *(StructField(c, LongType()) for c in COUNTS),
                                               StructField("groups_sha256", StringType()), StructField("n_best", LongType()),
                                               StructField("count_sum", LongType())])))
    return out.select(*(F.col("row").getField(c).alias(c) for c in given), *RESULT), scores


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))[0]
