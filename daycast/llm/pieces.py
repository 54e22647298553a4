"""SentencePiece encoding and decoding by a streaming Viterbi search.

The lattice of a text has a node per character boundary and an edge per piece.
A node keeps one backpointer: for a unigram model the best-scoring path, for a
BPE model the only piece with which merging the text up to here can end (a
piece may follow another if merging the two alone leaves them as they are).
Nodes older than the longest piece are dropped; ids are committed as soon as
the paths of all nodes in the window run through one boundary.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daycast.llm.carry import packed, unpacked
from daycast.session import ship_package

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Encoded words a worker remembers (some 200 MB).
REMEMBERED = 1 << 20


class Pieces:
    """A SentencePiece vocabulary: pieces, scores, byte pieces."""

    def __init__(self, model: bytes, merges: bool = True) -> None:
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.merges = merges
        self.unknown = p.unk_id()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte = [-1] * 256
        self.raw: list[bytes] = []
        for i in range(p.get_piece_size()):
            s = p.id_to_piece(i)
            if p.is_byte(i):
                self.byte[int(s[1:-1], 16)] = i
                self.raw.append(bytes([int(s[1:-1], 16)]))
            elif p.is_control(i) or p.is_unknown(i) or p.is_unused(i):
                self.raw.append(b"")
            else:
                self.ids[s] = i
                self.score[s] = p.get_score(i)
                self.raw.append(s.replace(BLANK, " ").encode())
        self.longest = max(map(len, self.ids))
        #: Characters that stand side by side in some piece; a cut between others is safe.
        self.inside = {s[i:i + 2] for s in self.ids for i in range(len(s) - 1)}
        self.blanks = sorted((len(s) for s in self.ids if not s.strip(BLANK)), reverse=True)
        #: Lengths of the pieces that end in three (or two) characters, longest first.
        self.tails: dict[str, tuple[int, ...]] = {x: (2, 1) for x in self.ids if len(x) == 2}
        sizes: dict[str, set[int]] = {}
        for x in self.ids:
            if len(x) > 2:
                sizes.setdefault(x[-3:], {1, *[2] * (x[-2:] in self.ids)}).add(len(x))
        self.tails |= {end: tuple(sorted(s, reverse=True)) for end, s in sizes.items()}
        self._follows: dict[tuple[str, str], bool] = {}
        self._pairs: dict[int, bool] = {}

    def _merge(self, s: str) -> list[str]:
        """Pieces of a short string by merging the best pair until none is left."""
        parts = list(s)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _may_follow(self, a: str, b: str) -> bool:
        key = (a, b)
        ok = self._follows.get(key)
        if ok is None:
            if len(self._follows) > 1 << 20:
                self._follows.clear()
            ok = self._follows[key] = self._merge(a + b) == ([a, b] if a else [b])
        return ok

    def search(self, chars: Iterable[str]) -> Iterator[str]:
        """Pieces (or single unknown characters) of a stream of characters, committed as early as all paths agree."""
        ids, score, longest = self.ids, self.score, self.longest
        start = 0  # boundary up to which pieces are committed
        text = ""  # characters from there on
        last = [""]  # per boundary from start: last piece of its path, None if no path ends there
        back = [0]  # per boundary: boundary (from start) where that piece begins
        cost = [0.0]
        due = 4 * longest
        for c in chars:
            text += c
            n = len(text)
            found, best = None, -1e300
            for size in range(min(longest, n), 0, -1):
                piece = text[n - size:]
                before = last[n - size]
                if before is None:
                    continue
                known = piece in ids
                if not known and size > 1:
                    continue
                if not self.merges:
                    total = cost[n - size] + (score[piece] if known else -1e6)
                    if total > best:
                        found, best = size, total
                elif not known or before not in ids and before or self._may_follow(before, piece):
                    found = size
                    break
            last.append(text[n - found:] if found else None)
            back.append(n - found if found else 0)
            cost.append(best)
            if n >= due:
                done = self._agreed(last, back, n)
                if done:
                    yield from self._path(last, back, done)
                    text, last, back, cost = text[done:], last[done:], [max(b - done, 0) for b in back[done:]], cost[done:]
                    last[0], back[0] = last[0], 0
                    start += done
                due = len(text) + 4 * longest
        yield from self._path(last, back, len(text))

    def _agreed(self, last: list, back: list, n: int) -> int:
        """Largest boundary on the paths of all nodes that a coming piece can start from."""
        paths = None
        for end in range(max(0, n - self.longest + 1), n + 1):
            if last[end] is None:
                continue
            on, at = {end}, end
            while at:
                at = back[at]
                on.add(at)
            paths = on if paths is None else paths & on
        return max(paths) if paths else 0

    @staticmethod
    def _path(last: list, back: list, end: int) -> list[str]:
        out = []
        while end:
            out.append(last[end])
            end = back[end]
        return out[::-1]

    def _short(self, s: str) -> list[int] | None:
        """The search for a string that fits into the window; None if it holds unknown characters."""
        ids, follows, tails, one = self.ids, self._pairs, self.tails, (1,)
        last = [-1] * (len(s) + 1)  # piece number of each boundary's path
        back = [0] * (len(s) + 1)
        for i in range(1, len(s) + 1):
            for size in (i > 2 and tails.get(s[i - 3:i])) or (i > 1 and tails.get(s[i - 2:i])) or one:
                j = i - size
                if j < 0:
                    continue
                before = last[j]
                if before < 0 and j:
                    continue
                piece = ids.get(s[j:i])
                if piece is None:
                    continue
                pair = before << 32 | piece
                ok = follows.get(pair)
                if ok is None:
                    if len(follows) > 1 << 20:
                        follows.clear()
                    ok = follows[pair] = self._may_follow(s[back[j]:j], s[j:i])
                if ok:
                    last[i], back[i] = piece, j
                    break
            else:
                if s[i - 1] not in ids:
                    return None
        out, i = [], len(s)
        while i:
            out.append(last[i])
            i = back[i]
        return out[::-1]

    def _ids_of(self, segment: str) -> list[int]:
        if self.merges and len(segment) <= 4 * self.longest and (short := self._short(segment)) is not None:
            return short
        out: list[int] = []
        for piece in self.search(segment):
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte[0] >= 0:
                out.extend(self.byte[b] for b in piece.encode())
            else:
                out.append(self.unknown)
        return out

    def encode_segment(self, segment: str) -> list[int]:
        """Ids of a segment: a run of blanks and the word after it.

        All blank pieces share the lowest score, so in merging a run is joined
        last, from the left and as far as pieces go; only the blank next to the
        word can belong to the word's first piece.
        """
        if self.merges and len(segment) <= 4 * self.longest and BLANK not in segment and segment.rfind(" ") == 0 and len(segment) > 1:
            short = self._short(BLANK + segment[1:])  # the usual case: one blank and a word
            if short is not None:
                return short
        word = segment.lstrip(" ")
        run = len(segment) - len(word)
        # a blank character proper in the text is no blank: it goes by its bytes
        parts = word.split(BLANK)
        tail = self._ids_of(BLANK * (run > 0) + parts[0]) if word or run else []
        for part in parts[1:]:
            tail += [self.byte[b] for b in BLANK.encode()] + self._ids_of(part)
        if run > 1 or run and not word:
            alone = self.ids.get(BLANK)
            if tail and tail[0] == alone:
                tail, left = tail[1:], run
            else:
                left = run - 1
            head = []
            while left:
                size = next(b for b in self.blanks if b <= left)
                head.append(self.ids[BLANK * size])
                left -= size
            tail = head + tail
        return tail

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the blank put before a text goes."""
        raw = self.raw
        return b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


class _Remembered(dict):
    """Segment to its ids as bytes; a worker keeps it from task to task."""

    def __init__(self, pieces: Pieces) -> None:
        super().__init__()
        self.pieces = pieces

    def __missing__(self, segment: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        out = array("i", self.pieces.encode_segment(segment)).tobytes()
        if len(segment) <= 64:
            self[segment] = out
        return out


def segments(text: str) -> list[str]:
    """Cuts no piece spans: before each run of blanks, and around line breaks (a blank is put before the text)."""
    out: list[str] = []
    for i, line in enumerate(text.split("\n")):
        if i:
            out.append("\n")
        words = (" " + line if not i else line).split(" ")
        if "" not in words[1:]:
            if words[0]:
                out.append(words[0])
            out.extend([" " + w for w in words[1:]])
            continue
        run = 0
        if words[0]:
            out.append(words[0])
        for w in words[1:]:
            run += 1
            if w:
                out.append(" " * run + w)
                run = 0
        if run:
            out.append(" " * run)
    return out


def encode(docs: DataFrame, model: str = MODEL, merges: bool = True) -> DataFrame:
    """All documents with ``ids`` (array of piece numbers) and ``decoded`` (the text read back from them).

    Needs ``text``; other columns pass (``ids`` and ``decoded`` are replaced).
    NULL and empty texts have no ids and decode to an empty text; texts of any
    length are searched in a bounded window; repeated rows are equal; an empty
    table stays empty.  ``model`` is a file of the driver, sent to the tasks.
    """
    ship_package(docs.sparkSession)
    with open(model, "rb") as f:
        blob = docs.sparkSession.sparkContext.broadcast(f.read())
    keep = [c for c in docs.columns if c not in ("ids", "decoded")]
    at = keep.index("text")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema.fields)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _loaded(blob.value, merges)
        pieces = seen.pieces
        for whole in batches:
            for a in range(0, whole.num_rows, 256):
                batch = whole.slice(a, 256)
                ids, ends, decoded = [], [0], []
                for text in batch.column(at).to_pylist():
                    raw = b"".join([seen[s] for s in segments(text)]) if text else b""
                    got = np.frombuffer(raw, np.int32)
                    ids.append(got)
                    ends.append(ends[-1] + len(got))
                    decoded.append(pieces.decode(got))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(decoded, pa.string())], names=[*keep, "ids", "decoded"])

    return docs.select(*keep).mapInArrow(task, fields + "ids array<int>, decoded string")


_MODELS: dict[tuple[bytes, bool], _Remembered] = {}


def _loaded(model: bytes, merges: bool) -> _Remembered:
    """A worker's vocabulary and words, read once."""
    key = (hashlib.sha256(model).digest(), merges)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = _Remembered(Pieces(model, merges))
    return _MODELS[key]


def op5_pieces(spark, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode(docs).select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
                               (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage (the last): ``ids`` of every document, its other columns but ``text`` as given (``ids`` is replaced).

    NULL and empty texts have no ids, repeated rows are equal, an empty table stays empty.
    """
    from pyspark.sql import functions as F

    return unpacked(encode(packed(docs)), docs, {"ids": F.col("ids")}).drop("text")
