"""Alignment: segments against whole texts, bitmaps, scores along postings against brute force over all documents."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daycast.llm import alignment as A

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n_a string, block string, pair int"
LETTERS = ["a", "b", "the", " ", " ", "  ", "\n", "\t", "\r\n", "é", "漢", "1", "23", ".", "!?", " ", "\x1c", "\x85", "​", "'s", "'ll",
           "<|endoftext|>", "</s>", "▁", "İ", "🎉", "﻿", "　", "\x00", "x y", "A"]


@pytest.fixture(scope="module")
def models():
    with open(A.BYTES_MODEL) as f, open(A.PIECES_MODEL, "rb") as g:
        return A.Tokenizers(f.read(), g.read())


@pytest.fixture(scope="module")
def plain():
    """The contract over one whole text: every overlapping pair of tokens, by byte ranges."""
    a_model, b_model = Tokenizer.from_file(A.BYTES_MODEL), sentencepiece.SentencePieceProcessor(model_file=A.PIECES_MODEL)
    a_model.encode_special_tokens = True
    letters = A._byte_alphabet()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in a_model.get_vocab().items() if all(c in letters for c in t)}

    def b_bytes(i):
        s = b_model.id_to_piece(i)
        return bytes([int(s[1:-1], 16)]) if b_model.is_byte(i) else s.replace("▁", " ").encode()

    def one(text):
        if not text:
            return None
        whole = " " + text
        a, b = a_model.encode(whole, add_special_tokens=False).ids, b_model.encode(text)
        raw_a, raw_b = [a_bytes[i] for i in a], [b_bytes(i) for i in b]
        if b"".join(raw_a) != whole.encode() or b"".join(raw_b) != whole.encode():
            return None
        of_a = [i for i, r in enumerate(raw_a) for _ in r]
        of_b = [j for j, r in enumerate(raw_b) for _ in r]
        links = [(a[i], b[j]) for i, j in dict.fromkeys(zip(of_a, of_b))]
        cuts = [k for k in range(1, len(of_a) + 1) if k == len(of_a) or of_a[k] != of_a[k - 1] and of_b[k] != of_b[k - 1]]
        groups, p, q = [], 0, 0
        for k in cuts:
            i, j = of_a[k - 1] + 1, of_b[k - 1] + 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
            p, q = i, j
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    return one


def brute(plain, rows):
    """Contract rows of ``(id, text)``, and documents and links of every pair."""
    found = [(i, plain(t)) for i, t in rows]
    total, docs, best = Counter(), Counter(), {}
    for _, f in found:
        if f:
            total.update(f[3])
            docs.update(set(f[3]))
    for (_, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    out = [(i, 0, 0, 0, 0, 0, 0, "") if f is None else
           (i, *f[:3], len(f[3]), sum(total[p] == best[p[1]] for p in f[3]), sum(total[p] for p in f[3]), f[4]) for i, f in found]
    return sorted(out, key=str), {p: (docs[p], n, n == best[p[1]]) for p, n in total.items()}


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_segments_equal_whole_texts(models, plain):
    rng = random.Random(1)
    texts = [None, "", " ", "  ", "\n", "a ", " a", "▁", "a▁b c"]
    texts += ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 14))) for _ in range(4000)]
    seen, cut = A._Segments(models), 0
    for at in range(0, len(texts), 500):
        some = texts[at:at + 500]
        counts, digests, (doc, pair, times) = A._some(seen, some)
        found = {}
        for d, p, n in zip(doc.tolist(), pair.tolist(), times.tolist()):
            found.setdefault(d, Counter())[p >> models.bits, p & (1 << models.bits) - 1] = n
        for i, t in enumerate(some):
            want = plain(t)
            if want is None:
                assert not counts[i].any() and digests[i] == "" and i not in found, repr(t)
            else:
                assert tuple(counts[i]) == (*want[:3], len(want[3])) and digests[i] == want[4] and found[i] == Counter(want[3]), repr(t)
                cut += len(models.segments(t)) > 1
    assert cut > 1000


def test_a_model_whose_pieces_cross_blanks_takes_whole_texts(models, monkeypatch, plain):
    monkeypatch.setattr(models, "cuts", False)
    counts, digests, _ = A._some(A._Segments(models), ["two words  and more ", "x"])
    assert [tuple(c) for c in counts] == [(*w[:3], len(w[3])) for w in map(plain, ["two words  and more ", "x"])]
    assert digests == [plain(t)[4] for t in ("two words  and more ", "x")]


def test_bitmaps_round_trip_and_merge():
    rng = np.random.default_rng(2)
    for n in (1, 2, 30, 500, 6000, 60000):
        slots = np.sort(rng.choice(1 << 16, n, replace=False))
        times = rng.integers(1, 2 if n == 30 else 1 << 20, n)
        assert (A.unpack(A.pack(slots)) == slots).all() and len(A.pack(slots)) <= min(2 * n, 1 << 13) + 2
        back = np.zeros(1 << 16, np.int64)
        for bit, on in A.read_planes(A.planes_of(slots, times)):
            back[on] += 1 << bit
        assert (back[slots] == times).all() and back.sum() == times.sum()
        half = rng.random(n) < 0.5
        parts = [A.planes_of(slots[h], times[h]) for h in (half, ~half) if h.any()]
        assert dict((b, s.tolist()) for b, s in A.read_planes(A.merge(parts))) == dict(
            (b, s.tolist()) for b, s in A.read_planes(A.planes_of(slots, times)))


def test_query_against_brute_force(spark, plain):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = A.op12_alignment(spark, SF)
    assert out.columns == COLUMNS
    assert got(out) == brute(plain, rows)[0]


def test_small_blocks_and_a_small_memory(spark, plain, models, monkeypatch):
    """Many blocks, resets of the remembered segments, repeated rows, hot pairs; pair table and extra columns too."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé漢1.") for _ in range(rng.randint(1, 7))) for _ in range(40)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(250)]
    rows += [rows[0]] * 30 + [(900, None), (901, ""), (None, "the the"), (902, "a▁b"), (903, "the " * 3000), (904, "x" * 5000)]
    df = spark.createDataFrame([(i, t, "mine", "given", 7) for i, t in rows], SCHEMA).repartition(5)
    monkeypatch.setattr(A, "POSTINGS", 300)
    monkeypatch.setattr(A, "REMEMBERED", 50)
    monkeypatch.setattr(A, "DOCS", 1 << 14)
    out, scores = A.align(df)
    want, pairs = brute(plain, rows)
    assert got(out) == want and out.columns == ["doc_id", "block", "pair", *COLUMNS[1:]]
    assert {(r["block"], r["pair"]) for r in out.select("block", "pair").distinct().collect()} == {("given", 7)}
    assert {(r["a"], r["b"]): (r["docs"], r["links"], r["best"]) for r in scores.collect()} == pairs


def test_empty_table_and_text_alone(spark, plain):
    empty = spark.createDataFrame([], SCHEMA)
    out, scores = A.align(empty)
    assert out.collect() == [] and scores.collect() == []
    only = spark.createDataFrame([("hello world",), (None,)], "text string")
    out, _ = A.align(only)
    assert out.columns == COLUMNS[1:] and out.agg(F.sum("n_links"), F.count(F.lit(1))).first() == (len(plain("hello world")[3]), 2)
