"""Substring removal, Jaccard join and their sketch and graph helpers against plain code."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daycast.llm import graph, jaccard, sketch, substring
from daycast.llm.words import find_words, hash_windows, hash_words, text_buffers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, extra string"


def removed_plainly(docs, k=13):
    first = {}
    words = {i: WORD.findall(t or "") for i, t in docs}
    order = sorted(words, key=lambda i: (i is None, i))
    for i in order:
        for a in range(len(words[i]) - k + 1):
            first.setdefault(tuple(words[i][a:a + k]), i)
    out = {}
    for i in order:
        gone = set()
        for a in range(len(words[i]) - k + 1):
            if first[tuple(words[i][a:a + k])] != i:
                gone.update(range(a, a + k))
        out[i] = (len(words[i]), len(gone), " ".join(w for x, w in enumerate(words[i]) if x not in gone))
    return out


def components_plainly(docs):
    sets = {}
    for i, t in docs:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets[i] = frozenset(tuple(w[a:a + 5]) for a in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=3, n=120):
    """Texts with shared passages, copies, near copies in chains, odd blanks and non-Latin words."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)] + ["é漢", "İ", "ﬀ", " x", " "]
    passages = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(4)]
    docs = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.25 and docs:  # a near copy of an earlier text, so chains arise
            words = WORD.findall(rng.choice(docs)[1])
            for _ in range(rng.randint(0, 3)):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.35 and docs:
            words = WORD.findall(rng.choice(docs)[1])
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 5, 12, 13, 14, 40, 150]))]
            if rng.random() < 0.4:
                at = rng.randint(0, len(words))
                words[at:at] = rng.choice(passages)
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(words)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_removal_equals_plain_code(spark, seed):
    docs = corpus(seed)
    got = substring.remove_repeats(spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA).repartition(5))
    want = removed_plainly(docs)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got.collect()} == want
    assert any(x[1] for x in want.values())


def test_substring_edges(spark):
    a = " ".join(f"a{i}" for i in range(20))
    rows = [(5, a, "p"), (5, a, "p"), (None, a, "q"), (2, None, "r"), (3, "", "s"), (9, a + " b", "t"), (1, "\n \t", "u"),
            (7, "z " * 5000, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string")  # a clashing column is replaced
    got = sorted([(r.doc_id is None, r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(df).collect()], key=str)
    want = [(False, 5, 20, 0, a)] * 2 + [(True, None, 20, 20, ""), (False, 2, 0, 0, ""), (False, 3, 0, 0, ""), (False, 9, 21, 20, "b"),
                                         (False, 1, 0, 0, ""), (False, 7, 5000, 0, " ".join(["z"] * 5000))]
    assert got == sorted(want, key=str)
    assert substring.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_substring_query_digest(spark):
    r = substring.op2_substring(spark, "/root/testdata/sf0.001")
    docs = [(x.doc_id, x.text) for x in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = {i: (n, g, hashlib.sha256(t.encode()).hexdigest()) for i, (n, g, t) in removed_plainly(docs).items()}
    assert {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in r.collect()} == want


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_plain_code(spark, seed):
    docs = corpus(seed)
    got = jaccard.components(spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA).repartition(4))
    want = components_plainly(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == want
    assert len({c for _, c in want.values()}) < len(want)


@pytest.mark.parametrize("seed", [5, 6])
def test_jaccard_with_a_full_sketch_writes_no_sets_of_documents_that_are_alone(spark, seed, monkeypatch):
    class Full:
        """A sketch without a free cell: every shingle may occur anywhere."""
        beside, name = None, "full"

        def level(self, h):
            return np.ones(len(h), np.int64)

        def may(self, h):
            return np.ones(len(h), bool)

        def close(self):
            pass

        drop = close

    build, stage, signed = sketch.build, jaccard.stage, {}

    def kept(df, name):
        out = stage(df, name)
        if name == "signatures":
            signed.update({r.doc_id: r.shared is None for r in out.collect()})
        return out

    monkeypatch.setattr(sketch, "build", lambda docs, hashes, n, at=(2,), bits=sketch.MAX_BITS, **more: Full() if docs.columns == ["text"]
                        else build(docs, hashes, n, at, bits, **more))
    monkeypatch.setattr(jaccard, "stage", kept)
    docs = corpus(seed) + [(1000 + i, " ".join(f"x{i}y{j}" for j in range(100))) for i in range(40)]
    got = {r.doc_id: r.component_id for r in jaccard.components(spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA).repartition(4)).collect()}
    want = components_plainly(docs)
    assert got == {k: v[1] for k, v in want.items()}
    assert all(signed[i] for i in range(1000, 1040))


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_repeat_the_least_number(seed):
    rng = np.random.default_rng(seed)
    for _ in range(3000):
        n = int(rng.integers(1, 120))
        a = rng.choice(10**6, n, replace=False)
        keep = rng.permutation(n)[:int(rng.integers(0, n + 1))]
        b = np.unique(np.concatenate([a[keep], rng.choice(10**6, int(rng.integers(0 if len(keep) else 1, n // 3 + 2)), replace=False)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (n + len(b) - both):
            continue
        sizes = np.array([n, len(b)])
        ends = jaccard._prefix_length(sizes) + jaccard._slack(sizes)
        met = len(np.intersect1d(np.sort(a)[:ends[0]], np.sort(b)[:ends[1]]))
        assert (met >= jaccard._least(sizes)).all()


def test_jaccard_links_between_regions_are_found(spark):
    """Two pivots' regions that only boundary documents link: a chain of sliding windows."""
    words = [f"w{i}" for i in range(140)]
    docs = [(i, " ".join(words[i * 4:i * 4 + 60])) for i in (3, 0, 5, 1, 4, 2, 12, 14, 13)]
    got = {r.doc_id: r.component_id for r in jaccard.components(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: c for i, (_, c) in components_plainly(docs).items()}


def test_jaccard_edges(spark):
    rows = [(4, "One two three"), (2, "one TWO three"), (8, "one two"), (1, None), (3, ""), (6, " \n"), (7, "É é"), (9, "é é"),
            (5, "x " * 3000), (5, "x " * 3000), (None, "one two three")]
    got = sorted([(str(r.doc_id), r.n_shingles, r.component_id)
                  for r in jaccard.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()])
    want = [("1", 0, 1), ("2", 1, 2), ("3", 0, 3), ("4", 1, 2), ("5", 1, 5), ("5", 1, 5), ("6", 0, 6), ("7", 1, 7), ("8", 1, 8),
            ("9", 1, 9), ("None", 1, 2)]
    assert got == sorted(want)
    assert jaccard.components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_jaccard_stage_keeps_one_of_each_group(spark):
    docs = corpus(4)
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA)
    kept = {r.doc_id for r in jaccard.stage_dedup(spark, df, "").collect()}
    assert kept == {c for _, c in components_plainly(docs).values()}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)] + [(200 + 2 * i, 201 + 2 * i) for i in range(10)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges * 2, "x long, y long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {201 + 2 * i: 200 + 2 * i for i in range(10)}
    assert {k: v for k, v in got.items() if k != v} == want
    assert graph.components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_sketch_never_underestimates(spark):
    values = [v for v in range(3000) for _ in range(1 + (v % 7 == 0) + 4 * (v % 50 == 0))]
    random.Random(1).shuffle(values)

    def draw(batch):
        yield batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(6)
    counts = sketch.build(df, draw, len(values), (2, 5))
    level = counts.level(np.arange(3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    true = collections.Counter(values)
    exact = np.array([(true[v] >= 2) + (true[v] >= 5) for v in range(3000)])
    assert (level >= exact).all() and (level == exact).mean() > 0.99


def test_merged_counters_do_not_wrap(spark):
    """One hash, 65,537 times over two tasks: 60,000 + 5,537, in either order."""
    docs = spark.createDataFrame(spark.sparkContext.parallelize([(60_000,), (5_537,)], 2), "n long")
    one = 0x123456789ABCDEF1

    def hashes(batch):
        for n in batch.column("n").to_pylist():
            yield np.full(n, one, np.uint64)

    assert sketch.build(docs, hashes, 65_537).may(np.array([one], np.uint64)).all()


def test_gap_coding_round_trip():
    cells = np.unique(np.random.default_rng(0).integers(0, 1 << 22, 5000))
    assert (sketch.unpack(sketch.pack(cells)) == cells).all()
    assert len(sketch.unpack(sketch.pack(cells[:0]))) == 0


def test_array_words_equal_the_pattern():
    import pyarrow as pa

    texts = ["a b", None, "", " \x1cx\u0085y z \x0bq\t\r\n", "é漢 é漢", "x" * 3000]
    data, offs = text_buffers(pa.array(texts))
    starts, ends, doc = find_words(data, offs)
    found = collections.defaultdict(list)
    for s, e, d in zip(starts, ends, doc):
        found[int(d)].append(bytes(data[s:e]).decode())
    assert [found[i] for i in range(len(texts))] == [WORD.findall(t or "") for t in texts]
    h = hash_words(data, starts, ends)
    assert h[list(doc).index(4)] == h[list(doc).index(4) + 1] and len(set(h.tolist())) == len(h) - 1
    w, at = hash_windows(h, doc, 2)
    assert [int(doc[i]) for i in at] == [int(d) for d, e in zip(doc, doc[1:]) if d == e]


def test_result_types(spark):
    df = substring.op2_substring(spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}
    df = jaccard.op4_jaccard(spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}
    assert df.filter(F.col("component_id") > F.col("doc_id")).count() == 0


def thue_morse(n):
    """A word over two letters and its complement: equal under every polynomial hash modulo 2^64 from 2,048 letters on."""
    bits = np.array([bin(i).count("1") & 1 for i in range(n)])
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_words_that_agree_under_every_base_differ(n):
    one, two = thue_morse(n)
    data, offs = text_buffers(pa.array([one, two]))
    starts, ends, _ = find_words(data, offs)
    for which in (0, 1):
        a, b = hash_words(data, starts, ends, which)
        assert a != b and (a >> np.uint64(32)) != (b >> np.uint64(32))


def test_colliding_words_do_not_repeat_windows_or_link_sets(spark):
    """No window of these documents is in another: nothing is removed, nothing linked."""
    one, two = thue_morse(2048)
    texts = [" ".join([one] * 13), " ".join([two] * 13), one, two, f"a {one} b c d", f"a {two} b c d"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["n_removed"] for r in substring.remove_repeats(df).collect()} == {0}
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.components(df).collect()} == {(i, i) for i in range(6)}


def test_sketch_pieces_round_trip_in_both_forms():
    rng = np.random.default_rng(8)
    forms = set()
    for n, top in ((0, 1), (1, 1 << 22), (50, 1 << 22), (16_000, 1 << 22), (1 << 20, 1 << 22), (1000, 1000)):
        cells = np.sort(rng.choice(top, n, replace=False)).astype(np.int64)
        blob = sketch.pack(cells)
        forms.add(blob[0])
        assert (sketch.unpack(blob) == cells).all() and len(sketch.unpack(blob)) == n
        assert len(blob) <= 1 + n + int((np.diff(cells, prepend=0) // 255).sum())
    assert forms == {0, 1}


def test_stage_leaves_one_row_per_group(spark):
    """Repeated rows, NULL ids, one id with two texts, texts without shingles, columns with internal names."""
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    third = " ".join(f"u{i}" for i in range(40))
    near = text.replace("w39", "x")
    rows = [(7, text), (7, text), (9, near), (None, text), (None, other), (None, other), (3, None), (3, None), (3, ""), (5, third), (5, "lone words here"), (4, " ")]
    df = spark.createDataFrame([(i, t, "tag", 1, 2) for i, t in rows], "doc_id long, text string, _tag string, _row int, _n int")
    out = jaccard.stage_dedup(spark, df.repartition(3), "")
    assert out.columns == df.columns and {tuple(r)[2:] for r in out.collect()} == {("tag", 1, 2)}
    want = [(7, text), (None, other), (3, None), (3, None), (3, ""), (5, third), (5, "lone words here"), (4, " ")]
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted(want, key=str)
    assert jaccard.stage_dedup(spark, df.filter("false"), "").count() == 0
