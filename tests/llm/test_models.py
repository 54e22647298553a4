"""Piece encoding, page text, neighbours, classifier and the pipeline."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from daycast.llm import classifier, neighbours, pages, pieces

SF = "/root/testdata/sf0.001"


# ---- pieces ----------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    with open(pieces.MODEL, "rb") as f:
        blob = f.read()
    return pieces.Pieces(blob), sentencepiece.SentencePieceProcessor(model_proto=blob)


def ids_of(p, text):
    return [i for s in pieces.segments(text) for i in p.encode_segment(s)] if text else []


HARD = ["Hello  world\nfoo  ", " ", "  ", "\n", "a", "    " * 9 + "x  y", "\t tab", "émigré ß ☃ 漢字 🎉 x", " lead", "trail ", "a\n\n b",
        "x" * 500, "the" * 300, "1234567890" * 50, "hello" + " " * 33 + "w", " \n ", "==>>==", "\u0000\u0007", "İﬀ é"]


def test_ids_equal_the_library(vocabulary):
    p, library = vocabulary
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz   \n.,ABCé漢"
    texts = HARD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(400)]
    for t in texts:
        got = ids_of(p, t)
        assert got == library.encode(t), t
        assert p.decode(np.array(got, np.int32)) == t


def test_search_commits_in_a_bounded_window(vocabulary):
    """The stream equals the search over the whole text, and yields long before the text ends."""
    p, library = vocabulary
    text = "▁" + "internationalisation" * 60
    read = 0

    def chars():
        nonlocal read
        for c in text:
            read += 1
            yield c

    out = p.search(chars())
    next(out)
    assert read <= 8 * p.longest
    assert [p.ids[x] for x in p.search(text)] == library.encode(text[1:])


def test_unigram_search_takes_the_best_path(vocabulary):
    p, _ = vocabulary
    with open(pieces.MODEL, "rb") as f:
        u = pieces.Pieces(f.read(), merges=False)
    rng = random.Random(3)
    for _ in range(40):
        s = "▁" + "".join(rng.choice("abcdeinorst") for _ in range(rng.randint(1, 90)))
        best = [0.0] + [-1e300] * len(s)
        for i in range(1, len(s) + 1):
            for j in range(max(0, i - u.longest), i):
                if s[j:i] in u.ids:
                    best[i] = max(best[i], best[j] + u.score[s[j:i]])
        got = list(u.search(s))
        assert "".join(got) == s and sum(u.score[x] for x in got) == pytest.approx(best[-1])


def test_literal_blank_marks_round_trip(vocabulary):
    p, _ = vocabulary
    for t in ("▁", "a▁b ▁ c", "▁▁ x"):
        assert p.decode(np.array(ids_of(p, t), np.int32)) == t


def test_encoding_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "one two", "x"), (3, "one two", "x"), (4, "long " * 30_000, "x"), (5, "z" * 40_000, "x")]
    out = pieces.encode(spark.createDataFrame(rows, "doc_id long, text string, ids string"))
    got = [(r.doc_id, list(r.ids), r.decoded) for r in out.collect()]
    assert [g[2] for g in sorted(got, key=lambda g: g[0])] == [t or "" for _, t, _ in rows]
    assert got[0][1] == [] and out.columns == ["doc_id", "text", "ids", "decoded"]
    assert pieces.encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_piece_query_round_trips(spark):
    got = pieces.op5_pieces(spark, SF)
    assert got.count() == got.filter("round_trip and n_ids = size(ids)").count() == 200


# ---- pages -----------------------------------------------------------------


@pytest.fixture(scope="module")
def trees(spark):
    return pages.fit(spark.read.parquet(f"{SF}/pages.parquet"))


ARTICLE = ("<h1>On  the\n title</h1><p>First &amp; <b>bold</b> text, long enough to be read.<p>Second&nbsp;paragraph &lt;x&gt; follows the first one."
           "<ul><li>an item of it<li>another item</ul><blockquote>Quoted words.</blockquote>")
TEXT = ("On the title\nFirst & bold text, long enough to be read.\nSecond paragraph <x> follows the first one.\nan item of it\nanother item\n"
        "Quoted words.")
AROUND = ('<header><a href="/">Site</a></header><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">About</a></li></ul></nav>',
          '<aside><p>Related reading</p></aside><section class="comments"><h2>Comments</h2><div class="comment"><p>Nice one!</p></div></section>'
          '<div class="cookie-notice"><p>We use cookies.</p></div><form><label>Mail</label><input><button>Go</button></form>'
          '<div class="ad">Buy now.</div><footer>&copy; us</footer></body>')


@pytest.mark.parametrize("opening,closing", [("<article>", "</article>"), ('<div class="post-content">', "</div>"), ("<main><article>", "</article></main>")])
def test_main_text(trees, opening, closing):
    page = f"<html><head><title>t</title><script>var a='<p>no</p>';</script></head><body>{AROUND[0]}{opening}{ARTICLE}{closing}{AROUND[1]}"
    assert pages.main_text(page, trees) == TEXT


SENTENCE = "The council met on Monday evening and agreed on a plan for the old harbour, which will be rebuilt over the next four years. "


def test_broken_and_odd_pages(trees):
    for page in ("<", "<p", "</p>", "<!--", "<script>never closed", "a<b", "<div class='x", "&bogus; &#x41;", "<p><p><p>", "<a><a></b></a>"):
        pages.main_text(page, trees)
    assert pages.main_text("no   markup\n at all", trees) == "no markup at all"
    assert pages.main_text("<article><p>cut off in the middle of the te", trees) == "cut off in the middle of the te"


@pytest.mark.parametrize("page,want", [
    (f"<article><p title=it's>{SENTENCE}</p><p>More of it's text, and {SENTENCE}</p></article>", [SENTENCE, f"More of it's text, and {SENTENCE}"]),
    (f"<article><p>{SENTENCE}</p><p>< 5 percent of {SENTENCE}", [SENTENCE, f"< 5 percent of {SENTENCE}"]),
    (f"<article><p>{SENTENCE}</p><!--><p>kept, and {SENTENCE}</p><!---><p>{SENTENCE}</p></article>", [SENTENCE, f"kept, and {SENTENCE}", SENTENCE]),
    (f"<article><p>{SENTENCE}</p><!-- no --!><p>{SENTENCE}</p><p>{SENTENCE}<b class=", [SENTENCE] * 3),
    (f'<article><p>{SENTENCE}</p><form><select><option>no</form><p>{SENTENCE}</p></article>', [SENTENCE] * 2),
    (f'<article><p title="a>b" lang=en>{SENTENCE}</p><p class="x>{SENTENCE}</p></article>', [SENTENCE] * 2),
])
def test_malformed_pages_lose_nothing(trees, page, want):
    assert pages.main_text(page, trees) == "\n".join(" ".join(w.split()) for w in want)


@pytest.mark.parametrize("unit", ['<a title="x ', "<div><a ", "<h1><a ", "<svg/><svg ", "<a <b>", "<p a='x>", "</b ", "<!--", "<script>", "<title <title "])
def test_long_malformed_pages_are_read_in_one_pass(trees, unit):
    import time

    began = time.process_time()
    pages.main_text(unit * (2_000_000 // len(unit)), trees)
    assert time.process_time() - began < 20  # some 1 to 4 seconds; by the square it would be hours


def test_long_page_is_read_whole(trees):
    n = 5_000
    got = pages.main_text("<nav><a href=/>Home</a></nav><article>" + f"<p>{SENTENCE}</p>" * n + "</article><footer>end</footer>", trees)
    assert got == "\n".join([SENTENCE.strip()] * n)


def test_sample_takes_copies_once(spark):
    page = "<nav><a href=/>Home</a></nav><article><p>" + SENTENCE + "</p></article><footer>end</footer>"
    df = spark.createDataFrame([(1, page)] * 300 + [(i, page.replace("plan", f"plan {i}")) for i in range(2, 6)], "page_id long, html string")
    got = pages.extract(df).collect()
    assert len(got) == 304 and all(r.text.startswith("The council met") and "Home" not in r.text for r in got)


def test_decoding_keeps_nothing_below_a_dropped_element():
    nodes = pages.read_page("<nav><p>in</p></nav><article><p>yes, all of this</p><aside>no</aside></article>")
    score = np.array([0, -3, 0.5, 2, 1, -2], float)
    assert pages.decode(nodes, score)[1:] == [False, False, True, True, False]


@pytest.mark.parametrize("page,want", [
    (f"<body><h1>T</h1>{SENTENCE}<br><br>And <b>then</b> {SENTENCE}</body>", ["T", f"{SENTENCE}And then {SENTENCE}"]),
    (f"<html><head><title>t</title><meta charset=utf-8><body><article><h1>T</h1><p>{SENTENCE}</p></article></body>", ["T", SENTENCE]),
    (f"<html><head><title>t</title><article><h1>T</h1><p>{SENTENCE}</p></article>", ["T", SENTENCE]),
    (f'<article><h1>T</h1><svg width="1"/><iframe src="x" /><p>{SENTENCE}</p><svg/><p>{SENTENCE}</p><svg><text>no</text></svg></article>', ["T", SENTENCE, SENTENCE]),
    (f"<article><h1>T</h1><math/><p>{SENTENCE}</p><script src=/a/>var no = 1;</script><script/>no<p>no</script></article>", ["T", SENTENCE]),
    (f"<article><h1>T</h1><p>{SENTENCE} where <math><mi>a</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>", ["T", f"{SENTENCE} where a=2 holds."]),
])
def test_pages_of_other_shapes(trees, page, want):
    assert pages.main_text(page, trees) == "\n".join(" ".join(w.split()) for w in want)


def test_place_among_many_siblings():
    nodes = pages.read_page("<article>" + "<p>four</p>" * 100 + "</article>")
    x = pages.features(nodes)
    assert np.allclose(x[2:, -2], 0.01)


def test_all_given_pages(spark):
    import html
    import re

    got = pages.op6_pages(spark, SF).collect()
    raw = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(raw)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", raw[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?p>|</?h1>", inner)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_page_edges(spark):
    rows = [(1, None, "u"), (2, "", "u"), (3, "<article><p>x y z</p></article>", "u"), (3, "<article><p>x y z</p></article>", "u")]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, html string, text string")).collect()
    assert [r.text for r in got] == ["", "", "x y z", "x y z"]
    assert pages.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


# ---- neighbours ------------------------------------------------------------


def nearest_plainly(ids, x, is_query, top=10):
    out = {}
    for i, q in enumerate(ids):
        if is_query(q):
            d = np.sqrt(((x - x[i]) ** 2).sum(1))
            d[i] = np.inf
            order = np.lexsort((ids, d))[:top]
            out[q] = [(int(ids[j]), d[j]) for j in order if np.isfinite(d[j])]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 32))
    x = (centres[rng.integers(0, 30, 6000)] + 0.5 * rng.normal(size=(6000, 32))).astype(np.float32).astype(float)
    x[3000:5000] = x[17]  # a third of all vectors are one
    ids = np.arange(6000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = neighbours.search(df, F.col("vec_id") % 100 == 0).collect()
    want = nearest_plainly(ids, x, lambda i: i % 100 == 0)
    by = {q: sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) for q in want}
    hits = sum(len({v for _, v, _ in by[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, rows in by.items():
        assert [r for r, _, _ in rows] == list(range(1, 11)) and q not in [v for _, v, _ in rows]
        for _, v, s in rows:
            assert s == pytest.approx(np.sqrt(((x[q] - x[v]) ** 2).sum()), abs=1e-12)
    assert [v for _, v, _ in by[3100]] == [17, *range(3000, 3009)]  # ties go to the smaller id


def test_recall_where_the_index_prunes(spark):
    """60,000 clustered vectors, a third of them one vector or close to it, with groups around that hot place."""
    rng = np.random.default_rng(6)
    n, dim = 60_000, 32
    centres = rng.normal(size=(300, dim))
    x = centres[rng.integers(0, 300, n)] + 0.4 * rng.normal(size=(n, dim))
    hot = x[0].copy()
    x[:12_000] = hot
    x[12_000:20_000] = hot + 0.01 * rng.normal(size=(8_000, dim))
    around = hot + 0.6 * rng.normal(size=(100, dim))
    x[20_000:22_000] = np.repeat(around, 20, axis=0) + 0.2 * rng.normal(size=(2_000, dim))
    x = x.astype(np.float32)
    perm = rng.permutation(n)  # ids say nothing about the place
    asked = np.concatenate([np.arange(20_000, 22_000, 20), np.arange(22_000, n, 380)])
    table = pa.table({"vec_id": perm, "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dim).cast(pa.list_(pa.float32())),
                      "q": np.isin(np.arange(n), asked)})
    got = neighbours.search(spark.createDataFrame(table).repartition(8), F.col("q")).toPandas()
    x = x.astype(float)
    hits = {}
    for i in asked:
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        d[i] = np.inf
        last = np.sort(d)[9]
        hits[i] = (got["score"][got["query_id"] == perm[i]] <= last + 1e-9).sum() / 10
    near = np.mean([h for i, h in hits.items() if i < 22_000])
    rest = np.mean([h for i, h in hits.items() if i >= 22_000])
    print(f"recall around the hot place {near:.3f}, elsewhere {rest:.3f}")
    assert near >= 0.9 and rest >= 0.9


def vector_table(x, ids=None):
    flat = pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
    return pa.table({"vec_id": np.arange(len(x)) if ids is None else ids, "embedding": flat})


def test_recall_without_structure(spark):
    """20,000 vectors that no index prunes well: the walks go as far as the true neighbours lie."""
    x = np.random.default_rng(8).normal(size=(20_000, 64)).astype(np.float32).astype(float)
    got = neighbours.search(spark.createDataFrame(vector_table(x)), F.col("vec_id") % 200 == 0).toPandas()
    want = nearest_plainly(np.arange(len(x)), x, lambda i: i % 200 == 0)
    hits = sum(len({v for v, _ in want[q]} & set(got["vec_id"][got["query_id"] == q])) for q in want)
    assert hits >= 0.95 * 10 * len(want)


def test_rows_that_come_twice(spark):
    """Each of two equal query rows gets its ten nearest; the other row is one of them."""
    x = np.random.default_rng(9).normal(size=(40, 4)).astype(np.float32).astype(float)
    ids = np.repeat(np.arange(40), 2)
    got = neighbours.search(spark.createDataFrame(vector_table(np.repeat(x, 2, axis=0), ids)), F.col("vec_id") % 20 == 0).collect()
    for q in (0, 20):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        one = [q, *np.repeat(np.argsort(d)[1:], 2)][:10]
        assert sorted((r.rank, r.vec_id) for r in got if r.query_id == q) == sorted(2 * list(enumerate(one, 1)))


def test_walks_reach_a_cell_with_what_it_needs():
    rng = np.random.default_rng(10)
    d1, d2, count = rng.random(30), rng.random(40), rng.integers(0, 60, 1200)
    count[rng.integers(0, 1200, 5)] = 5_000
    cells = rng.choice(np.flatnonzero(count), 40, replace=False)
    for cell, enough in zip(cells, neighbours.needed(d1, d2, count, cells)):
        assert cell in neighbours.walk(d1, d2, count, enough)
        assert enough == 1 or cell not in neighbours.walk(d1, d2, count, enough - 1)


def test_closest_measures_exactly():
    """Far from zero, beside one huge vector and with ties, the product drops nothing that is nearest."""
    rng = np.random.default_rng(12)
    m = (3e6 + rng.normal(size=(700, 16))).astype(np.float32).astype(float)
    m[5] *= 1e15
    m[100:130] = m[99]
    e, q = m[90:140], np.arange(90, 140)
    rows, cols, d = neighbours.closest(m, np.arange(700), e, q, 10)
    want = nearest_plainly(np.arange(700), m, lambda i: 90 <= i < 140)
    for i, query in enumerate(q):
        assert list(zip(cols[rows == i].tolist(), d[rows == i])) == want[query]


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0]),
            (None, [1.0, 1.0]), (8, [1.0, 0.0]), (9, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.search(df, F.col("vec_id") == 0).collect()]
    assert sorted(got) == [(0, 1, 8, 0.0), (0, 2, 1, pytest.approx(2 ** 0.5))]
    assert neighbours.search(df.filter("vec_id in (2, 3)"), F.lit(True)).count() == 0
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


def test_cells_are_walked_by_summed_distance():
    d1, d2 = np.array([3.0, 1.0, 2.0]), np.array([0.5, 0.1])
    count = np.ones(6, int)
    order = neighbours.walk(d1, d2, count, 6)
    sums = [d1[c // 2] + d2[c % 2] for c in order]
    assert sums == sorted(sums) and len(set(order)) == 6
    count[order[0]] = 0
    assert neighbours.walk(d1, d2, count, 1) == [order[1]]


def test_one_hot_cell_does_not_end_the_walk():
    d1, d2 = np.arange(20.0), np.arange(20.0) / 50
    count = np.ones(400, int)
    count[0] = 1_000_000
    assert len(neighbours.walk(d1, d2, count, 2_000)) == 400
    assert len(neighbours.walk(d1, d2, np.full(400, 1_000_000), 2_000)) == neighbours.LEAST_CELLS


# ---- classifier ------------------------------------------------------------


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{d}/labels.parquet")
    got = classifier.op9_classifier(spark, d).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and np.mean([r.predicted == r.quality for r in held]) >= 0.95


def test_classifier_edges(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "some words here", "a"), (3, "some words here", "a"), (None, "x", "a"),
                                  (4, "y " * 50_000, "a")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(3, 1), (4, 0), (1, None), (77, 1)], "doc_id long, quality int")
    for lab in (labels, labels.limit(0)):
        out = classifier.score(docs, lab)
        rows = out.collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert classifier.score(docs.limit(0), labels).count() == 0


def test_labels_of_held_out_rows_and_other_columns_are_never_used(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    flipped = labels.withColumn("quality", F.when(classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in classifier.score(docs.select("doc_id", "text"), labels).collect()}
    b = {r.doc_id: r.score for r in classifier.score(docs.withColumn("lang", F.lit("?")), flipped).collect()}
    assert a == pytest.approx(b, abs=1e-6)


# ---- pipeline --------------------------------------------------------------


def test_pipeline_follows_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, [docs.count()]
    for name, f in corpus_pipeline.STAGES[:-1]:
        docs = f(spark, docs, SF).cache()
        assert docs.columns == columns, name
        rows.append(docs.count())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert rows[1] < rows[0] and rows[2] < rows[1] and rows[3] == rows[2] and last.count() == rows[4]
    got = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, len(r.ids), sum(r.ids)) for r in df.collect())
    assert key(got) == key(last)


def test_pipeline_of_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
    assert docs.count() == 0
