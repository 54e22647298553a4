"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Features are computed inside each row by array functions: a whole text never
leaves its row, so nothing but small feature sketches is shuffled.  The limits
are upper fences of quantile sketches kept per (language, source); a sketch of
a language is the merge of its sources' sketches, that of the corpus the merge
of all languages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daycast.llm.carry import packed, unpacked
from daycast.llm.words import BLANKS, text_of, word_array
from daycast.session import stage as stage_table

SYMBOLS = "#*$%&|<>"

#: Measures held against a fence, and the least spread each is given (a corner
#: of a corpus where all documents agree would otherwise reject any deviation).
MEASURES = {"symbol_share": 0.01, "dup_line_share": 0.1, "repeat_share": 0.1}
#: Fence: upper quartile plus this many spreads (quartile distance).
FENCE = 4.0
#: Documents at which a source's own quartiles weigh as much as its language's.
PRIOR = 200.0


def features(docs: DataFrame) -> DataFrame:
    """Adds ``n_words, word_chars, n_lines, n_symbols, n_dup_lines, n_repeat_words`` and ``base_failed``.

    NULL texts count as empty (no words, zero everywhere, ``base_failed``).
    Further columns of the input pass through; a column that bears the name of
    a feature is replaced.
    """
    text = text_of("text")

    def hashed(w: Column, i: Column) -> Column:
        return F.struct(F.xxhash64(w, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2)).alias("h"), i.alias("i"))

    def twice(x: Column, i: Column) -> Column:
        return (F.get(F.col("_g"), i - 1)["h"].eqNullSafe(x["h"])) | (F.get(F.col("_g"), i + 1)["h"].eqNullSafe(x["h"]))

    covered = F.aggregate(
        "_r", F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("sum")),
        lambda a, x: F.struct(x.alias("last"), (a["sum"] + F.least(F.lit(3), x - a["last"])).alias("sum")),
        lambda a: a["sum"])
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    return (docs
            .withColumn("_w", word_array("text"))
            .withColumn("_l", lines)
            .withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", F.length(F.translate(text, BLANKS, "")).cast("long"))
            .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
            .withColumn("n_lines", F.size("_l").cast("long"))
            .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
            # windows as (hash, position), sorted: equal windows stand side by side
            .withColumn("_g", F.sort_array(F.transform(F.slice("_w", 1, F.greatest(F.size("_w") - 2, F.lit(0))), hashed)))
            .withColumn("_r", F.sort_array(F.transform(F.filter("_g", twice), lambda x: x["i"])))
            .withColumn("n_repeat_words", covered)
            .withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
            .drop("_w", "_l", "_g", "_r")
            # a filter on a feature must not be pushed below: it would be computed once for each mention
            .withColumn("_row", F.monotonically_increasing_id()))



_SHARES = {"symbol_share": ("n_symbols", "word_chars"), "dup_line_share": ("n_dup_lines", "n_lines"),
           "repeat_share": ("n_repeat_words", "n_words")}


def _measure(name: str) -> Column:
    a, b = _SHARES[name]
    return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))


def fences(feats: DataFrame, k: int = 2000) -> DataFrame:
    """Upper limits per (lang, source): ``lang, source`` and one column ``<measure>_fence`` each.

    Quantile sketches (KLL, parameter ``k``) are built per (lang, source) with
    map-side partial aggregation, so a hot source shuffles one sketch per task.
    Sketches merge upward; a source with few documents leans on its language,
    a language on the corpus, with weight ``PRIOR`` documents.  The result has a
    row per (lang, source); NULLs are a group of their own.
    """
    # a written table: three readers, one pass over the documents
    own = stage_table(feats.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(_measure(m), F.lit(k)).alias(m) for m in MEASURES]), "sketches")

    def quartiles(df: DataFrame, tag: str) -> list[Column]:
        return [F.kll_sketch_get_quantile_double(F.col(m), F.lit(q)).alias(f"{m}_{tag}{i}")
                for m in MEASURES for i, q in ((1, 0.25), (3, 0.75))]

    merged = [F.kll_merge_agg_double(F.col(m)).alias(m) for m in MEASURES]
    lang = own.groupBy("lang").agg(F.sum("n").alias("n"), *merged)
    corpus = lang.agg(F.lit(1).alias("one"), *merged).select("one", *quartiles(own, "all"))
    by_lang = (lang.withColumn("one", F.lit(1)).join(corpus, "one")
               .select("lang", F.col("n").alias("n_lang"), *quartiles(own, "lang"),
                       *[f"{m}_all{i}" for m in MEASURES for i in (1, 3)]))
    both = (own.select("lang", "source", "n", *quartiles(own, "own")).alias("a")
            .join(by_lang.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang"))).drop(F.col("b.lang")))

    def blended(m: str, i: int) -> Column:
        up = (F.col("n_lang") * F.col(f"{m}_lang{i}") + PRIOR * F.col(f"{m}_all{i}")) / (F.col("n_lang") + PRIOR)
        return (F.col("n") * F.col(f"{m}_own{i}") + PRIOR * up) / (F.col("n") + PRIOR)

    # limits are rounded up to a grid so that the sketches' random compaction does not move them
    return both.select("lang", "source", *[
        (F.ceil((blended(m, 3) + FENCE * F.greatest(blended(m, 3) - blended(m, 1), F.lit(least))) * 200) / 200)
        .alias(f"{m}_fence") for m, least in MEASURES.items()])


RESULTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed",
           *[f"{m}_fence" for m in MEASURES], "kept")


def judge(docs: DataFrame, texts: bool = True) -> DataFrame:
    """All documents with their features, fences and ``kept`` (``RESULTS``).

    ``docs`` needs ``text, lang, source``; all its columns stay whatever their
    names, but those named like a result are replaced.  NULL or empty texts fail
    the base rules; ties at a fence are kept; repeated rows get equal verdicts; an
    empty table gives an empty table.  Only sketches are shuffled.  With ``texts`` the
    documents are read twice, for the sketches and for the verdict; without, the
    result has no ``text`` column and the features of one pass are written down.
    """
    done = _judged(packed(docs), texts)
    return unpacked(done, docs if texts else docs.drop("text"), {c: F.col(c) for c in RESULTS})


def _judged(docs: DataFrame, texts: bool) -> DataFrame:
    if texts:
        feats, seen = features(docs), features(docs.select("text", "lang", "source"))
    else:
        feats = seen = stage_table(features(docs).drop("text"), "features")
    limit = fences(seen).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    inside = None
    for m in MEASURES:
        ok = _measure(m) <= F.coalesce(F.col(f"{m}_fence"), F.lit(1.0))
        inside = ok if inside is None else inside & ok
    return (feats.join(limit, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("kept", ~F.col("base_failed") & inside & (F.col("_row") >= 0)))


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return judge(docs, texts=False).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go.

    The columns of ``docs`` pass as given, also those named like a result.  NULL
    and empty texts are rejected (base rules), repeated rows stay or go together,
    ties at a fence stay, an empty table stays empty.
    """
    return unpacked(_judged(packed(docs), True).filter("kept"), docs)
