"""Mixing sources to target weights by Sainte-Laguë apportionment.

A budget of words is dealt to sources by weight (water filling under a cap of
two passes), then cut into equal blocks that go to sources, and within a
source to its shards, by highest quotients.  Each shard fills its integer quota
with whole documents in a seeded order, and the one document that then brings
it nearest to the quota.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daycast.llm.carry import packed, unpacked
from daycast.llm.words import n_words

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, and passes over a source at most.
BUDGET, PASSES = 1.5, 2
#: Words in a block.
BLOCK = 16
#: Documents per (hash) shard of a source, at least; smaller sources are one shard.
SHARD_DOCS = 4096
SEED = 20261


def targets(sizes: DataFrame) -> DataFrame:
    """Adds ``weight`` and ``target`` to a table of ``source, source_size`` (one row per source).

    Water filling: with the level L, a source gets min(cap, weight * L).  In the
    order of cap / weight the full sources come first, so running sums give L.
    The windows run over one row per source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    filled = W.orderBy(F.col("ratio"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1)
    return (sizes.withColumn("weight", weight)
            .withColumn("cap", F.col("source_size") * F.lit(float(PASSES)))
            .withColumn("ratio", F.col("cap") / F.col("weight"))
            .withColumn("rest", F.sum("source_size").over(everything) * F.lit(BUDGET) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("level", F.col("rest") / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
            # the level seen by the first source that does not fill up holds for all after it
            .withColumn("level", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
            .withColumn("target", F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))))
            .drop("cap", "ratio", "rest", "level"))


def apportion(votes: DataFrame, by: list[str], vote: str, seats: str, order: list[str], out: str) -> DataFrame:
    """Sainte-Laguë: ``seats`` (a column, equal within ``by``) dealt by highest quotients vote / (2k - 1).

    Seats that are certain (the rounded-down share less a margin) are given at
    once; only quotients around the share are ranked.  The margin of a row is
    1 + (rows of its group) * its share of the votes, more than rounding of the
    other rows can ever shift, so the result is that of dealing one by one.
    Ties go to the first in ``order``.  Rows without votes get no seat.
    """
    group = W.partitionBy(*by)
    share = F.coalesce(F.try_divide(F.col(vote) * F.col(seats), F.col("_all")), F.lit(0.0))
    base = (votes.withColumn("_all", F.sum(vote).over(group).cast("double"))
            .withColumn("_n", F.count(F.lit(1)).over(group))
            .withColumn("_share", share)
            .withColumn("_margin", (F.lit(2) + F.ceil(F.col("_n") * F.coalesce(F.try_divide(F.col(vote).cast("double"), F.col("_all")), F.lit(0.0)))).cast("long"))
            .withColumn("_sure", F.greatest(F.lit(0).cast("long"), F.floor("_share") - F.col("_margin")))
            .withColumn("_open", F.col(seats) - F.sum("_sure").over(group)))
    quotients = (base.filter(F.col(vote) > 0)
                 .withColumn("_k", F.explode(F.sequence(F.col("_sure") + 1, F.floor("_share").cast("long") + F.col("_margin") + 1)))
                 .withColumn("_q", F.col(vote) / (2 * F.col("_k") - 1))
                 .withColumn("_rank", F.row_number().over(group.orderBy(F.col("_q").desc(), *[F.col(c).asc_nulls_last() for c in order])))
                 .filter(F.col("_rank") <= F.col("_open"))
                 .groupBy(*order).agg(F.count(F.lit(1)).alias("_won")))
    match = None
    for c in order:
        e = F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        match = e if match is None else match & e
    return (base.alias("a").join(quotients.alias("b"), match, "left")
            .select("a.*", (F.col("a._sure") + F.coalesce(F.col("b._won"), F.lit(0))).alias(out))
            .drop("_all", "_n", "_share", "_margin", "_sure", "_open"))


def mix(docs: DataFrame) -> DataFrame:
    """All documents with ``size, source_size, target, taken``.

    Needs ``doc_id, text, source``; other columns pass whatever their names (those
    named like one of the four results are replaced).  NULL texts have size 0 and take nothing; a
    NULL source is a source, last in order; repeated rows count and are taken
    one by one; without words every target is 0; no rows give no rows.
    ``taken`` counts words over at most two passes of a document; a pass takes
    the whole document, so it is 0, 1 or 2 times ``size``.

    Shuffled: one row per source and shard for the quotas, and the documents
    once, by (source, shard).  A shard is a hash of the document id, so a hot
    source is spread over many shards; their number follows the source's own
    number of documents.
    """
    return unpacked(_mixed(packed(docs)), docs, {c: F.col(c) for c in ("size", "source_size", "target", "taken")})


def _mixed(docs: DataFrame) -> DataFrame:
    keep = docs.columns
    sized = docs.select(*keep).withColumn("size", n_words("text"))
    # sources of several shards: at most one row per 2 * SHARD_DOCS documents
    parts = (docs.groupBy(F.col("source").alias("p_source")).agg(F.floor(F.count(F.lit(1)) / SHARD_DOCS).cast("long").alias("_parts"))
             .filter("_parts > 1"))
    lot = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(SEED))
    sized = (sized.withColumn("_lot", lot).join(F.broadcast(parts), F.col("source").eqNullSafe(F.col("p_source")), "left")
             .withColumn("_shard", F.pmod(F.col("_lot"), F.coalesce("_parts", F.lit(1).cast("long")))).drop("p_source", "_parts"))

    shards = sized.groupBy("source", "_shard").agg(F.sum("size").alias("shard_size"))
    sources = targets(shards.groupBy("source").agg(F.sum("shard_size").alias("source_size")))
    blocks = (sources.withColumn("_one", F.lit(1))
              .withColumn("seats", F.round(F.sum("target").over(W.partitionBy("_one")) / BLOCK).cast("long")))
    quota = apportion(blocks, ["_one"], "target", "seats", ["source"], "blocks").select("source", "source_size", "target", "blocks")
    per_shard = (shards.alias("s").join(quota.alias("q"), F.col("s.source").eqNullSafe(F.col("q.source")))
                 .select("s.source", "s._shard", "s.shard_size", "q.source_size", "q.target", "q.blocks"))
    # a source's blocks go to its shards by their sizes
    per_shard = apportion(per_shard, ["source"], "shard_size", "blocks", ["source", "_shard"], "shard_blocks")
    per_shard = per_shard.select(F.col("source").alias("q_source"), F.col("_shard").alias("q_shard"), "shard_size", "source_size", "target",
                                 F.least(F.col("shard_blocks") * BLOCK, F.col("shard_size") * PASSES).alias("quota"))

    shard = W.partitionBy("source", "_shard")
    order = shard.orderBy(F.xxhash64("_lot", F.lit(1)), "doc_id", "size")
    joined = sized.join(per_shard, F.col("source").eqNullSafe(F.col("q_source")) & (F.col("_shard") == F.col("q_shard")))
    whole = F.least(F.lit(PASSES), F.floor(F.coalesce(F.try_divide(F.col("quota"), F.col("shard_size")), F.lit(0)))).cast("long")
    # what the shard's passes leave of its quota, up to this document
    after = F.col("_rest") - F.sum("size").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    gap = F.coalesce(F.min(F.when(F.col("_after") >= 0, F.col("_after"))).over(shard), F.col("_rest"))
    # of the documents beyond, the one that brings the shard nearest to its quota (none, if all lead further away)
    off = F.abs(F.col("size") - F.col("_gap"))
    fits = (F.col("_after") < 0) & (off < F.col("_gap"))
    best = F.min(F.when(fits, F.struct(off.alias("off"), F.col("_place").alias("place")))).over(shard)["place"]
    chosen = (F.col("_after") >= 0) | F.coalesce(F.col("_place") == F.col("_best"), F.lit(False))
    return (joined.withColumn("_whole", whole).withColumn("_rest", F.col("quota") - F.col("_whole") * F.col("shard_size"))
            .withColumns({"_after": after, "_place": F.row_number().over(order)})
            .withColumn("_gap", gap).withColumn("_best", best)
            .withColumn("taken", ((F.col("_whole") + F.when(chosen, 1).otherwise(0)) * F.col("size")).cast("long"))
            .select(*keep, "size", F.col("source_size").cast("long").alias("source_size"), "target", "taken"))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: a row per pass over a document, its text unchanged (``n_chars``, if there, is its length).

    The other columns of ``docs`` pass as given, also those named like a result.
    NULL and empty texts take no words and so have no row; a NULL source is a
    source; repeated rows are taken one by one; an empty table stays empty.
    """
    mixed = _mixed(packed(docs)).filter("taken > 0")
    out = mixed.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.try_divide(F.col("taken"), F.col("size")).cast("int"))))
    length = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return unpacked(out, docs, length)
