"""Training-data pipeline over ``documents``: filter, deduplicate, blank secrets, mix, tokenize.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``, written as Parquet in the
shared folder and read again as the next one's ``docs``; all but the last keep
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from daycast.llm import jaccard, mixing, pieces, quality, secrets
from daycast.session import drop_stage, stage

STAGES = [
    ("quality_rules", quality.stage),
    ("jaccard_join", jaccard.stage_dedup),
    ("secret_scans", secrets.stage),
    ("source_mixing", mixing.stage),
    ("piece_encoding", pieces.stage),
]

#: SQL has no form of the quantile sketches, the piece search and the seeded shards; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the tables between them are removed as soon as the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), name)
        if before is not None:
            drop_stage(before)
        before = docs
    return docs
