"""Columns that an operator does not read travel in one struct, so that no name of theirs meets a name of the operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns that stay columns where a table of documents has them; operators never use these names for anything else.
KNOWN = ("doc_id", "text", "lang", "source")
GIVEN = "_given_columns"


def _named(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns but ``KNOWN`` in the struct ``GIVEN``; unchanged without such columns."""
    rest = [c for c in docs.columns if c not in KNOWN]
    if not rest:
        return docs
    return docs.select(*[c for c in docs.columns if c in KNOWN],
                       F.struct(*[_named(c).alias(f"c{i}") for i, c in enumerate(rest)]).alias(GIVEN))


def unpacked(df: DataFrame, docs: DataFrame, results: dict[str, Column] | None = None) -> DataFrame:
    """The columns of ``docs`` from ``df``, made from ``packed(docs)``; a result replaces a column of its name or is added."""
    results = results or {}
    rest = [c for c in docs.columns if c not in KNOWN]
    given = {c: F.col(c) if c in KNOWN else F.col(GIVEN).getField(f"c{rest.index(c)}") for c in docs.columns}
    return df.select(*[results.get(c, x).alias(c) for c, x in given.items()],
                     *[x.alias(c) for c, x in results.items() if c not in given])
