"""Columns named like an operator's own: every operator and stage over documents leaves them as given."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daycast.llm import jaccard, mixing, pieces, quality, secrets, substring

LLM = Path(quality.__file__).parent
MODULES = {"quality": quality, "jaccard": jaccard, "secrets": secrets, "mixing": mixing, "pieces": pieces, "substring": substring}
TABLE = {"doc_id", "text", "lang", "source"}
OPERATORS = {
    "judge": (quality.judge, set(quality.RESULTS)),
    "mix": (mixing.mix, {"size", "source_size", "target", "taken"}),
    "scan": (secrets.scan, {"spans"}),
    "redact": (secrets.redact, set()),
    "remove_repeats": (substring.remove_repeats, {"n_words", "n_removed", "kept"}),
}


def own_names(module: str) -> list[str]:
    """Every name that stands in quotes in a module and could be a column's, and what the operators give back."""
    found = re.findall(r"[\"']((?:[ab]\.)?_?[a-z][a-z0-9_]*)[\"']", (LLM / f"{module}.py").read_text())
    fences = [f"{m}_fence" for m in quality.MEASURES] if module == "quality" else []
    return sorted({n.split(".")[-1] for n in found} | set(fences) | {"_given_columns", "c0", "a.b", "ids", "decoded"})


def documents(spark):
    words = [f"w{i}" for i in range(70)]
    texts = [" ".join(words), " ".join(words), "token = abcdef0123 " + " ".join(words[::-1]), "short one", "", None]
    rows = [(i, t, "en", "web" if i % 2 else None) for i, t in enumerate(texts)] + [(None, texts[2], None, "web"), (3, "short one", "en", "web")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def rows_of(df, columns):
    return sorted(map(str, df.select(*[F.col(f"`{c}`") for c in columns]).collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_operators_leave_given_columns(spark, name):
    operator, results = OPERATORS[name]
    module = operator.__module__.split(".")[-1]
    plain, names = documents(spark), [n for n in own_names(module) if n not in TABLE | {"n_chars"}]
    assert results <= set(names)
    given = plain.select("*", *[F.lit(f"given {n}").alias(n) for n in names])
    out, want = operator(given), operator(plain)
    assert set(out.columns) == set(given.columns)
    assert rows_of(out, want.columns) == rows_of(want, want.columns)
    rest = [n for n in names if n not in results]
    assert {tuple(r) for r in out.select(*[F.col(f"`{n}`") for n in rest]).collect()} == {tuple(f"given {n}" for n in rest)}


@pytest.mark.parametrize("at", range(5))
def test_stages_leave_given_columns(spark, at):
    _, stage = corpus_pipeline.STAGES[at]
    module = stage.__module__.split(".")[-1]
    plain, names = documents(spark), [n for n in own_names(module) if n not in TABLE | {"n_chars"}]
    given = plain.select("*", *[F.lit(f"given {n}").alias(n) for n in names])
    out, want = stage(spark, given, ""), stage(spark, plain, "")
    last = at == 4
    assert out.columns == [c for c in given.columns if not (last and c == "text")]
    assert rows_of(out, want.columns) == rows_of(want, want.columns)
    rest = [n for n in names if not (last and n == "ids")]
    assert {tuple(r) for r in out.select(*[F.col(f"`{n}`") for n in rest]).collect()} == {tuple(f"given {n}" for n in rest)}
    empty = stage(spark, given.limit(0), "")
    assert empty.columns == out.columns and empty.count() == 0
