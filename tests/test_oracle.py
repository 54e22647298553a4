"""Every registered query equals its DuckDB oracle on the smallest fixture."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rs))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_rows_only():
    from daycast.plans.catalog import QUERIES

    assert set(QUERIES) - set(ORACLE) <= {"ridge_forecast", "tuned_forecast", "tuned_report"}
    assert set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[key])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, got) == _canon(ocols, exp)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["series_id", "model_name", "window_size", "baseline", "mae_window", "mase_window",
                          "should_retrain"]
    assert df.count() >= 0
