"""Validation over increments: the state after n deliveries equals one full validation."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from daycast.operators import validate as V
from daycast.operators import validate_state as VS
from daycast.session import scratch_path
from daycast.sources import sinks as SK

RULES = {"target": {"allow_negative": False, "max_value": 80.0}, "regressors": {"t": {"min_value": 5.0}, "absent": {"min_value": 1.0}}}


@pytest.fixture
def root(spark):
    return scratch_path(spark, f"state-{uuid.uuid4().hex}")


def frame(spark, days, seed=1):
    rng = random.Random(seed)
    out = []
    for d in days:
        for s in ("a", "b", None):
            for _ in range(rng.randint(1, 6)):
                out.append((s, dt.date(2024, 1, 1) + dt.timedelta(days=d), rng.choice([None, -1.0, 10.0, 90.0]), rng.choice([None, 1.0, 9.0])))
        out += [("a", dt.date(2024, 1, 1) + dt.timedelta(days=d), 7.0, 7.0)] * rng.randint(1, 3)
    return spark.createDataFrame(out, "series_id string, ds date, y double, t double")


def full(df):
    """The same figures by the checks over all rows at once."""
    nulls = {(s, c): n for s, c, n in rows(V.null_counts(df), "series_id", "column", "null_count")}
    rules = sorted(rows(V.rule_violations(df, RULES), "series_id", "scope", "column", "rule", "violations"), key=str)
    copies = dict(rows(V.duplicate_rows(df)))
    gaps = {s: (n, text) for s, n, text in rows(V.missing_days_report(df))}
    return nulls, rules, copies, gaps


def stored(state):
    nulls = {(s, c): n for s, c, n in rows(VS.null_counts(state), "series_id", "column", "null_count")}
    rules = sorted(rows(VS.rule_violations(state), "series_id", "scope", "column", "rule", "violations"), key=str)
    rep = VS.report(state).collect()
    return nulls, rules, {r["series_id"]: r["duplicated_rows"] for r in rep}, {r["series_id"]: (r["missing_count"], r["missing_range"]) for r in rep}


def test_deliveries_equal_one_full_validation(spark, root):
    parts = [frame(spark, d, seed) for seed, d in enumerate((range(0, 3), range(3, 40), [60], range(41, 45)))]
    whole = parts[0]
    for i, p in enumerate(parts):
        state = VS.deliver(p, root, str(i), rules=RULES)
        whole = p if i == 0 else whole.unionByName(p)
        assert stored(state) == full(whole)
    assert state.groupBy("series_id", "day").count().filter("count > 1").isEmpty()


def test_a_day_delivered_again_replaces_its_rows(spark, root):
    VS.deliver(frame(spark, range(0, 5)), root, "1", rules=RULES)
    again = frame(spark, [2], seed=9).filter("series_id = 'b'")  # series a and NULL have no rows on that day any more
    state = VS.deliver(again, root, "2", rules=RULES)
    assert stored(state) == full(frame(spark, range(0, 5)).filter(F.col("ds") != dt.date(2024, 1, 3)).unionByName(again))
    # the same delivery once more changes nothing
    assert stored(VS.deliver(again, root, "2", rules=RULES)) == stored(state)


def test_undated_rows_belong_to_their_delivery(spark, root):
    bare = spark.createDataFrame([("a", None, 1.0, None)], "series_id string, ds date, y double, t double")
    for run in ("1", "2", "2"):
        state = VS.deliver(frame(spark, [0]).unionByName(bare), root, run, rules=RULES)
    assert state.filter("day is null").agg(F.sum("n_rows")).first()[0] == 2


def test_a_delivery_touches_its_months_only(spark, root):
    VS.deliver(frame(spark, range(0, 70)), root, "1", rules=RULES)
    path = SK.artifact_path(root, VS.ARTIFACT)[0]
    before = {tuple(p) for p in SK.pointer(spark, path)["parts"]}
    VS.deliver(frame(spark, [70]), root, "2", rules=RULES)
    after = {tuple(p) for p in SK.pointer(spark, path)["parts"]}
    assert {os.path.basename(p) for _, p in after - before} == {"month=2024-03"} and len(after) == 3


def test_empty_delivery(spark, root):
    state = VS.deliver(frame(spark, [0]).filter("false"), root, "1", rules=RULES)
    assert state.count() == 0 and VS.report(state).count() == 0
