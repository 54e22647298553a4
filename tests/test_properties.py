"""Property tests (few examples each: every example is a Spark job)."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from daycast.functions.metrics import metric
from daycast.operators.clean import repair_zeros, repair_zeros_raw
from daycast.operators.sequence import ordered_neighbors
from daycast.operators.validate import rule_violations

SETTINGS = dict(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.one_of(st.none(), st.sampled_from([0.0, 0.0, 1.0, 2.5, 7.0, -3.0])), min_size=1, max_size=40)


@settings(**SETTINGS)
@given(series=st.lists(values, min_size=1, max_size=3), width=st.integers(1, 9))
def test_neighbors_match_window(spark, series, width):
    data = [(f"s{i}", j, v) for i, vals in enumerate(series) for j, v in enumerate(vals)]
    df = spark.createDataFrame(data, "k string, o int, v double")
    w = Window.partitionBy("k").orderBy("o")
    exp = df.select("k", "o", F.lag("v", 1).over(w).alias("v_prev1"), F.lead("v", 2).over(w).alias("v_next2"))
    got = ordered_neighbors(df, "k", ["o"], "v", before=1, after=2, bucket=F.floor(F.col("o") / width))
    cols = ["k", "o", "v_prev1", "v_next2"]
    assert sorted(rows(got, *cols), key=str) == sorted(rows(exp, *cols), key=str)


@settings(**SETTINGS)
@given(vals=values, width=st.integers(1, 5))
def test_zero_repair_matches_pandas(spark, vals, width):
    df = spark.createDataFrame([("s", i, i, v) for i, v in enumerate(vals)], "series_id string, ds int, ev int, y double")
    s = pd.Series([np.nan if v is None else v for v in vals], dtype="float64")
    m = s.replace(0, np.nan).rolling(5, min_periods=1, center=True).mean()
    exp = s.where(s != 0, m).tolist()
    for out in (repair_zeros(df), repair_zeros_raw(df, "series_id", ["ds", "ev"], "y", bucket=F.floor(F.col("ds") / width))):
        got = [r[1] for r in sorted(rows(out, "ds", "y"))]
        for a, b in zip(got, exp):
            assert (a is None and np.isnan(b)) or (a is not None and abs(a - b) < 1e-9)


@settings(**SETTINGS)
@given(lo=st.floats(-5, 5), widen=st.floats(0, 5))
def test_widening_rule_never_adds_violations(spark, lo, widen):
    df = spark.createDataFrame([("s", float(v)) for v in range(-6, 7)], "series_id string, y double")
    def n(rule):
        return sum(r[0] for r in rows(rule_violations(df, rule), "violations"))
    assert n({"target": {"min_value": lo - widen, "max_value": lo + 1 + widen}}) <= \
        n({"target": {"min_value": lo, "max_value": lo + 1}})


def test_metric_registry(spark):
    import pytest

    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "y double, yhat double")
    assert df.select(metric("mae").alias("m")).first()["m"] == 1.5
    with pytest.raises(ValueError):
        metric("wape")
