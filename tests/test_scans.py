"""Each raw table is scanned once in a query's executed plan (repeated
consumers read the staged tables instead)."""

import importlib.util
import os

import pytest

import __spark_entry__ as E
from conftest import SMALL

_spec = importlib.util.spec_from_file_location(
    "scan_audit", os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "scan_audit.py"))
audit = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(audit)

RAW = ("orders", "customer", "lineitem", "events")


@pytest.mark.parametrize("key", ["daily_totals", "missing_days", "holiday_windows", "zero_repair", "sorted_check",
                                 "retrain_decision", "retrain_decision_by_nation", "validation_report",
                                 "weather_union_first", "json_records_flatten"])
def test_raw_tables_scanned_once(spark, key):
    df = E.queries()[key](spark, SMALL)
    df.collect()
    scans = audit.executed_scans(df)
    assert all(scans[t] <= 1 for t in RAW), dict(scans)
