"""Command line smoke test."""

import uuid

from conftest import SMALL
from daycast.__main__ import main
from daycast.session import scratch_path


def test_cli_list_and_query(spark, capsys):
    assert main(["list"]) == 0
    keys = capsys.readouterr().out.split()
    assert "retrain_decision" in keys and len(keys) >= 50
    out = scratch_path(spark, f"cli-{uuid.uuid4().hex}")
    assert main(["query", "daily_totals", "--sf-dir", SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0
