"""Landing folder and day layout: files are read once, fetches read one folder."""

import datetime as dt
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from daycast.operators.daily import fetch_window
from daycast.session import scratch_path
from daycast.sources import landing as LD
from daycast.sources import layout as LY


@pytest.fixture
def base(spark):
    path = scratch_path(spark, f"landing-{uuid.uuid4().hex}")
    os.makedirs(os.path.join(path, "in", "sub"))
    return path


def put(base, name, text):
    with open(os.path.join(base, "in", name), "w") as f:
        f.write(text)


def names(df):
    return sorted((os.path.basename(r["file"]), *[v for c, v in r.asDict().items() if c != "file"]) for r in df.collect())


def records(*values):
    return [{"jour": d, "conso_jour": v} for d, v in values]


def test_a_second_run_reads_nothing(spark, base):
    put(base, "a.json", json.dumps({"records": [{"record": r} for r in records(("2024-01-01", 1.0), ("2024-01-02", 2.0))]}, indent=2))
    put(base, "sub/b.json", json.dumps({"results": records(("2024-01-03", 3.0))}))
    put(base, "bad.json", '{"records": [')
    put(base, "list.json", "[1, 2]")
    put(base, "none.json", "")
    put(base, "empty.json", '{"records": []}')
    put(base, "neither.json", '{"other": 1}')
    assert LD.ingest(spark, base + "/in", base) == 6
    got, bad = LD.landed(spark, base)
    want = [("a.json", "2024-01-01", 1.0), ("a.json", "2024-01-02", 2.0), ("b.json", "2024-01-03", 3.0)]
    assert names(got) == want
    assert names(bad) == [("bad.json", '{"records": ['), ("list.json", "[1, 2]")]
    assert LD.ingest(spark, base + "/in", base) == 0
    put(base, "c.json", json.dumps({"records": records(("2024-01-04", None))}))
    assert LD.ingest(spark, base + "/in", base) == 1
    got, bad = LD.landed(spark, base)
    assert sorted(names(got), key=str) == sorted([*want, ("c.json", "2024-01-04", None)], key=str) and bad.count() == 2


def test_rows_and_rejects_are_all_records(spark, base):
    """Many files over many small batches: each is one or the other, and counted once."""
    for i in range(23):
        put(base, f"{i:02}.json", json.dumps({"records": records(*[(f"2024-02-{k + 1:02}", float(i)) for k in range(i % 4 + 1)])})[:None if i % 5 else 9])
    assert LD.ingest(spark, base + "/in", base, batch_files=4) == 23
    got, bad = LD.landed(spark, base)
    assert got.count() == sum(i % 4 + 1 for i in range(23) if i % 5) and bad.count() == sum(i % 5 == 0 for i in range(23))


def test_a_run_that_dies_is_repeated_whole(spark, base, monkeypatch):
    put(base, "a.json", json.dumps({"records": records(("2024-01-01", 1.0))}))
    real = LD.SHAPES["records"]
    dies = lambda text: (F.raise_error(F.lit("task gone")).cast("boolean"), real(text)[1])
    monkeypatch.setitem(LD.SHAPES, "records", dies)
    with pytest.raises(Exception, match="task gone"):
        LD.ingest(spark, base + "/in", base)
    monkeypatch.setitem(LD.SHAPES, "records", real)
    LD.ingest(spark, base + "/in", base)
    assert names(LD.landed(spark, base)[0]) == [("a.json", "2024-01-01", 1.0)]


def test_weather_arrays(spark, base):
    full = {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [1.0, 2.0], "temperature_2m_min": [0.0, None], "temperature_2m_mean": [0.5, 1.0]}
    put(base, "w.json", json.dumps({"daily": full}))
    put(base, "short.json", json.dumps({"daily": {**full, "temperature_2m_min": [0.0]}}))
    put(base, "lacks.json", json.dumps({"daily": {"time": ["2024-01-01"]}}))
    LD.ingest(spark, base + "/in", base, shape="arrays")
    got, bad = LD.landed(spark, base)
    assert [r["time"] for r in got.orderBy("time").collect()] == ["2024-01-01", "2024-01-02"]
    assert [n for n, _ in names(bad)] == ["lacks.json", "short.json"]


# ---- day layout ----------------------------------------------------------------


def readings(spark, days, n=40, factor=1.0):
    out = [(f"s{i % 3}", i, dt.datetime(2024, 1, d, i % 24, 30), factor * i) for d in days for i in range(n)]
    return spark.createDataFrame(out, "series_id string, event_id long, ts timestamp_ntz, value double")


def folders(path):
    return sorted(f for f in os.listdir(path) if f.startswith(LY.DAY))


def test_daily_mode_reads_one_folder(spark, base):
    path = base + "/days"
    df = readings(spark, range(1, 11)).unionByName(spark.createDataFrame([("s0", 99, None, 1.0)], "series_id string, event_id long, ts timestamp_ntz, value double"))
    LY.write_days(df, path)
    assert len(folders(path)) == 11  # ten days and the rows without a time
    out = LY.fetch_days(spark, path, "daily", as_of="2024-01-05")
    assert sorted(rows(out)) == sorted(rows(fetch_window(df, "daily", as_of="2024-01-05"))) and out.columns == df.columns
    scan = [ln for ln in out._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in ln][0]
    assert f"{LY.DAY}#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert {f"{LY.DAY}=2024-01-04"} == {os.path.basename(os.path.dirname(r[0])) for r in out.select(F.input_file_name()).distinct().collect()}
    full = LY.fetch_days(spark, path, "full", start=dt.datetime(2024, 1, 8, 12))
    assert sorted(rows(full)) == sorted(rows(fetch_window(df, "full", start=dt.datetime(2024, 1, 8, 12))))
    with pytest.raises(ValueError):
        LY.fetch_days(spark, path, "daily")


def test_a_day_delivered_again_replaces_its_folder_only(spark, base):
    path = base + "/days"
    LY.write_days(readings(spark, range(1, 5)), path)
    before = {f: sorted(os.listdir(os.path.join(path, f))) for f in folders(path)}
    LY.write_days(readings(spark, [3], factor=10.0), path)
    after = {f: sorted(os.listdir(os.path.join(path, f))) for f in folders(path)}
    assert {f for f in before if before[f] != after[f]} == {f"{LY.DAY}=2024-01-03"}
    assert LY.fetch_days(spark, path, "daily", as_of="2024-01-04").agg(F.max("value")).first()[0] == 390.0


def test_a_hot_day_has_several_bounded_files(spark, base):
    path = base + "/days"
    LY.write_days(readings(spark, [1], n=1000).unionByName(readings(spark, [2], n=10)), path, rows=100)
    counts = {f: spark.read.parquet(os.path.join(path, f)).groupBy(F.input_file_name()).count().agg(F.count(F.lit(1)), F.max("count")).first() for f in folders(path)}
    files, largest = counts[f"{LY.DAY}=2024-01-01"]
    assert files >= 8 and largest <= 100 and tuple(counts[f"{LY.DAY}=2024-01-02"]) == (1, 10)
