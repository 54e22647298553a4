"""Artifact versions: a write that dies changes nothing, readers keep what they opened, writers do not overwrite each other."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from daycast.session import scratch_path
from daycast.sources import sinks as SK


@pytest.fixture
def root(spark):
    return scratch_path(spark, f"versions-{uuid.uuid4().hex}")


def frame(spark, n, v, first=0):
    return spark.range(first, first + n).select(F.concat(F.lit("s"), "id").alias("series_id"), F.lit(v).alias("yhat"))


def values(spark, root, name="forecast"):
    return {r["series_id"]: r["yhat"] for r in SK.read_artifact(spark, root, name).collect()}


def dies(i):
    return F.when(F.col(i) >= 30, F.raise_error(F.lit("executor gone")).cast("double")).otherwise(9.0)


def test_a_write_that_dies_half_way_leaves_the_old_rows(spark, root):
    SK.save_forecast(frame(spark, 40, 1.0), root, "m")
    with pytest.raises(Exception, match="executor gone"):
        SK.save_forecast(spark.range(40).select(F.concat(F.lit("s"), "id").alias("series_id"), dies("id").alias("yhat")), root, "m")
    assert values(spark, root) == {f"s{i}": 1.0 for i in range(40)}
    SK.save_forecast(frame(spark, 5, 2.0), root, "m")  # the store is usable afterwards
    assert values(spark, root) == {f"s{i}": 2.0 if i < 5 else 1.0 for i in range(40)}


@pytest.mark.parametrize("name,keys", [("retrain_flag", None), ("forecast", ["model_name", "series_bucket"])])
def test_dying_between_data_and_pointer(spark, root, monkeypatch, name, keys):
    def put(v):
        df = frame(spark, 20, v)
        if keys:
            df = df.withColumns({"model_name": F.lit("m"), "series_bucket": SK.series_bucket("series_id")})
        SK.write_artifact(df, root, name, partition_by=keys)

    put(1.0)
    with monkeypatch.context() as m:
        m.setattr(SK, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver gone")))
        with pytest.raises(RuntimeError):
            put(2.0)
    assert set(values(spark, root, name).values()) == {1.0}
    put(3.0)
    assert set(values(spark, root, name).values()) == {3.0}


def test_a_reader_of_the_version_before_goes_on(spark, root):
    SK.save_flags(frame(spark, 3, 1.0), root, "a")
    opened = SK.read_artifact(spark, root, "retrain_flag")
    SK.save_flags(frame(spark, 3, 2.0), root, "b")
    assert {r["yhat"] for r in opened.collect()} == {1.0}
    for v in (3.0, 4.0, 5.0):
        SK.save_flags(frame(spark, 3, v), root, "c")
    folders = [f for f in os.listdir(SK.artifact_path(root, "retrain_flag")[0]) if f.startswith(SK.FOLDER)]
    assert len(folders) == 2 and set(values(spark, root, "retrain_flag").values()) == {5.0}


def test_only_touched_partitions_are_written_anew(spark, root):
    SK.save_forecast(frame(spark, 200, 1.0), root, "m")
    path = SK.artifact_path(root, "forecast")[0]
    before = {tuple(p) for p in SK.pointer(spark, path)["parts"]}
    SK.save_forecast(frame(spark, 1, 2.0), root, "m")
    after = {tuple(p) for p in SK.pointer(spark, path)["parts"]}
    assert len(after - before) == 1 and len(after) == len(before)
    SK.save_forecast(frame(spark, 10, 7.0), root, "other")
    got = SK.read_artifact(spark, root, "forecast").groupBy("model_name").count().collect()
    assert {r["model_name"]: r["count"] for r in got} == {"m": 200, "other": 10}


def test_two_writers_at_once(spark, root):
    SK.save_flags(frame(spark, 3, 1.0), root, "a")
    path, _ = SK.artifact_path(root, "retrain_flag")
    seen = SK.pointer(spark, path)
    SK.save_flags(frame(spark, 3, 2.0), root, "b")  # the faster one
    with pytest.raises(RuntimeError, match="another run"):
        SK.write_artifact(frame(spark, 3, 3.0), root, "retrain_flag", given=(seen,))
    assert set(values(spark, root, "retrain_flag").values()) == {2.0}


def test_append_and_empty_frames(spark, root):
    for v in (1.0, 2.0):
        SK.append_metrics_history(frame(spark, 2, v), root)
    assert SK.read_artifact(spark, root, "metrics_history").count() == 4
    empty = frame(spark, 2, 1.0).filter("false")
    SK.save_forecast(empty, root, "m")
    out = SK.read_artifact(spark, root, "forecast")
    assert out.count() == 0 and out.columns == ["series_id", "yhat", "model_name", "series_bucket"]


def test_a_folder_without_a_pointer_is_read_as_it_is(spark, root):
    path, _ = SK.artifact_path(root, "retrain_flag")
    frame(spark, 4, 1.0).write.json(path)
    assert SK.has_artifact(spark, root, "retrain_flag") and SK.read_flags(spark, root).count() == 4
