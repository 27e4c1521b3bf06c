"""Upserts of micro-batches into a store in parts."""

import os

import pytest

from lanefold.streaming.ingest import BucketStore, completions, continuous_upsert, read_landing


def test_store_by_batches(spark, tmp_path):
    kind = "k long, at long, v string"
    store = BucketStore(spark, str(tmp_path / "store"), ["k"], 8)
    store.write(spark.createDataFrame([(k, 0, "old") for k in range(40)], kind), -1)
    landed = str(tmp_path / "in")
    want = {k: (0, "old") for k in range(40)}
    for rows in ([(3, 1, "a"), (3, 2, None), (100, 1, "n")], [(3, 1, "b")], []):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(landed)
        continuous_upsert(read_landing(spark, landed, kind, files_per_batch=1), store, ["at", "v"], "at", str(tmp_path / "log")).awaitTermination()
        for k, at, v in sorted(rows, key=lambda r: r[1]):
            want[k] = (at, v)
        got = [tuple(r) for r in store.table().collect()]
        assert len(got) == len(want) and {k: (at, v) for k, at, v in got} == want
    versions = sorted(os.listdir(tmp_path / "store" / "data"))
    assert versions == ["v=-1", "v=0", "v=1"]
    assert len([p for p in os.listdir(tmp_path / "store" / "data" / "v=1") if p.startswith("_b=")]) == 1
    again = spark.createDataFrame([(3, 1, "b")], kind)
    store.upsert(again, 1, ["at", "v"])
    assert {r.k: (r.at, r.v) for r in store.table().collect()} == want
    assert {r.k: (r.at, r.v) for r in store.table(1).collect()}[3] == (2, None)


def test_empty_store(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "store"), ["k"], 4)
    store.write(spark.createDataFrame([], "k long, v string"), -1)
    assert store.table() is None
    store.upsert(spark.createDataFrame([(1, "x"), (None, "y")], "k long, v string"), 0, ["v"])
    assert sorted(map(tuple, store.table().collect()), key=repr) == [(1, "x"), (None, "y")]


def _land(spark, tmp_path, rows):
    spark.createDataFrame([(k, c, f"2025-01-01 {h:02}:00:00") for k, c, h in rows], "s string, c string, t string").selectExpr("s", "c", "cast(t as timestamp) t").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")


def _run(spark, tmp_path, **params):
    stream = read_landing(spark, f"{tmp_path}/in", "s string, c string, t timestamp", files_per_batch=1).withWatermark("t", "0 seconds")
    completions(stream, "s", "c", ["a", "b"], **params).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/log").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    return sorted(tuple(r) for r in spark.read.schema("s string, state string, missing string").parquet(f"{tmp_path}/out").collect())


def test_completions_once_each_and_after_a_restart(spark, tmp_path):
    _land(spark, tmp_path, [("x", "a", 1), ("x", "a", 1), ("y", "b", 1), (None, "a", 1), ("z", "other", 1), ("w", "a", 1), ("w", "b", 1)])
    assert _run(spark, tmp_path) == [("w", "complete", "")]
    _land(spark, tmp_path, [("x", "b", 2), ("w", "a", 2)])
    _land(spark, tmp_path, [("x", "a", 3), ("x", "b", 3), ("y", "a", 3)])
    want = [("w", "complete", ""), ("x", "complete", ""), ("y", "complete", "")]
    assert _run(spark, tmp_path) == want
    assert _run(spark, tmp_path) == want


def test_completions_that_expire(spark, tmp_path):
    _land(spark, tmp_path, [("x", "a", 1), ("y", "b", 1), ("w", "a", 1), ("w", "b", 1)])
    _land(spark, tmp_path, [("y", "a", 2)])
    _land(spark, tmp_path, [("v", "b", 9)])
    hours = {"time": "t", "timeout_s": 4 * 3600}
    want = [("w", "complete", ""), ("x", "expired", "b"), ("y", "complete", "")]
    assert _run(spark, tmp_path, **hours) == want
    _land(spark, tmp_path, [("x", "b", 10)])
    assert _run(spark, tmp_path, **hours) == sorted([*want, ("x", "late", "")])
    with pytest.raises(ValueError):
        completions(spark.createDataFrame([], "s string, c string"), "s", "c", ["a"], timeout_s=1)
