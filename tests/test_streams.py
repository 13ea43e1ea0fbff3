"""Streams batch by batch: keys that turn stale and come back, and tables whose upkeep doesn't grow with the batches."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vacantia.operators.ranking import first_per_key
from vacantia.streaming import last_seen, snapshots

SCHEMA = "user long, ts timestamp, n long"


def _land(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _at(hour, minute=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour, minutes=minute)


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(last_seen.STORE[0])
    spark.conf.set(*last_seen.STORE)
    yield
    spark.conf.set(last_seen.STORE[0], before)


def test_a_key_turns_stale_and_comes_back(spark, tmp_path, rocks):
    landed, seen = f"{tmp_path}/landed", []

    def run(rows):
        _land(spark, landed, rows)
        stream = snapshots.read_landed(spark, landed, SCHEMA)
        changes = last_seen.last_seen_changes(stream, "user", "ts", 10 * 3_600_000, "0 seconds")
        batch = []
        query = changes.writeStream.outputMode("update").foreachBatch(lambda df, _: batch.extend(df.collect())).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
        seen.append(sorted((r.key, r.ms // 3_600_000 % 1000, r.is_stale) for r in batch))

    hour = int(_at(0).replace(tzinfo=dt.timezone.utc).timestamp()) // 3600 % 1000
    run([(1, _at(0), 0), (1, _at(1), 0), (1, _at(1), 1), (2, _at(5), 0), (None, _at(2), 0), (3, None, 0)])
    assert seen[-1] == [(1, hour + 1, False), (2, hour + 5, False)]
    run([(2, _at(12), 0)])  # 1 was due at 11
    assert seen[-1] == [(1, hour + 1, True), (2, hour + 12, False)]
    run([(1, _at(13), 0)])
    assert seen[-1] == [(1, hour + 13, False)]
    run([(4, _at(40), 0)])
    assert seen[-1] == [(1, hour + 13, True), (2, hour + 12, True), (4, hour + 40, False)]


def test_upserts_keep_two_manifests_and_the_parts_they_name(spark, tmp_path):
    landed, target, want = f"{tmp_path}/landed", f"{tmp_path}/table", {}
    empty = spark.createDataFrame([], "user long, ts timestamp, n long, newest long")
    merged = lambda old, new: first_per_key(old.unionByName(new), ["user"], [F.col("newest")])
    for k in range(6):
        rows = [(u, _at(k, u), 100 * k + u) for u in range(k, 12, k + 1)]
        want |= {u: n for u, _, n in rows}
        _land(spark, landed, rows)
        stream = snapshots.read_landed(spark, landed, SCHEMA).withColumn("newest", -F.unix_micros("ts"))
        snapshots.upsert_stream(stream, target, f"{tmp_path}/state", ["user"], ["newest"], merged, empty, parts=4).awaitTermination()
        assert {r.user: r.n for r in snapshots.current(spark, target, empty.schema).collect()} == want
    assert len(snapshots._manifests(spark, target)) == 2
    files = [d for d, _, names in os.walk(target) if "part=" in d and any(n.endswith(".parquet") for n in names)]
    assert len(files) <= 8  # two versions of each part


def test_a_batch_that_runs_again_starts_from_the_one_before(spark, tmp_path):
    landed, target = f"{tmp_path}/landed", f"{tmp_path}/table"
    empty = spark.createDataFrame([], "user long, ts timestamp, n long, newest long")
    added = lambda old, new: old.unionByName(new).groupBy("user").agg(F.max("ts").alias("ts"), F.sum("n").alias("n"), F.min("newest").alias("newest"))

    def run(state):
        stream = snapshots.read_landed(spark, landed, SCHEMA, files_per_trigger=1).withColumn("newest", -F.unix_micros("ts"))
        snapshots.upsert_stream(stream, target, state, ["user"], ["newest"], added, empty, parts=3).awaitTermination()

    _land(spark, landed, [(u, _at(1), 1) for u in range(9)])
    run(f"{tmp_path}/state")
    run(f"{tmp_path}/other")  # without its checkpoint batch 0 runs again
    assert {r.n for r in snapshots.current(spark, target, empty.schema).collect()} == {1}
