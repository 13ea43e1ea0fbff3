"""Last seen from a stream whose spans of time land in many files: no span is split between batches, and so none of its rows are late."""

from pyspark.sql import functions as F

from vacantia.plans import stream_queries


def test_spans_of_many_files_are_taken_in_whole(spark, tmp_path, monkeypatch):
    folder = f"{tmp_path}/sf"
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("user_id < 6")
    events.repartition(6).write.parquet(f"{folder}/events.parquet")
    batches, upsert = [], stream_queries.S.upsert_stream
    monkeypatch.setattr(stream_queries.S, "upsert_stream", lambda *a, **k: batches.append(upsert(*a, **k)) or batches[-1])
    got = {(r.user_id, r.last_seen, r.is_stale) for r in stream_queries.seen(spark, folder).collect()}
    last = events.groupBy("user_id").agg(F.date_trunc("millisecond", F.max("ts")).cast("timestamp_ntz").alias("last"), F.max("ts").alias("ts"))
    end = events.agg(F.max("ts").alias("end"))
    want = {tuple(r) for r in last.crossJoin(end).select("user_id", "last", F.expr("ts + INTERVAL 36 HOUR < end")).collect()}
    assert got == want and len(want)
    taken = [p["numInputRows"] for q in batches for p in q.recentProgress if p["numInputRows"]]
    assert len(taken) == 3  # a batch for two spans, whatever the number of files
