"""Registered queries that replay ``events`` as streams and give what a batch gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.operators.merge import latest, merge
from vacantia.operators.ranking import first_per_key
from vacantia.plans.postings import shared_folder, table
from vacantia.registry import register
from vacantia.streaming import last_seen as L
from vacantia.streaming import snapshots as S


def _landed(s, d, out: str):
    """The events as a landed stream of files."""
    rows = table(s, d, "events")
    rows.repartition(4, "user_id").write.parquet(f"{out}/landed")
    # watermarks need instants
    return S.read_landed(s, f"{out}/landed", rows.schema).withColumn("ts", F.col("ts").cast("timestamp"))


def first_events(s, d):
    out = shared_folder(s)
    stream = S.unique_snapshots(_landed(s, d, out), ["user_id", "event_type"], late="3650 days").select("user_id", "event_type")
    S.run_available(stream, f"{out}/rows", f"{out}/state")
    return s.read.schema("user_id long, event_type string").parquet(f"{out}/rows")


def _last_events(s, d, out: str):
    """The last event of each user, merged batch by batch; the table that is left."""
    empty = s.createDataFrame([], "user_id long, last_event long, last_seen timestamp, newest long")
    # newest orders the rows of a user inside a batch: the smallest comes first
    stream = _landed(s, d, out).select("user_id", F.col("event_id").alias("last_event"), F.col("ts").alias("last_seen"), (-F.unix_micros(F.col("ts").cast("timestamp"))).alias("newest"))
    policy = {"last_event": lambda old, new: F.greatest(old, new), "last_seen": latest}
    S.upsert_stream(stream, f"{out}/table", f"{out}/state", ["user_id"], ["newest", "last_event"], lambda a, b: merge(a, b, ["user_id"], policy), empty).awaitTermination()
    return S.current(s, f"{out}/table", empty.schema)


def upserted(s, d):
    return _last_events(s, d, shared_folder(s)).select("user_id", F.col("last_seen").cast("timestamp_ntz").alias("last_seen"))


def seen(s, d):
    """Users with the time of their last event and whether that is over a day and a half before the last of all, from a stream in order of time."""
    out = shared_folder(s)
    rows = table(s, d, "events")
    bounds = rows.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    days = (bounds.high - bounds.low).days // 6 + 1
    span = F.floor(F.datediff(F.col("ts"), F.lit(bounds.low)) / days)
    # two of six spans of time land, in however many files, and are taken in before the next: a span that is split would be late
    land = lambda k: rows.where(span.isin(k, k + 1)).write.mode("append").parquet(f"{out}/landed")
    land(0)
    stream = S.read_landed(s, f"{out}/landed", rows.schema, files_per_trigger=1_000_000).withColumn("ts", F.col("ts").cast("timestamp"))
    changes = L.last_seen_changes(stream, "user_id", "ts", 12 * 3_600_000, "1 day").withColumnRenamed("key", "user_id")
    # of two changes of a user the one with the newer time holds, and of one time the one that is stale
    changes = changes.withColumns({"newest": -F.col("ms"), "fresh": ~F.col("is_stale")})
    empty = s.createDataFrame([], "user_id long, ms long, is_stale boolean, newest long, fresh boolean")
    latest_of = lambda old, new: first_per_key(old.unionByName(new.select(*old.columns)), ["user_id"], [F.col("newest"), F.col("fresh")])
    store = s.conf.get(L.STORE[0])
    s.conf.set(*L.STORE)
    try:
        for k in (0, 2, 4):
            if k:
                land(k)
            S.upsert_stream(changes, f"{out}/table", f"{out}/state", ["user_id"], ["newest", "fresh"], latest_of, empty, parts=8, mode="update").awaitTermination()
    finally:
        s.conf.set(L.STORE[0], store)
    return S.current(s, f"{out}/table", empty.schema).select("user_id", F.timestamp_millis("ms").cast("timestamp_ntz").alias("last_seen"), "is_stale")


def windows(s, d):
    out = shared_folder(s)
    empty = s.createDataFrame([], "start timestamp, event_type string, n long")
    # update mode sends the windows that changed; state older than the watermark is dropped
    counts = S.activity(_landed(s, d, out), "event_type", 24, late="2 days")
    S.upsert_stream(counts, f"{out}/table", f"{out}/state", ["start", "event_type"], ["n"], lambda a, b: merge(a, b, ["start", "event_type"], {}), empty, mode="update").awaitTermination()
    return S.current(s, f"{out}/table", empty.schema).withColumn("start", F.col("start").cast("timestamp_ntz"))


register("k01_unique_snapshots", first_events, "SELECT DISTINCT user_id, event_type FROM events")
register("k02_stream_upsert", upserted, "SELECT user_id, max(ts) AS last_seen FROM events GROUP BY 1")
register("k03_activity_windows", windows, "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
register("k04_last_seen", seen, """
SELECT user_id, date_trunc('millisecond', max(ts))::TIMESTAMP AS last_seen, max(ts) + INTERVAL 36 HOUR < (SELECT max(ts) FROM events) AS is_stale FROM events GROUP BY 1""")
