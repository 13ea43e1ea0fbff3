"""Posting snapshots as streams: de-duplication, upserts by foreachBatch, activity windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vacantia.operators import ranking
from vacantia.storage import written


def read_landed(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of the Parquet files that land in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def unique_snapshots(stream: DataFrame, keys: list[str], ts: str = "ts", late: str = "1 day") -> DataFrame:
    """The first of the snapshots of a key within the watermark; state older than that is dropped."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def activity(stream: DataFrame, by: str, hours: int, ts: str = "ts", late: str = "1 hour") -> DataFrame:
    """Rows per window of ``hours`` and group; rows later than the watermark are dropped."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, f"{hours} hours"), by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), by, "n")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Writes what has landed as Parquet and stops."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whatever the store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _manifests(spark: SparkSession, target: str) -> list[int]:
    """The batches that have a manifest, two at most unless a clean-up was cut short."""
    at, store = _folder(spark, f"{target}/manifests")
    return sorted(int(f.getPath().getName()) for f in store.listStatus(at)) if store.exists(at) else []


def _manifest(spark: SparkSession, target: str, batch: int) -> dict[int, int]:
    """The newest version of each part after a batch: as many rows as there are parts."""
    return {r.part: r.v for r in spark.read.schema("part int, v long").parquet(f"{target}/manifests/{batch}").collect()}


def _versions(spark: SparkSession, target: str, schema: StructType, versions: dict[int, int]) -> DataFrame:
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(f"{target}/v={v}/part={p}" for p, v in sorted(versions.items())))


def current(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The table that upsert_stream keeps: of each part the version that the newest manifest names."""
    batches = _manifests(spark, target)
    return _versions(spark, target, schema, _manifest(spark, target, batches[-1]) if batches else {})


def upsert_stream(stream: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame], empty: DataFrame, parts: int = 64, mode: str = "append") -> StreamingQuery:
    """Merges each micro-batch into a table dealt into ``parts`` by a hash of the keys.

    A batch reads and rewrites the parts that its keys lie in, as ``target/v=<batch>/part=<p>``, leaves the others, and then
    writes a manifest of the newest version of each part, a row for each. It starts from the manifest of the batch before, so
    one that runs again gives the same rows; versions that neither of the two manifests names are removed with the older manifests.
    What a batch lists and reads doesn't grow with the number of batches. Within a batch the last row of a key by ``order`` is merged."""
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        new = written(ranking.first_per_key(batch, keys, [F.col(o) for o in order]))
        touched = [r.part for r in new.select(part.alias("part")).distinct().collect()]
        if not touched:
            return
        before = [b for b in _manifests(spark, target) if b < batch_id]
        known = _manifest(spark, target, before[-1]) if before else {}
        old = _versions(spark, target, empty.schema, {p: v for p, v in known.items() if p in touched})
        merged = merge(old, new).select(*empty.columns).withColumn("part", part)
        merged.repartition("part").write.partitionBy("part").mode("overwrite").parquet(f"{target}/v={batch_id}")
        now = known | dict.fromkeys(touched, batch_id)
        spark.createDataFrame(sorted(now.items()), "part int, v long").coalesce(1).write.mode("overwrite").parquet(f"{target}/manifests/{batch_id}")
        for b in before[:-1]:
            for p, v in _manifest(spark, target, b).items():
                if v not in (known[p], now[p]):
                    at, store = _folder(spark, f"{target}/v={v}/part={p}")
                    store.delete(at, True)
            at, store = _folder(spark, f"{target}/manifests/{b}")
            store.delete(at, True)

    return stream.writeStream.outputMode(mode).foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
