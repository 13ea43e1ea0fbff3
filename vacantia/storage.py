"""Tables that one step writes for the next, in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under spark.checkpoint.dir, which must be set on a cluster."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(base or 'file://' + tempfile.gettempdir() + '/spark-shared').rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, by: str | None = None) -> DataFrame:
    """The frame as a Parquet table: computed once, whatever reads it, and read again after a loss. A table written ``by`` a column is read without the folders that a join doesn't need."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def importable(spark: SparkSession) -> None:
    """Lets the Python workers of a local session import this package wherever the driver was started; a cluster ships it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")
