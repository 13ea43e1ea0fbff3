"""Distinct counts that add up: bitmaps of ids by group and day, rolled up to any days and groups without the rows.

A bitmap covers 32,768 consecutive ids, so a group and day has a row for each such stretch that it has ids of, and a roll-up
is an ``or`` of rows. Counts are exact for every set of days.

Cases: null ids are left out, as a distinct count leaves them out; null groups and days are groups of their own; repeated rows and
repeated merges of one day change nothing; ids may be negative; an empty frame has no bitmaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, by: list[str], id_col: str) -> DataFrame:
    """(by, stretch, bits): the ids of each group."""
    rows = df.where(F.col(id_col).isNotNull()).withColumn("__id", F.col(id_col).cast("long"))
    return rows.groupBy(*by, F.bitmap_bucket_number("__id").alias("stretch")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias("bits"))


def merged(*bitmaps: DataFrame) -> DataFrame:
    """Stored bitmaps with those of further days; a day that comes again adds what is new in it."""
    first, *rest = bitmaps
    by = [c for c in first.columns if c != "bits"]
    for b in rest:
        first = first.unionByName(b)
    return first.groupBy(*by).agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_ids(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """(by, n): the distinct ids of each group of stored groups."""
    whole = bitmaps.groupBy(*by, "stretch").agg(F.bitmap_or_agg("bits").alias("bits"))
    return whole.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias("n"))
