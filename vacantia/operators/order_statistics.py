"""Exact order statistics of groups of any size, without sorting a group in one task.

Distinct values of each group are counted, the counts are sorted into ranges over all tasks, and each range's sums are
added up per group: a row for each group and range, so the windows over them are as long as there are ranges. A rank then
lies in one known range of its group. A group that holds all rows is spread over all ranges like any other.

Cases: null values are left out; groups may be null, and null equals null; equal values are one; groups of fewer rows than ``least`` go;
an empty frame gives no groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.storage import written

QUARTILES = (("p25", 0.25), ("median", 0.5), ("p75", 0.75))
_RANGE = "_range"


def count_values(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """(by, value, c): the rows of each distinct value that isn't null."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("c"))


def _in_ranges(counts: DataFrame, by: list[str], value: str, ranges: int | None) -> DataFrame:
    n = ranges or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(counts.repartitionByRange(n, *by, value).withColumn(_RANGE, F.spark_partition_id()), _RANGE)


def _sums(ranged: DataFrame, by: list[str], weight: str) -> DataFrame:
    """(by, range, own, n, before): what a range has of a group, what the group has, and what it has in the ranges before."""
    sums = ranged.groupBy(*by, _RANGE).agg(F.sum(weight).alias("_own"))
    group = Window.partitionBy(*by)
    return sums.withColumn("n", F.sum("_own").over(group)).withColumn("_before", F.sum("_own").over(group.orderBy(_RANGE)) - F.col("_own"))


def _with_upto(ranged: DataFrame, sums: DataFrame, by: list[str], value: str, weight: str) -> DataFrame:
    """Rows of the ranges in ``sums`` with n of the group, and upto, the sum of the weights to the row."""
    keys = [*by, _RANGE]
    right = sums.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "n", "_before")
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_k{i}")) if k != _RANGE else F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)))
    upto = F.col("_before") + F.sum(weight).over(Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(right, same).withColumn("upto", upto).drop(*(f"_k{i}" for i in range(len(keys))), "_before", _RANGE)


def running_sums(counts: DataFrame, by: list[str], value: str, weight: str = "c", ranges: int | None = None) -> DataFrame:
    """The counts with n, the sum of the group's weights, and upto, that of the weights of values up to the row's."""
    ranged = _in_ranges(counts, by, value, ranges)
    return _with_upto(ranged, _sums(ranged, by, weight), by, value, weight)


def at_ranks(counts: DataFrame, by: list[str], value: str, points: tuple[tuple[str, float], ...] = QUARTILES, weight: str = "c", least: Column | int = 1, ranges: int | None = None) -> DataFrame:
    """(by, n, a column for each point): the values at index floor(n * p) of each group, from the ranges that have them."""
    ranged = _in_ranges(counts, by, value, ranges)
    index = lambda p: F.floor(F.col("n") * p)
    sums = _sums(ranged, by, weight).where(F.col("n") >= least)
    here = reduce(lambda a, b: a | b, ((F.col("_before") <= index(p)) & (index(p) < F.col("_before") + F.col("_own")) for _, p in points))
    rows = _with_upto(ranged, sums.where(here), by, value, weight)
    pick = lambda p: F.min(F.when(F.col("upto") > index(p), F.col(value)))
    out = rows.groupBy(*by, "n").agg(*(pick(p).alias(name) for name, p in points))
    return out.select(*by, "n", *(name for name, _ in points))
