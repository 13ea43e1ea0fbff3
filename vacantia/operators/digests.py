"""Which ids of a group are on one side only, by digests: groups that are equal on both sides ship one row.

A group's digest is the number of its rows and two exact sums of hashes of their ids. Groups whose digests differ are looked at again by ``BUCKETS``
buckets of ids, and only ids in buckets that differ are compared. The digests are partial sums in each task, so what is shuffled follows the
groups, and the ids of changed buckets, and not the rows.

Cases: rows with a null group or id are left out of both sides and are listed nowhere; repeated rows make digests differ and change no result;
a group that one side lacks differs in all its buckets; two different buckets pass for equal with a probability of about 2^-128.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
_SUMS = ("n", "s1", "s2")


def _ids(df: DataFrame, group: list[str], id_col: str) -> DataFrame:
    h = F.xxhash64(F.col(id_col))
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in [*group, id_col]))
    return df.where(known).select(*group, F.col(id_col).alias("__id"), F.pmod(h, F.lit(BUCKETS)).alias("__bucket"), F.xxhash64(F.lit(1), id_col).alias("__h1"), F.xxhash64(F.lit(2), id_col).alias("__h2"))


def digests(ids: DataFrame, by: list[str]) -> DataFrame:
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    return ids.groupBy(*by).agg(F.count("*").alias("n"), exact("__h1").alias("s1"), exact("__h2").alias("s2"))


def _differing(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """The keys whose digests differ."""
    other = digests(right, by).select(*by, *(F.col(c).alias(f"r{c}") for c in _SUMS))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"r{c}")) for c in _SUMS))
    return digests(left, by).join(other, by, "full").where(~same).select(*by)


def differences(left: DataFrame, right: DataFrame, group: list[str], id_col: str) -> DataFrame:
    """(group, id, side): the ids that only one side has; side is 'left' or 'right'."""
    a, b = _ids(left, group, id_col), _ids(right, group, id_col)
    groups = _differing(a, b, group)
    a, b = (x.join(groups, group, "left_semi") for x in (a, b))
    by = [*group, "__bucket"]
    buckets = _differing(a, b, by)
    key = [*group, "__id"]
    a, b = (x.join(buckets, by, "left_semi").select(*key).distinct() for x in (a, b))
    only = a.withColumn("l", F.lit(True)).join(b.withColumn("r", F.lit(True)), key, "full").where("l IS NULL OR r IS NULL")
    return only.select(*group, F.col("__id").alias(id_col), F.when(F.col("l"), "left").otherwise("right").alias("side"))


def listed_by_digest(tracked: DataFrame, listing: DataFrame, group: list[str], id_col: str) -> DataFrame:
    """Tracked rows and whether the listing has them; only ids that are missing meet the rows."""
    key = [*group, id_col]
    gone = differences(tracked, listing, group, id_col).where("side = 'left'").select(*key, F.lit(True).alias("__gone"))
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in key))
    return tracked.join(gone, key, "left").withColumn("is_listed", known & F.col("__gone").isNull()).drop("__gone")
