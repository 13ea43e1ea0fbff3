"""Counts that are kept up to date by signed changes of a snapshot instead of being made again.

A snapshot's changes against the one before are rows with a sign: what is new counts +1, what is gone -1, and a row whose values
changed both. Stored counts take them in by one sum per group, retractions included, so a group that has lost all its rows goes.

Cases: keys are unique in a snapshot and not null (rows without a key are left out of both sides); null values and groups are values like
others; a snapshot that comes again changes nothing; an empty snapshot takes everything back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def signed_changes(before: DataFrame, after: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(values, sign) of the rows that a snapshot adds, takes back or changes."""
    side = lambda df, name: df.where(F.col(key).isNotNull()).select(key, F.struct(*values).alias(name))
    both = side(before, "__old").join(side(after, "__new"), key, "full")
    same = reduce(lambda a, b: a & b, (F.col(f"__old.{v}").eqNullSafe(F.col(f"__new.{v}")) for v in values))
    changed = both.where(F.col("__old").isNull() | F.col("__new").isNull() | ~same)
    rows = F.array(F.struct(F.col("__old").alias("v"), F.lit(-1).alias("sign")), F.struct(F.col("__new").alias("v"), F.lit(1).alias("sign")))
    return changed.select(F.explode(F.filter(rows, lambda r: r["v"].isNotNull())).alias("r")).select("r.v.*", "r.sign")


def counted(changes: DataFrame, by: list[str]) -> DataFrame:
    """(by, n): the sum of the signs of each group; of rows without a sign their number."""
    sign = F.col("sign") if "sign" in changes.columns else F.lit(1)
    return changes.groupBy(*by).agg(F.sum(sign).alias("n"))


def taken_in(stored: DataFrame, change: DataFrame, by: list[str]) -> DataFrame:
    """Stored counts with those of the changes; groups without rows go."""
    return stored.unionByName(change).groupBy(*by).agg(F.sum("n").alias("n")).where("n <> 0")
