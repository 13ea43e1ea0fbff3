"""Windows, order and samples. Samples are deterministic: rows are ordered by a hash of their key and a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.operators import order_statistics

#: The order of seniority in reports.
SENIORITY_ORDER = ["junior", "mid", "senior", "staff_principal", "director_plus"]


def first_per_key(df: DataFrame, key: list, order: list) -> DataFrame:
    """The first row of each key, as one aggregate without a sort of the rows."""
    rest = [c for c in df.columns]
    keys = [k if isinstance(k, Column) else F.col(k) for k in key]
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    return df.groupBy(*named).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__row")).select("__row.*")


def latest_by_id(df: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """The row with the highest id of each key; rows with a null in the key stay."""
    whole = df.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    loose = df.where(" OR ".join(f"{k} IS NULL" for k in keys))
    best = whole.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max_by(F.struct(*df.columns), ident).alias("__row")).select("__row.*")
    return best.unionByName(loose)


def top_per_group(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """The first k rows of each group."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def business_order(column: str, values: list[str] | None = None) -> Column:
    """The place of a value in the fixed order; others come last."""
    values = values or SENIORITY_ORDER
    place = F.array_position(F.array(*map(F.lit, values)), F.col(column))
    return F.when(place > 0, place).otherwise(len(values) + 1)


def oldest_first(df: DataFrame, column: str, tie: str, k: int) -> DataFrame:
    """The k rows with the oldest value; rows without one come last."""
    return df.orderBy(F.col(column).asc_nulls_last(), tie).limit(k)


def newest(df: DataFrame, column: str, tie: str, k: int) -> DataFrame:
    return df.orderBy(F.col(column).desc_nulls_last(), tie).limit(k)


def display_name(df: DataFrame, key: str, name: str, overrides: DataFrame | None = None, least: int = 1) -> DataFrame:
    """Per key of at least ``least`` rows the override, else the most common name that begins with a capital, else
    the most common one."""
    counts = df.groupBy(key, name).agg(F.count("*").alias("n"))
    order = F.struct(F.col(name).rlike("^[A-Z]").alias("capital"), "n", F.col(name).alias("name"))
    best = counts.groupBy(key).agg(F.sum("n").alias("n_rows"), F.max(order).alias("__best")).where(F.col("n_rows") >= least)
    best = best.select(key, "n_rows", F.col("__best.name").alias("display_name"))
    if overrides is not None:
        best = best.join(overrides.select(key, F.col("display_name").alias("__own")), key, "left").withColumn("display_name", F.coalesce("__own", "display_name")).drop("__own")
    return best


def shuffled(ident: str, seed: int) -> Column:
    return F.xxhash64(F.col(ident), F.lit(seed))


def capped_sample(df: DataFrame, group: str, ident: str, cap: int, seed: int = 0) -> DataFrame:
    """At most ``cap`` rows of each group, in random order."""
    return top_per_group(df, [group], [shuffled(ident, seed), ident], cap).drop("rank")


def stratified_sample(df: DataFrame, stratum: str, ident: str, n: int, quota: int, seed: int = 0, order: Column | None = None) -> DataFrame:
    """``n`` rows: at most ``quota`` of each stratum first, then the rest in random order, or in that of ``order``."""
    order = shuffled(ident, seed) if order is None else order
    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(order, ident))
    return df.withColumn("__rank", rank).withColumn("__late", F.col("__rank") > quota).orderBy("__late", order, ident).limit(n).drop("__rank", "__late")


def round_robin(df: DataFrame, group: list[str], ident: str, n: int) -> DataFrame:
    """``n`` rows, one of each group in turn."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(ident))
    return df.withColumn("turn", rank).orderBy("turn", *group).limit(n)


def recent_per_source(df: DataFrame, source: str, day: str, ident: str, n: int) -> DataFrame:
    return top_per_group(df, [source], [F.desc(day), ident], n)


def pay_rank(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The share of rows of the group with lower pay, by running sums over ranges of distinct values."""
    sums = order_statistics.running_sums(order_statistics.count_values(df, value, by), by, value)
    below = F.col("upto") - F.col("c")
    ranks = sums.select(*by, value, F.when(F.col("n") > 1, below / (F.col("n") - 1)).otherwise(0.0).alias("percent_rank"))
    return df.join(ranks, [*by, value], "left")


def open_roles(df: DataFrame, by: list[str]) -> DataFrame:
    """Postings with the number of open ones of their group."""
    return df.join(df.groupBy(*by).agg(F.count("*").alias("open_roles")), by)


def feed_group(days_open: Column, ratio: Column, roles: Column, pay: Column, remote: Column) -> Column:
    """The one group of a posting in the feed; the first that holds."""
    return F.when(remote, "remote").when(days_open <= 7, "fresh").when(pay >= 0.75, "top_pay").when((ratio > 1.5) | (days_open >= 30), "still_hiring").when(roles >= 3, "scaling")


def relevance(here: Column, days_open: Column, matches: Column, paid: Column) -> Column:
    """100 for the place, up to 50 for freshness, 10 for each filter matched, 5 for pay."""
    return F.when(here, 100).otherwise(0) + F.greatest(F.lit(50) - days_open, F.lit(0)) + matches * 10 + F.when(paid, 5).otherwise(0)


def fit_signals(signals: dict[str, Column]) -> Column:
    """The names of the conditions that hold."""
    return F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in signals.items())))
