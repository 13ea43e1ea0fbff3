"""Audits and roll-ups of postings, runs and labels: counts, rates and coverage by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions.text import any_of
from vacantia.operators.metrics import percent


def source_status(df: DataFrame, by: str, checked: str, day: str) -> DataFrame:
    """Rows, checked rows and the latest day of each group."""
    return df.groupBy(by).agg(F.count("*").alias("rows"), F.count(checked).alias("checked"), F.max(day).alias("latest"))


def usage(df: DataFrame, by: str, tokens: str) -> DataFrame:
    """Total, least and most tokens of each group."""
    return df.groupBy(by).agg(F.sum(tokens).alias("total"), F.min(tokens).alias("low"), F.max(tokens).alias("high"), F.count("*").alias("n"))


def merge_stats(df: DataFrame, by: str, key: Column) -> DataFrame:
    """Rows of each group and what is left of them by key."""
    return df.groupBy(by).agg(F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_rows"))


def duplicate_rate(df: DataFrame, by: str, key: Column) -> DataFrame:
    """Percentage of each group's rows whose key another row of it has, to two places."""
    share = F.lit(100) * (F.count("*") - F.countDistinct(key)) / F.count("*")
    return df.groupBy(by).agg(F.round(share.cast("decimal(18,8)"), 2).alias("duplicate_pct"))


def ingest_funnel(df: DataFrame, outer: str, inner: str, dropped: Column) -> DataFrame:
    """Rows and kept rows of each pair of groups, of each outer group, and in all."""
    sums = df.rollup(outer, inner).agg(F.count("*").alias("n"), F.sum((~dropped).cast("long")).alias("kept"))
    return sums.select(F.coalesce(outer, F.lit("All")).alias(outer), F.coalesce(inner, F.lit("All")).alias(inner), "n", "kept")


def coverage(df: DataFrame, by: str, column: str) -> DataFrame:
    """Rows of each group with a value, and in all."""
    return df.groupBy(by).agg(F.count(column).alias("filled"), F.count("*").alias("n"))


def row_coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows in all, with a value, and without."""
    return df.agg(F.count("*").alias("rows"), F.count(column).alias("filled"), (F.count("*") - F.count(column)).alias("empty"))


def correction_breakdown(df: DataFrame, where: Column, by: list[str]) -> DataFrame:
    """Rows to correct by group and target."""
    return df.where(where).groupBy(*by).agg(F.count("*").alias("n"))


def rolled_up(df: DataFrame, unit: str, ts: str, by: str, value: str) -> DataFrame:
    """Rows and the value's sum by hour, day or another unit of time and group."""
    return df.groupBy(F.date_trunc(unit, ts).alias(unit), by).agg(F.count("*").alias("n"), F.sum(F.col(value).cast("decimal(18,4)")).alias("total"))


def report_gate(df: DataFrame, by: list[str], least: int = 30) -> DataFrame:
    """Groups with enough rows for a report."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).withColumn("enough", F.col("n") >= least)


def jobs_per_place(df: DataFrame, locations: str = "locations") -> DataFrame:
    """Rows per city of their locations; a row counts once for each of its cities."""
    cities = F.array_distinct(F.transform(F.filter(locations, lambda l: l["city"].isNotNull()), lambda l: l["city"]))
    return df.select(F.explode(cities).alias("place")).groupBy("place").agg(F.count("*").alias("n"))


def progress(df: DataFrame, company: str, ts: str) -> DataFrame:
    """Distinct companies, rows and the last activity of a run."""
    return df.agg(F.countDistinct(company).alias("companies"), F.count("*").alias("n"), F.max(ts).alias("last"))


def suspicious_employers(df: DataFrame, name: str, words: list[str], least: int, k: int) -> DataFrame:
    """Employers with many rows and whether their name has one of the words, most rows first."""
    counts = df.groupBy(name).agg(F.count("*").alias("n")).withColumn("keyword", any_of(F.lower(name), words))
    return counts.where(F.col("n") >= least).orderBy(F.desc("n"), name).limit(k)


def drop_reasons(df: DataFrame, by: str, rules: dict[str, Column], kept: str = "kept") -> DataFrame:
    """Rows per group and the first rule that drops them."""
    reason = F.coalesce(*(F.when(hit, F.lit(name)) for name, hit in rules.items()), F.lit(kept))
    return df.groupBy(by, reason.alias("reason")).agg(F.count("*").alias("n"))


def gold_predictions(gold: DataFrame, predicted: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Counts of the pairs of gold and predicted values that one key has."""
    return gold.join(predicted, key).groupBy(*fields).agg(F.count("*").alias("n"))


def labelled_set(raw: DataFrame, enriched: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """Raw rows with a long enough text whose key was enriched."""
    return raw.where(F.length(text) > least).join(enriched.select(key).distinct(), key, "left_semi")


def only_in_one(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """How many values one of two sets has and the other hasn't."""
    return df.select(key, F.size(F.array_except(a, b)).cast("long").alias("only_a"), F.size(F.array_except(b, a)).cast("long").alias("only_b"))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows of each frame, as one table."""
    out = None
    for name, df in frames.items():
        own = df.agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        out = own if out is None else out.unionAll(own)
    return out


def fill_nulls(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Nulls of these columns replaced once and for all."""
    return df.withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v)) for c, v in values.items()})


def titles_of(df: DataFrame, by: str, title: str = "title") -> DataFrame:
    """Distinct titles and rows of each group."""
    return df.groupBy(by).agg(F.countDistinct(title).alias("titles"), F.count("*").alias("n"))


def seasonality(df: DataFrame, day: str) -> DataFrame:
    """Rows by weekday (1 is Sunday) and month."""
    return df.groupBy(F.dayofweek(day).alias("weekday"), F.month(day).alias("month")).agg(F.count("*").alias("n"))


def clarity(df: DataFrame, by: str, items: str, k: int) -> DataFrame:
    """Groups by items named per row, most first."""
    sums = df.groupBy(by).agg(F.sum(F.size(items)).alias("items"), F.count("*").alias("n"))
    return sums.orderBy(F.desc(F.col("items") / F.col("n")), by).limit(k)


def count_and_latest(df: DataFrame, where: Column, day: str) -> DataFrame:
    return df.where(where).agg(F.count("*").alias("n"), F.max(day).alias("latest"))


def boilerplate_report(df: DataFrame, by: str, before: Column, after: Column, embedded: Column) -> DataFrame:
    """Characters before and after boilerplate goes, the percentage that goes, and how many rows have a vector."""
    sums = df.groupBy(by).agg(F.sum(F.length(before)).alias("before"), F.sum(F.length(after)).alias("after"), F.count("*").alias("n"), F.sum(embedded.cast("long")).alias("embedded"))
    return sums.withColumn("boilerplate_pct", percent(F.col("before") - F.col("after"), F.col("before"))).withColumn("embedded_pct", percent(F.col("embedded"), F.col("n")))


def run_agreement(pairs: DataFrame, fields: dict[str, tuple[str, str]], sets: tuple[str, str], tokens: tuple[str, str], gates: dict[str, int]) -> DataFrame:
    """Two runs side by side in one row: agreement of each field, mean Jaccard of two sets, tokens saved, and the verdict.

    The second run is safe if each gated field agrees in its percentage of rows at least and tokens are saved."""
    union = F.size(F.array_union(*sets))
    jaccard = F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(*sets)) / union)
    same = {f: F.sum(F.col(a).eqNullSafe(F.col(b)).cast("long")).alias(f) for f, (a, b) in fields.items()}
    sums = pairs.agg(
        F.count("*").alias("n"), *same.values(), F.sum(F.bround(jaccard, 3).cast("decimal(18,3)")).alias("jaccard_sum"),
        F.sum(tokens[0]).alias("tokens_a"), F.sum(tokens[1]).alias("tokens_b"),
    )
    safe = F.col("tokens_a") > F.col("tokens_b")
    for field, least in gates.items():
        safe = safe & (F.col(field) * 100 >= F.col("n") * least)
    return sums.withColumn("saved", F.col("tokens_a") - F.col("tokens_b")).withColumn("safe", safe)
