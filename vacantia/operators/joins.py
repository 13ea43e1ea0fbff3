"""Joins between postings, employers, raw rows and listings. Sides are broadcast only by their measured size,
which is Catalyst's choice; nothing here forces one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.functions.text import days_open, fill_time_ratio, report_key
from vacantia.operators.automaton import match_patterns


def with_context(jobs: DataFrame, employers: DataFrame, fill: DataFrame, as_of: Column) -> DataFrame:
    """Postings with their employer's row and fill time (jobs.employer_name = canonical_name), days open and ratio."""
    meta = employers.withColumnRenamed("canonical_name", "employer_name")
    stats = fill.select("employer_name", F.col("median_days").alias("employer_median_days"))
    out = jobs.join(meta, "employer_name", "left").join(stats, "employer_name", "left").withColumn("days_open", days_open(F.col("posted_date"), as_of))
    return out.withColumn("fill_time_ratio", fill_time_ratio(F.col("days_open"), F.col("employer_median_days")))


def active_jobs(enriched: DataFrame, raw: DataFrame) -> DataFrame:
    """Enriched rows with the source id and slug of their raw row; rows without either go."""
    keys = raw.select(F.col("id").alias("raw_job_id"), "source_job_id", "slug").where("source_job_id IS NOT NULL AND slug IS NOT NULL")
    return enriched.join(keys, "raw_job_id")


def without_match(left: DataFrame, right: DataFrame, key: str, right_key: str | None = None) -> DataFrame:
    """Rows of the left frame whose key the right one hasn't."""
    return left.join(right.select(F.col(right_key or key).alias(key)), key, "left_anti")


def missing_rows(raw: DataFrame, enriched: DataFrame, known_hashes: DataFrame, hash_column: Column) -> DataFrame:
    """Raw rows with no enriched row, without those whose hash is known."""
    rows = without_match(raw, enriched, "id", "raw_job_id").withColumn("hash", hash_column)
    return without_match(rows, known_hashes, "hash")


def not_recent(companies: DataFrame, seen: DataFrame, slug: str, last: str, as_of: Column, hours: int) -> DataFrame:
    """Companies not seen in the last hours."""
    recent = seen.where(F.col(last) >= as_of - F.make_interval(hours=F.lit(hours))).select(slug).distinct()
    return companies.join(recent, slug, "left_anti")


def listed(tracked: DataFrame, listing: DataFrame, keys: list[str]) -> DataFrame:
    """Tracked rows and whether the listing has them."""
    return tracked.join(listing.select(*keys).distinct().withColumn("is_listed", F.lit(True)), keys, "left").withColumn("is_listed", F.coalesce("is_listed", F.lit(False)))


def by_report_key(jobs: DataFrame, employers: DataFrame, name: str = "employer_name") -> DataFrame:
    """Postings with the employer whose canonical name is their report key."""
    return jobs.withColumn("report_key", report_key(F.col(name))).join(employers.withColumnRenamed("canonical_name", "report_key"), "report_key", "left")


def display_names(jobs: DataFrame, employers: DataFrame) -> DataFrame:
    """Postings with their employer's display name, or its key where there is none."""
    names = employers.select(F.col("canonical_name").alias("employer_name"), F.col("display_name").alias("__shown"))
    return jobs.join(names, "employer_name", "left").withColumn("shown_name", F.coalesce("__shown", "employer_name")).drop("__shown")


def match_dictionary(df: DataFrame, text: str, patterns: DataFrame) -> DataFrame:
    """Rows with the first pattern (by ord) whose words their text contains as whole words; patterns: pattern, ord, value."""
    return match_patterns(df, text, patterns)


def orphans(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """Distinct keys of the left frame that the right one lacks."""
    return without_match(left.select(key).where(F.col(key).isNotNull()).distinct(), right, key, right_key)


def with_enough(employers: DataFrame, jobs: DataFrame, least: int, missing: str | None = None) -> DataFrame:
    """Employers with at least ``least`` postings, and their number; only those without a value of ``missing``."""
    counts = jobs.groupBy(F.col("employer_name").alias("canonical_name")).agg(F.count("*").alias("n_jobs")).where(F.col("n_jobs") >= least)
    rows = employers.where(F.col(missing).isNull()) if missing else employers
    return rows.join(counts, "canonical_name")


def from_siblings(df: DataFrame, key: Column, column: str, order: str) -> DataFrame:
    """Empty values taken from the first row of the same key that has one."""
    first = df.where(F.col(column).isNotNull()).groupBy(key.alias("__key")).agg(F.min_by(column, order).alias("__value"))
    return df.withColumn("__key", key).join(first, "__key", "left").withColumn(column, F.coalesce(column, "__value")).drop("__key", "__value")


def price_out(metrics: DataFrame, prices: DataFrame) -> DataFrame:
    """Each row of totals at each price; both sides are summaries (a row per source, a row per model)."""
    return metrics.crossJoin(prices).withColumn("cost", F.col("tokens") / 1_000_000 * F.col("price"))


def ranked_sources(df: DataFrame, key: str, source: str, score: str) -> DataFrame:
    """Per key its best source and the others in order."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), source))
    rows = df.groupBy(key, source).agg(F.max(score).alias(score)).withColumn("rank", rank)
    return rows.groupBy(key).agg(F.max(F.when(F.col("rank") == 1, F.col(source))).alias("primary_source"), F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") > 1, F.struct("rank", source)))), lambda x: x[source]), ",").alias("alternates"))


def corrected(df: DataFrame, corrections: DataFrame, key: str, column: str) -> DataFrame:
    """Values replaced by those of the correction table (key, new_value)."""
    new = corrections.select(F.col(key), F.col("new_value").alias("__new"))
    return df.join(new, key, "left").withColumn(column, F.coalesce("__new", column)).drop("__new")
