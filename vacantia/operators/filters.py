"""Predicates and filters over postings. Frames stay lazy, and plain comparisons reach the scan."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vacantia.functions.text import any_of, company_slug, is_director

#: States that are not checked again.
TERMINAL = ("404", "410")


def valid_patterns(patterns: list[str]) -> list[str]:
    """The patterns that compile; a bad one is left out."""
    out = []
    for p in patterns:
        try:
            re.compile(p)
            out.append(p)
        except re.error:
            continue
    return out


def relevant_titles(df: DataFrame, title: str, patterns: list[str]) -> DataFrame:
    """Rows whose title in lower case has a match of one of the patterns; without patterns all rows."""
    if not patterns:
        return df
    good = valid_patterns(patterns)
    return df.where(F.lower(title).rlike("|".join(f"(?:{p})" for p in good)) if good else F.lit(False))


def in_target(location: Column, targets: list[str]) -> Column:
    """Whether the location contains a target, case apart; without a location or targets it doesn't."""
    return F.coalesce(any_of(F.lower(location), [t.lower() for t in targets]), F.lit(False))


def funnel(df: DataFrame, drops: dict[str, Column]) -> DataFrame:
    """Adds drop_reason, the first condition that holds; null for rows that stay."""
    rule = reduce(lambda r, kv: r.when(kv[1], kv[0]), list(drops.items())[1:], F.when(list(drops.values())[0], list(drops)[0]))
    return df.withColumn("drop_reason", rule)


def observed_funnel(df: DataFrame, drops: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The rows that stay, and the funnel's counters: seen, kept and one for each reason.

    The counters come from the pass that filters; they are there when an action on the rows has ended."""
    seen = Observation()
    n = lambda c: F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    reasons = [n(F.col("drop_reason") == r).alias(f"dropped_{r}") for r in drops]
    marked = funnel(df, drops).observe(seen, F.count("*").alias("seen"), n(F.col("drop_reason").isNull()).alias("kept"), *reasons)
    return marked.where("drop_reason IS NULL").drop("drop_reason"), seen


def mined_slugs(df: DataFrame, url: str, host: str, ignore: list[str]) -> DataFrame:
    """Distinct company slugs of URLs on a host."""
    return df.select(company_slug(F.col(url), host).alias("slug")).where(F.col("slug").isNotNull() & ~F.col("slug").isin(ignore)).distinct()


def family_range(df: DataFrame, family: str, low: str, high: str) -> DataFrame:
    return df.where((F.col("job_family") == family) & F.col("posted_date").between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def long_enough(df: DataFrame, text: str, least: int) -> DataFrame:
    return df.where(F.length(F.trim(text)) >= least)


def due_for_check(df: DataFrame, status: str, checked: str, as_of: Column, days: int = 3) -> DataFrame:
    """Rows in no terminal state that were never checked or not for ``days``."""
    return df.where(~F.coalesce(F.col(status).isin(*TERMINAL), F.lit(False)) & (F.col(checked).isNull() | (F.col(checked) < F.date_sub(as_of, days))))


def open_rows(df: DataFrame, source_column: str, source: str, status: str, closed: tuple = ("404", "410", "soft_404")) -> DataFrame:
    return df.where((F.col(source_column) == source) & ~F.coalesce(F.col(status).isin(*closed), F.lit(False)))


def unknown_locations(df: DataFrame, locations: str = "locations") -> DataFrame:
    """Rows whose only location is unknown."""
    return df.where((F.size(locations) == 1) & (F.col(locations)[0]["type"] == "unknown"))


def rows_of_scope(df: DataFrame, scope: str, sources: list[str] | None = None, before: Column | None = None, locations: str = "locations") -> DataFrame:
    """Rows with a location of the scope, from some sources, classified before a time."""
    keep = F.exists(locations, lambda l: l["scope"] == scope)
    if sources:
        keep = keep & F.col("source").isin(sources)
    return df.where(keep & (F.col("classified_at") < before) if before is not None else keep)


def to_reclassify(df: DataFrame, family: str, low: str, high: str, title_pattern: str | None = None) -> DataFrame:
    """Direct postings of a family in a time window, by title."""
    rows = family_range(df.where("NOT coalesce(is_agency, false)"), family, low, high)
    return rows.where(F.col("title").rlike("(?i)" + title_pattern)) if title_pattern else rows


def misfiled(df: DataFrame, likes: list[str], exceptions: list[str], family: str = "product") -> DataFrame:
    """Rows of a family whose title is like one of the patterns and has none of the exceptions."""
    hit = reduce(lambda a, b: a | b, (F.col("title").ilike(p) for p in likes))
    return df.where((F.col("job_family") == family) & hit & ~any_of(F.lower("title"), exceptions))


def due_for_enrichment(employers: DataFrame, as_of: Column, days: int = 180, force: bool = False) -> DataFrame:
    """Employers never enriched, without a description, or enriched over ``days`` ago; all of them if forced."""
    if force:
        return employers
    return employers.where(F.col("description").isNull() | F.col("enrichment_date").isNull() | (F.col("enrichment_date") < F.date_sub(as_of, days)))


def titles_that_differ(a: DataFrame, b: DataFrame, key: str, title: str) -> DataFrame:
    """Keys whose title is another in the other frame."""
    other = b.select(key, F.col(title).alias("other_title"))
    return a.join(other, key).where(~F.col(title).eqNullSafe(F.col("other_title"))).select(key, title, "other_title")


def mismatched_rows(df: DataFrame, results: DataFrame, key: str, field: str) -> DataFrame:
    """Rows whose field was wrong in an earlier run; results: key, field, matched."""
    wrong = results.where((F.col("field") == field) & ~F.col("matched")).select(key).distinct()
    return df.join(wrong, key, "left_semi")


def paid_rows(df: DataFrame, pay: str, city_column: str, city: str) -> DataFrame:
    """Rows of a city with pay."""
    return df.where(F.col(pay).isNotNull() & (F.col(city_column) == city))


def missing_values(df: DataFrame, column: str, text: str, least: int) -> DataFrame:
    """Rows without a value whose text is long enough to give one."""
    return df.where(F.col(column).isNull() & (F.length(text) >= least))


def empty_text(df: DataFrame, text: str) -> DataFrame:
    """Rows whose text is null or blank."""
    return df.where(~F.coalesce(text, F.lit("")).rlike(r"\S"))


def edge_titles(df: DataFrame, title: str, words: list[str]) -> DataFrame:
    """Rows whose title has one of the words that need a second look."""
    return df.where(any_of(F.lower(title), words))


def any_element(df: DataFrame, array: str, test) -> DataFrame:
    """Rows with an element for which ``test`` (a function of a column) holds."""
    return df.where(F.coalesce(F.exists(array, test), F.lit(False)))


def track_candidates(df: DataFrame, family: str, seniority: str, title: str) -> DataFrame:
    """Rows of delivery and product at director_plus whose title doesn't say so."""
    return df.where(F.col(family).isin("delivery", "product") & (F.col(seniority) == "director_plus") & ~is_director(F.col(title)))
