"""Merges of snapshots by key, with a policy per column. A merge reads both sides once, joins them on the key
and returns the new table; the same functions run on a batch or inside a stream's foreachBatch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Policy = Callable[[Column, Column], Column]

#: What a column becomes where both sides have the key: (old, new).
replace: Policy = lambda old, new: new
keep_old: Policy = lambda old, new: old
fill_new: Policy = lambda old, new: F.coalesce(new, old)
fill_old: Policy = lambda old, new: F.coalesce(old, new)
latest: Policy = lambda old, new: F.greatest(old, new)


def merge(old: DataFrame, new: DataFrame, keys: list[str], policies: dict[str, Policy], default: Policy = fill_new, action: str | None = None) -> DataFrame:
    """Rows of both frames by key. Columns are those of ``old``; rows whose key has a null never match.

    ``new`` must have one row per key: de-duplicate it first (ranking.first_per_key)."""
    columns = old.columns
    o = old.select(F.struct(*columns).alias("o"), *(F.col(k).alias(f"__{k}") for k in keys))
    n = new.select(F.struct(*(F.col(c) if c in new.columns else F.lit(None).cast(old.schema[c].dataType).alias(c) for c in columns)).alias("n"), *(F.col(k).alias(f"__{k}") for k in keys))
    both = o.join(n, [f"__{k}" for k in keys], "full")
    pick = lambda c: F.when(F.col("o").isNull(), F.col(f"n.{c}")).when(F.col("n").isNull(), F.col(f"o.{c}")).otherwise(policies.get(c, default)(F.col(f"o.{c}"), F.col(f"n.{c}"))).alias(c)
    out = [pick(c) for c in columns]
    if action:
        out.append(F.when(F.col("o").isNull(), "inserted").when(F.col("n").isNull(), "kept").otherwise("updated").alias(action))
    return both.select(*out)


def upsert_raw(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Raw rows by (source, source_job_id): known ones are refreshed, new ones and those without an id are inserted."""
    keys = keys or ["source", "source_job_id"]
    return merge(old, new, keys, {"id": keep_old, "scraped_at": keep_old, "last_seen": latest}, replace, "action")


def upsert_enriched(old: DataFrame, new: DataFrame, key: str = "job_hash") -> DataFrame:
    """Enriched rows by hash: nulls keep old values, empty arrays replace them, and the first posted_date stays."""
    return merge(old, new, [key], {"posted_date": fill_old, "created_at": fill_old}, fill_new, "action")


def split_valid(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required values, and the others with what they lack."""
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    lacks = F.array_compact(F.array(*(F.when(blank(c), F.lit(c)) for c in required)))
    rows = df.withColumn("missing", lacks)
    return rows.where(F.size("missing") == 0).drop("missing"), rows.where(F.size("missing") > 0)


def ensure_employers(employers: DataFrame, seen: DataFrame) -> DataFrame:
    """Employers with a row for each name seen (canonical_name, display_name); a display name is upgraded only
    while it is the canonical default."""
    better = lambda old, new: F.when(F.lower(old) == old, F.coalesce(new, old)).otherwise(old)
    return merge(employers, seen, ["canonical_name"], {"display_name": better}, keep_old)


def update_inferred(employers: DataFrame, inferred: DataFrame, column: str, source: str, protected: tuple[str, ...] = ("manual", "scraped")) -> DataFrame:
    """Inferred values (canonical_name, value) where the present one isn't from a protected source."""
    new = inferred.select("canonical_name", F.col("value").alias("__value"))
    free = F.col("__value").isNotNull() & ~F.coalesce(F.col(source).isin(*protected), F.lit(False))
    rows = employers.join(new, "canonical_name", "left")
    return rows.withColumns({column: F.when(free, F.col("__value")).otherwise(F.col(column)), source: F.when(free, F.lit("inferred")).otherwise(F.col(source))}).drop("__value")


def update_employers(old: DataFrame, new: DataFrame, fill: list[str], always: list[str]) -> DataFrame:
    """Some columns only where they are empty, others whenever there is a new value."""
    return merge(old, new, ["canonical_name"], {**dict.fromkeys(fill, fill_old), **dict.fromkeys(always, fill_new)}, keep_old)


def freshness(tracked: DataFrame, listings: DataFrame, company: list[str], job: str, status: str) -> DataFrame:
    """New status of tracked postings from their companies' listings (company, job, ok).

    A company is skipped if its listing failed or is empty, or if none of its two or more tracked postings is
    on it; else a posting is active or soft_404 as the listing has it."""
    heads = listings.groupBy(*company).agg(F.min(F.col("ok").cast("int")).alias("__ok"), F.count(job).alias("__listed"))
    on = listings.where(F.col(job).isNotNull()).select(*company, job).distinct().withColumn("__on", F.lit(1))
    rows = tracked.join(on, [*company, job], "left")
    matches = rows.groupBy(*company).agg(F.count("*").alias("__tracked"), F.count("__on").alias("__matched"))
    rows = rows.join(matches, company).join(heads, company, "left")
    failed = F.col("__ok").isNull() | (F.col("__ok") == 0) | (F.col("__listed") == 0)
    odd = (F.col("__matched") == 0) & (F.col("__tracked") > 1)
    verdict = F.when(failed, "skipped_error").when(odd, "skipped_suspicious").when(F.col("__on") == 1, "active").otherwise("closed")
    new = F.when(verdict == "active", "active").when(verdict == "closed", "soft_404").otherwise(F.col(status))
    return rows.withColumn("verdict", verdict).withColumn(status, new).drop("__ok", "__listed", "__on", "__tracked", "__matched")


def write_status(jobs: DataFrame, checks: DataFrame, key: str = "id", terminal: tuple[str, ...] = ("404", "410")) -> DataFrame:
    """Status and time of the checks; terminal states stay."""
    policy = lambda old, new: F.when(old.isin(*terminal), old).otherwise(F.coalesce(new, old))
    return merge(jobs, checks, [key], {"url_status": policy, "url_checked_at": latest}, keep_old)


def changed_only(df: DataFrame, column: str, new: Column, when: Column | None = None) -> DataFrame:
    """Adds new_value and was_changed (null-safe), recomputed where ``when`` holds."""
    value = F.when(when, new).otherwise(F.col(column)) if when is not None else new
    return df.withColumn("new_value", value).withColumn("was_changed", ~F.col(column).eqNullSafe(F.col("new_value")))


def touch(old: DataFrame, new: DataFrame, key: str, columns: list[str], now: Column) -> DataFrame:
    """The new rows with updated_at set to now where one of the columns differs from the old row."""
    before = old.select(F.col(key), F.struct(*columns).alias("__old"), F.col("updated_at").alias("__at"))
    return new.drop("updated_at").join(before, key, "left").withColumn("updated_at", F.when(F.struct(*columns).eqNullSafe(F.col("__old")), F.col("__at")).otherwise(now)).drop("__old", "__at")


def fill_from(df: DataFrame, side: DataFrame, key: str, column: str) -> DataFrame:
    """Empty values taken from a side table."""
    return df.join(side.select(key, F.col(column).alias("__side")), key, "left").withColumn(column, F.coalesce(column, "__side")).drop("__side")


def rename_families(skills: Column, renames: dict[str, str]) -> Column:
    """An array of (name, family_code) with some codes renamed."""
    codes = F.create_map(*[F.lit(x) for kv in renames.items() for x in kv])
    return F.transform(skills, lambda s: F.struct(s["name"].alias("name"), F.coalesce(F.try_element_at(codes, s["family_code"]), s["family_code"]).alias("family_code")))
