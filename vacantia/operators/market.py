"""Market questions and taxonomy audits on postings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacantia.functions.text import any_of


def stale_mappings(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """(skill, current_family, new_family) of rows whose family isn't the mapping's; rows: skill, family."""
    new = mapping.select(F.lower("name").alias("skill"), F.col("family").alias("new_family"))
    own = rows.select(F.lower("skill").alias("skill"), F.col("family").alias("current_family")).distinct()
    return own.join(new, "skill").where(~F.col("current_family").eqNullSafe(F.col("new_family"))).distinct()


def keyword_clusters(skills: DataFrame, clusters: dict[str, list[str]], least: int = 2) -> DataFrame:
    """Distinct skills per cluster, each in the first one that has a keyword of it; small clusters go."""
    low = F.lower("skill")
    named = skills.distinct().select(F.coalesce(*(F.when(any_of(low, words), F.lit(c)) for c, words in clusters.items())).alias("cluster"))
    return named.where("cluster IS NOT NULL").groupBy("cluster").agg(F.count("*").alias("members")).where(F.col("members") >= least)


def several_families(mapping: DataFrame) -> DataFrame:
    """Skills in more than one family, with the first and the last by position."""
    own = mapping.groupBy(F.lower("skill").alias("skill"))
    return own.agg(F.countDistinct("family").alias("families"), F.min_by("family", "pos").alias("first_family"), F.max_by("family", "pos").alias("last_family")).where("families > 1")


def skill_share(df: DataFrame, by: list[str]) -> DataFrame:
    """Postings with each skill by year and group, and the group's postings with skills."""
    rows = df.where(F.size("skills") > 0).withColumn("year", F.year("posted_date"))
    total = rows.groupBy("year", *by).agg(F.count("*").alias("postings"))
    return rows.select("year", *by, F.explode("skills").alias("skill")).groupBy("year", *by, "skill").agg(F.count("*").alias("n")).join(total, ["year", *by])


def new_values(df: DataFrame, column: str, year: int) -> DataFrame:
    """Values of a year that the year before hasn't."""
    of = lambda y: df.where((F.year("posted_date") == y) & F.col(column).isNotNull()).select(column).distinct()
    return of(year).join(of(year - 1), column, "left_anti")


def similar_titles(df: DataFrame, least: float) -> DataFrame:
    """Titles of one subfamily whose skill sets have a Jaccard similarity of at least ``least``.

    Titles meet by their rarer skills only (prefix filter on document frequency), not by every shared skill;
    the common skills of the pairs that meet are then counted from the sets."""
    own = df.where("title IS NOT NULL").select("job_subfamily", "title", F.explode("skills").alias("skill")).distinct()
    freq = own.groupBy("job_subfamily", "skill").agg(F.count("*").alias("df"))
    sets = own.join(freq, ["job_subfamily", "skill"]).groupBy("job_subfamily", "title").agg(F.array_sort(F.collect_list(F.struct("df", "skill"))).alias("s"))
    size = F.size("s")
    prefix = F.slice("s", F.lit(1), size - F.ceil(size * least).cast("int") + 1)
    keys = sets.select("job_subfamily", "title", F.transform("s", lambda x: x["skill"]).alias("skills"), F.explode(F.transform(prefix, lambda x: x["skill"])).alias("key"))
    other = keys.select("job_subfamily", "key", F.col("title").alias("other"), F.col("skills").alias("other_skills"))
    pairs = keys.join(other, ["job_subfamily", "key"]).where("title < other").dropDuplicates(["job_subfamily", "title", "other"])
    common = F.size(F.array_intersect("skills", "other_skills")).cast("long")
    return pairs.withColumn("common", common).where(F.col("common") >= least * (F.size("skills") + F.size("other_skills") - F.col("common"))).select("job_subfamily", "title", "other", "common")


def skill_hierarchy(df: DataFrame, levels: list[str]) -> DataFrame:
    """Counts at each level of a hierarchy."""
    return df.rollup(*levels).agg(F.count("*").alias("n"))


def skill_overlap(df: DataFrame) -> DataFrame:
    """Skills that two subfamilies have in common; both sides are small distinct sets."""
    sets = df.select("job_subfamily", F.explode("skills").alias("skill")).distinct()
    other = sets.select(F.col("job_subfamily").alias("b"), "skill")
    return sets.withColumnRenamed("job_subfamily", "a").join(other, "skill").where("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
