"""The report bundle: all metrics of a market segment from one pass over its postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.operators import order_statistics
from vacantia.operators.metrics import UNKNOWN, percent
from vacantia.storage import written

#: Metrics that are shares of known values, and what pay is grouped by.
DISTRIBUTIONS = ("seniority", "job_subfamily", "track", "working_arrangement", "industry", "employer_size", "ownership_type")
PAY_GROUPS = ("seniority", "job_subfamily")
_CELL = "array<struct<metric:string,code:string>>"


def _cells(metric: str, codes: Column) -> Column:
    return F.transform(codes, lambda c: F.struct(F.lit(metric).alias("metric"), c.cast("string").alias("code")))


def _pairs(skills: Column) -> Column:
    """The pairs of distinct skills of one posting, as one text each."""
    own = F.array_sort(F.array_distinct(skills))
    return F.flatten(F.transform(own, lambda a: F.transform(F.filter(own, lambda b: b > a), lambda b: F.concat(a, F.lit(" + "), b))))


def segment_counts(jobs: DataFrame, employers: DataFrame, ats_sources: list[str]) -> DataFrame:
    """(metric, code, n): every count that the report is made of, by one explode and one grouping.

    jobs: employer_name, seniority, job_subfamily, track, working_arrangement, source, skills, skills_all, salary_midpoint,
    is_agency; employers: canonical_name, industry, employer_size, ownership_type."""
    known = employers.select(F.col("canonical_name").alias("employer_name"), "industry", "employer_size", "ownership_type", F.lit("matched").alias("matched"))
    df = jobs.join(known, "employer_name", "left")
    one = lambda metric, c: _cells(metric, F.array(c))
    none = F.array().cast(_CELL)
    ats = F.col("source").isin(ats_sources)
    paid = F.col("salary_midpoint").isNotNull()
    direct = F.concat(
        one("direct", F.lit("direct")), one("employer", F.col("employer_name")),
        *(one(c, F.col(c)) for c in ("seniority", "job_subfamily", "track")),
        F.when(ats, one("working_arrangement", F.col("working_arrangement"))).otherwise(none),
        F.when(F.col("matched").isNotNull(), F.concat(one("matched", F.col("matched")), *(one(c, F.col(c)) for c in ("industry", "employer_size", "ownership_type")))).otherwise(none),
        F.when(F.size("skills_all") > 0, F.concat(one("with_skills", F.lit("with_skills")), _cells("skill", F.col("skills_all")), _cells("pair", _pairs(F.col("skills"))))).otherwise(none),
        F.when(paid, F.concat(one("pay", F.col("salary_midpoint")), *(F.array(F.struct(F.concat(F.lit(f"pay {c} "), F.coalesce(c, F.lit("unknown"))).alias("metric"), F.col("salary_midpoint").cast("string").alias("code"))) for c in PAY_GROUPS))).otherwise(none),
    )
    agency = F.coalesce("is_agency", F.lit(False))
    cells = F.concat(one("jobs", F.lit("jobs")), F.when(agency, one("agency", F.lit("agency"))).otherwise(direct))
    return df.select(F.explode(cells).alias("c")).groupBy("c.metric", "c.code").agg(F.count("*").alias("n"))


def report_bundle(jobs: DataFrame, employers: DataFrame, ats_sources: list[str], top: int = 15, top_pairs: int = 10, least_pay: int = 20, least_group: int = 10) -> DataFrame:
    """(section, code, n, value) of a segment's postings: summary, employers, shares of known values, skills and their
    pairs, pay. Agencies count in the summary only; the value of a share is a half-even percentage.

    The counts are written once: the postings are read by one job, and what follows reads one row for each metric and code."""
    counts = written(segment_counts(jobs, employers, ats_sources))
    is_known = F.col("code").isNotNull() & ~F.col("code").isin(*UNKNOWN)
    totals = counts.groupBy("metric").agg(F.sum("n").alias("total"), F.sum(F.when(is_known, F.col("n")).otherwise(0)).alias("known"), F.count("code").alias("codes"))
    wide = lambda name, c: F.coalesce(F.max(F.when(F.col("metric") == name, F.col(c))), F.lit(0))
    # one row of scalars
    sums = totals.agg(
        *(wide(m, "total").alias(m) for m in ("jobs", "agency", "direct", "matched", "with_skills", "skill", "pair")),
        wide("employer", "codes").alias("employers"), wide("seniority", "known").alias("seniority_known"),
    )
    ranked = counts.where(F.col("metric").isin("employer", "skill", "pair") & F.col("code").isNotNull())
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("metric").orderBy(F.desc("n"), "code")))
    # Spark limits each group before the shuffle
    best = ranked.where(F.col("rank") <= top)
    tops = best.where((F.col("metric") != "pair") | (F.col("rank") <= top_pairs)).crossJoin(F.broadcast(sums))
    whole = F.when(F.col("metric") == "employer", F.col("direct")).otherwise(F.col("with_skills"))
    tops = tops.select(F.concat(F.lit("top "), F.col("metric")).alias("section"), "code", "n", percent(F.col("n"), whole).cast("double").alias("value"))
    shares = counts.where(F.col("metric").isin(*DISTRIBUTIONS) & is_known).join(F.broadcast(totals.where(F.col("metric").isin(*DISTRIBUTIONS))), "metric")
    shares = shares.select(F.col("metric").alias("section"), "code", "n", percent(F.col("n"), F.col("known")).cast("double").alias("value"))
    covered = totals.where(F.col("metric").isin(*DISTRIBUTIONS)).select(F.lit("coverage").alias("section"), F.col("metric").alias("code"), F.col("known").alias("n"), percent(F.col("known"), F.col("total")).cast("double").alias("value"))
    level = lambda *names: F.coalesce(F.sum(F.when((F.col("metric") == "seniority") & F.col("code").isin(*names), F.col("n"))), F.lit(0))
    held = lambda k: F.coalesce(F.sum(F.when((F.col("metric") == "employer") & (F.col("rank") <= k), F.col("n"))), F.lit(0))
    levels = counts.agg(level("senior", "staff_principal", "director_plus").alias("senior"), level("junior").alias("junior"), level("junior", "mid").alias("entry"))
    row = sums.crossJoin(F.broadcast(levels)).crossJoin(F.broadcast(best.agg(held(5).alias("top5"), held(15).alias("top15"))))
    n = lambda section, code, count, value=None: F.struct(F.lit(section).alias("section"), F.lit(code).alias("code"), count.cast("long").alias("n"), (F.lit(None) if value is None else value).cast("double").alias("value"))
    c = F.col
    summary = row.select(F.inline(F.array(
        n("summary", "total_jobs", c("jobs")), n("summary", "direct_jobs", c("direct")), n("summary", "agency_jobs", c("agency"), percent(c("agency"), c("jobs"))),
        n("summary", "unique_employers", c("employers"), F.when(c("employers") > 0, F.bround(c("direct") / c("employers"), 2))),
        n("summary", "top_5_concentration", c("top5"), percent(c("top5"), c("direct"))), n("summary", "top_15_concentration", c("top15"), percent(c("top15"), c("direct"))),
        n("summary", "senior_to_junior", c("senior"), F.when(c("junior") > 0, F.bround(c("senior") / c("junior"), 1))), n("summary", "entry_accessibility", c("entry"), percent(c("entry"), c("seniority_known"))),
        n("coverage", "skills", c("with_skills"), percent(c("with_skills"), c("direct"))), n("coverage", "employers", c("matched"), percent(c("matched"), c("direct"))),
    )))
    # pay by floor nearest rank, by selection over ranges of the distinct values of all groups
    pay = counts.where(F.col("metric").startswith("pay")).select("metric", F.col("code").cast("decimal(18,2)").alias("pay"), "n")
    points = order_statistics.at_ranks(pay.withColumnRenamed("n", "c"), ["metric"], "pay", least=F.when(F.col("metric") == "pay", least_pay).otherwise(least_group))
    points = points.select("metric", F.col("n").alias("total"), *(F.col(p).cast("double").alias(p) for p in ("p25", "median", "p75")))
    pay = points.select("metric", "total", F.explode(F.create_map(*[x for k in ("p25", "median", "p75") for x in (F.lit(k), F.col(k))])).alias("code", "value"))
    pay = pay.select(F.col("metric").alias("section"), "code", F.col("total").alias("n"), "value")
    return summary.unionByName(tops).unionByName(shares).unionByName(covered).unionByName(pay)
