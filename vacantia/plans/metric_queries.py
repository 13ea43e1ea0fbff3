"""Registered queries of the report metrics, on the postings frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.operators import audits as A
from vacantia.operators import distinct_counts as B
from vacantia.operators import locations as L
from vacantia.operators import maintained as N
from vacantia.operators import metrics as M
from vacantia.operators import reports as R
from vacantia.plans.postings import AS_OF, employers, postings, table
from vacantia.registry import register
from vacantia.storage import written


def pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN round_even({a} / {b} * 100, 0)::INT END"


def _distribution_sql(column: str, by: str = "", source: str = "postings") -> str:
    own, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    return f"""
WITH c AS (SELECT {own}CASE WHEN {column} NOT IN ('unknown', 'null') THEN {column} END AS code, count(*) AS n FROM {source} GROUP BY ALL),
t AS (SELECT *, sum(n) OVER ({part}) AS total, coalesce(sum(n) FILTER (WHERE code IS NOT NULL) OVER ({part}), 0) AS known FROM c)
SELECT {own}code, n, {pct("n", "known")} AS pct, total::BIGINT AS total, known::BIGINT AS known, (total - known)::BIGINT AS unknown, {pct("known", "total")} AS coverage_pct
FROM t WHERE code IS NOT NULL"""


register("f01_distribution_seniority", lambda s, d: M.distribution(postings(s, d), "seniority"), _distribution_sql("seniority"))
register("f01_distribution_by_city", lambda s, d: M.distribution(postings(s, d), "working_arrangement", ["city"]), _distribution_sql("working_arrangement", "city"))
register("f19_url_status", lambda s, d: M.distribution(postings(s, d), "url_status"), _distribution_sql("url_status"))
register("c07_direct_only", lambda s, d: M.distribution(postings(s, d).where("NOT coalesce(is_agency, false)"), "job_family"), _distribution_sql("job_family", source="(SELECT * FROM postings WHERE NOT coalesce(is_agency, false))"))
register("c08_source_whitelist", lambda s, d: M.distribution(postings(s, d).where(F.col("source").isin("src0", "src1", "src2")), "source"), _distribution_sql("source", source="(SELECT * FROM postings WHERE source IN ('src0', 'src1', 'src2'))"))

register(
    "f02_employer_metrics",
    lambda s, d: M.employer_metrics(postings(s, d)),
    f"""WITH c AS (SELECT employer_name, count(*) AS n FROM postings GROUP BY 1), t AS (SELECT sum(n) AS jobs, count(*) AS employers FROM c),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, employer_name)::INT AS rank FROM c)
SELECT employer_name, n, {pct("n", "jobs")} AS pct, rank, employers, round_even(jobs / employers, 2) AS jobs_per_employer FROM r, t WHERE rank <= 15""",
)
register(
    "f03_concentration",
    lambda s, d: M.concentration(postings(s, d)),
    f"""WITH r AS (SELECT n, row_number() OVER (ORDER BY n DESC, employer_name) AS rank FROM (SELECT employer_name, count(*) AS n FROM postings GROUP BY 1)),
t AS (SELECT sum(n) FILTER (WHERE rank <= 5) AS a, sum(n) FILTER (WHERE rank <= 15) AS b, sum(n) AS jobs FROM r)
SELECT {pct("a", "jobs")} AS top5_pct, {pct("b", "jobs")} AS top15_pct, jobs::BIGINT AS jobs FROM t""",
)
register(
    "f04_seniority",
    lambda s, d: M.seniority_metrics(postings(s, d)),
    f"""WITH t AS (SELECT count(*) FILTER (WHERE seniority IN ('senior', 'staff_principal', 'director_plus')) AS senior, count(*) FILTER (WHERE seniority = 'junior') AS junior,
count(*) FILTER (WHERE seniority IN ('junior', 'mid')) AS entry, count(*) FILTER (WHERE seniority NOT IN ('unknown', 'null')) AS known FROM postings)
SELECT senior, junior, known, CASE WHEN junior > 0 THEN round_even(senior / junior, 1) END AS senior_to_junior, {pct("entry", "known")} AS entry_pct FROM t""",
)
register(
    "f05_top_skills",
    lambda s, d: M.top_skills(postings(s, d)),
    f"""WITH w AS (SELECT skills_all FROM postings WHERE len(skills_all) > 0), t AS (SELECT count(*) AS with_skills FROM w)
SELECT skill, n, {pct("n", "with_skills")} AS pct FROM (SELECT skill, count(*) AS n FROM (SELECT unnest(skills_all) AS skill FROM w) GROUP BY 1 ORDER BY n DESC, skill LIMIT 15), t""",
)
_PAIRS = "p AS (SELECT id, unnest(skills) AS s FROM postings), q AS (SELECT x.s AS a, y.s AS b, count(*) AS n FROM p x JOIN p y ON x.id = y.id AND x.s < y.s GROUP BY ALL)"
register("f06_skill_pairs", lambda s, d: M.skill_pairs(postings(s, d)), f"WITH {_PAIRS} SELECT * FROM q ORDER BY n DESC, a, b LIMIT 10")
register("f06_frequent_pairs", lambda s, d: M.frequent_pairs(postings(s, d)), f"WITH {_PAIRS} SELECT * FROM q ORDER BY n DESC, a, b LIMIT 10")
register("f06_skill_pairs_all", lambda s, d: M.skill_pairs(postings(s, d), k=None), f"WITH {_PAIRS} SELECT * FROM q")
register("q09_skills_with", lambda s, d: M.skill_pairs(postings(s, d), k=None, anchor="Brand#12"), f"WITH {_PAIRS} SELECT * FROM q WHERE 'Brand#12' IN (a, b)")


def enriched(s, d):
    """Postings with what is known of their employers."""
    return postings(s, d).join(employers(s, d).withColumnRenamed("canonical_name", "employer_name"), "employer_name", "left")


_ENRICHED = "(SELECT p.*, industry, employer_size, founding_year, ownership_type, headquarters, display_name FROM postings p LEFT JOIN employers ON canonical_name = employer_name)"
for _column in ("industry", "employer_size", "ownership_type"):
    register(f"f07_{_column}", lambda s, d, c=_column: M.distribution(enriched(s, d), c), _distribution_sql(_column, source=_ENRICHED))
register(
    "f07_maturity",
    lambda s, d: M.distribution(enriched(s, d).withColumn("maturity", F.when(2025 - F.col("founding_year") <= 5, "startup").when(2025 - F.col("founding_year") <= 15, "growth").when(F.col("founding_year").isNotNull(), "mature")), "maturity"),
    _distribution_sql("maturity", source=f"(SELECT *, CASE WHEN 2025 - founding_year <= 5 THEN 'startup' WHEN 2025 - founding_year <= 15 THEN 'growth' WHEN founding_year IS NOT NULL THEN 'mature' END AS maturity FROM {_ENRICHED})"),
)


def _rank_sql(by: str = "", least: int = 1, where: str = "TRUE", iqr: bool = True) -> str:
    own, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    pick = lambda p, name: f"max(salary_midpoint) FILTER (WHERE rn = floor(n * {p})::BIGINT + 1) AS {name}"
    more = ", p75 - p25 AS iqr" if iqr else ""
    group = f"GROUP BY {own}n" if by else "GROUP BY n"
    return f"""
WITH r AS (SELECT {own}salary_midpoint, row_number() OVER ({part} ORDER BY salary_midpoint) AS rn, count(*) OVER ({part}) AS n FROM postings WHERE salary_midpoint IS NOT NULL AND {where}),
g AS (SELECT {own}n, {pick(0.25, "p25")}, {pick(0.5, "median")}, {pick(0.75, "p75")} FROM r WHERE n >= {least} {group})
SELECT *{more} FROM g"""


register("f08_compensation", lambda s, d: M.compensation(postings(s, d).where("region = 'AMERICA'")), _rank_sql(least=20, where="region = 'AMERICA'"))
register("f09_pay_by_seniority", lambda s, d: M.compensation(postings(s, d), by=["seniority"], least=10), _rank_sql("seniority", 10))
register("f09_pay_by_subfamily", lambda s, d: M.compensation(postings(s, d), by=["job_subfamily"], least=10), _rank_sql("job_subfamily", 10))
register("q13_pay_by_city", lambda s, d: M.nearest_rank(postings(s, d), "salary_midpoint", ["city", "job_subfamily"]), _rank_sql("city, job_subfamily", iqr=False))
register(
    "q13_pay_bands",
    lambda s, d: postings(s, d).select(F.width_bucket(F.col("salary_midpoint").cast("double"), F.lit(0.0), F.lit(500000.0), F.lit(20)).alias("band")).groupBy("band").agg(F.count("*").alias("n")),
    "SELECT CASE WHEN salary_midpoint >= 500000 THEN 21 ELSE floor(salary_midpoint / 25000)::BIGINT + 1 END AS band, count(*) AS n FROM postings GROUP BY 1",
)
register(
    "f10_agency_rate",
    lambda s, d: M.conditional_counts(postings(s, d), [], {"agency": F.col("is_agency"), "direct": ~F.col("is_agency")}).withColumn("agency_pct", M.percent(F.col("agency"), F.col("n"))),
    f"WITH t AS (SELECT count(*) AS n, count(*) FILTER (WHERE is_agency) AS agency, count(*) FILTER (WHERE NOT is_agency) AS direct FROM postings) SELECT *, {pct('agency', 'n')} AS agency_pct FROM t",
)


_SEGMENT = ("region = 'EUROPE'", "job_family = 'data'", "posted_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'")
_ATS = ["src0", "src1", "src2", "src3"]
_TRACK = "CASE seniority WHEN 'director_plus' THEN 'management' WHEN 'unknown' THEN NULL ELSE 'ic' END"


def report_bundle(s, d):
    """The whole report of one market segment."""
    jobs = postings(s, d).where(" AND ".join(_SEGMENT)).withColumn("track", F.expr(_TRACK))
    return R.report_bundle(jobs, employers(s, d).where("founding_year % 4 > 0"), _ATS)


def _bundle_sql() -> str:
    """The report from its parts, each by itself."""
    share = lambda c, source, known=None: f"""
SELECT '{c}' AS section, {c} AS code, count(*) AS n, round_even(count(*) / sum(count(*)) OVER () * 100, 0)::DOUBLE AS value FROM {source} WHERE {c} NOT IN ('unknown', 'null') GROUP BY {c}
UNION ALL SELECT 'coverage', '{c}', count(*) FILTER (WHERE {c} NOT IN ('unknown', 'null')), round_even(count(*) FILTER (WHERE {c} NOT IN ('unknown', 'null')) / count(*) * 100, 0)::DOUBLE FROM {source}"""  # noqa: E731
    parts = [share(c, "direct") for c in ("seniority", "job_subfamily", "track")] + [share("working_arrangement", "ats")]
    parts += [share(c, "known") for c in ("industry", "employer_size", "ownership_type")]
    top = lambda name, code, source, k, whole: f"""
SELECT 'top {name}', code, n, round_even(n / (SELECT count(*) FROM {whole}) * 100, 0)::DOUBLE FROM (SELECT {code} AS code, count(*) AS n FROM {source} GROUP BY 1 ORDER BY n DESC, code LIMIT {k})"""  # noqa: E731
    parts += [top("employer", "employer_name", "direct", 15, "direct"), top("skill", "skill", "(SELECT unnest(skills_all) AS skill FROM skilled)", 15, "skilled")]
    parts += [top("pair", "x || ' + ' || y", "(SELECT a.s AS x, b.s AS y FROM named a JOIN named b ON a.id = b.id AND a.s < b.s)", 10, "skilled")]
    scalar = lambda section, code, n, value="NULL": f"SELECT '{section}', '{code}', ({n})::BIGINT, ({value})::DOUBLE"
    held = lambda k: f"SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n, employer_name FROM direct GROUP BY employer_name ORDER BY n DESC, employer_name LIMIT {k})"
    n = lambda source, where="TRUE": f"(SELECT count(*) FROM {source} WHERE {where})"
    rate = lambda a, b: f"SELECT round_even(({a}) / ({b}) * 100, 0)"
    senior, junior, entry = (n("direct", f"seniority IN {x}") for x in ("('senior', 'staff_principal', 'director_plus')", "('junior')", "('junior', 'mid')"))
    parts += [
        scalar("summary", "total_jobs", n("segment")), scalar("summary", "direct_jobs", n("direct")), scalar("summary", "agency_jobs", n("segment", "is_agency"), rate(n("segment", "is_agency"), n("segment"))),
        scalar("summary", "unique_employers", "SELECT count(DISTINCT employer_name) FROM direct", "SELECT round_even(count(*) / count(DISTINCT employer_name), 2) FROM direct"),
        scalar("summary", "top_5_concentration", held(5), rate(held(5), n("direct"))), scalar("summary", "top_15_concentration", held(15), rate(held(15), n("direct"))),
        scalar("summary", "senior_to_junior", f"SELECT {senior}", f"SELECT CASE WHEN {junior} > 0 THEN round_even({senior} / {junior}, 1) END"),
        scalar("summary", "entry_accessibility", f"SELECT {entry}", rate(entry, n("direct", "seniority <> 'unknown'"))),
        scalar("coverage", "skills", n("skilled"), rate(n("skilled"), n("direct"))), scalar("coverage", "employers", n("known"), rate(n("known"), n("direct"))),
    ]
    for section, own, least in (("'pay'", "'all'", 20), ("'pay seniority ' || own", "seniority", 10), ("'pay job_subfamily ' || own", "job_subfamily", 10)):
        ranked = f"(SELECT {own} AS own, salary_midpoint AS p, row_number() OVER (PARTITION BY {own} ORDER BY salary_midpoint) AS rn, count(*) OVER (PARTITION BY {own}) AS n FROM direct WHERE salary_midpoint IS NOT NULL)"
        for code, q in (("p25", 0.25), ("median", 0.5), ("p75", 0.75)):
            parts.append(f"SELECT {section}, '{code}', n, p::DOUBLE FROM {ranked} WHERE n >= {least} AND rn = floor(n * {q})::BIGINT + 1")
    return f"""WITH segment AS (SELECT *, {_TRACK} AS track FROM postings WHERE {" AND ".join(_SEGMENT)}), direct AS (SELECT * FROM segment WHERE NOT is_agency),
ats AS (SELECT * FROM direct WHERE source IN ('src0', 'src1', 'src2', 'src3')), skilled AS (SELECT * FROM direct WHERE len(skills_all) > 0), named AS (SELECT id, unnest(skills) AS s FROM skilled),
known AS (SELECT direct.*, industry, employer_size, ownership_type FROM direct JOIN employers ON canonical_name = employer_name WHERE founding_year % 4 > 0)
""" + " UNION ALL ".join(parts)


register("f11_report_bundle", report_bundle, _bundle_sql())


def _fill_sql(by: str, least: int = 3) -> str:
    return f"""SELECT {by}, median(days)::DOUBLE AS median_days, count(*) AS n FROM (SELECT {by}, date_diff('day', posted_date, url_checked_at) AS days FROM postings WHERE url_status IN ('404', 'soft_404'))
WHERE days > 0 AND days < 365 GROUP BY {by} HAVING count(*) >= {least}"""


register("f12_fill_time", lambda s, d: M.fill_time(postings(s, d), ["employer_name"]), _fill_sql("employer_name"))
register("q03_fill_time_by_role_city", lambda s, d: M.fill_time(postings(s, d), ["job_subfamily", "city"]), _fill_sql("job_subfamily, city"))
register(
    "q03_fastest_employers",
    lambda s, d: M.fill_time(postings(s, d), ["employer_name"], least=2).orderBy("median_days", "employer_name").limit(20),
    f"SELECT * FROM ({_fill_sql('employer_name', 2)}) ORDER BY median_days, employer_name LIMIT 20",
)
register(
    "f13_fill_spread",
    lambda s, d: M.fill_time(postings(s, d), ["employer_name"]).agg(F.min("median_days").alias("low"), F.max("median_days").alias("high"), F.percentile("median_days", 0.5).alias("mid")),
    f"SELECT min(median_days) AS low, max(median_days) AS high, median(median_days) AS mid FROM ({_fill_sql('employer_name')})",
)
register(
    "f14_confident_mode",
    lambda s, d: M.confident_mode(postings(s, d), "employer_name", "working_arrangement", 0.5),
    """WITH c AS (SELECT employer_name, working_arrangement, count(*) AS n FROM postings WHERE working_arrangement NOT IN ('unknown', 'null') GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY employer_name)::BIGINT AS total, row_number() OVER (PARTITION BY employer_name ORDER BY n DESC, working_arrangement) AS rank FROM c)
SELECT employer_name, working_arrangement, n, total FROM r WHERE rank = 1 AND total >= 3 AND n / total >= 0.5""",
)
_DIMS = ["seniority", "job_subfamily", "job_family", "working_arrangement", "url_status", "city", "region", "is_agency"]
register(
    "f15_value_counts",
    lambda s, d: M.value_counts(postings(s, d), _DIMS),
    f"""WITH u AS (SELECT unnest({_DIMS!r}) AS dimension, unnest([{", ".join(c + "::VARCHAR" for c in _DIMS)}]) AS value FROM postings),
c AS (SELECT dimension, value, count(*) AS n FROM u GROUP BY ALL)
SELECT *, sum(n) OVER (PARTITION BY dimension)::BIGINT AS total, count(value) OVER (PARTITION BY dimension) AS n_values,
row_number() OVER (PARTITION BY dimension ORDER BY value IS NULL, n DESC, value) = 1 AS is_mode FROM c""",
)
for _a, _b in (("job_family", "seniority"), ("job_family", "working_arrangement"), ("city", "job_family"), ("seniority", "working_arrangement"), ("city", "working_arrangement")):
    register(
        f"f16_cross_{_a}_{_b}",
        lambda s, d, a=_a, b=_b: M.cross_tab(postings(s, d), a, b),
        f"SELECT CASE WHEN grouping({_a}) = 1 THEN 'All' ELSE coalesce({_a}, 'none') END AS {_a}, CASE WHEN grouping({_b}) = 1 THEN 'All' ELSE coalesce({_b}, 'none') END AS {_b}, count(*) AS n FROM postings GROUP BY CUBE ({_a}, {_b})",
    )
register(
    "f17_recent_vs_all",
    lambda s, d: M.conditional_counts(postings(s, d), ["job_family", "source"], {"recent": F.col("posted_date") >= F.lit("2001-01-01").cast("date"), "classified": M.is_known("seniority")}),
    "SELECT job_family, source, count(*) AS n, count(*) FILTER (WHERE posted_date >= DATE '2001-01-01') AS recent, count(*) FILTER (WHERE seniority NOT IN ('unknown', 'null')) AS classified FROM postings GROUP BY ALL",
)
register("f18_status", lambda s, d: A.source_status(postings(s, d), "source", "url_checked_at", "posted_date"), "SELECT source, count(*) AS rows, count(url_checked_at) AS checked, max(posted_date) AS latest FROM postings GROUP BY 1")
register(
    "f20_age_buckets",
    lambda s, d: M.age_buckets(table(s, d, "events").groupBy("user_id").agg(F.max("ts").alias("last"), F.max_by("event_type", F.struct("ts", "event_id")).alias("source")), "source", "last", F.lit("2024-01-31").cast("date")),
    """WITH l AS (SELECT user_id, max(ts) AS last, arg_max(event_type, (ts, event_id)) AS source FROM events GROUP BY 1)
SELECT source, CASE WHEN age IS NULL THEN 'never' WHEN age <= 3 THEN '<=3' WHEN age <= 7 THEN '<=7' ELSE '>7' END AS bucket, count(*) AS n
FROM (SELECT source, date_diff('day', last::DATE, DATE '2024-01-31') AS age FROM l) GROUP BY ALL""",
)
_LABELLED = "(SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
labelled = lambda s, d: table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left")
register("f28_accuracy", lambda s, d: M.accuracy(labelled(s, d).withColumn("long", (F.col("n_chars") > 1000).cast("int")), {"quality": ("quality", "long"), "toxic": ("toxic", "quality")}), f"""
WITH r AS (SELECT quality IS NOT DISTINCT FROM (n_chars > 1000)::INT AS a, toxic IS NOT DISTINCT FROM quality AS b FROM {_LABELLED})
SELECT unnest(['quality', 'toxic', 'all_fields']) AS field, unnest([count(*) FILTER (WHERE a), count(*) FILTER (WHERE b), count(*) FILTER (WHERE a AND b)]) AS "right", unnest([count(*), count(*), count(*)]) AS n FROM r""")
register("f29_mismatches", lambda s, d: M.mismatches(labelled(s, d), "quality", "toxic"), f"SELECT quality, toxic, count(*) AS n FROM {_LABELLED} WHERE quality IS DISTINCT FROM toxic GROUP BY ALL ORDER BY n DESC, quality NULLS LAST, toxic NULLS LAST LIMIT 3")
register("f30_thresholds", lambda s, d: M.accuracy(labelled(s, d), {"quality": ("quality", "toxic")}).select("field", F.when(F.col("field") == "quality", 50).otherwise(90).alias("threshold"), (F.col("right") * 100 >= F.when(F.col("field") == "quality", 50).otherwise(90) * F.col("n")).alias("passed")), f"""
WITH r AS (SELECT count(*) FILTER (WHERE quality IS NOT DISTINCT FROM toxic) AS a, count(*) AS n FROM {_LABELLED})
SELECT 'quality' AS field, 50 AS threshold, a * 100 >= 50 * n AS passed FROM r UNION ALL SELECT 'all_fields', 90, a * 100 >= 90 * n FROM r""")
_SAME = {"seniority": ("seniority", "other_seniority"), "job_subfamily": ("job_subfamily", "other_subfamily")}
register(
    "f31_set_agreement",
    lambda s, d: A.run_agreement(_two_runs(s, d), _SAME, ("skills", "other"), ("tokens", "other_tokens"), {"job_subfamily": 90, "seniority": 15}),
    """WITH a AS (SELECT o_custkey AS k, (posted_date, id) AS place, skills, seniority, job_subfamily, id % 90 + 20 AS tokens FROM postings JOIN orders ON o_orderkey = id),
f AS (SELECT k, arg_min(skills, place) AS x, arg_max(skills, place) AS y, arg_min(seniority, place) = arg_max(seniority, place) AS same, arg_min(job_subfamily, place) = arg_max(job_subfamily, place) AS own, arg_min(tokens, place) AS t, arg_max(tokens, place) AS u FROM a GROUP BY 1),
j AS (SELECT *, CASE WHEN len(list_distinct(list_concat(x, y))) = 0 THEN 1.0 ELSE len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) END AS j FROM f),
t AS (SELECT count(*) AS n, count(*) FILTER (WHERE same) AS seniority, count(*) FILTER (WHERE own) AS job_subfamily, sum(round_even(j, 3)::DECIMAL(18,3)) AS jaccard_sum, sum(t)::BIGINT AS tokens_a, sum(u)::BIGINT AS tokens_b FROM j)
SELECT *, tokens_a - tokens_b AS saved, tokens_a > tokens_b AND job_subfamily * 100 >= n * 90 AND seniority * 100 >= n * 15 AS safe FROM t""",
)


register("f32_p95", lambda s, d: M.nearest_rank(postings(s, d), "salary_midpoint", ["source"], points=(("p95", 0.95),)), """
WITH r AS (SELECT source, salary_midpoint, row_number() OVER (PARTITION BY source ORDER BY salary_midpoint) AS rn, count(*) OVER (PARTITION BY source) AS n FROM postings WHERE salary_midpoint IS NOT NULL)
SELECT source, n, max(salary_midpoint) FILTER (WHERE rn = floor(n * 0.95)::BIGINT + 1) AS p95 FROM r GROUP BY source, n""")
register("f33_usage", lambda s, d: A.usage(table(s, d, "documents"), "source", "n_chars"), "SELECT source, sum(n_chars)::BIGINT AS total, min(n_chars) AS low, max(n_chars) AS high, count(*) AS n FROM documents GROUP BY 1")
def _two_runs(s, d):
    """The first and the last posting of each employer, as if two runs had seen one posting."""
    at = F.struct("posted_date", "id")
    rows = postings(s, d).join(table(s, d, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey"), "id").withColumn("tokens", F.col("id") % 90 + 20)
    first = (F.min_by(c, at).alias(c) for c in ("skills", "seniority", "job_subfamily", "tokens"))
    last = (F.max_by(c, at).alias(n) for c, n in (("skills", "other"), ("seniority", "other_seniority"), ("job_subfamily", "other_subfamily"), ("tokens", "other_tokens")))
    return rows.groupBy("o_custkey").agg(*first, *last)


def _leaning(s, d):
    """Postings of some cities are remote more often."""
    more = F.col("city").isin("NATION_3", "NATION_8") & (F.col("id") % 2 == 0)
    return postings(s, d).withColumn("working_arrangement", F.when(more, "remote").otherwise(F.col("working_arrangement")))


_LEANING = "(SELECT * REPLACE (CASE WHEN city IN ('NATION_3', 'NATION_8') AND id % 2 = 0 THEN 'remote' ELSE working_arrangement END AS working_arrangement) FROM postings)"


def _places(s, d):
    here, more = L.location("city", None, F.col("city")), F.when(F.col("id") % 3 == 0, L.location("city", None, F.col("region")))
    return postings(s, d).withColumn("locations", F.array_compact(F.array(here, here, more, L.location("remote", scope="global"))))


_DOC_KEY = "md5(lower(trim(text)))"
register("f34_merge_stats", lambda s, d: A.merge_stats(table(s, d, "documents"), "source", F.md5(F.lower(F.trim("text")))), f"SELECT source, count(*) AS rows, count(DISTINCT {_DOC_KEY}) AS distinct_rows FROM documents GROUP BY 1")
register(
    "f35_funnel",
    lambda s, d: A.ingest_funnel(postings(s, d), "source", "city", F.col("is_agency")),
    "SELECT coalesce(source, 'All') AS source, coalesce(city, 'All') AS city, count(*) AS n, count(*) FILTER (WHERE NOT is_agency) AS kept FROM postings GROUP BY ROLLUP (source, city)",
)
register("f36_label_stats", lambda s, d: M.grouping_sets_counts(postings(s, d), ["job_family", "source", "seniority"]), "SELECT dimension, value, count(*) AS n FROM (SELECT unnest(['total', 'job_family', 'source', 'seniority']) AS dimension, unnest(['all', job_family, source, seniority]) AS value FROM postings) GROUP BY ALL")
register("f37_coverage", lambda s, d: A.coverage(labelled(s, d), "source", "quality"), f"SELECT source, count(quality) AS filled, count(*) AS n FROM {_LABELLED} GROUP BY 1")
register("f38_flag_audit", lambda s, d: M.conditional_counts(labelled(s, d), ["source"], {"missing": F.col("toxic").isNull(), "flagged": F.col("toxic") == 1, "clear": F.col("toxic") == 0}), f"SELECT source, count(*) AS n, count(*) FILTER (WHERE toxic IS NULL) AS missing, count(*) FILTER (WHERE toxic = 1) AS flagged, count(*) FILTER (WHERE toxic = 0) AS clear FROM {_LABELLED} GROUP BY 1")
register(
    "f39_corrections",
    lambda s, d: A.correction_breakdown(postings(s, d), (F.col("seniority") == "staff_principal") & F.col("title").contains("a"), ["job_family", "seniority"]),
    "SELECT job_family, seniority, count(*) AS n FROM postings WHERE seniority = 'staff_principal' AND title LIKE '%a%' GROUP BY ALL",
)
register("f40_row_coverage", lambda s, d: A.row_coverage(labelled(s, d), "quality"), f"SELECT count(*) AS rows, count(quality) AS filled, count(*) - count(quality) AS empty FROM {_LABELLED}")
register("f41_running_totals", lambda s, d: M.running_totals(postings(s, d), "posted_date", "job_family"), "WITH c AS (SELECT job_family, posted_date AS day, count(*) AS n FROM postings GROUP BY ALL) SELECT *, sum(n) OVER (PARTITION BY job_family ORDER BY day)::BIGINT AS cumulative FROM c")


def maintained_totals(s, d):
    """Running totals from counts that took in three snapshots: a third of the postings with some families unknown yet, two thirds, all."""
    by = ["job_family", "day"]
    rows = written(postings(s, d).select("id", "job_family", F.col("posted_date").alias("day")))
    early = F.when(F.col("id") % 5 == 0, F.lit("unknown")).otherwise(F.col("job_family"))
    first = rows.where("id % 3 = 0").withColumn("job_family", early)
    second = rows.where("id % 3 < 2 AND id % 7 > 0")
    stored = written(N.counted(first, by))
    for before, after in ((first, second), (second, rows)):
        stored = written(N.taken_in(stored, N.counted(N.signed_changes(before, after, "id", by), by), by))
    return M.cumulated(stored, "job_family")


register(
    "f41_maintained_totals",
    maintained_totals,
    """
WITH c AS (SELECT job_family, posted_date AS day, count(*) AS n FROM postings GROUP BY ALL)
SELECT *, sum(n) OVER (PARTITION BY job_family ORDER BY day)::BIGINT AS cumulative FROM c""",
)
register("f42_hourly", lambda s, d: A.rolled_up(table(s, d, "events"), "hour", "ts", "event_type", "value"), "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n, sum(value::DECIMAL(18,4)) AS total FROM events GROUP BY ALL")
register("f43_remote_by_size", lambda s, d: M.conditional_counts(enriched(s, d), ["employer_size"], {"remote": F.col("working_arrangement") == "remote", "flexible": F.col("working_arrangement").isin("remote", "hybrid")}).withColumn("flexible_pct", M.percent(F.col("flexible"), F.col("n"))), f"SELECT *, {pct('flexible', 'n')} AS flexible_pct FROM (SELECT employer_size, count(*) AS n, count(*) FILTER (WHERE working_arrangement = 'remote') AS remote, count(*) FILTER (WHERE working_arrangement IN ('remote', 'hybrid')) AS flexible FROM {_ENRICHED} GROUP BY 1)")
register(
    "f44_compare_segments",
    lambda s, d: M.compare_segments(_leaning(s, d), "city", "working_arrangement"),
    f"""WITH s AS (SELECT * FROM ({_distribution_sql("working_arrangement", "city", _LEANING)}) WHERE total >= 10)
SELECT a.code, a.city, b.city AS other, a.pct, b.pct AS other_pct FROM s a JOIN s b ON a.code = b.code AND a.city < b.city WHERE abs(a.pct - b.pct) > 20 OR greatest(a.pct, b.pct) > 2 * least(a.pct, b.pct)""",
)
register(
    "f45_report_gate",
    lambda s, d: A.report_gate(postings(s, d).withColumn("month", F.date_trunc("month", "posted_date").cast("date")), ["city", "job_family", "month"], 5),
    "SELECT city, job_family, date_trunc('month', posted_date)::DATE AS month, count(*) AS n, count(*) >= 5 AS enough FROM postings GROUP BY ALL",
)


def sited(s, d):
    """Postings with their employers, and as place of work the nation of the supplier of the first line."""
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    first = table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.min_by("l_suppkey", place).alias("s_suppkey"))
    places = table(s, d, "supplier").join(table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("site"))
    return enriched(s, d).drop("city").join(first.join(places, "s_suppkey").select("id", F.col("site").alias("city")), "id")


register(
    "f46_headquarters",
    lambda s, d: sited(s, d).groupBy("city", "employer_size").agg(
        F.count("*").alias("n"), F.sum((F.col("headquarters") != F.col("city")).cast("long")).alias("elsewhere"), F.percentile(2025 - F.col("founding_year"), 0.5).alias("median_age")
    ),
    f"""
WITH first AS (SELECT l_orderkey AS id, list(l_suppkey ORDER BY l_linenumber, l_partkey, l_suppkey)[1] AS s_suppkey FROM lineitem GROUP BY 1),
sited AS (SELECT n_name AS site, e.* FROM {_ENRICHED} e JOIN first ON first.id = e.id JOIN supplier ON supplier.s_suppkey = first.s_suppkey JOIN nation ON n_nationkey = s_nationkey)
SELECT site AS city, employer_size, count(*) AS n, count(*) FILTER (WHERE headquarters <> site) AS elsewhere, median(2025 - founding_year)::DOUBLE AS median_age FROM sited GROUP BY ALL""",
)
register("f46_headquarters_ranking", lambda s, d: M.top_k(enriched(s, d), "headquarters", 10), f"WITH c AS (SELECT headquarters, count(*) AS n FROM {_ENRICHED} GROUP BY 1), r AS (SELECT *, sum(n) OVER () AS total, row_number() OVER (ORDER BY n DESC, headquarters)::INT AS rank FROM c) SELECT headquarters, n, {pct('n', 'total')} AS pct, rank FROM r WHERE rank <= 10")
register("f47_fill_rates", lambda s, d: M.fill_rates(employers(s, d), ["industry", "ownership_type", "headquarters"]), "SELECT unnest(['industry', 'ownership_type', 'headquarters']) AS field, unnest([count(industry), count(ownership_type), count(headquarters)]) AS filled, unnest([count(*), count(*), count(*)]) AS n FROM employers")
register(
    "f48_jobs_per_place",
    lambda s, d: A.jobs_per_place(_places(s, d)),
    "SELECT place, count(*) AS n FROM (SELECT id, city AS place FROM postings UNION SELECT id, region FROM postings WHERE id % 3 = 0) GROUP BY 1",
)
register(
    "f49_duplicate_rate",
    lambda s, d: A.duplicate_rate(table(s, d, "documents"), "source", F.md5(F.lower(F.trim("text")))),
    f"SELECT source, round((100 * (count(*) - count(DISTINCT {_DOC_KEY})) / count(*))::DECIMAL(18,8), 2) AS duplicate_pct FROM documents GROUP BY 1",
)


def weekly_users(s, d):
    """Users by week and kind of event, and of all kinds, from bitmaps stored by kind and day; two halves of the month are merged."""
    events = table(s, d, "events").withColumn("day", F.to_date("ts"))
    half = F.col("day") < F.lit("2024-01-16").cast("date")
    daily = written(B.merged(*(B.id_bitmaps(events.where(part), ["event_type", "day"], "user_id") for part in (half, ~half))))
    weeks = daily.withColumn("week", F.date_trunc("week", "day").cast("date"))
    both = B.distinct_ids(weeks, ["event_type", "week"]).unionByName(B.distinct_ids(weeks, ["week"]).withColumn("event_type", F.lit("all")))
    return both.select("event_type", "week", "n")


register(
    "f50_distinct_rollup",
    weekly_users,
    """
WITH e AS (SELECT event_type, user_id, date_trunc('week', ts)::DATE AS week FROM events)
SELECT event_type, week, count(DISTINCT user_id) AS n FROM e GROUP BY ALL UNION ALL SELECT 'all', week, count(DISTINCT user_id) FROM e GROUP BY week""",
)
register("f50_progress", lambda s, d: A.progress(table(s, d, "events").where("ts >= TIMESTAMP '2024-01-15'"), "user_id", "ts"), "SELECT count(DISTINCT user_id) AS companies, count(*) AS n, max(ts) AS last FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
register(
    "f51_suspicious_employers",
    lambda s, d: A.suspicious_employers(postings(s, d).where("posted_date > DATE '2001-06-01'"), "employer_name", ["11", "7"], 2, 50),
    """SELECT employer_name, count(*) AS n, contains(employer_name, '11') OR contains(employer_name, '7') AS keyword FROM postings WHERE posted_date > DATE '2001-06-01'
GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, employer_name LIMIT 50""",
)
register("f52_source_coverage", lambda s, d: M.conditional_counts(postings(s, d), ["source"], {"alive": F.col("url_status") == "active", "with_skills": F.size("skills") > 0, "with_pay": F.col("salary_midpoint").isNotNull()}).withColumn("passed", F.col("with_skills") * 100 >= F.col("n") * 95), "SELECT source, count(*) AS n, count(*) FILTER (WHERE url_status = 'active') AS alive, count(*) FILTER (WHERE len(skills) > 0) AS with_skills, count(salary_midpoint) AS with_pay, count(*) FILTER (WHERE len(skills) > 0) * 100 >= count(*) * 95 AS passed FROM postings GROUP BY 1")
register("f53_share_within", lambda s, d: M.share_within(postings(s, d), "city", "job_family"), f"WITH c AS (SELECT city, job_family, count(*) AS n FROM postings GROUP BY ALL) SELECT *, {pct('n', 'sum(n) OVER (PARTITION BY city)')} AS pct FROM c")
register(
    "f54_drop_reasons",
    lambda s, d: A.drop_reasons(postings(s, d), "source", {"agency": F.col("is_agency"), "out_of_scope": F.col("job_family") == "out_of_scope", "gone": F.col("url_status") == "404"}),
    """SELECT source, CASE WHEN is_agency THEN 'agency' WHEN job_family = 'out_of_scope' THEN 'out_of_scope' WHEN url_status = '404' THEN 'gone' ELSE 'kept' END AS reason, count(*) AS n FROM postings GROUP BY ALL""",
)


def months(s, d, low, high):
    return M.distribution(postings(s, d).where(F.col("posted_date").between(F.lit(low).cast("date"), F.lit(high).cast("date"))), "job_subfamily")


def _months_sql(low, high):
    return _distribution_sql("job_subfamily", source=f"(SELECT * FROM postings WHERE posted_date BETWEEN DATE '{low}' AND DATE '{high}')")


_NOW, _BEFORE = ("2001-07-01", "2001-07-31"), ("2001-06-01", "2001-06-30")
_COMPARE = f"""WITH a AS ({_months_sql(*_NOW)}), b AS ({_months_sql(*_BEFORE)}),
m AS (SELECT coalesce(a.code, b.code) AS code, a.pct AS now, b.pct AS before, coalesce(a.pct, 0) - coalesce(b.pct, 0) AS change FROM a FULL JOIN b ON a.code = b.code),
k AS (SELECT *, CASE WHEN before IS NULL THEN 'new' WHEN now IS NULL THEN 'gone' WHEN change >= 1.0 THEN 'up' WHEN change <= -1.0 THEN 'down' ELSE 'same' END AS kind FROM m)"""
register("e14_period_compare", lambda s, d: M.period_compare(months(s, d, *_NOW), months(s, d, *_BEFORE), "code", "pct"), _COMPARE + " SELECT code, now, before, change, kind FROM k")
register("h14_movers", lambda s, d: M.biggest_movers(M.period_compare(months(s, d, *_NOW), months(s, d, *_BEFORE), "code", "pct"), "code"), _COMPARE + """ SELECT * FROM (SELECT 'gainer' AS what, code, change FROM k WHERE kind IN ('up', 'down') AND change > 0 ORDER BY change DESC, code LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'decline' AS what, code, change FROM k WHERE kind IN ('up', 'down') AND change < 0 ORDER BY change, code LIMIT 1)""")
register("h20_growth", lambda s, d: M.growth(postings(s, d), ["job_subfamily"]), "WITH c AS (SELECT job_subfamily, date_trunc('month', posted_date)::DATE AS month, count(*) AS n FROM postings GROUP BY ALL) SELECT *, lag(n) OVER (PARTITION BY job_subfamily ORDER BY month) AS previous FROM c")
register("q01_growth_by_city", lambda s, d: M.growth(postings(s, d), ["job_subfamily", "city"]), "WITH c AS (SELECT job_subfamily, city, date_trunc('month', posted_date)::DATE AS month, count(*) AS n FROM postings GROUP BY ALL) SELECT *, lag(n) OVER (PARTITION BY job_subfamily, city ORDER BY month) AS previous FROM c")
