"""Registered queries of the column functions, filters and rule-based classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import text as X
from vacantia.operators import classify as D
from vacantia.operators import filters as C
from vacantia.operators import metrics as M
from vacantia.plans.postings import AS_OF, postings, table
from vacantia.registry import register


def day():
    """The postings' today."""
    return F.lit(AS_OF).cast("date")


def _any(column: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{p}')" for p in parts) + ")"


pages = lambda s, d: table(s, d, "pages")
documents = lambda s, d: table(s, d, "documents")

_HTML = "trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
register("b01_strip_html", lambda s, d: pages(s, d).select("page_id", F.md5(X.strip_tags(F.col("html"))).alias("text_md5")), f"SELECT page_id, md5({_HTML}) AS text_md5 FROM pages")
#: What the SQL decodes, stated apart from the library, in this order.
_DECODED = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&#160;", " "), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&rsquo;", "’"), ("&lsquo;", "‘"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&bull;", "•"), ("&hellip;", "…"), ("&amp;", "&"),
]
_DECODE = "coalesce(html, '')"
for _e, _v in _DECODED:
    _DECODE = f"replace({_DECODE}, '{_e}', '{_v.replace(chr(39), chr(39) * 2)}')"
_CLEAN = f"trim(regexp_replace(regexp_replace({_DECODE}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"
register("b01_html_text", lambda s, d: pages(s, d).select("page_id", F.md5(X.strip_html(F.col("html"))).alias("text_md5")), f"SELECT page_id, md5({_CLEAN}) AS text_md5 FROM pages")
_STRIPPED = "regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g')"
for _e, _v in _DECODED:
    _STRIPPED = f"replace({_STRIPPED}, '{_e}', '{_v.replace(chr(39), chr(39) * 2)}')"
register("b02_html_text_tags_first", lambda s, d: pages(s, d).select("page_id", F.md5(X.strip_html(F.col("html"), False)).alias("text_md5")), f"SELECT page_id, md5(trim(regexp_replace({_STRIPPED}, '\\s+', ' ', 'g'))) AS text_md5 FROM pages")
register(
    "b41_truncate",
    lambda s, d: documents(s, d).select("doc_id", X.truncated(F.col("text"), 1000).alias("head")).select("doc_id", F.length("head").cast("long").alias("n"), F.md5("head").alias("head_md5")),
    "SELECT doc_id, length(left(text, 1000)) AS n, md5(left(text, 1000)) AS head_md5 FROM documents",
)
register("b07_job_id", lambda s, d: pages(s, d).select("page_id", X.job_id(F.col("url")).alias("job_id")), """SELECT page_id, coalesce(nullif(regexp_extract(url, '/(?:jobs?|careers|positions?)/([A-Za-z0-9-]*[0-9][A-Za-z0-9-]*)', 1), ''),
nullif(regexp_extract(url, '[?&](?:gh_jid|jobid|job_id|id)=([A-Za-z0-9-]+)', 1), ''), left(md5(url), 12)) AS job_id FROM pages""")
register("b09_hosts", lambda s, d: pages(s, d).select(X.host_of(F.col("url")).alias("host")).where("host IS NOT NULL").groupBy("host").agg(F.count("*").alias("n")), "SELECT lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) AS host, count(*) AS n FROM pages WHERE regexp_matches(url, '^https?://([^/:?#]+)') GROUP BY 1")
register("b10_slugs", lambda s, d: C.mined_slugs(pages(s, d), "url", "[^/]+", ["api", "jobs"]), "SELECT DISTINCT lower(regexp_extract(url, 'https?://(?:www\\.)?[^/]+/([A-Za-z0-9_.-]+)', 1)) AS slug FROM pages WHERE lower(regexp_extract(url, 'https?://(?:www\\.)?[^/]+/([A-Za-z0-9_.-]+)', 1)) NOT IN ('', 'api', 'jobs')")
register("b11_row_hash", lambda s, d: postings(s, d).select("id", X.row_hash(F.col("employer_name"), F.col("title"), F.col("city")).alias("hash")), "SELECT id, md5(coalesce(nullif(lower(trim(employer_name)), ''), 'unknown') || '|' || coalesce(nullif(lower(trim(title)), ''), 'unknown') || '|' || coalesce(nullif(lower(trim(city)), ''), 'unknown')) AS hash FROM postings")
register("b12_merge_key", lambda s, d: postings(s, d).select("id", X.merge_key(F.col("employer_name"), F.col("title"), F.col("city")).alias("hash")), "SELECT id, md5(lower(coalesce(employer_name, '')) || '|' || lower(coalesce(title, '')) || '|' || lower(coalesce(city, ''))) AS hash FROM postings")
register("b13_names", lambda s, d: table(s, d, "customer").select("c_custkey", X.canonical_name(F.col("c_name")).alias("canonical"), X.report_key(F.col("c_name")).alias("report"), X.sibling_key(F.col("c_name")).alias("sibling")), """SELECT c_custkey, lower(trim(c_name)) AS canonical, translate(lower(trim(c_name)), ' ,.''', '_') AS report, regexp_replace(regexp_replace(lower(c_name), 'careers', '', 'g'), '[^a-z0-9]', '', 'g') AS sibling FROM customer""")
register("b19_skill_key", lambda s, d: table(s, d, "part").select("p_partkey", X.skill_key(F.col("p_type")).alias("key")), """WITH p AS (SELECT p_partkey, replace(replace(replace(replace(replace(lower(trim(p_type)), 'modelling', 'modeling'), 'visualisation', 'visualization'), 'organisation', 'organization'), 'optimisation', 'optimization'), 'cataloguing', 'cataloging') AS n, lower(trim(p_type)) AS raw FROM part)
SELECT p_partkey, CASE WHEN length(raw) < 4 THEN raw WHEN ends_with(n, 'ies') AND length(n) > 5 THEN left(n, length(n) - 3) || 'y' WHEN ends_with(n, 'ses') AND length(n) > 5 THEN left(n, length(n) - 2)
WHEN ends_with(n, 's') AND NOT ends_with(n, 'ss') AND NOT ends_with(n, 'us') THEN left(n, length(n) - 1) ELSE n END AS key FROM p""")
register("b21_arrangement", lambda s, d: postings(s, d).groupBy(X.arrangement(F.col("working_arrangement")).alias("arrangement")).agg(F.count("*").alias("n")), "SELECT CASE WHEN working_arrangement IN ('onsite', 'hybrid', 'remote', 'flexible') THEN working_arrangement ELSE 'unknown' END AS arrangement, count(*) AS n FROM postings GROUP BY 1")
register(
    "b23_suppress_pay",
    lambda s, d: postings(s, d).select("id", X.suppress_pay(F.col("city"), F.col("salary_midpoint"), ("NATION_3", "NATION_5")).alias("pay")),
    "SELECT id, CASE WHEN city NOT IN ('NATION_3', 'NATION_5') THEN salary_midpoint END AS pay FROM postings",
)
register("b28_maturity", lambda s, d: _employers(s, d).select("canonical_name", X.maturity(F.col("founding_year")).alias("maturity")), "SELECT canonical_name, CASE WHEN 2025 - founding_year <= 5 THEN 'startup' WHEN 2025 - founding_year <= 15 THEN 'growth' WHEN founding_year IS NOT NULL THEN 'mature' END AS maturity FROM employers")
register("b35_days_open", lambda s, d: postings(s, d).select("id", X.days_open(F.col("posted_date"), day()).cast("long").alias("days")), f"SELECT id, date_diff('day', posted_date, DATE '{AS_OF}') AS days FROM postings")
register("b36_period_label", lambda s, d: postings(s, d).groupBy(X.period_label(F.col("posted_date")).alias("label")).agg(F.count("*").alias("n")), "SELECT strftime(posted_date, '%B %Y') AS label, count(*) AS n FROM postings GROUP BY 1")
register("b39_family_guess", lambda s, d: postings(s, d).groupBy(D.first_family(F.col("title"), {"data": ["data", "green"], "product": ["product", "blue"], "delivery": ["red"]}).alias("family")).agg(F.count("*").alias("n")), "SELECT CASE WHEN regexp_matches(lower(title), 'data|green') THEN 'data' WHEN regexp_matches(lower(title), 'product|blue') THEN 'product' WHEN regexp_matches(lower(title), 'red') THEN 'delivery' ELSE 'out_of_scope' END AS family, count(*) AS n FROM postings GROUP BY 1")
register("b42_cost", lambda s, d: documents(s, d).select("doc_id", X.token_cost(F.col("n_chars"), F.lit(0.5)).alias("cost")), "SELECT doc_id, n_chars / 1000000 * 0.5::DOUBLE AS cost FROM documents")

register("c01_titles", lambda s, d: C.relevant_titles(postings(s, d), "title", ["green|blue", "^red", "(unclosed"]).select("id"), "SELECT id FROM postings WHERE regexp_matches(lower(title), 'green|blue') OR regexp_matches(lower(title), '^red')")
register("c02_locations", lambda s, d: postings(s, d).where(C.in_target(F.col("city"), ["nation_1", "nation_23"])).select("id"), "SELECT id FROM postings WHERE contains(lower(city), 'nation_1') OR contains(lower(city), 'nation_23')")
register("c03_funnel", lambda s, d: C.funnel(postings(s, d), {"title": ~F.lower("title").rlike("a"), "location": ~C.in_target(F.col("city"), ["an"])}).groupBy("source", "drop_reason").agg(F.count("*").alias("n")), "SELECT source, CASE WHEN NOT contains(lower(title), 'a') THEN 'title' WHEN NOT contains(lower(city), 'an') THEN 'location' END AS drop_reason, count(*) AS n FROM postings GROUP BY ALL")


def observed_counters(s, d):
    """The kept rows are written by one pass over the postings, and the counters are those of this pass."""
    from vacantia.storage import written

    kept, counters = C.observed_funnel(postings(s, d), {"title": ~F.lower("title").rlike("a"), "location": ~C.in_target(F.col("city"), ["an"])})
    written(kept.select("id", "title", "city"))
    return s.createDataFrame(sorted(counters.get.items()), "counter string, n long")


register(
    "c03_observed_funnel",
    observed_counters,
    """
WITH r AS (SELECT CASE WHEN NOT contains(lower(title), 'a') THEN 'title' WHEN NOT contains(lower(city), 'an') THEN 'location' END AS reason FROM postings)
SELECT 'seen' AS counter, count(*) AS n FROM r UNION ALL SELECT 'kept', count(*) FILTER (WHERE reason IS NULL) FROM r
UNION ALL SELECT 'dropped_title', count(*) FILTER (WHERE reason = 'title') FROM r UNION ALL SELECT 'dropped_location', count(*) FILTER (WHERE reason = 'location') FROM r""",
)
register("c09_family_range", lambda s, d: C.family_range(postings(s, d), "data", "2000-01-01", "2000-12-31").groupBy("city").agg(F.count("*").alias("n")), "SELECT city, count(*) AS n FROM postings WHERE job_family = 'data' AND posted_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31' GROUP BY 1")
register("c10_long_enough", lambda s, d: C.long_enough(documents(s, d), "text", 500).groupBy("lang").agg(F.count("*").alias("n")), "SELECT lang, count(*) AS n FROM documents WHERE length(trim(text)) >= 500 GROUP BY 1")
register("c11_due_checks", lambda s, d: C.due_for_check(postings(s, d), "url_status", "url_checked_at", day(), 3).select("id"), f"SELECT id FROM postings WHERE url_status NOT IN ('404', '410') AND (url_checked_at IS NULL OR url_checked_at < DATE '{AS_OF}' - 3)")
register("c12_open_rows", lambda s, d: C.open_rows(postings(s, d), "source", "src1", "url_status").select("id"), "SELECT id FROM postings WHERE source = 'src1' AND url_status NOT IN ('404', '410', 'soft_404')")
register("c15_paid_rows", lambda s, d: C.paid_rows(postings(s, d), "salary_midpoint", "city", "NATION_3").select("id"), "SELECT id FROM postings WHERE salary_midpoint IS NOT NULL AND city = 'NATION_3'")
register("c16_reclassify", lambda s, d: C.to_reclassify(postings(s, d), "product", "2001-01-01", "2001-12-31", "e").select("id"), "SELECT id FROM postings WHERE NOT is_agency AND job_family = 'product' AND posted_date BETWEEN DATE '2001-01-01' AND DATE '2001-12-31' AND regexp_matches(title, '(?i)e')")
register("c17_misfiled", lambda s, d: C.misfiled(postings(s, d), ["%green%", "%blue%"], ["red"]).select("id"), "SELECT id FROM postings WHERE job_family = 'product' AND (title ILIKE '%green%' OR title ILIKE '%blue%') AND NOT contains(lower(title), 'red')")
register(
    "c19_missing",
    lambda s, d: C.missing_values(documents(s, d).join(table(s, d, "labels"), "doc_id", "left"), "quality", "text", 100).select("doc_id"),
    "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL AND length(text) >= 100",
)
register("c22_edge_titles", lambda s, d: C.edge_titles(postings(s, d), "title", ["gizmo", "anvil"]).select("id"), f"SELECT id FROM postings WHERE {_any('lower(title)', ['gizmo', 'anvil'])}")
register(
    "c23_contains_all",
    lambda s, d: C.any_element(postings(s, d), "skills", lambda x: (x >= "Brand#2") & x.endswith("5")).select("id"),
    "SELECT id FROM postings WHERE len(list_filter(skills, lambda x: x >= 'Brand#2' AND ends_with(x, '5'))) > 0",
)

_NAME, _TEXT = "lower(trim(employer_name))", "lower(coalesce(title, ''))"
register("d12_broken_json", lambda s, d: table(s, d, "events").select("event_id", X.field_from_broken_json(F.col("props"), "k").alias("k")), "SELECT event_id, coalesce(TRY(json_extract_string(props, '$.k')), nullif(regexp_extract(props, '\"k\"\\s*:\\s*\"([^\"]*)\"', 1), '')) AS k FROM events")
register("d06_arrangement", lambda s, d: postings(s, d).select("id", D.arrangement_precedence(F.when(F.col("source") == "src0", "lever").otherwise(F.col("source")), F.col("working_arrangement"), F.when(F.col("id") % 3 == 0, "unknown").otherwise("hybrid"), F.col("id") % 2 == 0, F.lit("onsite")).alias("arrangement")), """SELECT id, CASE WHEN source = 'src0' THEN coalesce(nullif(working_arrangement, 'unknown'), CASE WHEN id % 3 <> 0 THEN 'hybrid' END, 'onsite') ELSE coalesce(CASE WHEN id % 3 <> 0 THEN 'hybrid' END, CASE WHEN id % 2 = 0 THEN 'remote' END, 'onsite') END AS arrangement FROM postings""")


def _employers(s, d):
    from vacantia.plans.postings import employers

    return employers(s, d)
