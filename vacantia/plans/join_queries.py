"""Registered queries of joins, order, sets and merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import text as X
from vacantia.operators import audits as A
from vacantia.operators import classify as D
from vacantia.operators import digests as G
from vacantia.operators import joins as E
from vacantia.operators import market as Q
from vacantia.operators import merge as J
from vacantia.operators import vector_index as V
from vacantia.operators import metrics as M
from vacantia.operators import ranking as H
from vacantia.plans.metric_queries import _fill_sql
from vacantia.plans.postings import AS_OF, SENIORITY, employers, postings, spread, table
from vacantia.registry import register
from vacantia.sources import feeds

_DAY = f"DATE '{AS_OF}'"


def day():
    return F.lit(AS_OF).cast("date")


def context(s, d):
    jobs = postings(s, d)
    return E.with_context(jobs, employers(s, d), M.fill_time(jobs, ["employer_name"]), day())


register(
    "e01_context_view",
    lambda s, d: context(s, d).select("id", "display_name", "industry", "employer_size", F.col("days_open").cast("long").alias("days_open"), "employer_median_days", "fill_time_ratio"),
    f"""WITH f AS ({_fill_sql("employer_name")}) SELECT id, display_name, industry, employer_size, date_diff('day', posted_date, {_DAY}) AS days_open, median_days AS employer_median_days,
CASE WHEN median_days > 0 THEN date_diff('day', posted_date, {_DAY}) / median_days END AS fill_time_ratio
FROM postings p LEFT JOIN employers e ON canonical_name = p.employer_name LEFT JOIN f ON f.employer_name = p.employer_name""",
)
# raw rows are orders; lines of the first half of the years stand for what was enriched, and for what is listed
_EARLY = "TIMESTAMP '1998-01-01'"
lines = lambda s, d: table(s, d, "lineitem").select(F.col("l_orderkey").alias("raw_job_id"), F.col("l_partkey").alias("part"), "l_shipdate")
orders = lambda s, d: table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("slug"), F.col("o_orderstatus").alias("source_job_id"), "o_orderdate")
register("e02_active_jobs", lambda s, d: E.active_jobs(lines(s, d), orders(s, d).where("source_job_id <> 'P'")).groupBy("slug").agg(F.count("*").alias("n")), "SELECT o_custkey AS slug, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P' GROUP BY 1")
register("e03_missing_enriched", lambda s, d: E.without_match(orders(s, d), lines(s, d).where(f"l_shipdate < {_EARLY}"), "id", "raw_job_id").select("id"), f"SELECT o_orderkey AS id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate < {_EARLY})")
register("e04_unknown_hashes", lambda s, d: E.without_match(_hashed(s, d).where("doc_id % 2 = 1"), _hashed(s, d).where("doc_id % 2 = 0"), "hash").select("doc_id"), "WITH h AS (SELECT doc_id, md5(lower(trim(text))) AS hash FROM documents) SELECT doc_id FROM h WHERE doc_id % 2 = 1 AND hash NOT IN (SELECT hash FROM h WHERE doc_id % 2 = 0)")


def _hashed(s, d, *more):
    return table(s, d, "documents").select("doc_id", *more, F.md5(F.lower(F.trim("text"))).alias("hash"))


register("e05_resume", lambda s, d: E.not_recent(table(s, d, "events").select("user_id").distinct(), table(s, d, "events"), "user_id", "ts", F.lit("2024-01-31").cast("timestamp"), 48), "SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 48 HOUR)")
register("e06_listed", lambda s, d: E.listed(orders(s, d), lines(s, d).where(f"l_shipdate >= {_EARLY}").select(F.col("raw_job_id").alias("id")), ["id"]).select("id", "is_listed"), f"SELECT o_orderkey AS id, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= {_EARLY}) AS is_listed FROM orders")
register(
    "e06_listed_by_company",
    lambda s, d: G.listed_by_digest(
        table(s, d, "orders").select("o_custkey", "o_orderkey"), table(s, d, "orders").where("o_custkey % 10 > 0 OR o_orderkey % 3 > 0").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey"
    ),
    "SELECT o_custkey, o_orderkey, o_custkey % 10 > 0 OR o_orderkey % 3 > 0 AS is_listed FROM orders",
)
register("e07_by_report_key", lambda s, d: E.by_report_key(postings(s, d), employers(s, d)).agg(F.count("*").alias("n"), F.count("display_name").alias("matched")), "SELECT count(*) AS n, count(display_name) AS matched FROM postings LEFT JOIN employers ON canonical_name = translate(lower(trim(employer_name)), ' ,.''', '_')")
register("e08_display_names", lambda s, d: E.display_names(postings(s, d), employers(s, d)).select("id", "shown_name"), "SELECT id, coalesce(display_name, employer_name) AS shown_name FROM postings LEFT JOIN employers ON canonical_name = employer_name")
_DIM = [("spring", 1, "a"), ("tomato", 2, "b"), ("green", 3, "c"), ("blue", 4, "d"), ("red", 5, "e")]
register("e09_dictionary", lambda s, d: E.match_dictionary(table(s, d, "part").select("p_partkey", "p_name"), "p_name", s.createDataFrame(_DIM, "pattern string, ord int, value string")).select("p_partkey", "matched"), "SELECT p_partkey, " + "CASE " + " ".join(f"WHEN regexp_matches(lower(p_name), '(^|[^a-z0-9]){p}([^a-z0-9]|$)') THEN '{v}'" for p, _, v in _DIM) + " END AS matched FROM part")


def _skill_map(s, d):
    """Brands to types as a skill mapping: the last type of each brand."""
    return table(s, d, "part").groupBy(F.col("p_brand").alias("name")).agg(F.max("p_type").alias("family")).withColumn("pos", F.lit(0))


def _mapped(s, d):
    from vacantia.operators.classify import map_skills

    # a quarter of the brands is left unmapped
    return map_skills(postings(s, d), "id", "skills_all", _skill_map(s, d).where("NOT name LIKE '%5'"))


_MAP = "m AS (SELECT p_brand AS name, max(p_type) AS family FROM part WHERE p_brand NOT LIKE '%5' GROUP BY 1), k AS (SELECT id, unnest(skills_all) AS skill FROM postings)"
register("e10_skill_families", lambda s, d: _mapped(s, d).groupBy("name", "family").agg(F.count("*").alias("n")), f"WITH {_MAP} SELECT coalesce(name, skill) AS name, family, count(*) AS n FROM k LEFT JOIN m ON lower(m.name) = lower(skill) GROUP BY ALL")
register("f22_skill_audit", lambda s, d: _mapped(s, d).agg(F.count("*").alias("mentions"), F.countDistinct("skill").alias("skills"), F.count("family").alias("mapped")), f"WITH {_MAP} SELECT count(*) AS mentions, count(DISTINCT skill) AS skills, count(family) AS mapped FROM k LEFT JOIN m ON lower(m.name) = lower(skill)")
register("f23_stale_mappings", lambda s, d: Q.stale_mappings(table(s, d, "part").select(F.col("p_brand").alias("skill"), F.col("p_type").alias("family")), _skill_map(s, d)), "WITH m AS (SELECT p_brand AS name, max(p_type) AS family FROM part GROUP BY 1) SELECT lower(p_brand) AS skill, p_type AS current_family, family AS new_family FROM part JOIN m ON lower(name) = lower(p_brand) WHERE p_type <> family GROUP BY ALL")
register("f24_clusters", lambda s, d: Q.keyword_clusters(table(s, d, "part").select(F.col("p_name").alias("skill")), {"warm": ["red", "tomato"], "cold": ["blue", "green"]}, 2), "WITH c AS (SELECT DISTINCT p_name AS skill, CASE WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'tomato') THEN 'warm' WHEN contains(lower(p_name), 'blue') OR contains(lower(p_name), 'green') THEN 'cold' END AS cluster FROM part) SELECT cluster, count(*) AS members FROM c WHERE cluster IS NOT NULL GROUP BY 1 HAVING count(*) >= 2")
register("f25_several_families", lambda s, d: Q.several_families(table(s, d, "part").select(F.col("p_brand").alias("skill"), F.col("p_type").alias("family"), F.col("p_partkey").alias("pos"))), "SELECT lower(p_brand) AS skill, count(DISTINCT p_type) AS families, arg_min(p_type, p_partkey) AS first_family, arg_max(p_type, p_partkey) AS last_family FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
register("f26_mapping_stats", lambda s, d: D.mapping_stats(_skill_map(s, d)), "SELECT family, count(*) AS n FROM (SELECT p_brand, max(p_type) AS family FROM part GROUP BY 1) GROUP BY 1")
register("f27_remap_impact", lambda s, d: _mapped(s, d).groupBy("id").agg(F.sum(F.col("family").isNotNull().cast("int")).alias("hits")).agg(F.count("*").alias("rows"), F.sum((F.col("hits") > 0).cast("long")).alias("updated")), f"WITH {_MAP}, h AS (SELECT id, count(family) AS hits FROM k LEFT JOIN m ON lower(m.name) = lower(skill) GROUP BY 1) SELECT count(*) AS rows, count(*) FILTER (WHERE hits > 0) AS updated FROM h")
register("d03_fix_family", lambda s, d: _fixed(s, d), "WITH m AS (SELECT p_brand AS b, max(p_type) AS t FROM part GROUP BY 1) SELECT p_partkey, t AS p_type, p_type <> t AS was_corrected FROM part JOIN m ON b = p_brand")


def _fixed(s, d):
    from vacantia.operators.classify import fix_family

    return fix_family(table(s, d, "part"), "p_brand", "p_type", _skill_map(s, d).select(F.col("name").alias("subfamily"), "family")).select("p_partkey", "p_type", "was_corrected")


register(
    "e11_orphan_families",
    lambda s, d: E.orphans(table(s, d, "part"), table(s, d, "part").where("p_type IN ('ECONOMY', 'PROMO', 'LARGE')"), "p_type", "p_type"),
    "SELECT DISTINCT p_type FROM part WHERE p_type NOT IN ('ECONOMY', 'PROMO', 'LARGE')",
)
register("e12_gold_predictions", lambda s, d: A.gold_predictions(table(s, d, "documents"), table(s, d, "labels"), "doc_id", ["quality", "toxic"]), "SELECT quality, toxic, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL")
register(
    "e13_labelled_set",
    lambda s, d: A.labelled_set(_hashed(s, d, "text"), _hashed(s, d).where("doc_id % 2 = 0"), "hash", "text", 200).select("doc_id"),
    "WITH h AS (SELECT doc_id, text, md5(lower(trim(text))) AS hash FROM documents) SELECT doc_id FROM h WHERE length(text) > 200 AND hash IN (SELECT hash FROM h WHERE doc_id % 2 = 0)",
)
register("e15_with_enough", lambda s, d: E.with_enough(employers(s, d), postings(s, d), 5, "industry").select("canonical_name", "n_jobs"), "SELECT canonical_name, n_jobs FROM employers JOIN (SELECT employer_name, count(*) AS n_jobs FROM postings GROUP BY 1 HAVING count(*) >= 5) ON employer_name = canonical_name WHERE industry IS NULL")
register("e16_from_siblings", lambda s, d: E.from_siblings(employers(s, d), F.col("headquarters"), "ownership_type", "canonical_name").select("canonical_name", "ownership_type"), "WITH f AS (SELECT headquarters AS h, arg_min(ownership_type, canonical_name) AS v FROM employers WHERE ownership_type IS NOT NULL GROUP BY 1) SELECT canonical_name, coalesce(ownership_type, v) AS ownership_type FROM employers LEFT JOIN f ON h = headquarters")
register("e17_price_out", lambda s, d: E.price_out(table(s, d, "documents").groupBy("source").agg(F.sum("n_chars").alias("tokens")), s.createDataFrame([("a", 0.5), ("b", 2.0)], "model string, price double")).select("source", "model", "cost"), "SELECT source, model, tokens / 1000000 * price AS cost FROM (SELECT source, sum(n_chars)::BIGINT AS tokens FROM documents GROUP BY 1), (VALUES ('a', 0.5::DOUBLE), ('b', 2.0::DOUBLE)) AS p(model, price)")
register("e18_ranked_sources", lambda s, d: E.ranked_sources(postings(s, d).groupBy("employer_name", "source").agg(F.count("*").alias("n")), "employer_name", "source", "n"), "WITH g AS (SELECT employer_name, source, count(*) AS n FROM postings GROUP BY 1, 2), c AS (SELECT employer_name, source, row_number() OVER (PARTITION BY employer_name ORDER BY n DESC, source) AS rank FROM g) SELECT employer_name, max(source) FILTER (WHERE rank = 1) AS primary_source, coalesce(string_agg(source, ',' ORDER BY rank) FILTER (WHERE rank > 1), '') AS alternates FROM c GROUP BY 1")
register("e19_corrections", lambda s, d: E.corrected(employers(s, d), employers(s, d).where("founding_year % 7 = 0").select("canonical_name", F.lit("giant").alias("new_value")), "canonical_name", "employer_size").groupBy("employer_size").agg(F.count("*").alias("n")), "SELECT CASE WHEN founding_year % 7 = 0 THEN 'giant' ELSE employer_size END AS employer_size, count(*) AS n FROM employers GROUP BY 1")
register("e20_delete_by_key", lambda s, d: E.without_match(postings(s, d), employers(s, d).where("industry IS NULL"), "employer_name", "canonical_name").groupBy("city").agg(F.count("*").alias("n")), "SELECT city, count(*) AS n FROM postings WHERE employer_name NOT IN (SELECT canonical_name FROM employers WHERE industry IS NULL) GROUP BY 1")
register("e21_orphan_check", lambda s, d: E.orphans(postings(s, d), employers(s, d).where("founding_year < 2020"), "employer_name", "canonical_name").agg(F.count("*").alias("n")), "SELECT count(DISTINCT employer_name) AS n FROM postings WHERE employer_name NOT IN (SELECT canonical_name FROM employers WHERE founding_year < 2020)")

register("h01_first_per_key", lambda s, d: H.first_per_key(_hashed(s, d), ["hash"], ["doc_id"]), "SELECT min(doc_id) AS doc_id, md5(lower(trim(text))) AS hash FROM documents GROUP BY 2")
register("h02_latest_by_id", lambda s, d: H.latest_by_id(_hashed(s, d), ["hash"], "doc_id"), "SELECT max(doc_id) AS doc_id, md5(lower(trim(text))) AS hash FROM documents GROUP BY 2")
register("h03_top_k", lambda s, d: M.top_k(postings(s, d), "title", 40), "WITH c AS (SELECT title, count(*) AS n FROM postings GROUP BY 1), r AS (SELECT *, sum(n) OVER () AS total, row_number() OVER (ORDER BY n DESC, title NULLS FIRST)::INT AS rank FROM c) SELECT title, n, round_even(n / total * 100, 0)::INT AS pct, rank FROM r WHERE rank <= 40")
register("h04_top_in_group", lambda s, d: M.top_k(postings(s, d), "city", 5, ["job_family"]), "WITH c AS (SELECT job_family, city, count(*) AS n FROM postings GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY job_family) AS total, row_number() OVER (PARTITION BY job_family ORDER BY n DESC, city)::INT AS rank FROM c) SELECT job_family, city, n, round_even(n / total * 100, 0)::INT AS pct, rank FROM r WHERE rank <= 5")
register("h05_business_order", lambda s, d: postings(s, d).groupBy("seniority", H.business_order("seniority").cast("long").alias("place")).agg(F.count("*").alias("n")), "SELECT seniority, CASE seniority WHEN 'junior' THEN 1 WHEN 'mid' THEN 2 WHEN 'senior' THEN 3 WHEN 'staff_principal' THEN 4 WHEN 'director_plus' THEN 5 ELSE 6 END::BIGINT AS place, count(*) AS n FROM postings GROUP BY ALL")
register("h06_oldest_first", lambda s, d: H.oldest_first(postings(s, d), "url_checked_at", "id", 100).select("id"), "SELECT id FROM postings ORDER BY url_checked_at ASC NULLS LAST, id LIMIT 100")
register("h07_newest", lambda s, d: H.newest(postings(s, d), "posted_date", "id", 25).select("id"), "SELECT id FROM postings ORDER BY posted_date DESC NULLS LAST, id LIMIT 25")
register("h08_display_name", lambda s, d: H.display_name(table(s, d, "part").select(F.lower("p_brand").alias("key"), F.col("p_type").alias("name")), "key", "name", least=2), "WITH c AS (SELECT lower(p_brand) AS key, p_type AS name, count(*) AS n FROM part GROUP BY ALL) SELECT key, sum(n)::BIGINT AS n_rows, arg_max(name, (regexp_matches(name, '^[A-Z]'), n, name)) AS display_name FROM c GROUP BY 1 HAVING sum(n) >= 2")
register("h09_titles_per_employer", lambda s, d: H.top_per_group(postings(s, d).where("title IS NOT NULL").select("employer_name", "title").distinct(), ["employer_name"], ["title"], 5), "SELECT * FROM (SELECT employer_name, title, row_number() OVER (PARTITION BY employer_name ORDER BY title)::INT AS rank FROM (SELECT DISTINCT employer_name, title FROM postings WHERE title IS NOT NULL)) WHERE rank <= 5")
register("h10_capped_sample", lambda s, d: H.capped_sample(postings(s, d), "employer_name", "id", 2).groupBy("employer_name").agg(F.count("*").alias("n")), "SELECT employer_name, least(count(*), 2) AS n FROM postings GROUP BY 1")
register(
    "h11_stratified",
    lambda s, d: H.stratified_sample(postings(s, d), "job_family", "id", 200, 30, order=F.md5(F.col("id").cast("string"))).select("id", "job_family"),
    """WITH r AS (SELECT id, job_family, md5(id::VARCHAR) AS o, row_number() OVER (PARTITION BY job_family ORDER BY md5(id::VARCHAR), id) AS rn FROM postings)
SELECT id, job_family FROM r ORDER BY rn > 30, o, id LIMIT 200""",
)
register("h12_round_robin", lambda s, d: H.round_robin(postings(s, d), ["source", "region"], "id", 60).select("id"), "SELECT id FROM (SELECT *, row_number() OVER (PARTITION BY source, region ORDER BY id) AS turn FROM postings) ORDER BY turn, source, region LIMIT 60")
register("h13_recent_per_source", lambda s, d: H.recent_per_source(postings(s, d), "source", "posted_date", "id", 10).select("id", "rank"), "SELECT id, rank FROM (SELECT id, row_number() OVER (PARTITION BY source ORDER BY posted_date DESC, id)::INT AS rank FROM postings) WHERE rank <= 10")
register("h15_pay_rank", lambda s, d: H.pay_rank(postings(s, d), ["job_subfamily", "city"], "salary_midpoint").select("id", "percent_rank"), "SELECT id, percent_rank() OVER (PARTITION BY job_subfamily, city ORDER BY salary_midpoint) AS percent_rank FROM postings")
register("h16_open_roles", lambda s, d: H.open_roles(postings(s, d), ["employer_name", "job_subfamily"]).select("id", "open_roles"), "SELECT id, count(*) OVER (PARTITION BY employer_name, job_subfamily) AS open_roles FROM postings")


def feed(s, d):
    rows = H.pay_rank(context(s, d), ["job_subfamily", "city"], "salary_midpoint")
    roles = postings(s, d).groupBy("employer_name").agg(F.count("*").alias("roles"))
    rows = rows.join(roles, "employer_name").withColumn("grp", H.feed_group(F.col("days_open"), F.col("fill_time_ratio"), F.col("roles"), F.col("percent_rank"), F.col("working_arrangement") == "remote"))
    rows = rows.where("grp IS NOT NULL").withColumn("score", H.relevance(F.col("region") == "EUROPE", F.col("days_open"), F.lit(1), F.col("salary_midpoint").isNotNull()))
    return H.top_per_group(rows, ["grp"], [F.desc("score"), "id"], 7)


_FEED = f"""f AS ({_fill_sql("employer_name")}),
c AS (SELECT p.*, date_diff('day', posted_date, {_DAY}) AS days, date_diff('day', posted_date, {_DAY}) / median_days AS ratio, count(*) OVER (PARTITION BY p.employer_name) AS roles,
percent_rank() OVER (PARTITION BY job_subfamily, city ORDER BY salary_midpoint) AS pr FROM postings p LEFT JOIN f ON f.employer_name = p.employer_name),
g AS (SELECT *, CASE WHEN working_arrangement = 'remote' THEN 'remote' WHEN days <= 7 THEN 'fresh' WHEN pr >= 0.75 THEN 'top_pay' WHEN ratio > 1.5 OR days >= 30 THEN 'still_hiring' WHEN roles >= 3 THEN 'scaling' END AS grp,
CASE WHEN region = 'EUROPE' THEN 100 ELSE 0 END + greatest(50 - days, 0) + 10 + 5 AS score FROM c)"""
register("h17_feed_groups", lambda s, d: feed(s, d).select("id", "grp", "rank"), f"WITH {_FEED} SELECT id, grp, rank FROM (SELECT id, grp, row_number() OVER (PARTITION BY grp ORDER BY score DESC, id)::INT AS rank FROM g WHERE grp IS NOT NULL) WHERE rank <= 7")
register("h18_relevance", lambda s, d: context(s, d).select("id", H.relevance(F.col("region") == "EUROPE", F.col("days_open"), F.lit(1), F.lit(True)).cast("long").alias("score")), f"SELECT id, CASE WHEN region = 'EUROPE' THEN 100 ELSE 0 END + greatest(50 - date_diff('day', posted_date, {_DAY}), 0) + 15 AS score FROM postings")
register("h19_fit_signals", lambda s, d: postings(s, d).select("id", F.array_join(H.fit_signals({"remote": F.col("working_arrangement") == "remote", "senior": F.col("seniority") == "senior", "many_skills": F.size("skills") > 5}), ",").alias("signals")), "SELECT id, concat_ws(',', CASE WHEN working_arrangement = 'remote' THEN 'remote' END, CASE WHEN seniority = 'senior' THEN 'senior' END, CASE WHEN len(skills) > 5 THEN 'many_skills' END) AS signals FROM postings")

register(
    "i01_union",
    lambda s, d: feeds.union_sources(orders(s, d).select("id", F.lit("orders").alias("kind")), table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang")).groupBy("kind", "lang").agg(F.count("*").alias("n")),
    "SELECT kind, lang, count(*) AS n FROM (SELECT o_orderkey AS id, 'orders' AS kind, NULL AS lang FROM orders UNION ALL SELECT doc_id, NULL, lang FROM documents) GROUP BY ALL",
)
register("i02_intersection", lambda s, d: orders(s, d).select("id").intersect(lines(s, d).where(f"l_shipdate >= {_EARLY}").select(F.col("raw_job_id").alias("id"))), f"SELECT o_orderkey AS id FROM orders INTERSECT SELECT l_orderkey FROM lineitem WHERE l_shipdate >= {_EARLY}")
register(
    "i03_vocabularies",
    lambda s, d: table(s, d, "part").where("p_size <= 10").select("p_name", "p_brand").subtract(table(s, d, "part").where("p_size > 40").select("p_name", "p_brand")),
    "SELECT p_name, p_brand FROM part WHERE p_size <= 10 EXCEPT SELECT p_name, p_brand FROM part WHERE p_size > 40",
)
register("i04_new_slugs", lambda s, d: table(s, d, "pages").select(X.host_of(F.col("url")).alias("host")).where("page_id % 2 = 1").subtract(table(s, d, "pages").where("page_id % 2 = 0").select(X.host_of(F.col("url")).alias("host"))), "SELECT lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) AS host FROM pages WHERE page_id % 2 = 1 EXCEPT SELECT lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) FROM pages WHERE page_id % 2 = 0")
register(
    "i05_only_in_one",
    lambda s, d: A.only_in_one(_both(s, d), "o_custkey", "skills", "other"),
    """WITH a AS (SELECT o_custkey, posted_date, skills, id FROM postings JOIN orders ON o_orderkey = id), f AS (SELECT o_custkey, arg_min(skills, (posted_date, id)) AS x, arg_max(skills, (posted_date, id)) AS y FROM a GROUP BY 1)
SELECT o_custkey, len(list_filter(x, lambda v: NOT list_contains(y, v))) AS only_a, len(list_filter(y, lambda v: NOT list_contains(x, v))) AS only_b FROM f""",
)
register("i06_checks", lambda s, d: A.row_counts({"orders": orders(s, d), "customer": table(s, d, "customer")}), "SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer")


def _both(s, d):
    from vacantia.plans.metric_queries import _two_runs

    return _two_runs(s, d)


# snapshots: raw rows are orders before a day, the new snapshot has those of two years around it with other prices
_OLD, _NEW = "o_orderdate < TIMESTAMP '2000-01-01'", "o_orderdate >= TIMESTAMP '1999-01-01'"
_SNAP = "o_orderstatus AS source, o_orderkey AS source_job_id, o_orderkey AS id, {price} AS title, o_orderdate AS scraped_at, {seen} AS last_seen"


def _snapshots(s, d):
    rows = table(s, d, "orders")
    build = lambda where, price, seen: rows.where(where).select(F.col("o_orderstatus").alias("source"), F.col("o_orderkey").alias("source_job_id"), F.col("o_orderkey").alias("id"), F.expr(price).alias("title"), F.col("o_orderdate").alias("scraped_at"), F.expr(seen).alias("last_seen"))
    return build(_OLD, "o_orderpriority", "o_orderdate"), build(_NEW, "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE upper(o_orderpriority || '!') END", "o_orderdate + INTERVAL 10 DAYS")


_O = f"o AS (SELECT o_orderkey AS id, o_orderstatus AS source, o_orderpriority AS title, o_orderdate AS scraped_at, o_orderdate AS last_seen FROM orders WHERE {_OLD})"
_N = f"n AS (SELECT o_orderkey AS id, o_orderstatus AS source, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE upper(o_orderpriority || '!') END AS title, o_orderdate AS scraped_at, o_orderdate + INTERVAL 10 DAY AS last_seen FROM orders WHERE {_NEW})"
_ACT = "CASE WHEN o.id IS NULL THEN 'inserted' WHEN n.id IS NULL THEN 'kept' ELSE 'updated' END"
register("j01_upsert_raw", lambda s, d: J.upsert_raw(*_snapshots(s, d)).select("id", "title", "last_seen", "action"), f"WITH {_O}, {_N} SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN o.title ELSE n.title END AS title, greatest(o.last_seen, n.last_seen) AS last_seen, {_ACT} AS action FROM o FULL JOIN n ON o.id = n.id AND o.source = n.source")
register("j02_upsert_enriched", lambda s, d: J.upsert_enriched(*(x.withColumnRenamed("id", "job_hash").withColumnRenamed("scraped_at", "posted_date") for x in _snapshots(s, d))).select("job_hash", "title", "last_seen", "posted_date", "action"), f"WITH {_O}, {_N} SELECT coalesce(o.id, n.id) AS job_hash, coalesce(n.title, o.title) AS title, coalesce(n.last_seen, o.last_seen) AS last_seen, coalesce(o.scraped_at, n.scraped_at) AS posted_date, {_ACT} AS action FROM o FULL JOIN n ON o.id = n.id")
register("j03_valid_rows", lambda s, d: J.split_valid(postings(s, d).withColumn("title", F.when(F.col("id") % 5 > 0, F.col("title"))), ["employer_name", "title", "city"])[1].groupBy(F.array_join("missing", ",").alias("missing")).agg(F.count("*").alias("n")), "SELECT 'title' AS missing, count(*) AS n FROM postings WHERE id % 5 = 0 OR title IS NULL HAVING count(*) > 0")
register("j04_ensure_employers", lambda s, d: J.ensure_employers(employers(s, d).where("founding_year < 2000").withColumn("display_name", F.col("canonical_name")), employers(s, d)).select("canonical_name", "display_name"), "SELECT canonical_name, display_name FROM employers")
register("j05_inferred", lambda s, d: J.update_inferred(employers(s, d).withColumn("wa", F.lit("none")).withColumn("wa_source", F.when(F.col("founding_year") % 2 == 0, "manual")), M.confident_mode(postings(s, d), "employer_name", "working_arrangement", 0.5).select(F.col("employer_name").alias("canonical_name"), F.col("working_arrangement").alias("value")), "wa", "wa_source").groupBy("wa", "wa_source").agg(F.count("*").alias("n")), """WITH c AS (SELECT employer_name, working_arrangement AS v, count(*) AS n FROM postings WHERE working_arrangement NOT IN ('unknown', 'null') GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY employer_name) AS total, row_number() OVER (PARTITION BY employer_name ORDER BY n DESC, v) AS rank FROM c), m AS (SELECT employer_name, v FROM r WHERE rank = 1 AND total >= 3 AND n / total >= 0.5)
SELECT CASE WHEN v IS NOT NULL AND founding_year % 2 <> 0 THEN v ELSE 'none' END AS wa, CASE WHEN founding_year % 2 = 0 THEN 'manual' WHEN v IS NOT NULL THEN 'inferred' END AS wa_source, count(*) AS n FROM employers LEFT JOIN m ON employer_name = canonical_name GROUP BY ALL""")
register("j06_employer_merge", lambda s, d: J.update_employers(employers(s, d), employers(s, d).withColumn("industry", F.lit("new")).withColumn("headquarters", F.when(F.col("founding_year") > 1990, "here")), ["industry"], ["headquarters"]).groupBy("industry", "headquarters").agg(F.count("*").alias("n")), "SELECT coalesce(industry, 'new') AS industry, CASE WHEN founding_year > 1990 THEN 'here' ELSE headquarters END AS headquarters, count(*) AS n FROM employers GROUP BY ALL")
_LIST = "SELECT o_custkey AS company, o_orderkey AS job, o_custkey % 10 <> 0 AS ok FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'"
register("j07_freshness", lambda s, d: J.freshness(table(s, d, "orders").where("o_orderdate < TIMESTAMP '2000-01-01'").select(F.col("o_custkey").alias("company"), F.col("o_orderkey").alias("job"), F.lit("active").alias("status")), table(s, d, "orders").where("o_orderdate >= TIMESTAMP '1999-01-01'").select(F.col("o_custkey").alias("company"), F.col("o_orderkey").alias("job"), (F.col("o_custkey") % 10 != 0).alias("ok")), ["company"], "job", "status").select("job", "verdict", "status"), f"""WITH l AS ({_LIST}), h AS (SELECT company, bool_and(ok) AS ok, count(*) AS listed FROM l GROUP BY 1),
t AS (SELECT o_custkey AS company, o_orderkey AS job, o_orderkey IN (SELECT job FROM l) AS hit FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'), m AS (SELECT company, count(*) AS tracked, count(*) FILTER (WHERE hit) AS matched FROM t GROUP BY 1),
v AS (SELECT job, CASE WHEN ok IS NULL OR NOT ok OR listed = 0 THEN 'skipped_error' WHEN matched = 0 AND tracked > 1 THEN 'skipped_suspicious' WHEN hit THEN 'active' ELSE 'closed' END AS verdict FROM t JOIN m USING (company) LEFT JOIN h USING (company))
SELECT job, verdict, CASE WHEN verdict = 'closed' THEN 'soft_404' ELSE 'active' END AS status FROM v""")
register("j08_write_status", lambda s, d: J.write_status(postings(s, d).select("id", "url_status", "url_checked_at"), postings(s, d).where("id % 2 = 0").select("id", F.lit("active").alias("url_status"), F.lit(AS_OF).cast("date").alias("url_checked_at"))), f"SELECT id, CASE WHEN id % 2 <> 0 OR url_status = '404' THEN url_status ELSE 'active' END AS url_status, CASE WHEN id % 2 = 0 THEN greatest(url_checked_at, {_DAY}) ELSE url_checked_at END AS url_checked_at FROM postings")
register("j10_backfill_flags", lambda s, d: J.changed_only(postings(s, d), "is_agency", F.col("city") == "CHINA", F.col("id") % 4 == 0).groupBy("was_changed").agg(F.count("*").alias("n")), "SELECT id % 4 = 0 AND is_agency <> (city = 'CHINA') AS was_changed, count(*) AS n FROM postings GROUP BY 1")
register(
    "j14_null_pay",
    lambda s, d: postings(s, d).groupBy("city").agg(F.count(X.suppress_pay(F.col("city"), F.col("salary_midpoint"), ("NATION_4",))).alias("paid")),
    "SELECT city, count(CASE WHEN city <> 'NATION_4' THEN salary_midpoint END) AS paid FROM postings GROUP BY 1",
)
register("j17_touch", lambda s, d: J.touch(_stamped(s, d, "title"), _stamped(s, d, "CASE WHEN id % 3 = 0 THEN upper(title) ELSE title END"), "id", ["title"], day()).select("id", "updated_at"), f"SELECT id, CASE WHEN id % 3 = 0 AND upper(title) IS DISTINCT FROM title THEN {_DAY} ELSE posted_date END AS updated_at FROM postings")


def _stamped(s, d, title):
    return postings(s, d).select("id", F.expr(title).alias("title"), F.col("posted_date").alias("updated_at"))


register(
    "j18_fill_nulls",
    lambda s, d: A.fill_nulls(table(s, d, "documents").join(table(s, d, "labels"), "doc_id", "left"), {"quality": -1}).groupBy("quality").agg(F.count("*").alias("n")),
    "SELECT coalesce(quality, -1) AS quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
)
register("j20_fill_from_side", lambda s, d: J.fill_from(table(s, d, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, 7).alias("quality")), table(s, d, "labels"), "doc_id", "quality"), "SELECT doc_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN 7 END, quality) AS quality FROM documents LEFT JOIN labels USING (doc_id)")

register("q02_titles", lambda s, d: A.titles_of(postings(s, d), "job_subfamily"), "SELECT job_subfamily, count(DISTINCT title) AS titles, count(*) AS n FROM postings GROUP BY 1")
register("q04_skill_share_by_year", lambda s, d: Q.skill_share(postings(s, d), ["job_subfamily"]), "WITH k AS (SELECT year(posted_date)::INT AS year, job_subfamily, unnest(skills) AS skill FROM postings), t AS (SELECT year(posted_date)::INT AS year, job_subfamily, count(*) AS postings FROM postings WHERE len(skills) > 0 GROUP BY ALL) SELECT year, job_subfamily, skill, count(*) AS n, any_value(t.postings) AS postings FROM k JOIN t USING (year, job_subfamily) GROUP BY ALL")
register("q05_seasonality", lambda s, d: A.seasonality(postings(s, d), "posted_date"), "SELECT (dayofweek(posted_date) + 1)::INT AS weekday, month(posted_date)::INT AS month, count(*) AS n FROM postings GROUP BY ALL")
register(
    "q06_new_titles",
    lambda s, d: Q.new_values(postings(s, d).withColumn("title", F.concat("title", F.lit(" "), "employer_name")), "title", 2001),
    """WITH t AS (SELECT title || ' ' || employer_name AS title, year(posted_date) AS y FROM postings) SELECT DISTINCT title FROM t WHERE y = 2001 AND title IS NOT NULL AND title NOT IN (SELECT title FROM t WHERE y = 2000 AND title IS NOT NULL)""",
)
register("q07_similar_titles", lambda s, d: Q.similar_titles(postings(s, d), 0.75), """WITH k AS (SELECT DISTINCT job_subfamily, title, unnest(skills) AS s FROM postings WHERE title IS NOT NULL), c AS (SELECT job_subfamily, title, count(*) AS n FROM k GROUP BY ALL)
SELECT x.job_subfamily, x.title, y.title AS other, count(*) AS common FROM k x JOIN k y ON x.job_subfamily = y.job_subfamily AND x.s = y.s AND x.title < y.title JOIN c a ON a.job_subfamily = x.job_subfamily AND a.title = x.title JOIN c b ON b.job_subfamily = y.job_subfamily AND b.title = y.title
GROUP BY x.job_subfamily, x.title, y.title, a.n, b.n HAVING count(*) >= 0.75 * (a.n + b.n - count(*))""")
register("q08_top_skills_by_role", lambda s, d: M.top_k(postings(s, d).select("job_subfamily", "city", F.explode("skills").alias("skill")), "skill", 3, ["job_subfamily", "city"]), "WITH c AS (SELECT job_subfamily, city, skill, count(*) AS n FROM (SELECT job_subfamily, city, unnest(skills) AS skill FROM postings) GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY job_subfamily, city) AS total, row_number() OVER (PARTITION BY job_subfamily, city ORDER BY n DESC, skill)::INT AS rank FROM c) SELECT job_subfamily, city, skill, n, round_even(n / total * 100, 0)::INT AS pct, rank FROM r WHERE rank <= 3")
register("q08_skill_hierarchy", lambda s, d: Q.skill_hierarchy(table(s, d, "part"), ["p_size", "p_type", "p_brand"]), "SELECT p_size, p_type, p_brand, count(*) AS n FROM part GROUP BY ROLLUP (p_size, p_type, p_brand)")
register("q10_skill_overlap", lambda s, d: Q.skill_overlap(postings(s, d)), "WITH k AS (SELECT DISTINCT job_subfamily, unnest(skills) AS s FROM postings) SELECT x.job_subfamily AS a, y.job_subfamily AS b, count(*) AS common FROM k x JOIN k y ON x.s = y.s AND x.job_subfamily < y.job_subfamily GROUP BY ALL")
register("q11_arrangement_split", lambda s, d: M.distribution(postings(s, d), "working_arrangement", ["job_subfamily", "city"]).select("job_subfamily", "city", "code", "n", "pct"), "WITH c AS (SELECT job_subfamily, city, working_arrangement AS code, count(*) AS n FROM postings WHERE working_arrangement NOT IN ('unknown', 'null') GROUP BY ALL) SELECT *, round_even(n / sum(n) OVER (PARTITION BY job_subfamily, city) * 100, 0)::INT AS pct FROM c")
register("q12_before_after", lambda s, d: M.conditional_counts(postings(s, d), ["city"], {"before": F.col("posted_date") < F.lit("1998-06-01").cast("date"), "after": F.col("posted_date") >= F.lit("1998-06-01").cast("date")}), "SELECT city, count(*) AS n, count(*) FILTER (WHERE posted_date < DATE '1998-06-01') AS before, count(*) FILTER (WHERE posted_date >= DATE '1998-06-01') AS after FROM postings GROUP BY 1")
register("q14_share_with", lambda s, d: M.conditional_counts(postings(s, d), ["job_subfamily"], {"equity": F.col("salary_midpoint") > 200000}).withColumn("pct", M.percent(F.col("equity"), F.col("n"))), "SELECT *, round_even(equity / n * 100, 0)::INT AS pct FROM (SELECT job_subfamily, count(*) AS n, count(*) FILTER (WHERE salary_midpoint > 200000) AS equity FROM postings GROUP BY 1)")
register(
    "q15_clarity",
    lambda s, d: A.clarity(postings(s, d), "employer_name", "skills", 30),
    "SELECT employer_name, sum(len(skills))::BIGINT AS items, count(*) AS n FROM postings GROUP BY 1 ORDER BY sum(len(skills)) / count(*) DESC, employer_name LIMIT 30",
)
register("q16_top_by_quarter", lambda s, d: M.top_k(postings(s, d).withColumn("quarter", F.date_trunc("quarter", "posted_date").cast("date")), "employer_name", 2, ["job_subfamily", "quarter"]), "WITH c AS (SELECT job_subfamily, date_trunc('quarter', posted_date)::DATE AS quarter, employer_name, count(*) AS n FROM postings GROUP BY ALL), r AS (SELECT *, sum(n) OVER (PARTITION BY job_subfamily, quarter) AS total, row_number() OVER (PARTITION BY job_subfamily, quarter ORDER BY n DESC, employer_name)::INT AS rank FROM c) SELECT job_subfamily, quarter, employer_name, n, round_even(n / total * 100, 0)::INT AS pct, rank FROM r WHERE rank <= 2")
register(
    "q17_pairs_of_employers",
    lambda s, d: M.skill_pairs(postings(s, d, spread(s, d), of_part=True), k=None, by=["employer_name"], parts=spread(s, d)),
    "WITH p AS (SELECT id, employer_name, unnest(skills) AS s FROM postings) SELECT x.employer_name, x.s AS a, y.s AS b, count(*) AS n FROM p x JOIN p y ON x.id = y.id AND x.s < y.s GROUP BY ALL",
)
register("q18_size_split", lambda s, d: context(s, d).groupBy("employer_size", "seniority").agg(F.count("*").alias("n")), "SELECT employer_size, seniority, count(*) AS n FROM postings LEFT JOIN employers ON canonical_name = employer_name GROUP BY ALL")
register("q19_seniority_by_role", lambda s, d: M.cross_tab(postings(s, d), "job_subfamily", "seniority"), "SELECT CASE WHEN grouping(job_subfamily) = 1 THEN 'All' ELSE coalesce(job_subfamily, 'none') END AS job_subfamily, CASE WHEN grouping(seniority) = 1 THEN 'All' ELSE coalesce(seniority, 'none') END AS seniority, count(*) AS n FROM postings GROUP BY CUBE (job_subfamily, seniority)")
register(
    "q20_count_and_latest",
    lambda s, d: A.count_and_latest(postings(s, d), (F.col("job_family") == "data") & ~F.col("is_agency"), "posted_date"),
    "SELECT count(*) AS n, max(posted_date) AS latest FROM postings WHERE job_family = 'data' AND NOT is_agency",
)


def vector_search(s, d, where: str | None = None):
    """Exact search of every hundredth vector."""
    vectors = table(s, d, "embeddings")
    return V.search(V.build_index(vectors), vectors.where("vec_id % 100 = 0"), 0.3, 10, where=where)


def _vector_sql(where: str = "TRUE") -> str:
    return f"""
WITH q AS (SELECT vec_id AS query_id, embedding AS qe FROM embeddings WHERE vec_id % 100 = 0),
s AS (SELECT query_id, vec_id, round(list_cosine_similarity(qe::DOUBLE[], embedding::DOUBLE[]), 6) AS similarity FROM q, embeddings WHERE vec_id <> query_id AND {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id)::INT AS rank FROM s WHERE similarity >= 0.3)
SELECT query_id, vec_id, similarity, rank FROM r WHERE rank <= 10"""


register("q21_vector_search", vector_search, _vector_sql())
register("q21_vector_search_filtered", lambda s, d: vector_search(s, d, "label % 2 = 1"), _vector_sql("label % 2 = 1"))
