"""Registered queries of further column functions and small rules on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import text as X
from vacantia.operators import audits as A
from vacantia.operators import filters as C
from vacantia.operators import joins as E
from vacantia.operators import locations as L
from vacantia.operators import merge as J
from vacantia.operators import metrics as M
from vacantia.operators import skipping as K
from vacantia.plans.cases import dealt
from vacantia.plans.postings import AS_OF, employers, postings, shared_folder, spread, table
from vacantia.registry import register
from vacantia.sources import pages

part = lambda s, d: table(s, d, "part")
documents = lambda s, d: table(s, d, "documents")


register("b08_job_id_by_source", lambda s, d: table(s, d, "pages").select("page_id", X.job_id_by_source(F.col("url"), F.when(F.col("page_id") % 3 == 0, "manual").otherwise("lever")).alias("job_id")), "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN md5(url) ELSE nullif(regexp_extract(url, '([0-9]{6,})', 1), '') END AS job_id FROM pages")
register(
    "b16_merge_names",
    lambda s, d: M.merge_names(postings(s, d), "city", s.createDataFrame([("NATION_3", "NATION_1"), ("NATION_7", "SEVENTH")], "alias string, canonical string")).groupBy("city").agg(F.count("*").alias("n")),
    "SELECT CASE city WHEN 'NATION_3' THEN 'NATION_1' WHEN 'NATION_7' THEN 'SEVENTH' ELSE city END AS city, count(*) AS n FROM postings GROUP BY 1",
)
register("b20_currency", lambda s, d: documents(s, d).groupBy(X.valid_currency(F.when(F.col("lang") == "en", "GBP").when(F.col("lang") == "fr", "eur").otherwise("xxx")).alias("currency")).agg(F.count("*").alias("n")), "SELECT CASE lang WHEN 'en' THEN 'gbp' WHEN 'fr' THEN 'eur' END AS currency, count(*) AS n FROM documents GROUP BY 1")
register("b22_null_strings", lambda s, d: X.null_strings(postings(s, d).select("id", F.when(F.col("id") % 4 == 0, "NULL").otherwise(F.col("city")).alias("city"))), "SELECT id, CASE WHEN id % 4 <> 0 THEN city END AS city FROM postings")
register("b25_pay_precedence", lambda s, d: postings(s, d).select("id", X.first_truthy(F.when(F.col("id") % 2 == 0, F.col("salary_midpoint")).otherwise(F.lit(0).cast("decimal(18,2)")), F.lit(1).cast("decimal(18,2)")).alias("pay")), "SELECT id, coalesce(nullif(CASE WHEN id % 2 = 0 THEN salary_midpoint ELSE 0 END, 0), 1)::DECIMAL(18,2) AS pay FROM postings")
register("b26_board_urls", lambda s, d: postings(s, d).select("id", X.board_url(F.col("source"), F.col("id").cast("string"), F.when(F.col("id") % 3 == 0, "eu").when(F.col("id") % 3 == 1, "embed").otherwise("standard")).alias("url")), "SELECT id, CASE id % 3 WHEN 0 THEN 'https://job-boards.eu.greenhouse.io/' || source || '/jobs/' || id WHEN 1 THEN 'https://boards.greenhouse.io/embed/job_app?for=' || source || '&token=' || id ELSE 'https://job-boards.greenhouse.io/' || source || '/jobs/' || id END AS url FROM postings")
register("b27_career_pages", lambda s, d: employers(s, d).select("canonical_name", X.fill_template(F.lit("https://jobs.example.com/{slug}"), F.translate("canonical_name", "#", "-")).alias("url")), "SELECT canonical_name, 'https://jobs.example.com/' || replace(canonical_name, '#', '-') AS url FROM employers")
register(
    "b32_first_non_empty",
    lambda s, d: employers(s, d).select("canonical_name", X.first_non_empty(F.when(F.col("founding_year") % 3 == 0, F.lit("")).otherwise(F.col("industry")), F.col("ownership_type"), F.col("headquarters")).alias("place")),
    "SELECT canonical_name, coalesce(CASE WHEN founding_year % 3 > 0 THEN industry END, ownership_type, headquarters) AS place FROM employers",
)
register(
    "b33_labels",
    lambda s, d: postings(s, d).groupBy(X.decode_label(F.col("seniority"), {"junior": "Junior", "senior": "Senior"}).alias("label")).agg(F.count("*").alias("n")),
    "SELECT CASE seniority WHEN 'junior' THEN 'Junior' WHEN 'senior' THEN 'Senior' ELSE seniority END AS label, count(*) AS n FROM postings GROUP BY 1",
)


register("b34_benchmark_labels", lambda s, d: M.seniority_metrics(postings(s, d)).select(F.when(F.col("senior_to_junior") > 4, "senior-heavy").when(F.col("senior_to_junior") > 2, "balanced").otherwise("junior-friendly").alias("ratio_label"), F.when(F.col("entry_pct") >= 30, "open").when(F.col("entry_pct") >= 15, "mixed").otherwise("closed").alias("entry_label")), """WITH t AS (SELECT count(*) FILTER (WHERE seniority IN ('senior', 'staff_principal', 'director_plus')) AS s, count(*) FILTER (WHERE seniority = 'junior') AS j, count(*) FILTER (WHERE seniority NOT IN ('unknown', 'null')) AS k FROM postings), r AS (SELECT round_even(s / j, 1) AS ratio, round_even(j / k * 100, 0) AS entry FROM t)
SELECT CASE WHEN ratio > 4 THEN 'senior-heavy' WHEN ratio > 2 THEN 'balanced' ELSE 'junior-friendly' END AS ratio_label, CASE WHEN entry >= 30 THEN 'open' WHEN entry >= 15 THEN 'mixed' ELSE 'closed' END AS entry_label FROM r""")
register("b43_changed", lambda s, d: postings(s, d).groupBy(L.changed(F.col("skills"), F.col("skills_all")).alias("changed")).agg(F.count("*").alias("n")), "SELECT skills IS DISTINCT FROM skills_all AS changed, count(*) AS n FROM postings GROUP BY 1")


register(
    "b46_boilerplate",
    lambda s, d: _worded(s, d).select("doc_id", F.md5(X.drop_boilerplate(F.col("text"), ["equal opportunity employer", "cookie"])).alias("text_md5")),
    "SELECT doc_id, md5(CASE WHEN doc_id % 3 = 0 THEN 'Real work.' WHEN doc_id % 3 = 1 THEN 'Real work.' || chr(10) || chr(10) || 'More.' ELSE 'Real work.' END) AS text_md5 FROM documents",
)
register(
    "b47_boilerplate_report",
    lambda s, d: A.boilerplate_report(
        _worded(s, d).join(table(s, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.lit(True).alias("embedded")), "doc_id", "left"),
        "lang", F.col("text"), X.drop_boilerplate(F.col("text"), ["equal opportunity employer", "cookie"]), F.coalesce("embedded", F.lit(False)),
    ),
    f"""WITH r AS (SELECT lang, doc_id % 3 AS k, doc_id IN (SELECT vec_id FROM embeddings) AS e FROM documents),
t AS (SELECT lang, sum(CASE k WHEN 0 THEN 56 WHEN 1 THEN 32 ELSE 10 END)::BIGINT AS before, sum(CASE k WHEN 1 THEN 17 ELSE 10 END)::BIGINT AS after, count(*) AS n, count(*) FILTER (WHERE e) AS embedded FROM r GROUP BY 1)
SELECT *, round_even((before - after) / before * 100, 0)::INT AS boilerplate_pct, round_even(embedded / n * 100, 0)::INT AS embedded_pct FROM t""",
)


def _worded(s, d):
    """Short texts with lines of boilerplate, dealt over the documents."""
    texts = ["Real work.\nWe are an Equal Opportunity Employer, always.", "Real work.\nAccept a cookie\nMore.", "Real work."]
    return table(s, d, "documents").select("doc_id", "lang", dealt("doc_id", texts).alias("text"))


register(
    "c05_accessible",
    lambda s, d: _reachable(s, d).where(L.accessible_from(F.col("locations"), "NATION_6", "NATION_8", "EUROPE")).groupBy("city").agg(F.count("*").alias("n")),
    """SELECT city, count(*) AS n FROM postings WHERE city = 'NATION_6' OR working_arrangement = 'remote' AND id % 2 = 0 OR region = 'EUROPE' AND id % 3 = 0
OR city = 'NATION_8' AND (id % 5 = 0 OR id % 7 = 0) GROUP BY 1""",
)


def open_to_city(s, d):
    """Postings written near their places with a skipping index, and read again for one city."""
    path = f"{shared_folder(s)}/located"
    whole = F.exists("locations", lambda l: F.coalesce(l["scope"] == "global", F.lit(False)))
    K.write_indexed(_reachable(s, d, spread(s, d)).select("id", "city", "region", "locations"), path, near=[whole, F.col("region"), F.col("city"), F.col("id")], files=32)
    place = ("NATION_6", "NATION_8", "EUROPE")
    return K.read_containing(s, path, K.broad_tokens(*place), L.accessible_from(F.col("locations"), *place)).select("id", "city")


register(
    "c04_broad_location",
    open_to_city,
    """SELECT id, city FROM postings WHERE city = 'NATION_6' OR working_arrangement = 'remote' AND id % 2 = 0 OR region = 'EUROPE' AND id % 3 = 0
OR city = 'NATION_8' AND (id % 5 = 0 OR id % 7 = 0)""",
)
register(
    "c06_target_match",
    lambda s, d: _reachable(s, d).where(L.matches_targets(F.col("locations"), cities=["NATION_4"], countries=["NATION_6"])).select("id"),
    "SELECT id FROM postings WHERE city = 'NATION_4' OR working_arrangement = 'remote' AND id % 2 = 0 OR city = 'NATION_6' AND (id % 5 = 0 OR id % 7 = 0)",
)


def _reachable(s, d, parts=None):
    """Postings with a city, and for some a remote location of all the world or of a country, a country or a region."""
    here = L.location("city", F.col("region"), F.col("city"))
    more = [
        F.when((F.col("working_arrangement") == "remote") & (F.col("id") % 2 == 0), L.location("remote", scope="global")),
        F.when(F.col("id") % 3 == 0, L.location("region", region=F.col("region"))),
        F.when(F.col("id") % 5 == 0, L.location("remote", F.col("city"), scope="country")),
        F.when(F.col("id") % 7 == 0, L.location("country", F.col("city"))),
    ]
    return postings(s, d, parts).withColumn("locations", F.array_compact(F.array(here, *more)))
register("c14_rows_of_scope", lambda s, d: C.rows_of_scope(_located(s, d), "global", ["src0", "src2"]).select("id"), "SELECT id FROM postings WHERE working_arrangement = 'remote' AND id % 2 = 0 AND source IN ('src0', 'src2')")
register("b31_primary_label", lambda s, d: _located(s, d).groupBy(L.primary_label(F.col("locations")).alias("label")).agg(F.count("*").alias("n")), "SELECT city AS label, count(*) AS n FROM postings GROUP BY 1")


def _located(s, d):
    """Postings with a city, and for some a remote location of all the world or a region."""
    here = L.location("city", F.col("city"), F.col("city"))
    more = F.when((F.col("working_arrangement") == "remote") & (F.col("id") % 2 == 0), L.location("remote", scope="global"))
    wide = F.when(F.col("id") % 3 == 0, L.location("region", region=F.col("region")))
    return postings(s, d).withColumn("locations", F.array_compact(F.array(here, more, wide)))


register("c20_due_enrichment", lambda s, d: C.due_for_enrichment(employers(s, d).withColumn("description", F.when(F.col("founding_year") % 5 > 0, "x")).withColumn("enrichment_date", F.make_date(F.lit(2001), F.col("founding_year") % 12 + 1, F.lit(1))), F.lit(AS_OF).cast("date")).select("canonical_name"), f"SELECT canonical_name FROM employers WHERE founding_year % 5 = 0 OR make_date(2001, founding_year % 12 + 1, 1) < DATE '{AS_OF}' - 180")
register("c24_titles_differ", lambda s, d: C.titles_that_differ(postings(s, d).select("id", "title"), postings(s, d).select("id", F.when(F.col("id") % 6 == 0, F.upper("title")).otherwise(F.col("title")).alias("title")), "id", "title"), "SELECT id, title, upper(title) AS other_title FROM postings WHERE id % 6 = 0 AND title IS DISTINCT FROM upper(title)")
register("c25_mismatched_rows", lambda s, d: C.mismatched_rows(documents(s, d), table(s, d, "labels").select("doc_id", F.lit("quality").alias("field"), (F.col("quality") == F.col("toxic")).alias("matched")), "doc_id", "quality").select("doc_id"), "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality <> toxic)")
register("j09_url_rewrite", lambda s, d: table(s, d, "pages").select("page_id", X.https(F.col("url")).alias("url")), "SELECT page_id, CASE WHEN starts_with(url, 'http://') THEN 'https://' || url[8:] ELSE url END AS url FROM pages")
register("j11_backfill_locations", lambda s, d: J.changed_only(_located(s, d), "locations", F.slice("locations", 1, 1)).groupBy("was_changed").agg(F.count("*").alias("n")), "SELECT coalesce(working_arrangement = 'remote', false) AND id % 2 = 0 OR id % 3 = 0 AS was_changed, count(*) AS n FROM postings GROUP BY 1")
register("j16_missing_ids", lambda s, d: J.fill_from(postings(s, d).select("id", F.when(F.col("id") % 2 == 0, F.col("title")).alias("title")), postings(s, d), "id", "title"), "SELECT id, title FROM postings")
register("a10_batched_lookup", lambda s, d: E.without_match(postings(s, d), postings(s, d).where("id % 7 <> 0"), "id").select("id"), "SELECT id FROM postings WHERE id % 7 = 0")


def landed_orders(s, d, *conditions):
    """The orders as a listing in pages of a thousand rows, scanned page by page."""
    path = f"{shared_folder(s)}/pages"
    pages.land_pages(table(s, d, "orders"), path, "o_orderkey")
    return pages.scan_pages(s, path, *conditions)


register(
    "a09_full_scan",
    lambda s, d: landed_orders(s, d).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")),
    "SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders",
)
register(
    "a09_filtered_pages",
    lambda s, d: landed_orders(s, d, "o_orderstatus = 'O'", "o_orderkey > 5000", "o_totalprice >= 100000").select("o_orderkey", "o_custkey", "o_totalprice"),
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' AND o_orderkey > 5000 AND o_totalprice >= 100000",
)


def _combined(s, d):
    from vacantia.operators.classify import combine_agency

    pattern = F.when(F.col("id") % 3 == 0, "high").when(F.col("id") % 3 == 1, "medium").otherwise("low")
    agency, sure = combine_agency(pattern, F.when(F.col("id") % 5 > 0, F.col("is_agency")), F.lit(None).cast("string"))
    return postings(s, d).groupBy(agency.alias("agency"), sure.alias("sure")).agg(F.count("*").alias("n"))


register("d02_combine_flags", _combined, """WITH r AS (SELECT CASE id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS p, CASE WHEN id % 5 > 0 THEN is_agency END AS f FROM postings)
SELECT CASE p WHEN 'high' THEN true WHEN 'medium' THEN coalesce(f, true) ELSE coalesce(f, false) END AS agency, CASE WHEN p = 'high' THEN 'high' WHEN p = 'medium' AND f THEN 'high' WHEN p = 'medium' AND NOT f THEN 'low' WHEN p = 'medium' THEN 'medium' WHEN f IS NOT NULL THEN 'medium' ELSE 'low' END AS sure, count(*) AS n FROM r GROUP BY ALL""")
register("d13_legacy_codes", lambda s, d: _legacy(s, d), "SELECT id, CASE WHEN id % 2 = 0 THEN city WHEN city = 'NATION_4' THEN 'beijing' ELSE 'unknown' END AS place FROM postings")


def _legacy(s, d):
    parsed = F.when(F.col("id") % 2 == 0, F.array(L.location("city", F.col("region"), F.col("city")))).otherwise(F.array(L.location("unknown")))
    found = L.from_legacy(F.col("city"), {"NATION_4": L.location("city", "CN", "beijing")}, parsed)
    return postings(s, d).select("id", L.primary_label(found).alias("place"))


register("f21_freshness_totals", lambda s, d: _fresh(s, d), """WITH l AS (SELECT o_custkey AS company, o_orderkey AS job, o_custkey % 10 <> 0 AS ok FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'), h AS (SELECT company, bool_and(ok) AS ok FROM l GROUP BY 1),
t AS (SELECT o_custkey AS company, o_orderkey IN (SELECT job FROM l) AS hit FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'), m AS (SELECT company, count(*) AS tracked, count(*) FILTER (WHERE hit) AS matched FROM t GROUP BY 1)
SELECT CASE WHEN ok IS NULL OR NOT ok THEN 'skipped_error' WHEN matched = 0 AND tracked > 1 THEN 'skipped_suspicious' WHEN hit THEN 'active' ELSE 'closed' END AS verdict, count(*) AS jobs, count(DISTINCT company) AS companies FROM t JOIN m USING (company) LEFT JOIN h USING (company) GROUP BY 1""")


def _fresh(s, d):
    orders = table(s, d, "orders").select(F.col("o_custkey").alias("company"), F.col("o_orderkey").alias("job"), "o_orderdate")
    tracked = orders.where("o_orderdate < TIMESTAMP '2000-01-01'").select("company", "job", F.lit("active").alias("status"))
    listings = orders.where("o_orderdate >= TIMESTAMP '1999-01-01'").select("company", "job", (F.col("company") % 10 != 0).alias("ok"))
    return J.freshness(tracked, listings, ["company"], "job", "status").groupBy("verdict").agg(F.count("*").alias("jobs"), F.countDistinct("company").alias("companies"))


register("j12_rename_families", lambda s, d: _renamed(s, d), "SELECT CASE WHEN skill LIKE '%1' THEN 'first' ELSE 'rest' END AS family, count(*) AS n FROM (SELECT unnest(skills) AS skill FROM postings) GROUP BY 1")


def _renamed(s, d):
    tagged = F.transform("skills", lambda x: F.struct(x.alias("name"), F.when(x.endswith("1"), "one").otherwise("rest").alias("family_code")))
    rows = postings(s, d).select(F.explode(J.rename_families(tagged, {"one": "first"})).alias("k"))
    return rows.groupBy(F.col("k.family_code").alias("family")).agg(F.count("*").alias("n"))
