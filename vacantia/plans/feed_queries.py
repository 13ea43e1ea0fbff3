"""Registered queries of the scans and sinks: feeds are landed as files from the driver's tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.operators import merge as J
from vacantia.plans.cases import dealt, dealt_sql
from vacantia.plans.postings import postings, shared_folder, table
from vacantia.registry import register
from vacantia.sources import feeds

_PAID = ["salary_min", "salary_max", "currency"]


def _landed(s, d, **columns):
    """A folder of JSON lines with these fields of each posting; null fields are left out, as in a feed."""
    path = f"{shared_folder(s)}/landed"
    postings(s, d).select(F.to_json(F.struct(F.col("source").alias("company_slug"), *(c.alias(k) for k, c in columns.items()))).alias("value")).write.text(path)
    return path


def greenhouse(s, d):
    even = F.col("id") % 2 == 0
    path = _landed(
        s, d, id=F.col("id"), title=F.col("title"), location=F.struct(F.when(F.col("id") % 5 > 0, F.col("city")).alias("name")),
        departments=F.when(F.col("id") % 3 > 0, F.array(F.struct(F.col("job_family").alias("name")), F.struct(F.lit("second").alias("name")))),
        pay_input_ranges=F.when(even, F.array(F.struct((F.col("id") * 100 + 55).alias("min_cents"), (F.col("id") * 250).alias("max_cents"), F.lit("USD").alias("currency_type")))),
        content=F.concat(F.lit("&lt;p&gt;"), F.coalesce("title", F.lit("-")), F.lit("&lt;/p&gt; &amp; more")), absolute_url=F.concat(F.lit("https://x.co/"), "id"),
    )
    return feeds.greenhouse(feeds.read_json(s, path, feeds.GREENHOUSE)).select("company_slug", "job_id", "title", "location", "department", "description", "url", *_PAID)


register("a01_greenhouse_scan", greenhouse, """
SELECT source AS company_slug, id::VARCHAR AS job_id, title, CASE WHEN id % 5 > 0 THEN city ELSE 'Unspecified' END AS location, CASE WHEN id % 3 > 0 THEN job_family END AS department,
coalesce(title, '-') || ' & more' AS description, 'https://x.co/' || id AS url, CASE WHEN id % 2 = 0 THEN id::DOUBLE END AS salary_min, CASE WHEN id % 2 = 0 THEN floor(id * 2.5)::DOUBLE END AS salary_max,
CASE WHEN id % 2 = 0 THEN 'USD' END AS currency FROM postings""")


def lever(s, d):
    every = lambda k: F.col("id") % k == 0
    path = _landed(
        s, d, id=F.col("id").cast("string"), text=F.col("title"), descriptionPlain=F.when(~every(4), F.lit("Intro")), description=F.lit("<b>Intro</b> html"),
        lists=F.when(every(3), F.array(F.struct(F.lit("You").alias("text"), F.lit("<li>Code &amp; test</li>").alias("content")), F.struct(F.lit("").alias("text"), F.lit("<li>Talk</li>").alias("content")))),
        additionalPlain=F.when(every(2), F.lit("End")), workplaceType=F.when(every(5), "remote").otherwise("unspecified"), hostedUrl=F.when(every(2), F.concat(F.lit("https://l.co/"), "id")), applyUrl=F.lit("https://l.co/apply"),
        categories=F.struct(F.col("city").alias("location"), F.when(every(3), F.array("city", "region")).alias("allLocations"), F.lit("Team").alias("team"), F.when(every(2), F.col("job_family")).alias("department"), F.lit("Full-time").alias("commitment")),
        createdAt=F.col("id") * 1000,
    )
    rows = feeds.lever(feeds.read_json(s, path, feeds.LEVER))
    return rows.select("job_id", "title", "location", "department", "employment_type", "description", "url", "is_remote", "working_arrangement", F.unix_seconds("posted_at").alias("posted"))


register("a02_lever_scan", lever, """
SELECT id::VARCHAR AS job_id, title, CASE WHEN id % 3 = 0 THEN city || ' / ' || region ELSE city END AS location, CASE WHEN id % 2 = 0 THEN job_family ELSE 'Team' END AS department, 'Full-time' AS employment_type,
concat_ws(chr(10) || chr(10), CASE WHEN id % 4 > 0 THEN 'Intro' ELSE 'Intro html' END, CASE WHEN id % 3 = 0 THEN 'You' || chr(10) || 'Code & test' || chr(10) || chr(10) || 'Talk' END, CASE WHEN id % 2 = 0 THEN 'End' END) AS description,
CASE WHEN id % 2 = 0 THEN 'https://l.co/' || id ELSE 'https://l.co/apply' END AS url, id % 5 = 0 AS is_remote, CASE WHEN id % 5 = 0 THEN 'remote' END AS working_arrangement, id AS posted FROM postings""")
register("b03_list_sections", lambda s, d: lever(s, d).select("job_id", "description"), """
SELECT id::VARCHAR AS job_id, concat_ws(chr(10) || chr(10), CASE WHEN id % 4 > 0 THEN 'Intro' ELSE 'Intro html' END, CASE WHEN id % 3 = 0 THEN 'You' || chr(10) || 'Code & test' || chr(10) || chr(10) || 'Talk' END, CASE WHEN id % 2 = 0 THEN 'End' END) AS description FROM postings""")
register("b04_pay_from_cents", lambda s, d: greenhouse(s, d).select("job_id", "salary_min", "salary_max"), "SELECT id::VARCHAR AS job_id, CASE WHEN id % 2 = 0 THEN id::DOUBLE END AS salary_min, CASE WHEN id % 2 = 0 THEN floor(id * 2.5)::DOUBLE END AS salary_max FROM postings")

#: (compensation as JSON, least, most, currency)
_PAY = [
    ('{"compensationTiers":[{"salaryRange":{"min":{"value":100,"currency":"USD"},"max":{"value":200,"currency":"USD"}}}]}', 100.0, 200.0, "USD"),
    ('{"compensationTiers":[{"salaryRange":{"max":{"value":300,"currency":"EUR"}}}]}', None, 300.0, "EUR"),
    ('{"compensationTiers":[{"salaryRange":{"min":{"value":0,"currency":"USD"}},"components":[{"compensationType":"Bonus","minValue":1},{"compensationType":"Salary","minValue":5,"maxValue":9,"currencyCode":"GBP"}]}]}', 5.0, 9.0, "GBP"),
    ('{"summaryComponents":[{"compensationType":"Bonus","minValue":1},{"compensationType":"Salary","minValue":7,"maxValue":8,"currencyCode":"INR"}]}', 7.0, 8.0, "INR"),
    (None, None, None, None),
    ('{"compensationTiers":[{"salaryRange":{"max":{"value":300,"currency":"EUR"}},"components":[{"compensationType":"Salary","minValue":50,"currencyCode":"USD"}]}]}', 50.0, 300.0, "USD"),
    ('{"compensationTiers":[{"salaryRange":{"min":{"value":70.9,"currency":"SGD"},"max":{"value":80}}}],"summaryComponents":[{"compensationType":"Salary","minValue":1}]}', 70.0, 80.0, "SGD"),
]


def ashby(s, d):
    schema = next(f.dataType for f in s.createDataFrame([], feeds.ASHBY.replace("\n", " ")).schema if f.name == "compensation")
    path = _landed(
        s, d, id=F.col("id").cast("string"), title=F.col("title"), location=F.when(F.col("id") % 4 > 0, F.col("city")), isRemote=F.col("id") % 2 == 0,
        secondaryLocations=F.when(F.col("id") % 4 > 1, F.array(F.struct(F.col("region").alias("location")), F.struct(F.col("city").alias("location")))),
        address=F.struct(F.struct(F.col("city").alias("addressLocality"), F.col("region").alias("addressCountry")).alias("postalAddress")),
        compensation=F.from_json(dealt("id", [p[0] for p in _PAY]), schema), descriptionHtml=F.lit("<p>Do &amp; be</p>"),
    )
    return feeds.ashby(feeds.read_json(s, path, feeds.ASHBY)).select("job_id", "title", "location", "description", "is_remote", "working_arrangement", *_PAID)


register("a03_ashby_scan", ashby, f"""
SELECT id::VARCHAR AS job_id, title, CASE id % 4 WHEN 0 THEN city || ', ' || region WHEN 1 THEN city ELSE city || ' / ' || region END AS location, 'Do & be' AS description, id % 2 = 0 AS is_remote,
CASE WHEN id % 2 = 0 THEN 'remote' END AS working_arrangement, {", ".join(f"{dealt_sql('id', [p[k] for p in _PAY])} AS {c}" for k, c in enumerate(_PAID, 1))} FROM postings""")
register("b05_ashby_pay", lambda s, d: ashby(s, d).select("job_id", *_PAID), f"SELECT id::VARCHAR AS job_id, {', '.join(f'{dealt_sql("id", [p[k] for p in _PAY])} AS {c}' for k, c in enumerate(_PAID, 1))} FROM postings")


def workable(s, d):
    kind = F.col("id") % 3
    path = _landed(
        s, d, shortcode=F.col("id").cast("string"), title=F.col("title"), city=F.col("city"), country=F.col("region"), telecommuting=F.when(F.col("id") % 4 > 0, F.col("id") % 4 == 1), workplace_type=F.when(F.col("id") % 4 == 3, "Hybrid"),
        location=F.when(kind == 0, F.struct(F.concat(F.lit("at "), "city").alias("location_str"), F.lit("x").alias("city"))).when(kind == 1, F.struct(F.lit(None).cast("string").alias("location_str"), F.concat(F.lit("in "), "city").alias("city"))),
        salary=F.when(F.col("id") % 2 == 0, F.struct(F.lit(10.0).alias("salary_from"), F.lit(20.0).alias("salary_to"), F.lit("eur").alias("salary_currency"))), description=F.lit("<p>Do</p>"), published_on=F.lit("2001-02-03"),
    )
    return feeds.workable(feeds.read_json(s, path, feeds.WORKABLE)).select("job_id", "title", "location", "is_remote", "working_arrangement", "description", *_PAID, F.col("posted_at").cast("date").alias("posted"))


register("a04_workable_scan", workable, """
SELECT id::VARCHAR AS job_id, title, CASE id % 3 WHEN 0 THEN 'at ' || city WHEN 1 THEN 'in ' || city ELSE city || ', ' || region END AS location, CASE WHEN id % 4 > 0 THEN id % 4 = 1 END AS is_remote,
CASE id % 4 WHEN 1 THEN 'remote' WHEN 2 THEN 'on_site' WHEN 3 THEN 'hybrid' END AS working_arrangement, 'Do' AS description, CASE WHEN id % 2 = 0 THEN 10.0::DOUBLE END AS salary_min, CASE WHEN id % 2 = 0 THEN 20.0::DOUBLE END AS salary_max,
CASE WHEN id % 2 = 0 THEN 'EUR' END AS currency, DATE '2001-02-03' AS posted FROM postings""")


def smartrecruiters(s, d):
    text = lambda k, x: F.struct(F.lit(x).alias("text")).alias(k)
    listed = _landed(s, d, id=F.col("id").cast("string"), name=F.col("title"), location=F.struct(F.col("city").alias("city"), F.col("region").alias("country"), (F.col("id") % 3 == 0).alias("remote")), department=F.struct(F.col("job_family").alias("label")))
    sections = F.struct(F.struct(text("companyDescription", ""), text("jobDescription", "<p>Do</p>"), text("qualifications", "Be")).alias("sections"))
    detail = _landed(s, d, id=F.when(F.col("id") % 2 == 0, F.col("id").cast("string")), jobAd=sections, applyUrl=F.lit("https://s.co/apply"))
    rows = feeds.smartrecruiters(feeds.read_json(s, listed, feeds.SMART_LIST), feeds.read_json(s, detail, feeds.SMART_DETAIL))
    return rows.select("job_id", "title", "location", "department", "description", "url", "is_remote", "working_arrangement")


register("a05_smartrecruiters_scan", smartrecruiters, """
SELECT id::VARCHAR AS job_id, title, city || ', ' || region AS location, job_family AS department, CASE WHEN id % 2 = 0 THEN 'Do' || chr(10) || chr(10) || 'Be' ELSE '' END AS description,
CASE WHEN id % 2 = 0 THEN 'https://s.co/apply' END AS url, id % 3 = 0 AS is_remote, CASE WHEN id % 3 = 0 THEN 'remote' END AS working_arrangement FROM postings""")


def xml(s, d):
    path = f"{shared_folder(s)}/landed"
    place = F.array(F.struct(F.col("city").alias("city"), F.col("region").alias("country")), F.struct(F.lit("Elsewhere").alias("city"), F.lit("X").alias("country")))
    rows = postings(s, d).select(
        F.coalesce("title", F.lit("-")).alias("title"), F.concat(F.lit("https://x.co/jobs/9a"), "id").alias("url"), F.when(F.col("id") % 2 == 0, F.lit("<p>Pay $100,000 - $120,000</p>")).otherwise("no pay").alias("description"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("jobid"), F.lit("Big Co").alias("employer"), F.struct(place.alias("location")).alias("locations"),
    )
    rows.write.format("xml").option("rootTag", "jobs").option("rowTag", "job").save(path)
    return feeds.xml_feed(feeds.read_xml(s, path)).select("company_slug", "job_id", "title", "location", "description", *_PAID)


register("a06_xml_scan", xml, """
SELECT 'big-co' AS company_slug, CASE WHEN id % 3 = 0 THEN id::VARCHAR ELSE '9a' || id END AS job_id, coalesce(title, '-') AS title, city || ', ' || region AS location, CASE WHEN id % 2 = 0 THEN 'Pay $100,000 - $120,000' ELSE 'no pay' END AS description,
CASE WHEN id % 2 = 0 THEN 100000.0::DOUBLE END AS salary_min, CASE WHEN id % 2 = 0 THEN 120000.0::DOUBLE END AS salary_max, CASE WHEN id % 2 = 0 THEN 'usd' END AS currency FROM postings""")


def by_dimension(s, d):
    families = feeds.dimension(s, [(" Data ", "numbers"), ("PRODUCT", "things")], "job_family string, label string", "job_family")
    return postings(s, d).join(families, "job_family", "left").groupBy("label").agg(F.count("*").alias("n"))


def by_slug(s, d):
    slugs = feeds.company_slugs(s, {"First": "SRC0", "Second": {"slug": "src1", "url_type": "eu", "instance": "eu"}, "Third": {"slug": "Src2"}})
    return postings(s, d).join(slugs.withColumnRenamed("slug", "source"), "source").groupBy("company", "url_type", "instance").agg(F.count("*").alias("n"))


register("a07_pattern_dimension", by_dimension, "SELECT CASE job_family WHEN 'data' THEN 'numbers' WHEN 'product' THEN 'things' END AS label, count(*) AS n FROM postings GROUP BY 1")
register("a08_company_slugs", by_slug, """
SELECT CASE source WHEN 'src0' THEN 'First' WHEN 'src1' THEN 'Second' ELSE 'Third' END AS company, CASE source WHEN 'src1' THEN 'eu' ELSE 'standard' END AS url_type, CASE source WHEN 'src1' THEN 'eu' ELSE 'global' END AS instance, count(*) AS n
FROM postings WHERE source IN ('src0', 'src1', 'src2') GROUP BY ALL""")


def exported_json(s, d):
    path = f"{shared_folder(s)}/export"
    feeds.export_json(postings(s, d).select("id", "title", "skills", "posted_date"), path)
    return s.read.schema("id long, title string, skills array<string>, posted_date date").json(path).select("id", "title", F.array_join("skills", ",").alias("skills"), "posted_date")


def exported_csv(s, d):
    path = f"{shared_folder(s)}/export"
    feeds.export_csv(table(s, d, "documents").select("doc_id", "lang", "source", F.col("text").alias("description")), path)
    return s.read.schema("doc_id long, lang string, source string, description_length int").csv(path, header=True)


def upserted(s, d):
    path = shared_folder(s)
    rows = table(s, d, "customer").select(F.col("c_custkey").alias("id"), "c_name", "c_acctbal")
    feeds.write_table(rows.where("id % 3 > 0"), f"{path}/v0")
    new = rows.where("id % 3 < 2").withColumn("c_name", F.upper("c_name"))
    feeds.write_table(J.merge(s.read.parquet(f"{path}/v0"), new, ["id"], {}), f"{path}/v1")
    return s.read.parquet(f"{path}/v1").select("id", "c_name", "c_acctbal")


register("a11_json_export", exported_json, "SELECT id, title, array_to_string(skills, ',') AS skills, posted_date FROM postings")
register("a12_csv_export", exported_csv, "SELECT doc_id, lang, source, length(text)::INT AS description_length FROM documents")
register("a13_table_upsert", upserted, "SELECT c_custkey AS id, CASE WHEN c_custkey % 3 < 2 THEN upper(c_name) ELSE c_name END AS c_name, c_acctbal FROM customer")
