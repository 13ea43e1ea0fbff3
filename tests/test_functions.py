"""Column functions and rule-based classification on literal rows."""

import pytest
from pyspark.sql import functions as F

from vacantia.functions import text as X
from vacantia.operators import classify as D
from vacantia.operators import filters as C
from vacantia.operators import locations as L


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "html, text",
    [("&lt;p&gt;Hi &amp; bye&lt;/p&gt;", "Hi & bye"), ("<b>a</b>\n\n<i>b</i>", "a b"), (None, ""), ("  ", ""), ("a&nbsp;b &#39;c&#39;", "a b 'c'")],
)
def test_strip_html(spark, html, text):
    assert one(spark, html, X.strip_html) == text


def test_tags_first_keeps_encoded_tags(spark):
    assert one(spark, "<p>1 &lt; 2</p>", lambda c: X.strip_html(c, False)) == "1 < 2"


def test_visible_text_drops_furniture(spark):
    assert one(spark, "<script>x()</script><nav>menu</nav><p>Work</p><STYLE>p{}</STYLE>", X.visible_text) == "Work"


@pytest.mark.parametrize("text, want", [("Pay: $120,000 - $150,500 a year", (120000, 150500, "usd")), ("$90000–$100000", (90000, 100000, "usd")), ("competitive", (None, None, None))])
def test_salary_range(spark, text, want):
    row = spark.createDataFrame([(text,)], "v string").select(*X.salary_range(F.col("v"))).first()
    assert tuple(row) == want


@pytest.mark.parametrize("name, want", [("Technologies", "technology"), ("Databases", "databas"), ("roadmaps", "roadmap"), ("R", "r"), ("SAS", "sas"), ("data modelling", "data modeling"), ("business", "business"), ("Status", "status")])
def test_skill_key(spark, name, want):
    assert one(spark, name, X.skill_key) == want


@pytest.mark.parametrize("name, want", [("machine learning", "Machine Learning"), ("sql server", "SQL Server"), ("ci/cd", "CI/CD"), ("pl/sql tools", "Pl/SQL Tools"), ("aws, gcp", "AWS, GCP")])
def test_skill_title(spark, name, want):
    assert one(spark, name, X.skill_title) == want


@pytest.mark.parametrize("name, want", [("ibm", "IBM"), ("acme ai labs", "Acme AI Labs"), ("1st central", "1st Central"), ("big co", "Big Co")])
def test_employer_title(spark, name, want):
    assert one(spark, name, lambda c: X.employer_title(c, ["ai"])) == want


@pytest.mark.parametrize("raw, want", [("On-Site", "onsite"), ("REMOTE", "remote"), ("hybrid ", "hybrid"), ("somewhere", "unknown"), (None, "unknown")])
def test_arrangement(spark, raw, want):
    assert one(spark, raw, X.arrangement) == want


def test_row_hash_reads_blanks_as_unknown(spark):
    rows = spark.createDataFrame([("A ", None, "x"), ("a", "", "X")], "a string, b string, c string")
    assert rows.select(X.row_hash(F.col("a"), F.col("b"), F.col("c"))).distinct().count() == 1


def test_null_strings_in_structs_and_arrays(spark):
    df = spark.createDataFrame([(("null", ["a", "NULL"]), "Null", 1)], "s struct<x:string,y:array<string>>, t string, n int")
    row = X.null_strings(df).first()
    assert (row.s.x, row.s.y, row.t, row.n) == (None, ["a", None], None, 1)


@pytest.mark.parametrize("title, level, director", [("Staff Engineer", "staff_principal", False), ("Sr. Analyst", "senior", False), ("Engineer", "mid", False), ("VP of Data", "mid", True), ("Head of Product", "mid", True), (None, "mid", False)])
def test_titles(spark, title, level, director):
    assert one(spark, title, X.title_seniority) == level
    assert one(spark, title, X.is_director) == director


@pytest.mark.parametrize("text, want", [("3-5 years", (3, 5, "2-4")), ("8+ years", (8, None, "8+")), ("1 year", (1, None, "0-1")), ("senior", (None, None, None))])
def test_experience(spark, text, want):
    assert tuple(spark.createDataFrame([(text,)], "v string").select(*X.experience_bounds(F.col("v"))).first()) == want


@pytest.mark.parametrize("url, want", [("https://x.co/jobs/abc-123", "abc-123"), ("https://x.co/apply?gh_jid=77", "77")])
def test_job_id(spark, url, want):
    assert one(spark, url, X.job_id) == want
    assert len(one(spark, "https://x.co/", X.job_id)) == 12


def test_page_fields(spark):
    html = '<meta property="og:image" content="http://x/logo.png"><meta property="og:url" content="https://acme.com/careers"><p>Join</p>'
    row = spark.createDataFrame([(html,)], "h string").select(*(c.alias(k) for k, c in X.page_fields(F.col("h")).items())).first()
    assert (row.logo_url, row.domain, row.text) == ("http://x/logo.png", "acme.com", "Join")


@pytest.mark.parametrize(
    "name, text, want",
    [
        ("Tech Staffing Recruitment", None, "high"), ("Acme Headhunters", None, "high"), ("Northern Placement Co", None, "medium"), ("Green Talent", None, "medium"), ("Data Consulting", None, "low"),
        ("Talent Consulting Partners", None, "medium"), ("Blue Bank", "our client needs people on behalf of them", "medium"), ("Blue Group", "our client", "medium"), ("Blue Bank", "our client", "low"), (None, None, "low"),
    ],
)
def test_agency_rules(spark, name, text, want):
    df = spark.createDataFrame([(name, text)], "n string, t string")
    assert df.select(D.agency_confidence(F.col("n"), F.col("t"))).first()[0] == want


def test_agency_lists(spark):
    df = spark.createDataFrame([("Hays ",), ("Accenture",), ("Boston Consulting Group",)], "n string")
    found = D.detect_agencies(df, "n", None, spark.createDataFrame([("hays",)], "name string"), spark.createDataFrame([("boston consulting group",), ("accenture",)], "name string"))
    assert {r.n: (r.is_agency, r.agency_confidence) for r in found.collect()} == {"Hays ": (True, "high"), "Accenture": (False, "low"), "Boston Consulting Group": (False, "low")}


@pytest.mark.parametrize("pattern, flag, sure, want", [("high", False, None, (True, "high")), ("medium", True, None, (True, "high")), ("medium", False, None, (False, "low")), ("medium", None, None, (True, "medium")), ("low", True, None, (True, "medium")), ("low", None, None, (False, "low")), ("low", False, "high", (False, "high"))])
def test_combine_agency(spark, pattern, flag, sure, want):
    df = spark.createDataFrame([(pattern, flag, sure)], "p string, f boolean, s string")
    assert tuple(df.select(*D.combine_agency(F.col("p"), F.col("f"), F.col("s"))).first()) == want


@pytest.mark.parametrize("text, want", [("This is a fully remote job", "remote"), ("fully remote, with remote sensing", "unknown"), ("3 days in office", "hybrid"), ("hybrid role on a hybrid cloud", "unknown"), ("Office-based in Leeds", "onsite"), ("", "unknown")])
def test_text_arrangement(spark, text, want):
    assert one(spark, text, lambda c: D.text_arrangement(F.lit(None), c)) == want


@pytest.mark.parametrize(
    "code, url, body, want",
    [(404, "u", "", "404"), (410, "u", "", "410"), (403, "u", "", "blocked"), (202, "u", "", "blocked"), (503, "u", "", "error"), (None, None, None, "error"), (200, "http://x?ERROR=true", "", "soft_404"), (200, "u", "Sorry, this job is CLOSED", "soft_404"), (200, "u", "apply now", "active"), (302, "u", "", "redirect"), (418, "u", "", "error")],
)
def test_url_status(spark, code, url, body, want):
    df = spark.createDataFrame([(code, url, body)], "c int, u string, b string")
    assert df.select(D.url_status(F.col("c"), F.col("u"), F.col("b"))).first()[0] == want


def test_rendered_status(spark):
    assert [one(spark, b, D.rendered_status) for b in ("Just a moment...", "Page not found", "Apply", None)] == ["unverifiable", "soft_404", "active", "unverifiable"]


RULES = L.LocationRules(
    cities={"london": ("GB", ["london"]), "new_york": ("US", ["new york", "nyc"]), "singapore": ("SG", ["singapore", "sg"])},
    remote=[("country", "US", None, ["remote - us", "remote, us", "us remote"]), ("region", None, "EMEA", ["remote emea"]), ("global", None, None, ["remote", "anywhere"])],
    countries={"GB": ["united kingdom", "uk"], "DE": ["germany"]},
    regions={"EMEA": ["emea", "europe"]},
    country_names={"india": "IN", "germany": "DE", "uk": "GB"},
    restrictions={"US": [r"must be (located|based) in the us\b"], "CA": [r"based in canada"]},
)


def loc(kind, country=None, city=None, region=None, scope=None):
    return (kind, country, city, region, scope)


@pytest.mark.parametrize(
    "raw, text, want",
    [
        ("London", None, [loc("city", "GB", "london")]), ("  ", None, [loc("unknown")]), (None, None, [loc("unknown")]), ("Hybrid", None, [loc("unknown")]), ("Remote", None, [loc("remote", scope="global")]),
        ("Remote", "You must be based in the US for this role", [loc("remote", "US", scope="country")]), ("Remote - US", None, [loc("remote", "US", scope="country")]), ("India - Remote", None, [loc("remote", "IN", scope="country")]),
        ("London or NYC", None, [loc("city", "GB", "london"), loc("city", "US", "new_york")]), ("NYC / Remote", None, [loc("city", "US", "new_york"), loc("remote", "US", scope="country")]),
        ("London; London", None, [loc("city", "GB", "london")]), ("Germany", None, [loc("country", "DE")]), ("Ukraine", None, [loc("unknown")]), ("Europe", None, [loc("region", region="EMEA")]), ("Responsibilities", None, [loc("unknown")]),
        ("London, UK / Remote", None, [loc("remote", "GB", scope="country")]),
    ],
)
def test_locations(spark, raw, text, want):
    df = spark.createDataFrame([(raw, text)], "raw string, d string")
    got = L.extract_locations(df, "raw", RULES, "d" if text else None).first().locations
    assert [tuple(x) for x in got] == want


def test_location_predicates(spark):
    df = L.extract_locations(spark.createDataFrame([("London",), ("Remote - US",), ("Remote",), ("Germany",), ("Europe",)], "raw string"), "raw", RULES)
    near = {r.raw for r in df.where(L.accessible_from(F.col("locations"), "london", "GB", "EMEA")).collect()}
    assert near == {"London", "Remote", "Europe"}
    assert {r.raw for r in df.where(L.matches_targets(F.col("locations"), countries=["DE", "US"])).collect()} == {"Remote - US", "Remote", "Germany"}
    assert {r.raw: r.p for r in df.select("raw", L.primary_label(F.col("locations")).alias("p")).collect()} == {"London": "london", "Remote - US": "remote_us", "Remote": "remote_global", "Germany": "DE", "Europe": "unknown"}
    assert C.unknown_locations(L.extract_locations(spark.createDataFrame([("Mars",), ("NYC",)], "raw string"), "raw", RULES)).count() == 1


@pytest.mark.parametrize("titles, patterns, want", [(["Data Engineer", "Sales"], ["data (engineer|analyst)"], {"Data Engineer"}), (["A", "B"], [], {"A", "B"}), (["A"], ["(bad"], set())])
def test_relevant_titles(spark, titles, patterns, want):
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert {r.t for r in C.relevant_titles(df, "t", patterns).collect()} == want


def test_funnel_counts_first_reason(spark):
    df = C.funnel(spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], "t string, l string"), {"title": F.col("t") == "a", "location": F.col("l") == "x"})
    assert {(r.t, r.l): r.drop_reason for r in df.collect()} == {("a", "x"): "title", ("b", "x"): "location", ("b", "y"): None}


def test_map_skills_exact_then_loose(spark):
    mapping = spark.createDataFrame([("PyTorch", "ml", 0), ("Databases", "data", 1), ("Data Modeling", "data", 2), ("PYTORCH", "ai", 3)], "name string, family string, pos int")
    df = spark.createDataFrame([(1, ["pytorch", "DATABASES ", "data modelling", "Cobol", None])], "id int, skills array<string>")
    got = [(r.name, r.family) for r in D.map_skills(df, "id", "skills", mapping).orderBy("pos").collect()]
    assert got == [("PyTorch", "ai"), ("Databases", "data"), ("Data Modeling", "data"), ("Cobol", None)]
