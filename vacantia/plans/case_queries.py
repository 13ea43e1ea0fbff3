"""Registered queries of rules whose words don't occur in the driver's tables: literal cases dealt over all rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import text as X
from vacantia.operators import classify as D
from vacantia.operators import filters as C
from vacantia.operators import locations as L
from vacantia.operators import merge as J
from vacantia.plans.cases import dealt, dealt_sql, register_cases
from vacantia.plans.postings import postings, table
from vacantia.registry import register


def _beside(case, column: str):
    """The case in front of a text of the row."""
    return F.concat(case, F.lit(" "), F.coalesce(column, F.lit("")))


register_cases(
    "b06_salary_range", "documents", "doc_id",
    ["Pay: $120,000 - $150,500 a year", "$90000–$100000", "$ 80,000 to $95,000 or $1 - $2", "competitive", None],
    lambda c: X.salary_range(_beside(c, "text")),
    low=[120000, 90000, 80000, None, None], high=[150500, 100000, 95000, None, None], currency=["usd", "usd", "usd", None, None],
)
register_cases(
    "b17_employer_titles", "customer", "c_custkey",
    ["ibm", "box", "sky", "gap", "acme ai labs", "1st central bank", "22nd street llc", "o'neil group", "rolls-royce", "hp", "x1", "on", "big co", "3rd eye b2b", "THE ACME CO", "école 42nd"],
    X.employer_title,
    title=["IBM", "Box", "Sky", "Gap", "Acme AI Labs", "1st Central Bank", "22nd Street LLC", "O'Neil Group", "Rolls-Royce", "HP", "X1", "On", "Big Co", "3rd Eye B2B", "The Acme Co", "École 42nd"],
)
register_cases(
    "b18_skill_titles", "part", "p_partkey",
    ["machine learning", "sql server", "ci/cd", "pl/sql tools", "aws", "  data   modeling "],
    X.skill_title,
    title=["Machine Learning", "SQL Server", "CI/CD", "Pl/SQL Tools", "AWS", "Data Modeling"],
)
register_cases(
    "b29_city_from_url", "pages", "page_id",
    ["https://jobs.example.co.uk/1", "https://x.com/newyork/2", "https://x.com/NYC-3", "https://x.com/Denver", "https://x.com/London-nyc", "https://x.com/paris", None],
    X.city_from_url,
    city=["lon", "nyc", "nyc", "den", "lon", "lon", "lon"],
)
register_cases(
    "b30_location_codes", "orders", "o_orderkey",
    ["London, UK", "New York City", "Denver, CO", "United Kingdom", "Leeds UK", "Austin", "United States", "Paris", "", None],
    X.location_code,
    code=["lon", "nyc", "den", "lon", "lon", "usa", "usa", "par", "unknown", "unknown"],
)
register_cases(
    "b37_title_seniority", "orders", "o_orderkey",
    ["Staff Engineer", "Principal PM", "Sr. Analyst", "Lead Engineer", "Senior Buyer", "Engineer", "Leader", "Seniority Analyst"],
    X.title_seniority,
    level=["staff_principal", "staff_principal", "senior", "senior", "senior", "mid", "mid", "mid"],
)
_TITLES = ["Director, Data", "Head of Product", "Head, Data", "VP of Data", "Vice President", "SVP Sales", "EVP Ops", "AVP, Data", "RVP Sales", "Chief of Staff", "CTO", "CPO", "CDO", "Managing Partner",
           "General Manager", "President", "GM", "CIO", "Head Chef", "Directory Engineer", "Staff Engineer", None]
_SIGNAL = [True] * 14 + [False] * 8
register_cases("b38_director_signal", "orders", "o_orderkey", _TITLES, X.is_director, director=_SIGNAL)
register_cases(
    "b24_legacy_city_codes", "orders", "o_orderkey",
    [("city", "london", False), ("city", "new_york", True), ("city", "denver", False), ("city", "san_francisco", False), ("city", "singapore", False), ("city", "paris", True), ("remote", None, False), ("country", None, False), ("country", None, True), ("unknown", None, True)],
    lambda kind, city, remote: (
        X.legacy_city_code(F.array(F.struct(kind.alias("type"), city.alias("city")))),
        X.legacy_city_code(F.array(F.struct(kind.alias("type"), city.alias("city"))), remote),
    ),
    code=["lon", "nyc", "den", "sfo", "sgp", "unk", "remote", "unk", "unk", "unk"],
    code_with_flag=["lon", "nyc", "den", "sfo", "sgp", "unk", "remote", "unk", "remote", "remote"],
)
register_cases(
    "b44_slug_titles", "customer", "c_custkey",
    ["acme-data_labs", "x-1y", "o'neil", "ABC_corp", "plain", ""],
    X.slug_title,
    title=["Acme Data Labs", "X 1Y", "O'Neil", "Abc Corp", "Plain", ""],
)
register_cases(
    "b45_experience", "documents", "doc_id",
    ["3-5 years", "8+ years", "1 year", "6 to 9 yrs", "10 – 12 years", "senior"],
    lambda c: X.experience_bounds(c),
    low=[3, 8, 1, 6, 10, None], high=[5, None, None, 9, 12, None], bucket=["2-4", "8+", "0-1", "5-7", "8+", None],
)
_EMPTY = ["", "  \n ", None, "a text", "0"]
register("c21_empty", lambda s, d: C.empty_text(table(s, d, "documents").select("doc_id", dealt("doc_id", _EMPTY).alias("text")), "text").select("doc_id"), "SELECT doc_id FROM documents WHERE doc_id % 5 < 3")
register_cases(
    "d01_agencies", "documents", "doc_id",
    [("Tech Staffing Recruitment", ""), ("Acme Headhunters", ""), ("Northern Placement Co", ""), ("Green Talent", ""), ("Talent Consulting Partners", ""), ("Northern Consulting Partners", ""), ("Blue Group", ""),
     ("Blue Bank", "our client needs people on behalf of them"), ("Blue Group", "our client"), ("Blue Bank", "our client"), ("Blue Bank", ""), ("", "staffing"), (None, "")],
    lambda name, said: D.agency_confidence(name, _beside(said, "text")),
    confidence=["high", "high", "medium", "medium", "medium", "medium", "low", "medium", "medium", "low", "low", "low", "low"],
)
register_cases(
    "d07_text_arrangement", "documents", "doc_id",
    ["This is a fully remote job", "fully remote, with remote sensing", "3 days in office", "hybrid working in the hybrid cloud", "hybrid model", "This role is office-based", "must be on-site", "(Remote)", "plain"],
    lambda c: D.text_arrangement(F.lit(None), _beside(c, "text")),
    arrangement=["remote", "unknown", "hybrid", "unknown", "hybrid", "onsite", "onsite", "remote", "unknown"],
)
register_cases(
    "d08_url_status", "pages", "page_id",
    [(404, "u", ""), (410, "u", ""), (403, "u", ""), (202, "u", ""), (503, "u", ""), (None, "u", ""), (200, "http://x/?error=true", ""), (200, "http://x/notfound", ""), (200, "u", "<p>Page not found</p>"),
     (200, "u", "This position has been filled"), (200, "u", "apply now"), (301, "u", ""), (418, "u", "")],
    lambda code, url, body: D.url_status(code, url, _beside(body, "html")),
    status=["404", "410", "blocked", "blocked", "error", "error", "soft_404", "soft_404", "soft_404", "soft_404", "active", "redirect", "error"],
)
register_cases(
    "d09_rendered_status", "pages", "page_id",
    ["Just a moment...", "Please complete a security check", "Page not found", "This job is closed", "Apply", None],
    lambda c: D.rendered_status(_beside(c, "html")),
    status=["unverifiable", "unverifiable", "soft_404", "soft_404", "active", "unverifiable"],
)
register_cases(
    "d10_industry", "customer", "c_custkey",
    ["Alpha Staffing", "Beta Ventures", "River Bank", "Delta Software", "Employment Agency X", "Gamma Growth Equity Staffing", ""],
    lambda c: D.industry_by_words(c, D.INDUSTRY_WORDS),
    industry=["professional_services", "financial_services", "financial_services", None, "professional_services", "professional_services", None],
)

RULES = L.LocationRules(
    cities={"london": ("GB", ["london"]), "new_york": ("US", ["new york", "nyc"]), "singapore": ("SG", ["singapore", "sg"])},
    remote=[("country", "US", None, ["remote - us", "remote, us", "us remote"]), ("region", None, "EMEA", ["remote emea"]), ("global", None, None, ["remote", "anywhere"])],
    countries={"GB": ["united kingdom", "uk"], "DE": ["germany"]},
    regions={"EMEA": ["emea", "europe"]},
    country_names={"india": "IN", "germany": "DE", "uk": "GB"},
    restrictions={"US": [r"must be (located|based) in the us\b"], "CA": [r"based in canada"]},
)
_PLACES = {
    "London": "city:GB:london::", "NYC / Remote": "city:US:new_york::,remote:US:::country", "London or NYC": "city:GB:london::,city:US:new_york::", "London; London": "city:GB:london::", "Remote - US": "remote:US:::country",
    "Remote EMEA": "remote:::EMEA:region", "Remote": "remote::::global", "Hybrid": "unknown::::", "": "unknown::::", "Germany": "country:DE:::", "Ukraine": "unknown::::", "Europe": "region:::EMEA:", "India remote": "remote:IN:::country",
    "London, UK / Remote": "remote:GB:::country", "SG | Germany": "city:SG:singapore::,country:DE:::", "Mars": "unknown::::",
}
_LIMITS = [("Remote", "You must be based in the US for this role", "remote:US:::country"), ("Remote", "Based in Canada only", "remote:CA:::country"), ("Remote", "anyone", "remote::::global"), ("London", "must be located in the US", "city:GB:london::"), (None, "", "unknown::::")]


def _shown(locations):
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.array_join(F.transform(locations, lambda l: F.concat_ws(":", *(part(l[c]) for c in ("type", "country_code", "city", "region", "scope")))), ",")


def parsed(s, d):
    rows = table(s, d, "orders").select("o_orderkey", dealt("o_orderkey", list(_PLACES)).alias("raw"))
    return L.extract_locations(rows, "raw", RULES).select("o_orderkey", _shown(F.col("locations")).alias("found"))


def restricted(s, d):
    raw, said, _ = (list(x) for x in zip(*_LIMITS))
    rows = table(s, d, "documents").select("doc_id", dealt("doc_id", raw).alias("raw"), _beside(dealt("doc_id", said), "text").alias("said"))
    return L.extract_locations(rows, "raw", RULES, "said").select("doc_id", _shown(F.col("locations")).alias("found"))


def unknown_places(s, d):
    rows = table(s, d, "orders").select("o_orderkey", dealt("o_orderkey", list(_PLACES)).alias("raw"))
    return C.unknown_locations(L.extract_locations(rows, "raw", RULES)).select("o_orderkey")


register("d05_locations", parsed, f"SELECT o_orderkey, {dealt_sql('o_orderkey', list(_PLACES.values()))} AS found FROM orders")
register("d05_restricted_locations", restricted, f"SELECT doc_id, {dealt_sql('doc_id', [x[2] for x in _LIMITS])} AS found FROM documents")
register("c13_unknown_locations", unknown_places, f"SELECT o_orderkey FROM orders WHERE o_orderkey % {len(_PLACES)} IN (7, 8, 10, 15)")

_LEVELS = ["mid", "mid", "mid", "mid", "mid", "mid", "mid", "mid", "mid", "staff_principal", "mid", "mid", "mid", "mid", "mid", "mid", "mid", "mid", "mid", "mid", "staff_principal", "mid"]


def tracked(s, d):
    rows = postings(s, d).select("id", "job_family", "seniority", dealt("id", _TITLES).alias("title"), F.when(F.col("id") % 3 > 0, "management").otherwise("ic").alias("track"))
    return D.backfill_tracks(rows, "job_family", "title", "track", "seniority").select("id", "track", "seniority", "track_changed", "seniority_changed")


_TRACKED = f"""(SELECT id, job_family, seniority, CASE WHEN id % 3 > 0 THEN 'management' ELSE 'ic' END AS track,
job_family IN ('delivery', 'product') AND NOT {dealt_sql("id", _SIGNAL)} AS w, {dealt_sql("id", _LEVELS)} AS level FROM postings)"""
register("j13_backfill_tracks", tracked, f"""
SELECT id, CASE WHEN w THEN 'ic' ELSE track END AS track, CASE WHEN w AND seniority = 'director_plus' THEN level ELSE seniority END AS seniority,
w AND track = 'management' AS track_changed, w AND seniority = 'director_plus' AS seniority_changed FROM {_TRACKED}""")
register("d11_tracks", lambda s, d: tracked(s, d).select("id", "track", "seniority"), f"""
SELECT id, CASE WHEN w THEN 'ic' ELSE track END AS track, CASE WHEN w AND seniority = 'director_plus' THEN level ELSE seniority END AS seniority FROM {_TRACKED}""")
register(
    "c18_track_candidates",
    lambda s, d: C.track_candidates(postings(s, d).withColumn("title", dealt("id", _TITLES)), "job_family", "seniority", "title").select("id"),
    f"SELECT id FROM postings WHERE job_family IN ('delivery', 'product') AND seniority = 'director_plus' AND NOT {dealt_sql('id', _SIGNAL)}",
)
_SAID = ["a long description of what the work is and who is asked to apply for it", "short", None]
register(
    "j19_blocked_rows",
    lambda s, d: D.to_backfill(_raw(s, d), _raw(s, d).where("id % 4 = 0"), "id").select("id"),
    "SELECT id FROM postings WHERE id % 4 <> 0 AND NOT is_agency AND id % 3 = 0 AND job_family <> 'out_of_scope'",
)
register(
    "j19_blocked_reasons",
    lambda s, d: _raw(s, d).select("id", "blocked_reason"),
    "SELECT id, CASE WHEN is_agency THEN 'agency_hard_filter' WHEN id % 3 > 0 THEN 'description_too_short' WHEN job_family = 'out_of_scope' THEN 'out_of_scope' END AS blocked_reason FROM postings",
)


def _raw(s, d):
    return postings(s, d).withColumn("blocked_reason", D.blocked_reason(F.col("is_agency"), dealt("id", _SAID), F.col("job_family")))


_NAMES = {"acme ai labs": "Acme AI Labs", "box": "Box", "ibm": "IBM", "o'neil group": "O'Neil Group"}


def named(s, d):
    rows = table(s, d, "customer").select("c_custkey", dealt("c_custkey", list(_NAMES)).alias("canonical_name"))
    rows = rows.withColumn("display_name", F.when(F.col("c_custkey") % 5 > 0, F.col("canonical_name")).otherwise("Kept"))
    return J.changed_only(rows, "display_name", X.employer_title(F.col("canonical_name")), F.lower("display_name") == F.col("canonical_name")).select("c_custkey", F.col("new_value").alias("display_name"), "was_changed")


register("j15_backfill_names", named, f"SELECT c_custkey, CASE WHEN c_custkey % 5 > 0 THEN {dealt_sql('c_custkey', list(_NAMES.values()))} ELSE 'Kept' END AS display_name, c_custkey % 5 > 0 AS was_changed FROM customer")


def skills_mapped(s, d):
    mapping = s.createDataFrame([("PyTorch", "ml", 0), ("Databases", "data", 1), ("Data Modeling", "data", 2), ("pytorch", "ai", 3), ("databases", "infra", 4)], "name string, family string, pos int")
    raw = ["pytorch", "DATABASES ", "data modelling", "Cobol", "database", None]
    rows = table(s, d, "part").select("p_partkey", F.array(dealt("p_partkey", raw)).alias("skills"))
    return D.map_skills(rows, "p_partkey", "skills", mapping).select("p_partkey", "name", "family")


register("d04_map_skills", skills_mapped, f"""SELECT p_partkey, {dealt_sql("p_partkey", ["PyTorch", "Databases", "Data Modeling", "Cobol", "Database", None])} AS name,
{dealt_sql("p_partkey", ["ai", "infra", "data", None, None, None])} AS family FROM part WHERE p_partkey % 6 < 5""")
_PAGE = ['<meta property="og:image" content="http://x/logo.png"><meta property="og:url" content="https://acme.com/careers"><p>Join</p>', '<img src="/our-logo.svg"><p>Join</p>', '<link rel="icon" href="/fav.ico"><p>Join</p>', "<p>Join</p>"]
register_cases(
    "b40_page_fields", "pages", "page_id", _PAGE, lambda c: tuple(X.page_fields(c)[k] for k in ("logo_url", "domain", "text")),
    logo_url=["http://x/logo.png", "/our-logo.svg", "/fav.ico", None], domain=["acme.com", None, None, None], text=["Join", "Join", "Join", "Join"],
)
