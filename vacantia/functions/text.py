"""Column functions over text, names, URLs, pay and skills. All are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entities that postings use, in the order in which they are decoded (the ampersand last).
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&#160;", " "), ("&ndash;", "–"), ("&mdash;", "—"), ("&rsquo;", "’"), ("&lsquo;", "‘"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&bull;", "•"), ("&hellip;", "…"), ("&amp;", "&")]
#: Names that stay in capitals.
ABBREVIATIONS = [
    "sql", "aws", "gcp", "etl", "elt", "api", "apis", "rest", "sdk", "cli", "ai", "ml", "nlp", "llm", "gpu", "tpu",
    "ci", "cd", "ci/cd", "saas", "iaas", "paas", "http", "https", "json", "xml", "yaml", "csv", "html", "css", "js",
    "ts", "orm", "mvc", "mvp", "tdd", "bdd", "dns", "tcp", "udp", "ssh", "ssl", "tls", "cdn", "cms", "crm", "erp",
    "sap", "pmo", "raid", "itil", "iso", "soc", "gdpr", "hipaa", "pci", "owasp", "kpi", "okr", "sla", "roi", "b2b",
    "b2c", "sem", "seo", "ppc", "ux", "ui", "qa", "uat", "sdlc", "vpc", "iam", "rds", "hpe", "pmp", "dbt", "iot",
    "rpa", "bpm",
]
#: British spellings.
SPELLINGS = [("modelling", "modeling"), ("visualisation", "visualization"), ("organisation", "organization"), ("optimisation", "optimization"), ("cataloguing", "cataloging")]
CURRENCIES = ["gbp", "usd", "eur", "sgd", "inr"]
#: Ways to write a working arrangement.
ARRANGEMENTS = {"on-site": "onsite", "on site": "onsite", "in-office": "onsite", "in office": "onsite", "office": "onsite", "wfh": "remote", "fully remote": "remote", "flex": "flexible"}


def any_of(text: Column, parts: list[str]) -> Column:
    """Whether the text contains one of the strings."""
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts), F.lit(False))


def count_of(text: Column, parts: list[str]) -> Column:
    """How many of the strings the text contains."""
    return reduce(lambda a, b: a + b, (F.contains(text, F.lit(p)).cast("int") for p in parts), F.lit(0))


def matches_any(text: Column, patterns: list[str]) -> Column:
    """Whether one of the regexes is found, case apart, in one pass."""
    return text.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def decode_entities(c: Column) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), ENTITIES, c)


def strip_tags(c: Column) -> Column:
    """HTML without tags on one line, entities as they are; null is empty."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " "), r"\s+", " "))


def strip_html(c: Column, decode_first: bool = True) -> Column:
    """HTML as plain text on one line; null is empty."""
    if decode_first:
        return strip_tags(decode_entities(F.coalesce(c, F.lit(""))))
    return F.trim(F.regexp_replace(decode_entities(F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", " ")), r"\s+", " "))


def visible_text(c: Column, most: int = 8000) -> Column:
    """Text of a page without scripts, styles and page furniture, cut after ``most`` characters."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style|nav|footer|header)\b.*?</\1\s*>", " ")
    return F.substring(strip_html(c, decode_first=False), 1, most)


def salary_range(c: Column) -> tuple[Column, Column, Column]:
    """(low, high, currency) of the first $a-$b of a text."""
    pattern = r"\$\s*([0-9][0-9,]*)\s*(?:-|–|—|to)\s*\$\s*([0-9][0-9,]*)"
    pick = lambda k: F.regexp_replace(F.regexp_extract(c, pattern, k), ",", "").try_cast("long")
    return pick(1), pick(2), F.when(c.rlike(pattern), "usd")


def job_id(url: Column) -> Column:
    """The id in a posting's path or query, else a digest of the URL."""
    path = F.regexp_extract(url, r"/(?:jobs?|careers|positions?)/([A-Za-z0-9-]*[0-9][A-Za-z0-9-]*)", 1)
    query = F.regexp_extract(url, r"[?&](?:gh_jid|jobid|job_id|id)=([A-Za-z0-9-]+)", 1)
    return F.coalesce(F.nullif(path, F.lit("")), F.nullif(query, F.lit("")), F.substring(F.md5(url), 1, 12))


def job_id_by_source(url: Column, source: Column) -> Column:
    """Job ids where each source keeps them; a manual posting gets a digest."""
    number = F.regexp_extract(url, "([0-9]{6,})", 1)
    found = F.when(source == "adzuna", F.regexp_extract(url, "/(?:ad|details)/([0-9]+)", 1)).when(source == "greenhouse", F.regexp_extract(url, "/jobs/([0-9]+)", 1)).when(source == "manual", F.md5(url)).otherwise(number)
    return F.nullif(found, F.lit(""))


def company_slug(url: Column, host: str) -> Column:
    """The first path part of a URL on a board's host."""
    return F.nullif(F.lower(F.regexp_extract(url, rf"https?://(?:www\.)?{host}/([A-Za-z0-9_.-]+)", 1)), F.lit(""))


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^https?://([^/:?#]+)", 1)), F.lit(""))


def row_hash(*columns: Column) -> Column:
    """md5 of the parts in lower case, trimmed and joined by |; null and blank are 'unknown'."""
    parts = [F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("unknown")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def merge_key(*columns: Column) -> Column:
    """md5 of the parts in lower case, joined by | as they are."""
    return F.md5(F.concat_ws("|", *(F.lower(F.coalesce(c, F.lit(""))) for c in columns)))


def canonical_name(c: Column) -> Column:
    return F.lower(F.trim(c))


def report_key(c: Column) -> Column:
    """Lower case with _ for spaces and without , . '"""
    return F.translate(F.lower(F.trim(c)), " ,.'", "_")


def sibling_key(c: Column) -> Column:
    """The letters and digits of a name, without the word careers."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "careers", ""), "[^a-z0-9]", "")


def _title_word(w: Column, capitals: list[str]) -> Column:
    return F.when(F.lower(F.btrim(w, F.lit(".,;:()"))).isin(capitals), F.upper(w)).otherwise(F.initcap(w))


def skill_title(c: Column) -> Column:
    """Title case that keeps abbreviations in capitals, part by part around slashes."""
    word = lambda w: F.when(F.lower(F.btrim(w, F.lit(".,;:()"))).isin(ABBREVIATIONS), F.upper(w)).when(F.contains(w, F.lit("/")), F.array_join(F.transform(F.split(w, "/"), lambda p: _title_word(p, ABBREVIATIONS)), "/")).otherwise(F.initcap(w))
    return F.array_join(F.transform(F.filter(F.split(F.trim(c), r"\s+"), lambda w: w != ""), word), " ")


#: Words of employers' names that stay in capitals.
EMPLOYER_CAPITALS = [
    "ai", "ml", "it", "hr", "uk", "us", "eu", "hq", "io", "vr", "ar", "xr", "qa", "ux", "ui", "cx", "dx",
    "nyc", "usa", "llc", "inc", "plc", "api", "cto", "svp", "vp", "dba", "saas", "b2b", "b2c", "d2c",
    "hp", "td", "ab", "ad", "abb", "abc", "abm", "abs", "acs", "aeg", "aws", "bdo", "bny", "cgi", "cnn", "dbs",
    "dxc", "gsk", "hpe", "ibm", "ihg", "itv", "jll", "kbr", "kkr", "ntt", "rbc", "rsm", "rtx", "sap", "ubs", "wpp",
    "wsp", "wtw", "amd", "dpr", "erm", "hdr", "pvh",
]
#: Short names of one word that are brands and not initials.
SHORT_BRANDS = [
    "arm", "arc", "box", "cos", "eon", "eos", "fal", "fay", "fin", "fox", "gap", "hud", "ing", "ion", "ki", "mux", "on", "rec",
    "res", "rho", "ro", "sim", "sky", "spa", "sur", "wex", "wix", "wiz", "zip", "alt", "edo", "dat", "vec", "sj",
]


def title_case(c: Column) -> Column:
    """Each run of letters begins with a capital, after apostrophes, hyphens and digits too."""
    runs = F.split(F.lower(c), r"(?<!\p{L})(?=\p{L})")
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))), "")


def employer_title(c: Column, capitals: list[str] | None = None, brands: list[str] | None = None) -> Column:
    """Title case for employers: known initials in capitals, ordinals as 1st; one word of up to 3 letters is in capitals unless it is a brand."""
    capitals = EMPLOYER_CAPITALS if capitals is None else capitals
    brands = SHORT_BRANDS if brands is None else brands
    words = F.filter(F.split(F.trim(title_case(c)), r"\s+"), lambda w: w != "")
    one = F.get(words, F.lit(0))
    low = F.lower(one)
    single = F.when(low.isin(capitals) | (low.rlike(r"^\p{L}{1,3}$") & ~low.isin(brands)), F.upper(one)).otherwise(one)
    ordinal = lambda w: F.concat(F.regexp_extract(w, r"^(.*?[0-9]+)(?:St|Nd|Rd|Th)(\b.*)$", 1), F.lower(F.regexp_extract(w, r"[0-9](St|Nd|Rd|Th)\b", 1)), F.regexp_extract(w, r"^.*?[0-9]+(?:St|Nd|Rd|Th)(\b.*)$", 1))
    word = lambda w: F.when(F.lower(w).isin(capitals), F.upper(w)).when(w.rlike(r"[0-9](?:St|Nd|Rd|Th)\b"), ordinal(w)).otherwise(w)
    return F.when(F.size(words) == 1, single).otherwise(F.array_join(F.transform(words, word), " "))


def skill_key(c: Column) -> Column:
    """Lower case, American spelling, singular; names under 4 characters stay."""
    n = F.lower(F.trim(c))
    us = reduce(lambda x, s: F.replace(x, F.lit(s[0]), F.lit(s[1])), SPELLINGS, n)
    long = F.length(us) > 5
    single = (
        F.when(us.endswith("ies") & long, F.concat(F.left(us, F.length(us) - 3), F.lit("y")))
        .when(us.endswith("ses") & long, F.left(us, F.length(us) - 2))
        .when(us.endswith("s") & ~us.endswith("ss") & ~us.endswith("us"), F.left(us, F.length(us) - 1))
        .otherwise(us)
    )
    return F.when(F.length(n) < 4, n).otherwise(single)


def valid_currency(c: Column) -> Column:
    return F.when(F.lower(c).isin(CURRENCIES), F.lower(c))


def arrangement(c: Column) -> Column:
    """One of the known arrangements, else unknown."""
    c = F.lower(F.trim(c))
    mapped = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ARRANGEMENTS.items() for x in kv]), c), c)
    return F.when(mapped.isin("onsite", "hybrid", "remote", "flexible"), mapped).otherwise("unknown")


def null_strings(df, value: str = "null"):
    """Every string 'null' as null, inside structs and arrays too."""
    from pyspark.sql import types as T

    def walk(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, T.StringType):
            return F.when(F.lower(F.trim(c)) != value, c)
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*(walk(c[f.name], f.dataType).alias(f.name) for f in kind)))
        if isinstance(kind, T.ArrayType):
            return F.transform(c, lambda x: walk(x, kind.elementType))
        return c

    return df.select(*(walk(F.col(f.name), f.dataType).alias(f.name) for f in df.schema))


def suppress_pay(city: Column, value: Column, cities: tuple[str, ...] = ("lon", "sgp")) -> Column:
    """Pay is null in cities without a law on pay transparency."""
    return F.when(~F.coalesce(city.isin(*cities), F.lit(False)), value)


def pay_from_cents(ranges: Column, field: str) -> Column:
    """Whole units of the first range."""
    return F.floor(F.get(ranges, F.lit(0))[field] / 100).cast("long")


def first_truthy(a: Column, b: Column) -> Column:
    return F.coalesce(F.nullif(a, F.lit(0)), b)


def maturity(year: Column, now: int = 2025) -> Column:
    age = F.lit(now) - year
    return F.when(age <= 5, "startup").when(age <= 15, "growth").when(year.isNotNull(), "mature")


def days_open(posted: Column, as_of: Column) -> Column:
    return F.datediff(as_of, posted)


def fill_time_ratio(days: Column, median: Column) -> Column:
    return F.when(median > 0, days / median)


def period_label(day: Column) -> Column:
    return F.date_format(day, "MMMM yyyy")


def title_seniority(title: Column) -> Column:
    t = F.lower(title)
    return F.when(t.rlike(r"\b(staff|principal)\b"), "staff_principal").when(t.rlike(r"\b(senior|sr|lead)\b"), "senior").otherwise("mid")


#: Titles of directors and above.
DIRECTOR = [
    r"\bdirector\b", r"\bhead of\b", r"\bhead,", r"\bvp\b", r"\bvice president\b", r"\bsvp\b", r"\bevp\b", r"\bavp\b", r"\brvp\b",
    r"\bchief\b", r"\bcto\b", r"\bcpo\b", r"\bcdo\b", r"\bpartner\b",
]


def is_director(title: Column) -> Column:
    return matches_any(F.coalesce(title, F.lit("")), DIRECTOR)


def experience_bounds(c: Column) -> tuple[Column, Column, Column]:
    """(fewest years, most years, bucket) of texts like 3-5 years or 5+ years."""
    low = F.regexp_extract(c, r"([0-9]{1,2})\s*(?:\+|-|–|to|years?|yrs?)", 1).try_cast("int")
    high = F.regexp_extract(c, r"[0-9]{1,2}\s*(?:-|–|to)\s*([0-9]{1,2})", 1).try_cast("int")
    bucket = F.when(low < 2, "0-1").when(low < 5, "2-4").when(low < 8, "5-7").when(low.isNotNull(), "8+")
    return low, high, bucket


def token_cost(tokens: Column, price: Column) -> Column:
    """Cost of tokens at a price per million."""
    return tokens / 1_000_000 * price


def slug_title(c: Column) -> Column:
    return title_case(F.translate(c, "-_", "  "))


def drop_boilerplate(c: Column, patterns: list[str]) -> Column:
    """The text without paragraphs that match one of the patterns."""
    return F.btrim(F.regexp_replace(c, "(?im)^.*(?:" + "|".join(patterns) + ").*$", ""), F.lit(" \t\r\n"))


def page_fields(html: Column) -> dict[str, Column]:
    """The logo (og:image, else an image named logo, else the icon), the site's host, and the text of a page."""
    og = F.regexp_extract(html, r"""(?is)<meta[^>]+property=["']og:image["'][^>]+content=["']([^"']+)""", 1)
    image = F.regexp_extract(html, r"""(?is)<img[^>]+src=["']([^"']*logo[^"']*)""", 1)
    icon = F.regexp_extract(html, r"""(?is)<link[^>]+rel=["'][^"']*icon[^"']*["'][^>]+href=["']([^"']+)""", 1)
    site = F.regexp_extract(html, r"""(?is)<meta[^>]+property=["']og:url["'][^>]+content=["']https?://([^/"']+)""", 1)
    first = lambda *cs: F.coalesce(*(F.nullif(c, F.lit("")) for c in cs))
    return {"logo_url": first(og, image, icon), "domain": first(site), "text": visible_text(html)}


def fill_template(template: Column, slug: Column) -> Column:
    return F.replace(template, F.lit("{slug}"), slug)


def board_url(slug: Column, job: Column, kind: Column) -> Column:
    """The canonical URL of a posting by the board's kind."""
    host = F.when(kind == "eu", "job-boards.eu.greenhouse.io").when(kind == "embed", "boards.greenhouse.io").otherwise("job-boards.greenhouse.io")
    return F.when(kind == "embed", F.format_string("https://%s/embed/job_app?for=%s&token=%s", host, slug, job)).otherwise(F.format_string("https://%s/%s/jobs/%s", host, slug, job))


def field_from_broken_json(c: Column, field: str) -> Column:
    """A string field of JSON text, by parsing or else by pattern."""
    return F.coalesce(F.get_json_object(c, f"$.{field}"), F.nullif(F.regexp_extract(c, rf'"{field}"\s*:\s*"([^"]*)"', 1), F.lit("")))


def city_from_url(url: Column) -> Column:
    """A city's code from what the URL contains; London where nothing tells."""
    low = F.lower(F.coalesce(url, F.lit("")))
    return F.when(F.contains(url, F.lit(".co.uk")) | F.contains(low, F.lit("london")), "lon").when(any_of(low, ["newyork", "nyc"]), "nyc").when(F.contains(low, F.lit("denver")), "den").otherwise("lon")


#: Names in a location and the code they give, in order.
LOCATION_CODES = [("london", "lon"), ("new york", "nyc"), ("denver", "den"), ("united kingdom", "lon"), ("uk", "lon"), ("us", "usa"), ("united states", "usa")]


def location_code(c: Column) -> Column:
    """The code of the first known name in a location, else its first three letters."""
    low = F.lower(c)
    known = F.coalesce(*(F.when(F.contains(low, F.lit(name)), F.lit(code)) for name, code in LOCATION_CODES))
    return F.when(c.isNull() | (c == ""), "unknown").otherwise(F.coalesce(known, F.left(low, F.lit(3))))


#: Cities with a code of their own.
CITY_CODES = {"london": "lon", "new_york": "nyc", "denver": "den", "san_francisco": "sfo", "singapore": "sgp"}


def legacy_city_code(locations: Column, is_remote: Column | None = None) -> Column:
    """The code of the first location: a city's code, remote, or unk; the feed's own remote flag where the first is neither."""
    first = F.get(locations, F.lit(0))
    codes = F.create_map(*[F.lit(x) for kv in CITY_CODES.items() for x in kv])
    rule = F.when(first["type"] == "city", F.coalesce(F.try_element_at(codes, first["city"]), F.lit("unk"))).when(first["type"] == "remote", "remote")
    return rule.when(is_remote, "remote").otherwise("unk") if is_remote is not None else rule.otherwise("unk")


def first_non_empty(*columns: Column) -> Column:
    """The first of the texts that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def decode_label(code: Column, labels: dict[str, str]) -> Column:
    """A code's label, else the code."""
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in labels.items() for x in kv]), code), code)


def truncated(c: Column, most: int) -> Column:
    return F.left(c, F.lit(most))


def https(url: Column) -> Column:
    """The URL with its scheme as https."""
    return F.regexp_replace(url, "^http://", "https://")
