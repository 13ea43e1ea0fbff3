"""Rule-based classification as column expressions: agencies, arrangement, URL status, families, skills."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions.text import any_of, count_of, is_director, matches_any, skill_key, skill_title, title_seniority

# Fixed values of the agency rules.
STRONG_WORDS = ["recruitment", "recruiting", "recruiter", "staffing", "headhunters", "executive search", "talent acquisition", "placement", "resourcing"]
WEAK_WORDS = ["talent", "search", "consultancy", "consulting", "solutions", "group", "partners", "associates", "international", "global"]
STRONG_ENDS = ["recruitment", "recruiting", "staffing", "headhunters"]
WEAK_ENDS = ["talent", "search", "consultancy", "consulting", "solutions", "group", "partners", "associates"]
GENERIC_ENDS = ["solutions", "consulting", "partners", "associates", "group", "agency"]
HIRING_WORDS = ["talent", "staff", "recruit", "search"]
PHRASES = ["our client", "on behalf of", "exciting opportunity", "confidential client", "leading company", "growing business", "fantastic opportunity"]

# Fixed values of the page checks.
GONE_TEXTS = ["job not found", "position has been filled", "no longer available", "no longer accepting", "page not found", "this job is closed", "this position has been closed", "job has been removed", "listing has expired", "role has been filled", "opening has been filled", "job does not exist", "position is no longer available", "opportunity is no longer available"]
BOT_TEXTS = ["please complete a security check", "checking your browser", "please verify you are a human", "captcha", "access denied", "please wait while we verify", "just a moment", "ddos protection", "cloudflare", "enable javascript and cookies"]

# Fixed values of the arrangement rules.
REMOTE = [r"\(remote\)", "remote-first", "fully remote", "100% remote", "remote position", r"\bwork from home\b", r"\bwfh\b", "work remotely", "remote work environment"]
NOT_REMOTE = ["remote capture", "remotely piloted", "remote onboarding", "remote areas", "remote communities", "remote locations", "remote regions", "remote sensing", "remote monitoring"]
HYBRID = [r"\(hybrid\)", "hybrid working", "hybrid model", "hybrid role", r"\d+\s*days?.{0,10}(in\s*)?office", r"office\s*\d+\s*days?"]
NOT_HYBRID = ["hybrid cloud", "on-prem.*hybrid", "hybrid.*environment", "hybrid.*infrastructure", "hybrid.*solution"]
ONSITE = [r"\(onsite\)", r"\(on-site\)", "office-based", "office based", "role type:.*onsite", "position type:.*onsite", r"location:.*\(onsite\)", r"on-?site\s*(role|position|work)", "must be.{0,20}on-?site"]


def _ends(name: Column, ends: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (name.endswith(e) for e in ends), F.lit(False))


def agency_confidence(name: Column, text: Column | None = None, listed: Column | None = None, exempt: Column | None = None) -> Column:
    """'high', 'medium' or 'low' confidence that an employer is an agency; the first rule that holds decides.

    listed and exempt say whether the name is on the caller's lists of known agencies and known employers."""
    name = F.coalesce(F.lower(F.trim(name)), F.lit(""))
    strong, weak = count_of(name, STRONG_WORDS), count_of(name, WEAK_WORDS)
    special = [e for e in WEAK_ENDS if e not in GENERIC_ENDS]
    generic = [e for e in WEAK_ENDS if e in GENERIC_ENDS]
    rule = F.when((name == "") | (exempt if exempt is not None else F.lit(False)), "low")
    if listed is not None:
        rule = rule.when(listed, "high")
    rule = rule.when(strong >= 2, "high").when(_ends(name, STRONG_ENDS), "high").when(strong == 1, "medium")
    rule = rule.when(_ends(name, special), "medium").when(_ends(name, generic) & any_of(name, HIRING_WORDS), "medium").when(weak >= 2, "medium")
    if text is not None:
        said = count_of(F.coalesce(F.lower(text), F.lit("")), PHRASES)
        rule = rule.when((said >= 2) | ((said == 1) & (weak >= 1)), "medium")
    return rule.otherwise("low")


def detect_agencies(df: DataFrame, name: str, text: str | None, known_agencies: DataFrame, known_employers: DataFrame) -> DataFrame:
    """Adds is_agency and agency_confidence; the lists are frames with one column ``name`` in lower case."""
    key = F.lower(F.trim(F.col(name)))
    lists = known_agencies.select(F.col("name").alias("__k"), F.lit(True).alias("__listed")).distinct()
    good = known_employers.select(F.col("name").alias("__k"), F.lit(True).alias("__exempt")).distinct()
    joined = df.withColumn("__k", key).join(lists, "__k", "left").join(good, "__k", "left")
    no = F.lit(False)
    found = agency_confidence(F.col(name), F.col(text) if text else None, F.coalesce("__listed", no), F.coalesce("__exempt", no))
    return joined.withColumn("agency_confidence", found).withColumn("is_agency", F.col("agency_confidence") != "low").drop("__k", "__listed", "__exempt")


def combine_agency(pattern: Column, flag: Column, flag_confidence: Column) -> tuple[Column, Column]:
    """(is_agency, confidence) from the pattern's confidence and an outside flag."""
    agency = F.when(pattern == "high", True).when(pattern == "medium", F.coalesce(flag, F.lit(True))).otherwise(F.coalesce(flag, F.lit(False)))
    sure = F.when(pattern == "high", "high").when((pattern == "medium") & flag, "high").when((pattern == "medium") & ~flag, "low").when(pattern == "medium", "medium").when(flag.isNotNull(), F.coalesce(flag_confidence, F.lit("medium"))).otherwise("low")
    return agency, sure


def text_arrangement(title: Column, text: Column) -> Column:
    """remote, hybrid or onsite as the text says, with vetoes for other senses of the words; else unknown."""
    both = F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(text, F.lit("")))
    return (
        F.when(matches_any(both, REMOTE) & ~matches_any(both, NOT_REMOTE), "remote")
        .when(matches_any(both, HYBRID) & ~matches_any(both, NOT_HYBRID), "hybrid")
        .when(matches_any(both, ONSITE), "onsite")
        .otherwise("unknown")
    )


def url_status(code: Column, url: Column, body: Column) -> Column:
    """What a landed response says about a posting; no code is a network error."""
    error_url = any_of(F.lower(F.coalesce(url, F.lit(""))), ["error=true", "notfound"])
    gone = any_of(F.lower(F.coalesce(body, F.lit(""))), GONE_TEXTS)
    return (
        F.when(code.isNull(), "error").when(code == 404, "404").when(code == 410, "410").when(code.isin(403, 202), "blocked").when(code >= 500, "error")
        .when((code == 200) & (error_url | gone), "soft_404").when(code == 200, "active").when((code >= 300) & (code < 400), "redirect").otherwise("error")
    )


def rendered_status(body: Column) -> Column:
    """The verdict on a rendered page."""
    low = F.lower(F.coalesce(body, F.lit("")))
    return F.when(body.isNull() | any_of(low, BOT_TEXTS), "unverifiable").when(any_of(low, GONE_TEXTS), "soft_404").otherwise("active")


def first_family(title: Column, families: dict[str, list[str]], default: str = "out_of_scope") -> Column:
    """The first family one of whose patterns is found in the title."""
    rule = None
    for family, patterns in families.items():
        hit = matches_any(F.lower(title), patterns)
        rule = F.when(hit, family) if rule is None else rule.when(hit, family)
    return rule.otherwise(default) if rule is not None else F.lit(default)


def fix_family(df: DataFrame, subfamily: str, family: str, mapping: DataFrame) -> DataFrame:
    """The family that the subfamily belongs to, and whether that changed it; mapping: subfamily, family."""
    right = mapping.select(F.col("subfamily").alias(subfamily), F.col("family").alias("__right"))
    fixed = df.join(right, subfamily, "left").withColumn("was_corrected", F.col("__right").isNotNull() & ~F.col("__right").eqNullSafe(F.col(family)))
    return fixed.withColumn(family, F.coalesce("__right", family)).drop("__right")


def map_skills(df: DataFrame, key: str, skills: str, mapping: DataFrame) -> DataFrame:
    """(key, pos, skill, name, family): each skill's canonical name and family, by its exact lower-case name or else its
    normalised one; names in no mapping are title-cased. mapping: name, family and pos, its order: of entries with one
    name the first gives the canonical form and the last the family."""
    numbered = mapping.select(F.trim("name").alias("name"), "family", F.col("pos").alias("at"), F.lower(F.trim("name")).alias("exact"), skill_key(F.col("name")).alias("loose"))
    one = lambda c, n: numbered.groupBy(F.col(c).alias(f"__{n}")).agg(F.min_by("name", "at").alias(f"{n}_name"), F.max_by("family", "at").alias(f"{n}_family"))
    rows = df.select(key, F.posexplode_outer(skills).alias("pos", "skill")).where("skill IS NOT NULL")
    rows = rows.withColumn("__exact", F.lower(F.trim("skill"))).withColumn("__loose", skill_key(F.col("skill")))
    rows = rows.join(one("exact", "exact"), "__exact", "left").join(one("loose", "loose"), "__loose", "left")
    return rows.select(key, "pos", "skill", F.coalesce("exact_name", "loose_name", skill_title(F.col("skill"))).alias("name"), F.coalesce("exact_family", "loose_family").alias("family"))


def mapping_stats(mapping: DataFrame) -> DataFrame:
    """Skills of each family."""
    return mapping.groupBy("family").agg(F.countDistinct(F.lower(F.trim("name"))).alias("n"))


def industry_by_words(name: Column, rules: dict[str, list[str]]) -> Column:
    """The first industry one of whose words the name contains."""
    low = F.lower(F.coalesce(name, F.lit("")))
    return F.coalesce(*(F.when(any_of(low, words), industry) for industry, words in rules.items())) if rules else F.lit(None).cast("string")


def correct_track(family: Column, title: Column, track: Column, seniority: Column) -> tuple[Column, Column]:
    """In delivery and product, without a director's title: managers are individual contributors, and director_plus
    is the level that the title says."""
    wrong = F.coalesce(family.isin("delivery", "product"), F.lit(False)) & ~is_director(title)
    return F.when(wrong & (track == "management"), "ic").otherwise(track), F.when(wrong & (seniority == "director_plus"), title_seniority(F.coalesce(title, F.lit("")))).otherwise(seniority)


def backfill_tracks(df: DataFrame, family: str, title: str, track: str, seniority: str) -> DataFrame:
    """The rows with corrected track and seniority, and whether each was changed."""
    new_track, new_level = correct_track(F.col(family), F.col(title), F.col(track), F.col(seniority))
    was = df.withColumn("track_changed", ~new_track.eqNullSafe(F.col(track))).withColumn("seniority_changed", ~new_level.eqNullSafe(F.col(seniority)))
    return was.withColumns({track: new_track, seniority: new_level})


#: The fewest characters of a description that can be classified.
LEAST_DESCRIPTION = 50


def blocked_reason(agency: Column, description: Column, family: Column) -> Column:
    """Why a raw posting is left out on purpose; null if it isn't."""
    return F.when(agency, "agency_hard_filter").when(F.length(F.coalesce(description, F.lit(""))) < LEAST_DESCRIPTION, "description_too_short").when(family == "out_of_scope", "out_of_scope")


def to_backfill(raw: DataFrame, enriched: DataFrame, key: str, reason: str = "blocked_reason") -> DataFrame:
    """Raw rows without an enriched row that weren't left out on purpose."""
    return raw.where(F.col(reason).isNull()).join(enriched.select(key).distinct(), key, "left_anti")


#: Words in a company's name that tell its industry.
INDUSTRY_WORDS = {
    "professional_services": [
        "staffing", "recruiting", "recruitment", "talent acquisition", "consultancy", "consulting group", "associates", "partners llp",
        "solutions ltd", "resources", "personnel", "headhunter", "executive search", "employment agency",
    ],
    "financial_services": [
        "ventures", "venture capital", "capital partners", "investment partners", "private equity", "growth equity", "venture fund", "capital management",
        "bank", "banking", "credit union", "savings", "trust company",
    ],
}


def arrangement_precedence(source: Column, structured: Column, classified: Column, remote: Column, default: Column) -> Column:
    """The first known arrangement: a Lever posting's own field, the classifier, the remote flag, the employer's default."""
    known = lambda c: F.nullif(c, F.lit("unknown"))
    flag = F.when(remote, "remote")
    return F.when(source == "lever", F.coalesce(known(structured), known(classified), known(default), F.lit("unknown"))).otherwise(F.coalesce(known(classified), flag, known(default), F.lit("unknown")))
