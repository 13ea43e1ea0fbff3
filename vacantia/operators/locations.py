"""Locations from free text: staged rules over distinct strings.

Rules come as ``LocationRules`` (plain values, small); the work runs once per distinct string and is joined
back. A location is a struct of type, country_code, city, region and scope.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Arrangements that postings give as their location.
REMOTE_TERMS = ["remote", "work from home", "wfh", "anywhere", "fully remote", "remote only"]
OTHER_TERMS = ["hybrid", "in-office", "in office", "on-site", "onsite", "office-based", "office based"]
#: Separators of several locations; the first that splits is used.
SEPARATORS = [r"\s+or\s+", r"\s+-\s+", r"\s*/\s*", r"\s*;\s*", r"\s*\|\s*"]
TYPE = "struct<type:string,country_code:string,city:string,region:string,scope:string>"


@dataclass
class LocationRules:
    """cities: key -> (country, patterns); remote: (scope, country, region, patterns) in order; countries: code -> names;
    regions: key -> patterns; country_names: name -> code, in order; restrictions: code -> regexes, in order."""

    cities: dict[str, tuple[str, list[str]]]
    remote: list[tuple[str, str | None, str | None, list[str]]] = field(default_factory=list)
    countries: dict[str, list[str]] = field(default_factory=dict)
    regions: dict[str, list[str]] = field(default_factory=dict)
    country_names: dict[str, str] = field(default_factory=dict)
    restrictions: dict[str, list[str]] = field(default_factory=dict)


def location(kind: str, country=None, city=None, region=None, scope=None) -> Column:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x).cast("string")
    return F.struct(F.lit(kind).alias("type"), lit(country).alias("country_code"), lit(city).alias("city"), lit(region).alias("region"), lit(scope).alias("scope"))


def _first(rules: list[tuple[Column, Column]]) -> Column:
    """The value of the first condition that holds."""
    out = F.lit(None).cast(TYPE)
    for hit, value in reversed(rules):
        out = F.when(hit, value).otherwise(out)
    return out


def _word(text: Column, names: list[str]) -> Column:
    return text.rlike(r"(?i)\b(?:" + "|".join(re.escape(n.lower()) for n in names) + r")\b") if names else F.lit(False)


def _contains(text: Column, names: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(n.lower())) for n in names), F.lit(False))


def split_locations(c: Column) -> Column:
    """The parts of a string with several locations."""
    parts = F.array(c)
    for sep in reversed(SEPARATORS):
        parts = F.when(c.rlike("(?i)" + sep), F.split(c, "(?i)" + sep)).otherwise(parts)
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def match_remote(text: Column, rules: LocationRules) -> Column:
    """Scoped patterns in order, then global ones."""
    own = [(_contains(text, p), location("remote", country, None, region, scope)) for scope, country, region, p in rules.remote if scope != "global"]
    own += [(_contains(text, p), location("remote", scope="global")) for scope, _, _, p in rules.remote if scope == "global"]
    return _first(own)


def match_city(text: Column, rules: LocationRules) -> Column:
    return _first([(_word(text, p), location("city", country, key)) for key, (country, p) in rules.cities.items()])


def match_country(text: Column, rules: LocationRules) -> Column:
    return _first([(_word(text, names), location("country", code)) for code, names in rules.countries.items()])


def match_region(text: Column, rules: LocationRules) -> Column:
    return _first([(_contains(text, p), location("region", region=key)) for key, p in rules.regions.items()])


def match_country_remote(text: Column, rules: LocationRules) -> Column:
    """A country's name beside the word remote; names of up to two letters as whole words."""
    hit = lambda n: _word(text, [n]) if len(n) <= 2 else F.contains(text, F.lit(n))
    return F.when(F.contains(text, F.lit("remote")), _first([(hit(n), location("remote", code, scope="country")) for n, code in rules.country_names.items()]))


def country_restriction(description: Column, rules: LocationRules) -> Column:
    """The first country that the text restricts applicants to."""
    out = F.lit(None).cast("string")
    for code, patterns in reversed(list(rules.restrictions.items())):
        out = F.when(description.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), code).otherwise(out)
    return out


def _long_match(text: Column, rules: LocationRules) -> Column:
    """The first scoped pattern in the text, if it is more than half of it."""
    hits = []
    for scope, country, region, patterns in rules.remote:
        if scope == "global":
            continue
        for p in patterns:
            value = F.when(F.lit(2 * len(p)) > F.length(text), location("remote", country, None, region, scope))
            hits.append((F.contains(text, F.lit(p.lower())), value))
    return _first(hits)


def parse_location(raw: Column, description: Column | None, rules: LocationRules, infer_scope: bool = True) -> Column:
    """The locations of one string; one of type unknown if there are none."""
    unknown = F.array(location("unknown"))
    text = F.lower(F.trim(raw))
    limited = country_restriction(F.lower(F.coalesce(description, F.lit(""))), rules) if description is not None and rules.restrictions else F.lit(None).cast("string")
    restrict = lambda l: F.when((l["type"] == "remote") & (l["scope"] == "global") & limited.isNotNull(), location("remote", limited, scope="country")).otherwise(l)  # noqa: E731, E741
    match = lambda p: F.coalesce(match_remote(p, rules), match_city(p, rules), match_country(p, rules), match_region(p, rules))
    parts = F.filter(F.transform(split_locations(raw), lambda p: match(F.lower(p))), lambda l: l.isNotNull())
    if infer_scope:
        city = F.get(F.filter(parts, lambda l: l["type"] == "city"), F.lit(0))["country_code"]
        parts = F.transform(parts, lambda l: F.when((l["type"] == "remote") & (l["scope"] == "global") & city.isNotNull(), location("remote", city, scope="country")).otherwise(l))
    parts = F.transform(F.array_distinct(parts), restrict)
    long, country = _long_match(text, rules), match_country_remote(text, rules)
    return (
        F.when(raw.isNull() | (text == ""), unknown)
        .when(text.isin(REMOTE_TERMS), F.array(restrict(location("remote", scope="global"))))
        .when(text.isin(OTHER_TERMS), unknown)
        .when(long.isNotNull(), F.array(long))
        .when(country.isNotNull(), F.array(country))
        .when(F.size(parts) > 0, parts)
        .otherwise(unknown)
    )


def extract_locations(df: DataFrame, raw: str, rules: LocationRules, description: str | None = None, infer_scope: bool = True) -> DataFrame:
    """Adds ``locations``. Without descriptions each distinct string is parsed once and joined back."""
    if description:
        return df.withColumn("locations", parse_location(F.col(raw), F.col(description), rules, infer_scope))
    strings = df.select(raw).distinct().withColumn("locations", parse_location(F.col(raw), None, rules, infer_scope))
    return df.join(strings.withColumnRenamed(raw, "__raw"), F.col(raw).eqNullSafe(F.col("__raw")), "left").drop("__raw")


def accessible_from(locations: Column, city: str, country: str, region: str | None = None) -> Column:
    """Whether someone in the city can take the posting."""

    no = F.lit(False)

    def ok(l: Column) -> Column:  # noqa: E741
        hits = [l["city"] == city, l["scope"] == "global", (l["scope"] == "country") & (l["country_code"] == country), (l["type"] == "country") & (l["country_code"] == country)]
        hits += [l["region"] == region] if region else []
        return reduce(lambda a, b: a | b, (F.coalesce(h, no) for h in hits))

    return F.coalesce(F.exists(locations, ok), no)


def matches_targets(locations: Column, cities: list[str] | None = None, countries: list[str] | None = None, remote: bool = True) -> Column:
    """Whether a location is one of the target cities or countries, or remote from there."""
    no = F.lit(False)

    def ok(l: Column) -> Column:  # noqa: E741
        here = F.coalesce(l["country_code"].isin(countries), no) if countries else no
        far = (here | F.coalesce(l["scope"] == "global", no)) if countries else F.lit(True)
        city = F.coalesce(l["city"].isin(cities), no) if cities else no
        return ((l["type"] == "remote") & far & F.lit(remote)) | ((l["type"] == "city") & (city | here)) | ((l["type"] == "country") & here)

    return F.coalesce(F.exists(locations, ok), no)


def primary_label(locations: Column) -> Column:
    """City, remote_ and scope, country, or unknown, of the first location."""
    l = F.get(locations, F.lit(0))  # noqa: E741
    return F.when(l["type"] == "city", l["city"]).when(l["type"] == "remote", F.concat(F.lit("remote_"), F.lower(F.coalesce(l["country_code"], l["scope"])))).when(l["type"] == "country", l["country_code"]).otherwise("unknown")


def changed(old: Column, new: Column) -> Column:
    return ~old.eqNullSafe(new)


def from_legacy(code: Column, legacy: dict[str, Column], parsed: Column | None = None) -> Column:
    """The locations of a legacy city code: those parsed from the posting if any is known, else the code's own."""
    own = F.lit(None).cast(TYPE)
    for key, value in legacy.items():
        own = F.when(code == key, value).otherwise(own)
    known = F.filter(parsed, lambda l: l["type"] != "unknown") if parsed is not None else F.array().cast(f"array<{TYPE}>")
    return F.when(F.size(known) > 0, known).when(own.isNotNull(), F.array(own)).otherwise(F.array(location("unknown")))
