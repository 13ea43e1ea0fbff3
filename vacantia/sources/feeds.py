"""Scans of landed postings from five applicant-tracking feeds and an XML feed, and sinks.

Every scan has an explicit schema (a missing field is null) and gives the columns of ``UNIFIED``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.functions.text import first_truthy, job_id, pay_from_cents, salary_range, strip_html

UNIFIED = ["source", "company_slug", "job_id", "title", "location", "department", "employment_type", "description", "url", "salary_min", "salary_max", "currency", "is_remote", "working_arrangement", "posted_at"]

GREENHOUSE = """id long, title string, location struct<name: string>, departments array<struct<name: string>>,
pay_input_ranges array<struct<min_cents: long, max_cents: long, currency_type: string>>, content string, absolute_url string, updated_at string"""
LEVER = """id string, text string, descriptionPlain string, description string, lists array<struct<text: string, content: string>>, additional string, additionalPlain string,
categories struct<location: string, allLocations: array<string>, team: string, department: string, commitment: string>, workplaceType string, hostedUrl string, applyUrl string, createdAt long"""
_PAY = "struct<compensationType: string, minValue: double, maxValue: double, currencyCode: string>"
ASHBY = f"""id string, title string, location string, secondaryLocations array<struct<location: string>>,
address struct<postalAddress: struct<addressLocality: string, addressRegion: string, addressCountry: string>>,
compensation struct<compensationTierSummary: string, compensationTiers: array<struct<salaryRange: struct<min: struct<value: double, currency: string>, max: struct<value: double, currency: string>>, components: array<{_PAY}>>>, summaryComponents: array<{_PAY}>>,
department string, isRemote boolean, descriptionPlain string, descriptionHtml string, employmentType string, jobUrl string, publishedAt string"""
WORKABLE = """shortcode string, title string, city string, state string, country string, department string, employment_type string,
location struct<location_str: string, city: string, region: string, country: string, country_code: string>, locations array<struct<countryCode: string>>, workplace_type string, telecommuting boolean,
salary struct<salary_from: double, salary_to: double, salary_currency: string>, description string, url string, published_on string, created_at string"""
SMART_LIST = """id string, name string, location struct<city: string, region: string, country: string, remote: boolean>, department struct<label: string>, experienceLevel struct<id: string>,
typeOfEmployment struct<id: string>, industry struct<label: string>, function struct<label: string>, releasedDate string"""
_TEXT = "struct<text: string>"
SMART_DETAIL = f"id string, jobAd struct<sections: struct<companyDescription: {_TEXT}, jobDescription: {_TEXT}, qualifications: {_TEXT}, additionalInformation: {_TEXT}>>, applyUrl string"
XML_JOB = "title string, url string, description string, jobid string, employer string, locations struct<location: array<struct<city: string, state: string, country: string>>>"


def read_json(spark: SparkSession, path: str, schema: str, rows_in: str | None = None) -> DataFrame:
    """Landed JSON with a fixed schema; ``rows_in`` names the array that holds the postings, if there is one."""
    if rows_in:
        df = spark.read.schema(f"company_slug string, {rows_in} array<struct<{_colons(schema)}>>").json(path, mode="PERMISSIVE")
        return df.select("company_slug", F.explode(rows_in).alias("r")).select("company_slug", "r.*")
    return spark.read.schema("company_slug string, " + schema).json(path, mode="PERMISSIVE")


def _colons(schema: str) -> str:
    """The top-level fields of a schema string as those of a struct."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema).simpleString()[len("struct<") : -1]


def _blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def _unified(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    empty = {"salary_min": "double", "salary_max": "double", "is_remote": "boolean", "posted_at": "timestamp"}
    pick = lambda c: (F.lit(source) if c == "source" else F.col(c) if c == "company_slug" else columns.get(c, F.lit(None))).cast(empty.get(c, "string")).alias(c)
    return df.select(*map(pick, UNIFIED))


def greenhouse(df: DataFrame) -> DataFrame:
    """Location name, first department, pay of the first range in whole units, HTML as text."""
    return _unified(
        df, "greenhouse", job_id=F.col("id"), title=F.col("title"), location=F.coalesce("location.name", F.lit("Unspecified")), department=F.get("departments", F.lit(0))["name"], description=strip_html(F.col("content")),
        url=F.col("absolute_url"), salary_min=pay_from_cents(F.col("pay_input_ranges"), "min_cents"), salary_max=pay_from_cents(F.col("pay_input_ranges"), "max_cents"),
        currency=F.get("pay_input_ranges", F.lit(0))["currency_type"], posted_at=F.try_to_timestamp("updated_at"),
    )


def lever_description(df_columns: None = None) -> Column:
    """The plain text, each list as its heading and text, and the closing text."""
    lists = F.transform(F.coalesce("lists", F.array().cast("array<struct<text:string,content:string>>")), lambda x: F.concat_ws("\n", _blank(x["text"]), _blank(strip_html(x["content"], False))))
    main = F.coalesce(_blank(F.col("descriptionPlain")), _blank(strip_html(F.col("description"), False)))
    more = F.coalesce(_blank(F.col("additionalPlain")), _blank(strip_html(F.col("additional"), False)))
    return F.concat_ws("\n\n", main, _blank(F.array_join(F.filter(lists, lambda x: x != ""), "\n\n")), more)


def lever(df: DataFrame) -> DataFrame:
    """All locations joined by / where there are any, else the one location."""
    many = F.col("categories.allLocations")
    return _unified(
        df, "lever", job_id=F.col("id"), title=F.col("text"), location=F.when(F.size(many) > 0, F.array_join(many, " / ")).otherwise(F.col("categories.location")),
        department=F.coalesce("categories.department", "categories.team"), employment_type=F.col("categories.commitment"), description=lever_description(), url=F.coalesce("hostedUrl", "applyUrl"),
        working_arrangement=F.nullif(F.lower("workplaceType"), F.lit("unspecified")), is_remote=F.lower("workplaceType") == "remote", posted_at=F.timestamp_millis("createdAt"),
    )


def ashby_pay() -> tuple[Column, Column, Column]:
    """Pay from a tier's range, else the tier's Salary component, else the summary's.

    A place's minimum and maximum are kept apart, 0 counts as absent, and later places are read only as long as
    there is no minimum; what they have replaces what there was."""
    tier = F.get("compensation.compensationTiers", F.lit(0))
    salary = lambda xs: F.get(F.filter(xs, lambda c: c["compensationType"] == "Salary"), F.lit(0))
    some = lambda c: F.floor(F.nullif(c, F.lit(0.0)))
    low, high = some(tier["salaryRange"]["min"]["value"]), some(tier["salaryRange"]["max"]["value"])
    own = F.when(low.isNotNull(), tier["salaryRange"]["min"]["currency"])
    currency = F.when(high.isNotNull(), F.coalesce(tier["salaryRange"]["max"]["currency"], own)).otherwise(own)
    for place in (salary(tier["components"]), salary(F.col("compensation.summaryComponents"))):
        take = lambda new, old: F.when(low.isNull(), F.coalesce(new, old)).otherwise(old)  # noqa: B023, E731
        low, high, currency = take(some(place["minValue"]), low), take(some(place["maxValue"]), high), take(F.nullif(place["currencyCode"], F.lit("")), currency)
    return low, high, currency


def ashby(df: DataFrame) -> DataFrame:
    """Primary and distinct secondary locations, or the postal address."""
    low, high, currency = ashby_pay()
    other = F.transform(F.coalesce("secondaryLocations", F.array().cast("array<struct<location:string>>")), lambda x: x["location"])
    names = F.array_distinct(F.filter(F.concat(F.array("location"), other), lambda x: x.isNotNull() & (F.trim(x) != "")))
    post = F.col("address.postalAddress")
    address = F.concat_ws(", ", _blank(post["addressLocality"]), _blank(post["addressRegion"]), _blank(post["addressCountry"]))
    return _unified(
        df, "ashby", job_id=F.col("id"), title=F.col("title"), location=F.when(F.size(names) > 0, F.array_join(names, " / ")).otherwise(_blank(address)), department=F.col("department"), employment_type=F.col("employmentType"),
        description=F.coalesce(_blank(F.col("descriptionPlain")), strip_html(F.col("descriptionHtml"))), url=F.col("jobUrl"), salary_min=low, salary_max=high, currency=currency, is_remote=F.col("isRemote"),
        working_arrangement=F.when(F.col("isRemote"), "remote"), posted_at=F.try_to_timestamp("publishedAt"),
    )


def workable(df: DataFrame) -> DataFrame:
    """The location string, else city, region and country of either place; telecommuting decides where the type doesn't."""
    nested = F.concat_ws(", ", _blank(F.col("location.city")), _blank(F.col("location.region")), _blank(F.col("location.country")))
    flat = F.concat_ws(", ", _blank(F.col("city")), _blank(F.col("state")), _blank(F.col("country")))
    kind = F.coalesce(_blank(F.lower("workplace_type")), F.when(F.col("telecommuting"), "remote").when(~F.col("telecommuting"), "on_site"))
    return _unified(
        df, "workable", job_id=F.col("shortcode"), title=F.col("title"), location=F.coalesce(_blank(F.col("location.location_str")), _blank(nested), _blank(flat)), department=F.col("department"), employment_type=F.col("employment_type"),
        description=strip_html(F.col("description")), url=F.col("url"), salary_min=F.col("salary.salary_from"), salary_max=F.col("salary.salary_to"), currency=F.upper("salary.salary_currency"),
        is_remote=F.coalesce(F.col("telecommuting"), kind == "remote"), working_arrangement=kind, posted_at=F.coalesce(F.try_to_timestamp("published_on"), F.try_to_timestamp("created_at")),
    )


def smartrecruiters(listed: DataFrame, details: DataFrame) -> DataFrame:
    """List rows with the sections of their detail rows, where there are any."""
    section = lambda k: _blank(strip_html(F.col(f"jobAd.sections.{k}.text")))
    more = details.select("company_slug", "id", "jobAd", "applyUrl")
    df = listed.join(more, ["company_slug", "id"], "left")
    return _unified(
        df, "smartrecruiters", job_id=F.col("id"), title=F.col("name"), location=_blank(F.concat_ws(", ", _blank(F.col("location.city")), _blank(F.col("location.region")), _blank(F.col("location.country")))), department=F.col("department.label"),
        employment_type=F.col("typeOfEmployment.id"), description=F.concat_ws("\n\n", *map(section, ("companyDescription", "jobDescription", "qualifications", "additionalInformation"))), url=F.col("applyUrl"),
        is_remote=F.col("location.remote"), working_arrangement=F.when(F.col("location.remote"), "remote"), posted_at=F.try_to_timestamp("releasedDate"),
    )


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", "job").schema(XML_JOB).load(path)


def xml_feed(df: DataFrame) -> DataFrame:
    """The first location, pay from the text, and an id from the URL where there is none."""
    text = strip_html(F.col("description"), False)
    place = F.get("locations.location", F.lit(0))
    low, high, currency = salary_range(text)
    df = df.withColumn("company_slug", F.lower(F.regexp_replace(F.coalesce("employer", F.lit("")), r"\s+", "-")))
    return _unified(
        df, "custom", job_id=F.coalesce(_blank(F.col("jobid")), job_id(F.col("url"))), title=F.col("title"), location=_blank(F.concat_ws(", ", _blank(place["city"]), _blank(place["state"]), _blank(place["country"]))),
        description=text, url=F.col("url"), salary_min=low, salary_max=high, currency=currency,
    )


def union_sources(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dimension(spark: SparkSession, rows: list[tuple], schema: str, key: str | None = None) -> DataFrame:
    """A small dimension from configuration values, its key in lower case."""
    df = spark.createDataFrame(rows, schema)
    return df.withColumn(key, F.lower(F.trim(key))) if key else df


def company_slugs(spark: SparkSession, mapping: dict[str, str | dict]) -> DataFrame:
    """(company, slug, url_type, instance) of a mapping from names to slugs or to their settings."""
    rows = [(n, v, "standard", "global") if isinstance(v, str) else (n, v.get("slug"), v.get("url_type", "standard"), v.get("instance", "global")) for n, v in mapping.items()]
    return dimension(spark, rows, "company string, slug string, url_type string, instance string", "slug")


def batched_lookup(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows with the given keys."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def export_csv(df: DataFrame, path: str, text: str = "description") -> None:
    """Flat columns; the long text is only counted."""
    flat = df.withColumn(f"{text}_length", F.length(text)).drop(text) if text in df.columns else df
    flat.write.mode("overwrite").csv(path, header=True)


def write_table(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    """A Parquet table; write a merge's result to a new path, as it reads the old one."""
    (df.write.partitionBy(*partition) if partition else df.write).mode("overwrite").parquet(path)


def final_pay(structured: Column, classified: Column) -> Column:
    """A feed's own pay before the classifier's."""
    return first_truthy(structured, classified)
