"""The postings frame that operators run on: one row per order of the driver's star schema.

``postings`` builds it from Parquet tables with DataFrame functions; ``POSTINGS_SQL`` is the same frame as
common table expressions, for oracles. Amounts are decimals, so sums don't depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.storage import shared_folder  # noqa: F401  for the queries

#: The day that stands for today.
AS_OF = "2001-08-02"

SENIORITY = {"1-URGENT": "director_plus", "2-HIGH": "staff_principal", "3-MEDIUM": "senior", "4-NOT SPECIFIED": "unknown", "5-LOW": "junior"}
FAMILY = {"AUTOMOBILE": "data", "BUILDING": "product", "FURNITURE": "delivery", "HOUSEHOLD": "data", "MACHINERY": "out_of_scope"}
STATUS = {"F": "404", "P": "soft_404", "O": "active"}
ARRANGEMENT = {"A": "remote", "N": "hybrid", "R": "onsite"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def decode(column: str, values: dict[str, str], default: str | None = None):
    """A code replaced by its value from a small fixed map."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(column)), F.lit(default) if default else F.col(column))


#: Bytes of line files for one partition where these are spread, some 600,000 lines; smaller tables than SPREAD_FROM stay as they are.
PART_BYTES, SPREAD_FROM = 8 << 20, 64 << 20


def spread(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions for work whose tasks must not grow with the table of lines; None for a small table."""
    size = int(str(table(spark, sf_dir, "lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_BYTES) if size > SPREAD_FROM else None


def postings(spark: SparkSession, sf_dir: str, parts: int | None = None, of_part: bool = False) -> DataFrame:
    """A row for each order. With ``parts`` its lines are dealt into so many partitions; ``of_part`` says that columns of ``part`` are asked for."""
    # an outer join, which Spark drops where no part column is asked for; each column is an aggregate of its own, so that
    # only those that are asked for are made
    deal = lambda df, now: df.repartition(parts, "l_orderkey") if parts and now else df
    # only a join right below the aggregate is dropped
    lines = deal(table(spark, sf_dir, "lineitem"), not of_part)
    lines = lines.join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name"), "l_partkey", "left")
    lines = deal(lines, of_part)
    place = F.struct("l_linenumber", "l_partkey", "l_suppkey")
    per_order = lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.max("l_shipdate").cast("date").alias("url_checked_at"),
        F.transform(F.array_sort(F.collect_list(F.struct(place.alias("place"), "p_brand"))), lambda x: x["p_brand"]).alias("skills_all"),
        F.array_sort(F.collect_set("p_brand")).alias("skills"),
        F.min_by("l_returnflag", place).alias("flag"),
        F.min_by("p_name", place).alias("title"),
    )
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    people = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf_dir, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("o_orderkey", "id")
    return orders.join(per_order, "id", "left").select(
        "id",
        F.lower(F.trim("c_name")).alias("employer_name"),
        "title",
        F.col("o_orderdate").cast("date").alias("posted_date"),
        "url_checked_at",
        decode("o_orderstatus", STATUS).alias("url_status"),
        decode("o_orderpriority", SENIORITY).alias("seniority"),
        F.col("c_mktsegment").alias("job_subfamily"),
        decode("c_mktsegment", FAMILY).alias("job_family"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("salary_midpoint"),
        F.coalesce("skills", F.array().cast("array<string>")).alias("skills"),
        F.coalesce("skills_all", F.array().cast("array<string>")).alias("skills_all"),
        decode("flag", ARRANGEMENT).alias("working_arrangement"),
        (F.col("c_acctbal") < 0).alias("is_agency"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("region"),
        F.concat(F.lit("src"), F.pmod(F.col("id"), F.lit(5)).cast("string")).alias("source"),
    )


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + f" ELSE {column} END"


POSTINGS_SQL = f"""
per_order AS (
  SELECT l_orderkey AS id, max(l_shipdate)::DATE AS url_checked_at,
         list(p_brand ORDER BY l_linenumber, l_partkey, l_suppkey) AS skills_all, list_sort(list(DISTINCT p_brand)) AS skills,
         list(l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey)[1] AS flag,
         list(p_name ORDER BY l_linenumber, l_partkey, l_suppkey)[1] AS title
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey),
postings AS (
  SELECT o_orderkey AS id, lower(trim(c_name)) AS employer_name, title, o_orderdate::DATE AS posted_date, url_checked_at,
         {_case("o_orderstatus", STATUS)} AS url_status, {_case("o_orderpriority", SENIORITY)} AS seniority,
         c_mktsegment AS job_subfamily, {_case("c_mktsegment", FAMILY)} AS job_family, o_totalprice::DECIMAL(18,2) AS salary_midpoint,
         coalesce(skills, []) AS skills, coalesce(skills_all, []) AS skills_all, {_case("flag", ARRANGEMENT)} AS working_arrangement,
         c_acctbal < 0 AS is_agency, n_name AS city, r_name AS region, 'src' || (o_orderkey % 5)::VARCHAR AS source
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN per_order ON per_order.id = o_orderkey)"""


def employers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employer dimension: one row per customer."""
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lower(F.trim("c_name")).alias("canonical_name"),
        F.col("c_name").alias("display_name"),
        F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("industry"),
        F.when(F.col("c_acctbal") < 1000, "startup").when(F.col("c_acctbal") < 5000, "scaleup").otherwise("enterprise").alias("employer_size"),
        (F.lit(1950) + F.pmod("c_custkey", F.lit(75))).cast("int").alias("founding_year"),
        F.when(F.pmod("c_custkey", F.lit(3)) == 0, "public").when(F.pmod("c_custkey", F.lit(3)) == 1, "private").alias("ownership_type"),
        F.col("n_name").alias("headquarters"),
    )


EMPLOYERS_SQL = """
employers AS (
  SELECT lower(trim(c_name)) AS canonical_name, c_name AS display_name, nullif(c_mktsegment, 'MACHINERY') AS industry,
         CASE WHEN c_acctbal < 1000 THEN 'startup' WHEN c_acctbal < 5000 THEN 'scaleup' ELSE 'enterprise' END AS employer_size,
         (1950 + c_custkey % 75)::INT AS founding_year,
         CASE c_custkey % 3 WHEN 0 THEN 'public' WHEN 1 THEN 'private' END AS ownership_type, n_name AS headquarters
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
