"""A skipping index over the elements of location arrays, so that a containment predicate opens only files that may hold a match.

Beside a folder of Parquet files lies an index with one row for each file: a bitmap of ``BITS`` bits, one for each hashed token of the file's
locations (a token is a field of an element, or two fields together). A predicate states tokens one of which every match must have; files
without any of their bits are not opened, and the rows of the others pass the exact predicate. A bit that stands for
two tokens opens a file in vain and changes no result.

Cases: rows with null or empty locations have no tokens; null fields have none; files that landed after the index was made are always
read; without an index every file is; a predicate without tokens opens no indexed file; an empty folder gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of a file: as many as one bitmap of Spark has.
BITS = 32_768
FIELDS = ("type", "country_code", "city", "region", "scope")
#: Fields that predicates ask for together.
TOGETHER = (("type", "country_code"), ("type", "scope"), ("scope", "country_code"))
#: Spark doesn't read folders whose names begin so.
INDEX = "_location_index"


def token(**fields: str) -> str:
    """The token of an element with this field, or with these two in the order of ``TOGETHER``."""
    return "&".join(f"{k}={v}" for k, v in fields.items())


def tokens_of(locations: Column) -> Column:
    """The distinct tokens of all elements of an array."""
    field = lambda l, k: F.concat(F.lit(f"{k}="), l[k])
    one = lambda l: F.array(*(field(l, k) for k in FIELDS), *(F.concat(field(l, a), F.lit("&"), field(l, b)) for a, b in TOGETHER))
    return F.array_distinct(F.array_compact(F.flatten(F.transform(F.coalesce(locations, F.array().cast("array<struct<type:string,country_code:string,city:string,region:string,scope:string>>")), one))))


def _bit(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(BITS))


def file_bits(spark: SparkSession, path: str, locations: str = "locations") -> DataFrame:
    """(file, bit): a row for each bit of a file, however many rows the file has."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.explode(tokens_of(F.col(locations))).alias("token"))
    return rows.select("file", _bit(F.col("token")).alias("bit")).distinct()


def index_files(spark: SparkSession, path: str, locations: str = "locations") -> None:
    """Makes the index anew from the files that are there now."""
    # the bitmap's aggregate sorts what it gets, so it gets no row twice
    file_bits(spark, path, locations).groupBy("file").agg(F.bitmap_construct_agg("bit").alias("bits")).write.mode("overwrite").parquet(f"{path}/{INDEX}")


def write_indexed(df: DataFrame, path: str, locations: str = "locations", near: list[Column] | None = None, files: int | None = None) -> None:
    """Writes the rows in order of ``near``, so that equal places share files, and their index."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *near) if near else df).write.parquet(path)
    index_files(df.sparkSession, path, locations)


def files_with(spark: SparkSession, path: str, tokens: list[str]) -> list[str]:
    """The files that may hold one of the tokens: those of the index with one of their bits, and those that it doesn't know."""
    files = spark.read.parquet(path).inputFiles()
    try:
        index = spark.read.schema("file string, bits binary").parquet(f"{path}/{INDEX}")
    except AnalysisException:
        return files
    bits = spark.createDataFrame([(t,) for t in tokens], "t string").select(_bit(F.col("t"))).collect() if tokens else []
    byte = lambda b: F.conv(F.hex(F.substring("bits", b // 8 + 1, 1)), 16, 10).cast("int")
    on = reduce(lambda a, b: a | b, (F.shiftright(byte(b), b % 8) % 2 == 1 for (b,) in bits), F.lit(False))
    known = {r.file: r.on for r in index.select("file", F.coalesce(on, F.lit(False)).alias("on")).collect()}  # a row for each file
    # the index names files as Spark's readers do, inputFiles with another number of slashes
    plain = lambda f: f.replace(":///", ":/")
    known = {plain(f): on for f, on in known.items()}
    return [f for f in files if known.get(plain(f), True)]


def read_containing(spark: SparkSession, path: str, tokens: list[str], exact: Column) -> DataFrame:
    """The rows that satisfy ``exact``, which holds only for rows with one of the tokens, from the files that may have them."""
    schema = spark.read.parquet(path).schema
    files = files_with(spark, path, tokens)
    return (spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)).where(exact)


def broad_tokens(city: str, country: str, region: str | None = None) -> list[str]:
    """What a posting that is open to someone in the city has at least: the city, all the world, the country or the region."""
    return [token(city=city), token(scope="global"), token(scope="country", country_code=country), token(type="country", country_code=country), *([token(region=region)] if region else [])]
