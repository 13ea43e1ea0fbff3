"""The skipping index: no row is lost, and files without a match aren't opened."""

import pytest
from pyspark.sql import functions as F

from vacantia.operators import locations, skipping

CITIES = [f"city{k}" for k in range(40)]


@pytest.fixture
def landed(spark, tmp_path):
    k = F.col("id")
    city = F.concat(F.lit("city"), (k % 40).cast("string"))
    here = locations.location("city", F.concat(F.lit("c"), (k % 8).cast("string")), city)
    far = F.when(k % 100 == 0, locations.location("remote", scope="global")).when(k % 33 == 0, locations.location("remote", F.lit("c3"), scope="country"))
    df = spark.range(4000).withColumn("locations", F.when(k % 50 != 7, F.array_compact(F.array(here, far))))
    path = f"{tmp_path}/located"
    skipping.write_indexed(df, path, near=[k % 100 == 0, k % 40, k], files=20)
    return df, path


def test_one_city_opens_few_files_and_loses_no_row(spark, landed):
    df, path = landed
    for city in CITIES[::7]:
        exact = F.exists("locations", lambda l: l["city"] == city)
        tokens = [skipping.token(city=city)]
        assert len(skipping.files_with(spark, path, tokens)) <= 5 < 20
        got = skipping.read_containing(spark, path, tokens, exact)
        assert len(got.inputFiles()) <= 5
        assert {r.id for r in got.collect()} == {r.id for r in df.where(exact).collect()}


def test_the_broad_predicate(spark, landed):
    df, path = landed
    place = ("city5", "c3", None)
    exact = locations.accessible_from(F.col("locations"), *place)
    got = skipping.read_containing(spark, path, skipping.broad_tokens(*place), exact)
    assert {r.id for r in got.collect()} == {r.id for r in df.where(exact).collect()}
    both = skipping.token(scope="country", country_code="c4")  # each of the two occurs, but in no element together
    assert skipping.read_containing(spark, path, [both], F.lit(True)).count() <= 400


def test_files_that_land_later_and_folders_without_index(spark, landed, tmp_path):
    df, path = landed
    exact = F.exists("locations", lambda l: l["city"] == "city39")
    tokens = [skipping.token(city="city39")]
    before = len(skipping.files_with(spark, path, tokens))
    df.where("id < 80").coalesce(1).write.mode("append").parquet(path)
    assert len(skipping.files_with(spark, path, tokens)) == before + 1
    assert skipping.read_containing(spark, path, tokens, exact).count() == df.where(exact).count() + df.where("id < 80").where(exact).count()
    skipping.index_files(spark, path)
    assert len(skipping.files_with(spark, path, tokens)) == before + 1  # the new file has city39
    assert skipping.read_containing(spark, path, ["city=none"], F.lit(True)).count() <= 400
    df.write.parquet(f"{tmp_path}/plain")
    assert skipping.read_containing(spark, f"{tmp_path}/plain", tokens, exact).count() == df.where(exact).count()


def test_no_locations(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, [])], "id long, locations array<struct<type:string,country_code:string,city:string,region:string,scope:string>>")
    skipping.write_indexed(df, f"{tmp_path}/none")
    assert skipping.read_containing(spark, f"{tmp_path}/none", ["city=x"], F.lit(True)).count() in (0, 1, 2)
    assert [r.t for r in df.select(skipping.tokens_of(F.col("locations")).alias("t")).collect()] == [[], []]
