"""Work whose tasks don't grow with the table: bits of an index, lines and pairs dealt by the table's size."""

from pyspark.sql import functions as F

from vacantia.operators import locations, metrics, skipping
from vacantia.plans import postings as P

SF = "/root/testdata/sf0.001"


def test_the_index_sorts_a_row_for_each_bit_of_a_file(spark, tmp_path):
    here = locations.location("city", F.lit("c"), F.concat(F.lit("city"), (F.col("id") % 3).cast("string")))
    spark.range(5000).withColumn("locations", F.array(here)).coalesce(1).write.parquet(f"{tmp_path}/t")
    bits = skipping.file_bits(spark, f"{tmp_path}/t").collect()
    assert len(bits) == len(set(bits)) == 6  # three cities, a type, a country and both together


def test_lines_are_dealt_by_their_size_and_rows_stay(spark, monkeypatch):
    columns = ["id", "working_arrangement", "skills", "title"]
    assert P.spread(spark, SF) is None
    want = sorted(map(tuple, P.postings(spark, SF).select(*columns).collect()), key=str)
    monkeypatch.setattr(P, "SPREAD_FROM", 0)
    monkeypatch.setattr(P, "PART_BYTES", 10_000)
    parts = P.spread(spark, SF)
    assert parts > 4
    for of_part in (False, True):
        got = P.postings(spark, SF, parts, of_part).select(*columns)
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_pairs_are_dealt_before_they_are_counted(spark):
    df = spark.range(300).select((F.col("id") % 40).alias("g"), F.transform(F.sequence(F.lit(1), F.col("id") % 5 + 1), lambda k: k.cast("string")).alias("skills"))
    one, other = metrics.skill_pairs(df, k=None, by=["g"]), metrics.skill_pairs(df, k=None, by=["g"], parts=23)
    assert other.rdd.getNumPartitions() == 23
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, other.collect()))
