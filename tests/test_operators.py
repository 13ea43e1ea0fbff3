"""Metrics, merges, joins and samples: metamorphic checks and literal rows."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from tests.conftest import SF

import vacantia.plans
from vacantia.operators import joins, market, merge, metrics, ranking
from vacantia.registry import ORACLES, QUERIES
from vacantia.sources import feeds

vacantia.plans.load()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    want = duck.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    rows = lambda xs: sorted((tuple(plain(v) for v in x) for x in xs), key=repr)
    assert rows(tuple(r[c] for c in want.columns) for r in got.collect()) == rows(want.fetchall())


def test_percent_is_half_even(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (5, 8), (1, 200), (0, 0)], "c int, k int")
    assert [r.p for r in df.select(metrics.percent(F.col("c"), F.col("k")).alias("p")).collect()] == [round(1 / 8 * 100), round(3 / 8 * 100), round(5 / 8 * 100), round(1 / 200 * 100), None]


def test_nearest_rank_is_that_of_a_sorted_list(spark):
    r = random.Random(4)
    values = [(g, r.randrange(50)) for g in "ab" for _ in range(r.randrange(1, 60))]
    got = {x.g: x for x in metrics.nearest_rank(spark.createDataFrame(values, "g string, v int"), "v", ["g"]).collect()}
    for g in "ab":
        own = sorted(v for k, v in values if k == g)
        assert (got[g].p25, got[g].median, got[g].p75) == tuple(own[int(len(own) * p)] for p in (0.25, 0.5, 0.75))


def test_pairs_are_counted_once_per_posting(spark):
    df = spark.createDataFrame([(["b", "a", "a"],), (["a", "b", "c"],), (["c"],), ([],), (None,)], "s array<string>")
    assert {(r.a, r.b): r.n for r in metrics.skill_pairs(df, "s", None).collect()} == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1}


def test_distribution_of_nothing_known(spark):
    assert metrics.distribution(spark.createDataFrame([("unknown",), (None,)], "c string"), "c").count() == 0


RAW = "source string, source_job_id string, id long, title string, scraped_at string, last_seen string"


def test_upsert_twice_is_upsert_once(spark):
    old = spark.createDataFrame([("a", "1", 1, "x", "d1", "d1"), ("a", None, 2, "y", "d1", "d1")], RAW)
    new = spark.createDataFrame([("a", "1", 9, None, "d2", "d2"), ("b", "1", 3, "z", "d2", "d2")], RAW)
    once = merge.upsert_raw(old, new).drop("action")
    twice = merge.upsert_raw(once, new)
    assert sorted(map(tuple, once.collect()), key=str) == sorted((tuple(r)[:-1] for r in twice.collect()), key=str)
    assert {(r.id, r.title, r.scraped_at, r.last_seen) for r in once.collect()} == {(1, None, "d1", "d2"), (2, "y", "d1", "d1"), (3, "z", "d2", "d2")}
    again = spark.createDataFrame([("a", None, 5, "n", "d3", "d3")], RAW)
    assert merge.upsert_raw(once, again).where("action = 'inserted'").count() == 1  # no id: always inserted


def test_enriched_upsert_keeps_values_and_first_date(spark):
    schema = "job_hash string, title string, skills array<string>, posted_date string"
    old = spark.createDataFrame([("h", "t", ["a"], "d1")], schema)
    new = spark.createDataFrame([("h", None, [], "d2")], schema)
    assert tuple(merge.upsert_enriched(old, new).first()) == ("h", "t", [], "d1", "updated")


def test_freshness_guards(spark):
    tracked = spark.createDataFrame([("ok", "1"), ("ok", "2"), ("fail", "1"), ("empty", "1"), ("none2", "1"), ("none2", "2"), ("none1", "1")], "c string, j string").withColumn("status", F.lit("active"))
    listings = spark.createDataFrame([("ok", "1", True), ("fail", "1", False), ("empty", None, True), ("none2", "9", True), ("none1", "9", True)], "c string, j string, ok boolean")
    got = {(r.c, r.j): r.status for r in merge.freshness(tracked, listings, ["c"], "j", "status").collect()}
    assert got == {("ok", "1"): "active", ("ok", "2"): "soft_404", ("fail", "1"): "active", ("empty", "1"): "active", ("none2", "1"): "active", ("none2", "2"): "active", ("none1", "1"): "soft_404"}


def test_samples_keep_their_limits(spark):
    df = spark.range(300).select("id", F.pmod("id", F.lit(7)).cast("string").alias("g"))
    assert {r["count"] for r in ranking.capped_sample(df, "g", "id", 2).groupBy("g").count().collect()} == {2}
    assert ranking.stratified_sample(df, "g", "id", 50, 5).count() == 50
    assert min(r["count"] for r in ranking.stratified_sample(df, "g", "id", 50, 5).groupBy("g").count().collect()) >= 5
    assert [r.g for r in ranking.round_robin(df, ["g"], "id", 7).collect()] == list("0123456")


def test_similar_titles_lose_no_pair(spark):
    r = random.Random(6)
    rows = [("s", f"t{k}", sorted({f"k{r.randrange(12)}" for _ in range(r.randrange(1, 8))})) for k in range(60)]
    got = {(x.title, x.other) for x in market.similar_titles(spark.createDataFrame(rows, "job_subfamily string, title string, skills array<string>"), 0.5).collect()}
    want = {(a, b) for _, a, x in rows for _, b, y in rows if a < b and len(set(x) & set(y)) >= 0.5 * len(set(x) | set(y))}
    assert got == want


def test_dictionary_takes_the_first_pattern(spark):
    df = spark.createDataFrame([("Visit New York now",), ("yorkshire",), ("new yorker",), (None,)], "t string")
    pats = spark.createDataFrame([("new york", 2, "ny"), ("visit", 3, "v")], "pattern string, ord int, value string")
    assert [r.matched for r in joins.match_dictionary(df, "t", pats).orderBy("t").collect()] == [None, "ny", None, None]


def test_feeds(spark, tmp_path):
    import json

    def land(name, row, schema, read=feeds.read_json):
        (tmp_path / f"{name}.json").write_text(json.dumps(row))
        return read(spark, str(tmp_path / f"{name}.json"), schema)

    g = land("g", {"company_slug": "acme", "id": 7, "title": "Data Engineer", "location": {"name": "London"}, "departments": [{"name": "Data"}], "pay_input_ranges": [{"min_cents": 12345, "max_cents": 99999, "currency_type": "GBP"}], "content": "&lt;p&gt;Hi&lt;/p&gt;"}, feeds.GREENHOUSE)
    r = feeds.greenhouse(g).first()
    assert (r.job_id, r.location, r.department, r.salary_min, r.salary_max, r.description) == ("7", "London", "Data", 123.0, 999.0, "Hi")
    lever = land("l", {"company_slug": "x", "id": "a", "text": "T", "descriptionPlain": "Intro", "lists": [{"text": "You", "content": "<li>Code</li>"}], "categories": {"allLocations": ["A", "B"], "location": "A"}, "workplaceType": "remote"}, feeds.LEVER)
    r = feeds.lever(lever).first()
    assert (r.location, r.description, r.is_remote) == ("A / B", "Intro\n\nYou\nCode", True)
    tier = {"components": [{"compensationType": "Bonus", "minValue": 1}, {"compensationType": "Salary", "minValue": 5, "maxValue": 9, "currencyCode": "USD"}]}
    ashby = land("a", {"company_slug": "x", "id": "a", "title": "T", "location": "Paris", "secondaryLocations": [{"location": "Rome"}, {"location": "Paris"}], "compensation": {"compensationTiers": [tier]}, "isRemote": False, "descriptionHtml": "<b>x</b>"}, feeds.ASHBY)
    r = feeds.ashby(ashby).first()
    assert (r.location, r.salary_min, r.salary_max, r.currency, r.description) == ("Paris / Rome", 5.0, 9.0, "USD", "x")
    work = land("w", {"company_slug": "x", "shortcode": "S", "title": "T", "city": "Oslo", "country": "Norway", "telecommuting": True}, feeds.WORKABLE)
    r = feeds.workable(work).first()
    assert (r.location, r.working_arrangement, r.is_remote) == ("Oslo, Norway", "remote", True)
    listed = land("s", {"company_slug": "x", "id": "1", "name": "T", "location": {"city": "Bonn", "remote": True}}, feeds.SMART_LIST)
    detail = land("d", {"company_slug": "x", "id": "1", "jobAd": {"sections": {"jobDescription": {"text": "<p>Do</p>"}, "qualifications": {"text": "Be"}}}}, feeds.SMART_DETAIL)
    r = feeds.smartrecruiters(listed, detail).first()
    assert (r.title, r.location, r.description, r.is_remote) == ("T", "Bonn", "Do\n\nBe", True)
    (tmp_path / "f.xml").write_text("<jobs><job><title>T</title><url>https://x.co/jobs/9a</url><description>Pay $100,000 - $120,000</description><employer>Big Co</employer><locations><location><city>Rome</city><country>IT</country></location></locations></job></jobs>")
    r = feeds.xml_feed(feeds.read_xml(spark, str(tmp_path / "f.xml"))).first()
    assert (r.job_id, r.location, r.salary_min, r.currency, r.company_slug) == ("9a", "Rome, IT", 100000.0, "usd", "big-co")
    both = feeds.union_sources(feeds.greenhouse(g), feeds.lever(lever))
    assert both.columns == feeds.UNIFIED and both.count() == 2
    feeds.export_json(both, f"{tmp_path}/out.json")
    feeds.export_csv(both, f"{tmp_path}/out.csv")
    assert spark.read.csv(f"{tmp_path}/out.csv", header=True).count() == 2


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
