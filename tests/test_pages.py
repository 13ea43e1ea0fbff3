"""Landed pages: numbering, pushed filters, skipped pages, and the stream of later ones."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vacantia.sources import pages

SCHEMA = "id long, name string, at timestamp, pay double, ok boolean"


def _rows(n, start=0):
    return [(None if k % 50 == 7 else start + k, None if k % 9 == 0 else f"n{k % 13}", dt.datetime(2024, 1, 1) + dt.timedelta(hours=k), k * 1.5, k % 2 == 0) for k in range(n)]


@pytest.fixture
def landed(spark, tmp_path):
    pages.register_pages(spark)
    rows = _rows(530)
    path = f"file://{tmp_path}/pages"
    assert pages.land_pages(spark.createDataFrame(rows, SCHEMA).repartition(5), path, "id", 40) == 14
    return path, rows


def test_pages_are_full_and_in_order(spark, landed):
    path, rows = landed
    schema = spark.createDataFrame([], SCHEMA).schema
    read = [list(pages.read_range(path, pages.Range(k, k + 1), schema)) for k in range(14)]
    sizes = [sum(b.num_rows for b in batches) for batches in read]
    assert sizes == [40] * 13 + [10]
    ids = [i for batches in read for b in batches for i in b.column("id").to_pylist() if i is not None]
    assert ids == sorted(r[0] for r in rows if r[0] is not None)
    got = spark.read.format("pages").option("pages", 3).load(path)
    assert got.rdd.getNumPartitions() == 5 and got.schema == schema
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_filters_are_pushed(spark, landed):
    path, rows = landed
    conditions = [
        (F.col("id") > 300, lambda r: r[0] is not None and r[0] > 300),
        (F.col("name") == "n4", lambda r: r[1] == "n4"),
        (F.col("id").isin(3, 77, 400) & F.col("ok"), lambda r: r[0] in (3, 77, 400) and r[4]),
        ((F.col("at") <= dt.datetime(2024, 1, 3)) & (F.col("pay") >= 12.0), lambda r: r[2] <= dt.datetime(2024, 1, 3) and r[3] >= 12.0),
        (F.col("name").isNull() | (F.length("name") > 2), lambda r: r[1] is None or len(r[1]) > 2),
    ]
    for condition, plain in conditions:
        assert sorted(map(tuple, pages.scan_pages(spark, path, condition).collect()), key=str) == sorted(filter(plain, rows), key=str)
    plan = pages.scan_pages(spark, path, "id > 300", "name = 'n4'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan and "isnotnull" not in plan  # nothing is left for Spark


def test_pages_are_skipped_by_their_statistics(spark, landed, monkeypatch):
    path, _ = landed
    reader = pages.PagedReader(spark.createDataFrame([], SCHEMA).schema, {"path": path})
    left = list(reader.pushFilters([pages.GreaterThan(("id",), 480), pages.IsNotNull(("id",))]))
    assert left == []
    sizes = [sum(b.num_rows for b in pages.read_range(path, pages.Range(k, k + 1), reader.schema, reader.condition())) for k in range(14)]
    assert sum(map(bool, sizes)) <= 2 and sum(sizes) == sum(r[0] is not None and r[0] > 480 for r in _rows(530))


def test_stream_of_later_pages(spark, landed, tmp_path):
    path, rows = landed

    def run():
        stream = spark.readStream.format("pages").load(path)
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
        return sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()), key=str)

    assert run() == sorted(rows, key=str)
    later = _rows(95, 10_000)
    assert pages.land_pages(spark.createDataFrame(later, SCHEMA), path, "id", 40) == 17
    assert run() == sorted(rows + later, key=str)


def test_empty_listing(spark, tmp_path):
    pages.register_pages(spark)
    path = f"{tmp_path}/none"
    assert pages.land_pages(spark.createDataFrame([], SCHEMA), path, "id") == 0
    assert spark.read.format("pages").load(path).count() == 0
