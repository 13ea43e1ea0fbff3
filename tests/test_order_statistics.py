"""Selection over ranges against sorted lists."""

import random
import re

import pytest
from pyspark.sql import functions as F

from vacantia.operators import metrics, order_statistics, ranking

POINTS = (("low", 0.0), ("p25", 0.25), ("median", 0.5), ("p95", 0.95))


def _rows():
    r = random.Random(3)
    groups = ["a", "a", "a", "b", None, "rare"]
    rows = [(g, r.choice([None, r.randrange(40), r.randrange(10_000)])) for g in (r.choice(groups[:5]) for _ in range(3000))]
    return rows + [("rare", 5), ("one", 7), ("none", None), *[("a", 77)] * 2000]


@pytest.mark.parametrize("by", [["g"], []])
def test_values_at_ranks(spark, by):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, v int")
    got = {(r.g if by else None): tuple(r)[len(by) :] for r in metrics.nearest_rank(df, "v", by, least=1, points=POINTS).collect()}
    want = {}
    for g in {g for g, v in rows if v is not None} if by else {None}:
        values = sorted(v for h, v in rows if v is not None and (h == g or not by))
        want[g] = (len(values), *(values[int(len(values) * p)] for _, p in POINTS))
    assert got == want


def test_least_and_empty(spark):
    df = spark.createDataFrame(_rows(), "g string, v int")
    assert {r.g for r in metrics.nearest_rank(df, "v", ["g"], least=3).collect()} == {"a", "b", None}
    assert metrics.nearest_rank(df.limit(0), "v", ["g"]).count() == 0
    assert metrics.nearest_rank(df.where("v IS NULL"), "v").count() == 0


def test_share_of_rows_below(spark):
    rows = [(g, v, k) for k, (g, v) in enumerate(_rows()) if g is not None]
    got = {r.k: r.percent_rank for r in ranking.pay_rank(spark.createDataFrame(rows, "g string, v int, k int"), ["g"], "v").collect()}
    by = {}
    for g, v, _ in rows:
        by.setdefault(g, []).append(v)
    for g, v, k in rows[::7]:
        known = [x for x in by[g] if x is not None]
        want = None if v is None else 0.0 if len(known) == 1 else sum(x < v for x in known) / (len(known) - 1)
        assert got[k] == want


def test_a_group_with_all_rows_is_spread_over_ranges(spark):
    counts = spark.range(400_000).select(F.lit("all").alias("g"), F.xxhash64("id").alias("v"), F.lit(1).cast("long").alias("c"))
    ranged = order_statistics._in_ranges(counts, ["g"], "v", 16)
    sizes = [r["count"] for r in ranged.groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * sum(sizes) / 16
    r = order_statistics.at_ranks(counts, ["g"], "v", ranges=16).first()
    below = counts.agg(*(F.sum((F.col("v") < r[p]).cast("long")).alias(p) for p, _ in order_statistics.QUARTILES)).first()
    assert tuple(below) == tuple(int(400_000 * p) for _, p in order_statistics.QUARTILES)


def test_no_window_over_the_values_of_a_group(spark):
    df = spark.createDataFrame(_rows(), "g string, v int")
    plan = metrics.nearest_rank(df, "v", ["g"])._jdf.queryExecution().optimizedPlan().toString()
    over_values = [line for line in plan.splitlines() if "Window" in line and re.search(r"windowspecdefinition\([^)]*v#", line)]
    assert over_values and all(re.search(r"windowspecdefinition\(g#\d+, _range#", line) for line in over_values)


def test_mode_of_value_counts(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2), ("y", 2), (None, None), (None, None), (None, None)], "a string, b int")
    got = {(r.dimension, r.value): (r.n, r.total, r.n_values, r.is_mode) for r in metrics.value_counts(df, ["a", "b"]).collect()}
    assert got == {("a", "x"): (2, 7, 2, True), ("a", "y"): (2, 7, 2, False), ("a", None): (3, 7, 2, False), ("b", "1"): (2, 7, 2, True), ("b", "2"): (2, 7, 2, False), ("b", None): (3, 7, 2, False)}
