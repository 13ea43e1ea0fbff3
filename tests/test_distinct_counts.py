"""Bitmaps against counting distinct ids, and counters against counting rows."""

import itertools
import random

from pyspark.sql import functions as F

from vacantia.operators import distinct_counts, filters
from vacantia.storage import written


def test_any_set_of_days_is_exact(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.randrange(5), r.choice([None, r.randrange(-70_000, 70_000), r.randrange(50), 2**40 + r.randrange(9)])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g string, day int, id long")
    days = [distinct_counts.id_bitmaps(df.where(F.col("day") == k), ["g", "day"], "id") for k in range(5)]
    stored = written(distinct_counts.merged(*days, days[2]))  # a day that comes again
    for some in [(0,), (1, 3), (0, 2, 4), (0, 1, 2, 3, 4)]:
        got = {row.g: row.n for row in distinct_counts.distinct_ids(stored.where(F.col("day").isin(*some)), ["g"]).collect()}
        assert got == {g: len({i for h, d, i in rows if h == g and d in some and i is not None}) for g in ("a", "b", None)}
    pairs = {(a, b): distinct_counts.distinct_ids(stored.where(F.col("day").isin(a, b)), []).first().n for a, b in itertools.combinations(range(3), 2)}
    assert pairs == {(a, b): len({i for _, d, i in rows if d in (a, b) and i is not None}) for a, b in pairs}
    assert distinct_counts.distinct_ids(distinct_counts.id_bitmaps(df.limit(0), ["g"], "id"), ["g"]).count() == 0


def test_counters_are_those_of_the_pass_that_filters(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", None), ("b", 9)], "t string, n int")
    kept, seen = filters.observed_funnel(df, {"letter": F.col("t") == "b", "number": F.col("n") > 2})
    assert sorted(map(tuple, kept.collect()), key=str) == [("a", 1), ("c", None)]
    assert seen.get == {"seen": 5, "kept": 2, "dropped_letter": 2, "dropped_number": 1}
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") >= 1 and "Aggregate" not in plan
    kept, seen = filters.observed_funnel(df.limit(0), {"letter": F.col("t") == "b"})
    assert kept.count() == 0 and seen.get == {"seen": 0, "kept": 0, "dropped_letter": 0}
