"""Digests against comparing all ids."""

import random

from pyspark.sql import functions as F

from vacantia.operators import digests, joins

SCHEMA = "source string, company string, id long"


def _sides():
    r = random.Random(6)
    left = [(f"s{r.randrange(3)}", f"c{r.randrange(30)}", r.randrange(10**6)) for _ in range(4000)]
    right = [x for x in left if x[1] not in ("c3", "c4") or r.random() < 0.7]
    right += [("s0", "c5", 10**7 + k) for k in range(9)] + [("s9", "new", 1)] + right[:50]
    left += [("s1", "gone", 5), (None, "c1", 7), ("s1", "c1", None), ("s2", "twice", 8), ("s2", "twice", 8), ("s2", "pair", 1), ("s2", "pair", 1)]
    right += [("s2", "twice", 8), ("s2", "pair", 2), ("s2", "pair", 2)]
    return left, right


def test_the_ids_of_one_side_only(spark):
    left, right = _sides()
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    x, y = ({r for r in rows if None not in r} for rows in (left, right))
    got = {(r.source, r.company, r.id, r.side) for r in digests.differences(a, b, ["source", "company"], "id").collect()}
    assert got == {(*r, "left") for r in x - y} | {(*r, "right") for r in y - x}
    assert digests.differences(a, a, ["source", "company"], "id").count() == 0
    assert digests.differences(a.limit(0), b.limit(0), ["company"], "id").count() == 0
    assert digests.differences(a.limit(0), b, ["source", "company"], "id").count() == len(y)


def test_listed_rows_are_those_of_the_join(spark):
    left, right = _sides()
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = sorted(map(tuple, digests.listed_by_digest(a, b, ["source", "company"], "id").select("source", "company", "id", "is_listed").collect()), key=str)
    want = sorted(map(tuple, joins.listed(a, b, ["source", "company", "id"]).select("source", "company", "id", "is_listed").collect()), key=str)
    assert got == want and len(got) == len(left)


def test_only_groups_that_differ_are_looked_at_again(spark):
    left, right = _sides()
    ids = [digests._ids(spark.createDataFrame(rows, SCHEMA), ["source", "company"], "id") for rows in (left, right)]
    changed = {(r.source, r.company) for r in digests._differing(*ids, ["source", "company"]).collect()}
    groups = {r[:2] for r in left if None not in r}
    assert {c for _, c in changed} >= {"c3", "c4", "gone", "new", "twice", "pair"} and len(changed) < len(groups) / 1.3 + 9
    assert ids[0].groupBy("source", "company").agg(F.count("*")).count() == len(groups)
