"""The mix against targets, rates and bounds worked out plainly."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F
from tests.llm.fixtures import awkward

from vacantia.llm import source_mix

SCHEMA = "doc_id long, text string, source string, size int, c string, target double, h int, base int, k int"


def _table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2.0, 3, 4, 5) for r in rows], SCHEMA)


def _rows():
    r = random.Random(4)
    rows = [(k, " ".join(["w"] * r.choice([1, 2, 3, 7, 10, 40, 41, 200])), r.choice(["a", "a", "a", "b", "é", "Z", None])) for k in range(600)]
    rows += [(1000 + i, t, "odd") for i, t in awkward()]
    rows += [(5000, "the same row", "copies")] * 700 + [(None, "no id", "b"), (None, "no id", "b"), (None, "other", "b"), (7, "same id", "Z"), (None, None, None)]
    return rows + [(6000, None, "wordless"), (6001, " \n", "wordless")]


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_sizes_targets_and_bounds(spark, monkeypatch):
    monkeypatch.setattr(source_mix, "TOGETHER", 16)  # several buckets in large cells
    rows = _rows() + [(9000 + k, "one two three", "copies") for k in range(500)]
    words = Counter()
    for _, text, source in rows:
        words[source] += _size(text)
    aims = source_mix.brute_targets(dict(words))
    assert aims["wordless"] == 0 and any(aims[s] == 3 * words[s] for s in words if words[s])
    df = _table(spark, rows)
    found = source_mix.allot(df).withColumn("name", F.when(F.col("source") == "t", None).otherwise(F.expr("substring(source, 2)"))).collect()
    assert Counter((r.doc_id, r.name, r.size) for r in found for _ in range(r.c)) == Counter((i, s, _size(t)) for i, t, s in rows)
    taken = Counter()
    for r in found:
        assert r.source_size == words[r.name] and abs(r.target - aims[r.name]) < 1e-6 * max(1, r.target)
        assert 0 <= r.extra <= r.c and r.base * r.c + r.extra <= 3 * r.c
        taken[r.name] += (r.base * r.c + r.extra) * r.size
    for s in words:
        assert abs(taken[s] - aims[s]) <= (800 if s == "odd" else 2), (s, taken[s], aims[s])  # odd has one document of 6000 words
    cell = [r for r in found if r.name == "copies" and r.doc_id >= 9000]
    assert len({r.base for r in cell}) == 1 and {r.extra for r in cell} <= {0, 1}
    # the rows of the report from other partitions: the same copies
    again = source_mix.mix_report(df.repartition(7))
    assert not re.search("Python|Arrow|Pandas", again._jdf.queryExecution().toString())
    report = sorted((r[0] or -1, r[1], r[4]) for r in again.collect())
    copies = [(r.base + (k < r.extra)) * r.size for r in found for k in range(r.c)]
    assert report == sorted(zip([r.doc_id or -1 for r in found for _ in range(r.c)], [r.size for r in found for _ in range(r.c)], copies))


def test_texts_of_the_mix(spark):
    rows = _rows()[:40] + [(50, "the same row", "copies")] * 30 + [(None, "no id", None), (51, None, "b")]
    df = _table(spark, rows)
    mixed = source_mix.mixed(df)
    assert mixed.columns == df.columns
    got = Counter((r.doc_id, r.text, r.source) for r in mixed.collect())
    taken = Counter()
    for r in source_mix.allot(df).collect():
        taken[r.doc_id] += r.base * r.c + r.extra
    assert {i: n for i, n in taken.items() if n} == {i: sum(n for (j, _, _), n in got.items() if j == i) for i in {k[0] for k in got}}


def test_rates_are_tilted_exponentially(spark):
    rng = np.random.default_rng(1)
    sizes = {s: np.unique(rng.integers(1, 3000, 200)) for s in ("a", "b", "c", "d")}
    count = {s: rng.integers(1, 50, len(v)) for s, v in sizes.items()}
    total = {s: int((sizes[s] * count[s]).sum()) for s in sizes}
    aim = {"a": 0.2, "b": 1.0, "c": 2.9, "d": 3.0}
    cells = spark.createDataFrame([(s, int(n), int(m)) for s in sizes for n, m in zip(sizes[s], count[s])], "source string, size long, m long")
    aims = spark.createDataFrame([(s, total[s], aim[s] * total[s]) for s in sizes], "source string, words long, target double")
    found = {}
    for r in source_mix.rates(cells, aims).collect():
        found[r.source, r.size] = r.rate
    for s, v in sizes.items():
        low, high = -1.0, 1.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if (count[s] * v * np.minimum(3, np.exp(np.minimum(mid * v, 50)))).sum() < aim[s] * total[s] else (low, mid)
        expected = np.minimum(3, np.exp(np.minimum(high * v, 50))) if aim[s] < 3 else np.full(len(v), 3.0)
        assert np.allclose([found[s, int(n)] for n in v], expected, atol=1e-4), s


def test_copies_keep_to_the_target(spark):
    rng = np.random.default_rng(2)
    rows = [(f"s{k % 9}", int(n), int(rng.integers(1, 4)), float(rng.uniform(0, 3))) for k, n in enumerate(rng.integers(1, 20_000, 900))]
    rows = list({(s, n): (s, n, m, r) for s, n, m, r in rows}.values())
    aim = Counter()
    for s, n, m, r in rows:
        aim[s] += n * m * r
    df = spark.createDataFrame([(s, n, m, aim[s], r) for s, n, m, r in rows], "source string, size long, m long, target double, rate double")
    got = Counter()
    for r in source_mix.copies(df).collect():
        assert 0 <= r.k <= 3 * r.m
        got[r.source] += r.k * r.size
    smallest = {s: min(n for t, n, _, _ in rows if t == s) for s in aim}
    assert all(abs(got[s] - aim[s]) <= smallest[s] + 8 for s in aim), (got, aim)


def test_empty_and_wordless_tables(spark):
    assert source_mix.mix_report(_table(spark, [])).count() == 0
    assert [tuple(r) for r in source_mix.mix_report(_table(spark, [(1, None, None)])).collect()] == [(1, 0, 0, 0.0, 0)]
