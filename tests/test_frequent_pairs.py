"""The most frequent pairs by a sketch and a second pass, against counting all pairs."""

import random
from collections import Counter

from vacantia.operators import metrics


def _rows(n, spread):
    r = random.Random(8)
    often = [("k1", "k2"), ("k1", "k3"), ("k2", "k9"), ("k4", "k5")]
    rows = []
    for k in range(n):
        own = {f"s{r.randrange(spread)}" for _ in range(r.randrange(5))}
        for p, pair in enumerate(often):
            if k % (3 + 2 * p) == 0:
                own |= set(pair)
        rows.append((k, [*own, *list(own)[:1]]))
    return [*rows, (-1, None), (-2, []), (-3, ["alone"])]


def _plain(rows, k):
    counts = Counter()
    for _, s in rows:
        own = sorted(set(s or []))
        counts.update((a, b) for i, a in enumerate(own) for b in own[i + 1 :])
    return [(a, b, n) for (a, b), n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]]


def test_same_as_counting_all_pairs(spark):
    for n, spread, k, tracked in ((4000, 3000, 4, 64), (4000, 3000, 30, 64), (300, 6, 10, 16_384), (0, 5, 3, 64)):
        rows = _rows(n, spread)
        df = spark.createDataFrame(rows, "id int, skills array<string>")
        assert [tuple(r) for r in metrics.frequent_pairs(df, k=k, tracked=tracked).collect()] == _plain(rows, k), (n, spread, k)


def test_only_named_pairs_are_shuffled(spark, monkeypatch):
    rows = _rows(4000, 3000)
    df = spark.createDataFrame(rows, "id int, skills array<string>")
    sizes = []
    keep = metrics.written
    monkeypatch.setattr(metrics, "written", lambda counts: sizes.append(counts.count()) or keep(counts))
    got = metrics.frequent_pairs(df, k=4, tracked=512).collect()
    distinct = len({p for _, s in rows for i, a in enumerate(sorted(set(s or []))) for p in [(a, b) for b in sorted(set(s))[i + 1 :]]})
    assert [tuple(r) for r in got] == _plain(rows, 4) and sum(sizes) <= 512 < distinct / 20
