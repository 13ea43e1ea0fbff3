"""The inverted-file index against comparing with every vector."""

import numpy as np
import pytest
from tests.conftest import SF

from vacantia.operators import vector_index as V


def _plain(rows, queries, least, k):
    unit = lambda v: np.array(v, float) / max(np.linalg.norm(v), 1e-30)
    out = []
    for q, v in queries:
        found = sorted((-round(float(unit(v) @ unit(w)), 6), i) for i, w in rows if i != q)
        out += [(q, i, -s, rank + 1) for rank, (s, i) in enumerate([x for x in found if -x[0] >= least][:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 8))
    rows = [(i, (centers[i % 12] + 0.3 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(600)]
    return rows + [(1000 + i, [1.0] * 8) for i in range(300)] + [(2000, [0.0] * 8)]


def _table(spark, rows):
    return spark.createDataFrame([(i, v, (i or 0) % 3) for i, v in rows], "vec_id long, embedding array<float>, label int")


def test_exact_whatever_the_cells_and_blocks(spark, rows, monkeypatch):
    df = _table(spark, rows)
    queries = [r for r in rows if r[0] % 50 == 0]
    want = _plain(rows, queries, 0.5, 5)
    for cells, block, portion in ((1, 4096, 4096), (12, 64, 5), (40, 4096, 4096)):
        monkeypatch.setattr(V, "BLOCK", block)
        monkeypatch.setattr(V, "PORTION", portion)
        got = sorted(map(tuple, V.search(V.build_index(df, cells), df.where("vec_id % 50 = 0"), 0.5, 5).collect()))
        assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])


def test_cells_that_cannot_reach_are_left_out(spark, rows):
    df = _table(spark, rows)
    index = V.build_index(df, 30)
    looks = V._looks(index, df.where("vec_id % 50 = 0"), 0.9, None)
    assert looks.count() < 0.7 * looks.select("query_id").distinct().count() * len(index.centroids)


def test_filter_applies_before_the_best_are_taken(spark, rows):
    df = _table(spark, rows)
    got = V.search(V.build_index(df, 10), df.where("vec_id % 100 = 0"), 0.2, 4, where="label = 1").collect()
    want = _plain([r for r in rows if r[0] % 3 == 1], [r for r in rows if r[0] % 100 == 0], 0.2, 4)
    assert sorted(r[:2] for r in map(tuple, got)) == sorted(w[:2] for w in want)


def test_recall_over_every_hundredth_vector(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet".replace("sf0.001", "sf0.1"))
    queries = vectors.where("vec_id % 100 = 0")
    index = V.build_index(vectors)
    pairs = lambda df: {(r.query_id, r.vec_id) for r in df.collect()}
    exact = pairs(V.search(index, queries, 0.3, 10))
    probes = V.probes_for(index, vectors.where("vec_id % 7 = 3"), 0.3, 10)  # other queries than those that are measured
    assert probes < len(index.centroids)
    assert len(pairs(V.search(index, queries, 0.3, 10, probes)) & exact) >= 0.9 * len(exact)


def test_nulls_and_empty_frames(spark, rows):
    odd = _table(spark, [(None, [1.0] * 8), (5, None), *rows[:20]])
    index = V.build_index(odd)
    assert index.rows.count() == 20 and V.search(index, odd, -1.0, 30).where("vec_id = 5 OR query_id = 5").count() == 2 * 19
    assert V.search(V.build_index(odd.limit(0)), odd, 0.1, 3).count() == 0
    assert V.search(index, odd.limit(0), 0.1, 3).count() == 0
