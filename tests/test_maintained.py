"""Maintained counts against counting the last snapshot."""

import random

from vacantia.operators import maintained
from vacantia.storage import written

SCHEMA = "id long, family string, day int"


def test_after_every_snapshot_as_if_counted_anew(spark):
    r = random.Random(9)
    snapshot, shots = {}, []
    for _ in range(5):
        for k in list(snapshot):
            if r.random() < 0.15:
                del snapshot[k]
            elif r.random() < 0.2:
                snapshot[k] = (r.choice(["a", "b", None]), r.choice([*range(5), None]))
        snapshot |= {r.randrange(2000): (r.choice(["a", "b", "c", None]), r.randrange(5)) for _ in range(200)}
        shots.append([(k, *v) for k, v in snapshot.items()])
    shots += [shots[-1], []]
    by, before = ["family", "day"], spark.createDataFrame([], SCHEMA)
    stored = maintained.counted(before, by)
    for rows in shots:
        after = spark.createDataFrame(rows, SCHEMA)
        stored = written(maintained.taken_in(stored, maintained.counted(maintained.signed_changes(before, after, "id", by), by), by))
        want = {}
        for _, family, day in rows:
            want[family, day] = want.get((family, day), 0) + 1
        assert {(x.family, x.day): x.n for x in stored.collect()} == want
        before = after


def test_unchanged_rows_ship_nothing(spark):
    a = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "c", None), (None, "x", 9)], SCHEMA)
    b = spark.createDataFrame([(1, "a", 1), (2, None, 2), (3, "d", None), (4, "e", 4)], SCHEMA)
    got = sorted(map(tuple, maintained.signed_changes(a, b, "id", ["family", "day"]).collect()), key=str)
    assert got == sorted([("c", None, -1), ("d", None, 1), ("e", 4, 1)], key=str)
    assert maintained.signed_changes(a, a, "id", ["family", "day"]).count() == 0
