"""The automaton against looking for each pattern by itself."""

import random
import re

import pyarrow as pa
import pytest

from vacantia.operators import automaton

SCHEMA = "pattern string, ord int, value string"


def _normal(t):
    return " " + re.sub(r"[\W_]+", " ", t.lower()).strip() + " "


def _plain(text, patterns):
    if text is None:
        return None
    hits = [(o is not None, o or 0, p, v) for p, o, v in patterns if p is not None and _normal(p).strip() and _normal(p) in _normal(text)]
    return min(hits)[3] if hits else None


def _case(seed, n_patterns, n_texts, vocabulary):
    r = random.Random(seed)
    words = [f"{r.choice('abcdé')}{k % vocabulary}" for k in range(vocabulary)]
    patterns = [(" ".join(r.choice(words) for _ in range(r.choice([1, 1, 2, 3]))), k * 7919 % n_patterns, f"v{k}") for k in range(n_patterns)]
    patterns = list({p: (p, o, v) for p, o, v in patterns}.values())
    texts = ["".join(r.choice(words) + r.choice([" ", ", ", "-", " / ", "\n"]) for _ in range(r.randrange(40))) for _ in range(n_texts)]
    return patterns, texts


@pytest.mark.parametrize("states", [1 << 18, 3000])
def test_five_thousand_patterns(spark, states):
    patterns, texts = _case(1, 5000, 150, 3000)
    patterns += [(None, 0, "none"), ("- !", 0, "empty"), ("D+1!", None, "first of all")]
    texts = [*texts, None, "", "x " * 5000 + patterns[17][0] + " y" * 3000, patterns[5][0].upper(), "d 1"]
    df = spark.createDataFrame([(k, t, "own") for k, t in enumerate(texts)], "id int, text string, value string")
    got = automaton.match_patterns(df, "text", spark.createDataFrame(patterns, SCHEMA), states)
    assert got.columns == ["id", "text", "value", "matched"]
    assert {r.id: r.matched for r in got.collect()} == {k: _plain(t, patterns) for k, t in enumerate(texts)}


def test_lanes_and_overlapping_patterns(monkeypatch):
    monkeypatch.setattr(automaton, "LANE", 7)
    patterns = [b" he ", b" she sells ", b" sells sea ", b" a ", b" aa aa "]
    texts = [" he she sells sea a ", " aa aa aa ", "", " sells sea ", " she sells sea shells by the sea "]
    got = automaton.Automaton(patterns).search(pa.array(texts)).tolist()
    assert got == [min((k for k, p in enumerate(patterns) if p in t.encode()), default=5) for t in texts]


def test_no_patterns_and_no_shuffle(spark):
    df = spark.createDataFrame([("a b",), (None,)], "text string")
    assert [r.matched for r in automaton.match_patterns(df, "text", spark.createDataFrame([], SCHEMA)).collect()] == [None, None]
    found = automaton.match_patterns(df, "text", spark.createDataFrame([("b", 1, "x")], SCHEMA))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and sorted(map(str, (r.matched for r in found.collect()))) == ["None", "x"]
    assert automaton.match_patterns(df.limit(0), "text", spark.createDataFrame([("b", 1, "x")], SCHEMA)).count() == 0
