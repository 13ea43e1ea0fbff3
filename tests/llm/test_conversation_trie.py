"""The prefix trie against dictionaries of whole prefixes."""

import random

import numpy as np
import pytest

from vacantia.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, part int, p long, own string"


def _table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "own") for r in rows], SCHEMA)


def _rows():
    r = random.Random(1)
    rows = []
    for c in range(-7, 60):
        if r.random() > 0.1:
            rows += [(c, t if r.random() < 0.95 else None, r.choice(["user", "assistant", None]), r.choice(["a", "bb", "éé", "", None])) for t in range(r.choice([1, 2, 3, 5, 9, 12]))]
    rows += [(41, t + 20, "user", r.choice("xy")) for t in range(300)]
    # ties, repeated rows, no conversation, a long text, and (role, text) that only a separator tells apart
    return rows + [(None, 1, "u", "x"), (3, 1, "u", "tie"), (3, 1, "u", "tie"), (3, 1, "a", "tie"), (8, 30, "u", "z" * 300_000), (9, 30, "ab", "c"), (14, 30, "a", "bc")]


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("limit, levels, held", [(1 << 16, 1 << 12, 1 << 20), (30, 150, 50), (5, 1000, 4)])
def test_same_as_dictionaries(spark, limit, levels, held):
    rows = _rows()
    got = conversation_trie.prefix_trie(_table(spark, rows), limit=limit, levels=levels, held=held)
    assert _sorted(got.collect()) == _sorted(conversation_trie.brute_force(rows))


def test_empty_table_and_turnless_conversations(spark):
    assert conversation_trie.prefix_trie(_table(spark, [])).count() == 0
    # conversations 1 to 4 of an absent base lose their first turns
    rows = [(c, 0, "u", "t") for c in range(11, 15)]
    assert _sorted(conversation_trie.prefix_trie(_table(spark, rows)).collect()) == _sorted(conversation_trie.brute_force(rows))


def test_one_turn_repeated_over_several_ranges(spark):
    rows = [(5, 1, "u", "same")] * 400 + [(6, 1, "u", "same")] * 40
    assert _sorted(conversation_trie.prefix_trie(_table(spark, rows), limit=50, levels=200).collect()) == _sorted(conversation_trie.brute_force(rows))


def test_queue_spills_and_gives_messages_in_order(tmp_path):
    rng = np.random.default_rng(2)
    sent = np.column_stack([rng.integers(-5, 5, 3000), rng.integers(-5, 5, 3000), rng.integers(0, 9, (3000, 3))])
    queue = conversation_trie.Queue(str(tmp_path), 40)
    for part in np.array_split(sent, 70):
        queue.push(part)
    assert queue.spilled
    queue.next_level()
    for key in sorted({(int(a), int(b)) for a, b in sent[:, :2]}):
        assert queue.upto(*key)[:, 2:].sum(0).tolist() == sent[(sent[:, 0] == key[0]) & (sent[:, 1] == key[1]), 2:].sum(0).tolist()
    assert not len(queue.upto(9, 9)) and not list(tmp_path.iterdir())
