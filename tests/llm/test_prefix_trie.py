import random

import brute
import pytest
from finspark.llm.prefix_trie import MessageQueue, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def run(spark, rows, schema=SCHEMA, **options):
    got = prefix_trie(spark.createDataFrame(rows, schema), **options).select(COLUMNS).collect()
    return sorted(map(tuple, got), key=repr)


def conversations(rng, n, longest=6):
    """Conversations that share beginnings; some are copies of others."""
    rows, kept = [], []
    for c in range(n):
        if kept and rng.random() < 0.3:
            turns = rng.choice(kept)
        else:
            turns = [(rng.choice(("user", "assistant")), f"say {rng.randrange(3)} " * rng.randrange(3)) for _ in range(rng.randrange(1, longest))]
            kept.append(turns)
        rows += [(c - 15, t if rng.random() < 0.9 else None, role, text) for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"shard_rows": 1}, {"shard_rows": 9, "bands": 2, "held": 2}, {"shard_rows": 10 ** 6, "held": 3}])
def test_trie_equals_brute_force(spark, options):
    rows = conversations(random.Random(3), 70)
    assert run(spark, rows, **options) == brute.prefix_trie(rows)


def test_one_long_conversation_and_a_hot_beginning(spark):
    """A conversation in the crown over many bands, and copies in the crown that nothing hangs on."""
    rows = [(20, t, "user", f"turn {t}") for t in range(90)]
    rows += [(20 + c, t, "user", f"turn {t}") for c in (1, 2, 3, 5, 8) for t in range(40)]
    rows += [(c, t, "user", "same") for c in range(100, 140) for t in range(5)]
    for options in ({"shard_rows": 7}, {"shard_rows": 30, "bands": 3, "held": 1}, {}):
        assert run(spark, rows, **options) == brute.prefix_trie(rows)


def test_chunks_of_long_conversations(spark, monkeypatch):
    import finspark.llm.prefix_trie as trie
    monkeypatch.setattr(trie, "CHUNK", 4)
    monkeypatch.setattr(trie, "PIECE", 2)
    rows = conversations(random.Random(5), 40, longest=20)
    assert run(spark, rows) == brute.prefix_trie(rows)


def test_edge_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 0, "user", "x")]) == []
    # Conversation 1 has fewer turns than its h (3) and no base: it ends at the root, without turns.
    assert [r[:7] for r in run(spark, [(1, 0, "user", "x")])] == [(1, 0, None, 1, 0, 1, 0)]
    rows = [(4, 0, None, None), (4, 0, "", ""), (4, None, "b", "two  words"), (4, None, "a", "x"), (4, 5, "r", "x" * 100_000),
            (24, 1, "u", "y"), (24, 1, "u", "y"), (24, 1, "u", "y"), (24, 1, "u", "y"), (0, 0, "u", "a"), (-3, 0, "u", "b"), (-3, 1, "u", "b")]
    assert run(spark, rows) == brute.prefix_trie(rows)
    clash = [(*r, 1, "a", 2) for r in rows]
    assert run(spark, clash, SCHEMA + ", depth int, x string, place bigint") == brute.prefix_trie(rows)


def test_queue_spills_and_returns_everything_in_order():
    rng = random.Random(1)
    for held in (1, 3, 100):
        queue, places, got = MessageQueue(held), [(p,) for p in range(50)], []
        waiting = sorted((rng.randrange(5, 50), i) for i in range(400))
        rng.shuffle(waiting)
        late = []
        for p in places:
            for m in [m for m in waiting if m[0] - 5 == p[0]] + late:
                queue.push(m)
            late = []
            got += sorted(queue.take(p))
        assert got == sorted(waiting)
