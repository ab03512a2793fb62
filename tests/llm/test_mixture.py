import pytest

from finspark.llm.mixture import mix_sources, training_order

SCHEMA = "doc_id bigint, text string, source string"


def targets(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, full, rest = dict.fromkeys(order, 0.0), set(), float(sum(sizes.values()))
    while rest > 1e-9:
        free = [s for s in order if s not in full]
        total = sum(w[s] for s in free)
        for s in free:
            out[s] += rest * w[s] / total
        rest = 0.0
        for s in free:
            if out[s] >= most * sizes[s]:
                rest += out[s] - most * sizes[s]
                out[s] = most * sizes[s]
                full.add(s)
    return out


def test_targets_takings_and_positions(spark):
    rows = [(i, "w " * (1 + i % 7), f"s{i % 5}") for i in range(400)] + [(1000 + i, "w " * 40, "s9") for i in range(30)]
    rows += [(2000 + i, "w w", None) for i in range(3)] + [(3000, "w", "a tiny one")]
    got = mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    sizes = {}
    for r in got:
        assert r.size == len(r.text.split())
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    expected = targets(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert own[0].target == pytest.approx(expected[s]) and own[0].source_size == sizes[s]
        assert abs(sum(r.taken for r in own) - expected[s]) <= max(r.size for r in own)
    assert all(r.taken == r.size * len(r.positions) and len(r.positions) <= 3 for r in got)
    assert all(0 <= p <= 1 for r in got for p in r.positions) and all(r.positions == sorted(r.positions) for r in got)
    again = mix_sources(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)).collect()
    assert sorted(got, key=lambda r: r.doc_id) == sorted(again, key=lambda r: r.doc_id)


def test_schedule_and_sorted_order(spark):
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(2000)]
    mixed = mix_sources(spark.createDataFrame(rows, SCHEMA), weights=(1, 1), schedules=((1.5, 0.5), (0.5, 1.5)))
    order = training_order(mixed).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    early = [r for r in order if r.position < 0.25]
    share = sum(r.source == "a" for r in early) / len(early)
    assert share == pytest.approx(1.375 / 2, abs=0.02)  # the mean of 1.5 to 1.25 against that of 0.5 to 0.75


def test_edge_rows(spark):
    rows = [(None, None, None, 1), (1, "", "a", 1), (1, "", "a", 1), (2, " \n", "b", 1), (3, "w " * 50_000, "c", 1)]
    got = mix_sources(spark.createDataFrame(rows, "doc_id bigint, text string, source string, target int")).collect()
    assert len(got) == 5 and sum(r.taken for r in got) == 50_000 and got[0].__fields__.count("target") == 1
    assert mix_sources(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_and_null_ids_give_the_same_rows_under_any_partitioning(spark):
    rows = [((None, 7)[i % 2], "w " * (1 + i * 13 % 9) + f"x{i % 50}", "ab"[i % 3 // 2]) for i in range(1200)]
    rows += [(100 + i, "w " * (i % 5), "a") for i in range(100)]
    results = []
    for order, parts in ((rows, 1), (rows[::-1], 5), (rows[600:] + rows[:600], 16)):
        got = mix_sources(spark.createDataFrame(order, SCHEMA).repartition(parts)).collect()
        results.append(sorted(map(tuple, got), key=repr))
    assert results[0] == results[1] == results[2]
    assert len({r[6] for r in results[0]}) > 2  # some are taken more often than others
