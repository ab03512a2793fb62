import random

import brute
import numpy as np
import pyarrow as pa
from finspark.llm.simhash_tiles import compare, fingerprints, near_groups, population_counts, simhash_components, simhash_links, tile_directory

SCHEMA = "doc_id bigint, text string"


def as_unsigned(x):
    return x & (1 << 64) - 1


def run(spark, rows, **options):
    got = simhash_components(spark.createDataFrame(rows, SCHEMA), **options).collect()
    return sorted(((r["id"], as_unsigned(r["print"]), r["component"]) for r in got), key=lambda r: (r[0] is None, r))


def near_prints(rng, n):
    """Fingerprints in chains and bunches a few bits apart."""
    out = []
    for _ in range(n):
        p = rng.getrandbits(64)
        for _ in range(rng.choice((1, 1, 2, 9))):
            out.append(p)
            for b in rng.sample(range(64), rng.choice((1, 3, 4, 5, 6))):
                p ^= 1 << b
    return out


def test_fingerprints():
    texts = ["", None, "One", "one two  three", "A b\tc\nd e a b c d", " lead and trail \v", "é ü É x y z" * 9, "w" * 3000 + " x y z u"]
    texts += [brute.prose(random.Random(i), 10 ** i % 900) for i in range(8)]
    got = fingerprints(pa.array(texts), 4, 42).tolist()
    assert got == [brute.simhash(t) for t in texts] and got[0] == got[1] == 0


def test_long_text_is_whole():
    text = brute.prose(random.Random(2), 150_000)
    assert fingerprints(pa.array(["x", text, "y"]), 4, 42)[1] == brute.simhash(text)


def test_tiles_skip_no_link():
    rng = random.Random(4)
    prints = np.unique(np.array(near_prints(rng, 900), np.uint64))
    parts = population_counts(prints).astype(np.int64)
    cells, at, n = np.unique(parts, axis=0, return_inverse=True, return_counts=True)
    group, boxes = tile_directory(cells, n, 60)
    assert np.bincount(group, weights=n).max() <= max(60, n.max()) and len(boxes) > 20
    near = {(i, j) for i, _, j, _ in near_groups(boxes, 4)}
    assert len(near) < len(boxes) * (len(boxes) + 1) / 2
    for a in range(len(prints)):
        for b in np.flatnonzero(np.bitwise_count(prints ^ prints[a]) <= 4):
            assert tuple(sorted((group[at[a]], group[at[b]]))) in near


def test_compare_returns_a_forest_of_all_links():
    rng = random.Random(5)
    prints = np.unique(np.array(near_prints(rng, 200), np.uint64))
    rng.shuffle(order := list(range(len(prints))))
    left, right = prints[order[:300]], prints[order[300:]]
    for xs, ys in ((prints, None), (left, right)):
        a, b = compare(xs, ys, 4)
        both = xs if ys is None else np.concatenate([xs, ys])
        assert len(a) < len(both)
        side = np.zeros(len(both)) if ys is None else np.r_[np.zeros(len(xs)), np.ones(len(ys))]
        place = {int(p): i for i, p in enumerate(both)}
        # Plain components of the links (between the sides, if there are two).
        root = list(range(len(both)))
        find = lambda x: x if root[x] == x else find(root[x])
        for i, p in enumerate(both.tolist()):
            for j, q in enumerate(both.tolist()):
                if i < j and (ys is None or side[i] != side[j]) and (p ^ q).bit_count() <= 4:
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
        plain = [find(i) for i in range(len(both))]
        root = list(range(len(both)))
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = sorted((find(place[x]), find(place[y])))
            root[y] = x
        assert [find(i) for i in range(len(both))] == plain


def test_links_connect_what_brute_force_connects(spark):
    prints = sorted(set(near_prints(random.Random(6), 150)))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash_links(spark.createDataFrame(signed, "print bigint"), 4, tile=40).collect()
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(as_unsigned(a)), find(as_unsigned(b))))
        root[y] = x
    assert sorted((p, find(p)) for p in prints) == brute.print_components([(p, p) for p in prints])


def test_components_of_texts(spark):
    rng = random.Random(8)
    bases = [brute.prose(rng, n) for n in (30, 200, 900)]
    rows = [(i, brute.edited(rng, rng.choice(bases), rng.choice((0, 0, 1, 2, 3)))) for i in range(60)]
    rows += [(70, ""), (71, None), (72, " \n"), (73, "one two"), (74, "ONE  two"), (75, bases[1].upper().replace("W", "w"))]
    rng.shuffle(rows)
    prints = [(i, brute.simhash(t)) for i, t in rows]
    expected = [(i, dict(prints)[i], c) for i, c in brute.print_components(prints)]
    got = run(spark, rows)
    assert got == expected and len({c for _, _, c in got}) < 40 and (71, 0, 70) in got


def test_edge_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, "a b c d e"), (None, "")]) == [(None, 0, None), (None, brute.simhash("a b c d e"), None)]
    text = "a b c d e f"
    assert run(spark, [(5, text), (5, text), (3, text), (None, text)]) == [
        (3, brute.simhash(text), 3), (5, brute.simhash(text), 3), (5, brute.simhash(text), 3), (None, brute.simhash(text), None)]
    clash = spark.createDataFrame([(1, "a b", 9, 8, "x")], SCHEMA + ", id int, print int, component string")
    assert [tuple(r) for r in simhash_components(clash).select("id", "component").collect()] == [(1, 1)]
