import math
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from finspark.llm import char_model as C
from finspark.llm.perplexity import _repeat_lines, _widths, quality_rules
from finspark.llm.scratch import bucketed
from finspark.llm.words import find_words

SCHEMA = "doc_id bigint, text string, lang string"


def by_hand(texts):
    """P(last | others) of modified Kneser-Ney over 5-grams of characters, with dictionaries; 0 order is 1."""
    levels = [Counter(g for t in texts for g in zip(*(("    " + t)[i:] for i in range(5))))]
    for _ in range(4):
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    tables = []
    for own in levels:
        n, d = [sum(c == i for c in own.values()) for i in range(1, 5)], [0.5, 0.75, 0.9]
        if min(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.1), i + 0.95) for i in range(3)]
        total, cut = defaultdict(int), defaultdict(float)
        for g, c in own.items():
            total[g[:-1]] += c
            cut[g[:-1]] += d[min(c, 3) - 1]
        tables.append((own, total, cut, d))

    def probability(g, base):
        below = probability(g[1:], base) if len(g) > 1 else base
        own, total, cut, d = tables[len(g) - 1]
        if not total[g[:-1]]:
            return below
        c = own.get(g, 0)
        return (c - (d[min(c, 3) - 1] if c else 0) + cut[g[:-1]] * below) / total[g[:-1]]
    return probability


def test_probabilities_equal_dictionaries(spark):
    rng = random.Random(4)
    folds = [["".join(rng.choice("abcäßж字😀 ") for _ in range(rng.randrange(1, 300))) for _ in range(8)] for _ in range(2)]
    rows = []
    for fold, texts in enumerate(folds):
        for at in (0, 4):
            grams, counts, _, _ = C.distinct_grams(pa.array(texts[at:at + 4]))
            rows.append((0, fold * 2 + at, "=x", fold, bytearray(C.pack_numbers(grams)), bytearray(C.pack_numbers(counts))))
    blocks = spark.createDataFrame(rows, "part bigint, block bigint, lang string, fold int, grams binary, counts binary")
    got = C.log_probabilities(blocks, 3).collect()
    models, kinds = [by_hand(t) for t in folds], len(set("".join(map("".join, folds))))
    for r in got:
        chars = tuple(r.gram[i:i + 4].rstrip(b"\0").decode() for i in range(0, 20, 4))
        for f, log in enumerate((r.log0, r.log1)):
            assert log == pytest.approx(math.log(models[f](chars, 1 / (kinds + 1))), abs=1e-4)
    assert len(got) == len({g for t in folds for x in t for g in zip(*(("    " + x)[i:] for i in range(5)))})


def test_one_shard_and_many_give_the_same_rows(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, " ".join(brute.prose(rng, 20, 30) for _ in range(3)), rng.choice(("en", "de"))) for i in range(60)]
    table = spark.createDataFrame(rows, SCHEMA)
    once = {r.id: (round(r.log_perplexity, 5), r.kept) for r in quality_rules(table).collect()}
    monkeypatch.setattr(C, "ENTRIES", 500)
    assert {r.id: (round(r.log_perplexity, 5), r.kept) for r in quality_rules(table).collect()} == once


def test_runs_of_a_shard_merge_to_exact_counts(monkeypatch):
    monkeypatch.setattr(C, "ENTRIES", 3)
    texts = ["abcabcab", "bcabca", "", "abcabcab"]
    parts = [C.distinct_grams(pa.array([t])) for t in texts]
    table = pa.table({"fold": pa.array([0, 1, 0, 1], pa.int32()), "grams": [C.pack_numbers(p[0]) for p in parts],
                      "counts": [C.pack_numbers(p[1]) for p in parts]})
    row = C._shard_rows((pa.scalar("=x"), pa.scalar(0)), table).to_pylist()[-1]
    got = {g.tobytes(): (a, b) for g, (a, b, _, _) in zip(C.unpack_numbers(row["grams"], 5), C.unpack_numbers(row["counts"], 4))}
    hand = defaultdict(lambda: [0, 0])
    for fold, t in zip((0, 1, 0, 1), texts):
        for i in range(len(t)):
            hand[np.array([ord(c) for c in ("    " + t)[i:i + 5]], "<u4").tobytes()][fold] += 1
    assert got == {g: tuple(n) for g, n in hand.items()}


def test_texts_are_not_shuffled(spark):
    rows = [(0, i, "=x", 0, bytearray(b""), 1, bytearray(b""), bytearray(b"")) for i in range(3)]
    blocks = bucketed(spark.createDataFrame(rows, "part bigint, block bigint, lang string, fold int, body binary, entries bigint, "
                                                   "grams binary, counts binary"), "part")
    left = blocks.select("part", "block", "body").groupBy("part").cogroup(
        spark.range(3).selectExpr("id as part", "0L as block", "0 as shard", "cast('' as binary) as logs").groupBy("part"))
    plan = left.applyInArrow(lambda a, b: a.select(["part"]), "part bigint")._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("FileScan parquet"):]
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in side


def cyrillic(rng, n):
    return " ".join(rng.choice(["который", "дерево", "молоко", "письмо", "вечером", "дорога", "сегодня", "человек"]) for _ in range(n))


def test_garbled_letters_of_one_class_stand_out(spark):
    rng = random.Random(8)
    texts = [cyrillic(rng, 60) for _ in range(60)]
    garbled = "".join(c if c == " " else rng.choice("абвгдежзиклмнопрстуфхцчшщыьэюя") for c in texts[0])
    rows = [(i, t, "ru") for i, t in enumerate([*texts, garbled])]
    by = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, SCHEMA)).withColumnRenamed("id", "doc_id").collect()}
    assert by[60].log_perplexity > max(by[i].log_perplexity for i in range(60)) + 1 and not by[60].kept


def test_repeated_lines_after_leading_newlines():
    for texts, again in ((["\nabc\nabc", "x", "\n\nabc\n\nabc\n"], [1, 0, 1]), (["", "\nab\nc\nab\nab", "\n", "\nab"], [0, 2, 0, 0])):
        assert _repeat_lines(find_words(pa.array(texts))).tolist() == again


def test_every_language_has_its_own_band_and_wrong_languages_are_rejected(spark):
    rng, rows = random.Random(9), []
    for lang in range(36):
        letters = [chr(0x4E00 + 40 * lang + i) for i in range(8)]
        rows += [(100 * lang + i, " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(40)), f"l{lang}") for i in range(24)]
    rows.append((9999, rows[0][1], "l35"))
    by = {r.id: r for r in quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len({by[100 * lang].low for lang in range(36)}) == 36
    assert by[9999].log_perplexity > by[9999].high and not by[9999].kept and by[0].kept


def test_labels_choose_the_width_of_their_language(spark):
    good = [(i, 10_000, 1 + i % 100 / 1000) for i in range(400)]
    poor = [(1000 + i, 10_000, 1.2) for i in range(60)]
    rows = [(i, lang, n, p, False) for lang, all_ in (("=a", good + poor), ("=b", [(5000 + i, n, p) for i, n, p in good[:30] + poor[:30]]))
            for i, n, p in all_]
    rules = spark.createDataFrame(rows, "id bigint, lang string, n_words bigint, log_perplexity double, base_failed boolean")
    bands = spark.createDataFrame([("=a", 1.025, 1.075), ("=b", 1.025, 1.075)], "lang string, low double, high double")
    labels = spark.createDataFrame([(r[0], int(r[3] < 1.15)) for r in rows], "doc_id bigint, quality int")
    widths = {r.lang: r.width for r in _widths(rules, bands, labels, 4.5).collect()}
    assert 0.5 <= widths["=a"] < 2.5 and widths["=b"] == 4.5
