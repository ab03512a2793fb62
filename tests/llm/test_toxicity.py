import random

import brute
from finspark.llm import toxicity as T

LABELLED = "id bigint, text string, toxic int"


def sample(n=600):
    rng, rows = random.Random(8), []
    for i in range(n):
        text, toxic = brute.prose(rng, rng.randrange(5, 120)), int(i % 6 == 0)
        if toxic:
            text += " " + rng.choice(("you Moron!", "m0r0n", "ѕtupid stuff", "pathetic", "stupidities")) + " " + brute.prose(rng, 3)
        elif i % 25 == 1:
            text += " moron clan"
        rows.append((i, text, toxic))
    return rows


def test_folding():
    assert T.fold("M0R0N") == T.fold("moron") == T.fold("МОRОN") == T.fold("mo​ron")
    assert T.fold("ＩＤＩＯＴ, 1d10t!") == f"{T.fold('idiot').rstrip()}{T.fold('idiot')}"
    assert T.fold("ịdịot") == T.fold("𝐢diot") == T.fold("ⓘⓓⓘⓞⓣ") == T.fold("𝐈DIOT") == T.fold("i\u0323\u0331diot") == T.fold("idiot")
    assert T.fold("naïve") == T.fold("naive") and T.fold(None) == T.fold(" .,") == " "


def test_learns_words_stems_and_exceptions(spark):
    lexicon = T.learn_lexicon(spark.createDataFrame(sample(), LABELLED), min_odds=2.0)
    found = {e.strip() for e in lexicon.weights}
    assert any(T.fold("pathetic").strip().startswith(e) for e in found)
    assert T.fold("moron clan") in lexicon.exceptions
    docs = spark.createDataFrame([(1, "a p4thet1c idea"), (2, "w1 w2 w3"), (3, None), (4, ""), (5, "the moron clan")],
                                 "doc_id bigint, text string")
    got = {r.doc_id: r for r in T.score_toxicity(docs, lexicon).collect()}
    assert got[1].predicted == 1 and [got[i].predicted for i in (2, 3, 4, 5)] == [0] * 4
    assert all(0 <= r.score <= 1 for r in got.values()) and got[3].score == got[4].score == got[5].score


def test_given_exceptions_cover_matches():
    lexicon = T.Lexicon({" tras": 3.0}, frozenset({T.fold("trash can")}), 1.0, 0.0)
    made = lexicon.automaton()
    assert lexicon.value(made, T.fold("the trash can")) == 0
    assert lexicon.value(made, T.fold("the trash man")) > 0
    short, long = lexicon.value(made, T.fold("trash")), lexicon.value(made, T.fold("trash" + " w" * 500))
    assert short > long > 0


def test_held_out_rows_and_columns_are_never_learnt_from(spark):
    import zlib
    rows = [(i, t, "en", "s", y) for i, t, y in sample(300)]
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([(r[0], 1, r[4]) for r in rows] + [(None, 1, 1), (5, 1, None)], "doc_id bigint, quality int, toxic int")
    used = T.labelled_rows(docs, labels).collect()
    assert {r.id for r in used} == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5}
    assert len(T.labelled_rows(docs, labels, max_rows=50).collect()) == 50


def test_degenerate_samples_and_clashing_names(spark):
    none = T.learn_lexicon(spark.createDataFrame([], LABELLED))
    one = T.learn_lexicon(spark.createDataFrame([(1, "a b", 0)], LABELLED))
    docs = spark.createDataFrame([(1, "x " * 50_000, "s", 2), (1, "x", "s", 2)], "doc_id bigint, text string, score string, value int")
    for lexicon in (none, one):
        rows = T.score_toxicity(docs, lexicon).collect()
        assert len(rows) == 2 and all(r.predicted == 0 and r.value == 2 for r in rows)
    assert T.score_toxicity(docs.limit(0), none).collect() == []
    assert T.score_toxicity(docs, none, keep_text=True).columns == ["doc_id", "text", "value", "score", "predicted"]


def test_entries_and_values_equal_plain_python(spark):
    import math
    rows = sample()
    lexicon = T.learn_lexicon(spark.createDataFrame(rows, LABELLED), min_odds=2.0, stems=(4,))
    texts = {t: y for _, t, y in reversed(rows)}  # one of each text
    n, bad, seen = len(texts), sum(texts.values()), {}
    for text, toxic in texts.items():
        words = set(T.fold(text).split())
        for entry in {f" {w} " for w in words if len(w) > 2} | {f" {w[:4]}" for w in words if len(w) > 4}:
            a, b = seen.get(entry, (0, 0))
            seen[entry] = a + 1, b + toxic
    odds = {}
    for entry, (a, b) in seen.items():
        o = math.log((b + 0.5) / (bad + 1)) - math.log((a - b + 0.5) / (n - bad + 1))
        g = sum(2 * x * math.log(x / e) for x, e in ((b, a * bad / n), (a - b, a * (1 - bad / n))) if x)
        if b >= 3 and o >= 2.0 and g >= 24.0:
            odds[entry] = o
    assert lexicon.weights and set(lexicon.weights) <= set(odds)
    assert all(abs(w - odds[e]) < 1e-9 for e, w in lexicon.weights.items())
    for entry in set(odds) - set(lexicon.weights):  # left out only beside a shorter one of about its weight
        assert any(entry.rstrip().startswith(e.rstrip()) and w >= odds[entry] - 0.7 for e, w in lexicon.weights.items())

    def value(text):
        text, best = T.fold(text), {}
        hidden = [(m, m + len(p) - 1) for p in lexicon.exceptions for m in range(len(text)) if text.startswith(p, m)]
        for entry, weight in lexicon.weights.items():
            for at in range(len(text)):
                if text.startswith(entry, at) and not any(a <= at < b for a, b in hidden):
                    best[at] = max(best.get(at, 0), weight)
        return sum(best.values()) / (text.count(" ") + 19) ** 0.5

    docs = spark.createDataFrame([(i, t) for i, t, _ in rows[:80]] + [(900, None), (901, "the moron clan, M0RON")], "doc_id bigint, text string")
    for r in T.score_toxicity(docs, lexicon, keep_text=True).collect():
        expected = 1 / (1 + math.exp(-(lexicon.slope * value(r.text) + lexicon.base)))
        assert abs(r.score - expected) < 1e-9


def test_a_larger_sample_keeps_rare_toxic_words(spark):
    rows = [(i, f"n{i} w{i % 7} plain", 0) for i in range(3000)]
    rows += [(5000 + i, f"n{i} w{i % 7} common{'xyz'[i % 3]}word", 1) for i in range(600)]
    rows += [(9000 + i, f"n{i} w{i % 7} verfluchtes", 1) for i in range(12)]
    assert any(T.fold("verfluchtes").strip().startswith(e.strip()) for e in T.learn_lexicon(spark.createDataFrame(rows, LABELLED)).weights)
