import random
import re
from collections import Counter

import brute
from finspark.llm import perplexity as P

SCHEMA = "doc_id bigint, text string, lang string"


def base_numbers(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(own[i:i + 8]) for i in range(len(own) - 7))
    marked, seen, again = set(), set(), 0
    for i in range(len(own) - 7):
        if windows[tuple(own[i:i + 8])] > 1:
            marked |= set(range(i, i + 8))
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(own) < 20 or 100 * len(marked) > 30 * len(own)
    return len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(marked), failed


def corpus():
    rng = random.Random(6)
    rows = [(i, "\n".join(brute.prose(rng, rng.randrange(5, 40), 60) for _ in range(4)), rng.choice(("en", "de", None)))
            for i in range(90)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "é" * 3 + " ü\n\né" * 30, "xx"), (103, "a\nb\na\n\n \n \na", None),
             (104, "w " * 30_000, "en"), (105, "x | y # z " * 3 + "\r\n" + brute.prose(rng, 30), "en"), (None, "t\x0bu\x1fv", "en")]
    return rows + [(1, rows[1][1], rows[1][2]), (200, "".join(chr(33 + rng.randrange(14)) + " " for _ in range(200)), "en")]


def test_base_numbers_and_verdicts(spark):
    rows = corpus()
    got = P.quality_rules(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", low int")).collect()
    numbers = sorted(((r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str)
    assert numbers == sorted(((i, *base_numbers(t)) for i, t, _ in rows), key=str)
    by = {r.id: r for r in got}
    assert not by[200].kept and by[200].log_perplexity > by[200].high
    assert by[100].log_perplexity is None and not by[100].kept and not any(r.kept and r.base_failed for r in got)
    normal = [r for r in got if not r.base_failed and r.id is not None and r.id < 100]
    assert sum(r.kept for r in normal) >= 0.95 * len(normal)
    assert all(r.kept == (r.low <= r.log_perplexity <= r.high) for r in normal)


def test_empty_table(spark):
    assert P.quality_rules(spark.createDataFrame([], SCHEMA)).collect() == []
