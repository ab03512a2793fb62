import random
import re

import brute
from finspark.llm.license_scan import TEMPLATES, scan_licenses

SCHEMA = "doc_id bigint, text string"


def by_windows(rows, k=5):
    """Every template held by a window of twice its size, tried one by one."""
    split = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = {}
    for i, text in rows:
        own = brute.grams(split(text), k)
        for license_, name, template in TEMPLATES:
            wanted = set(brute.grams(split(template), k))
            m = len(wanted)
            best = max((len(wanted & set(own[at:at + 2 * m])) for at in range(0, len(own), m)), default=0)
            if 100 * best >= 80 * m:
                out[i, license_, name] = (best, m)
    return out


def test_equals_trying_every_template(spark):
    rng, rows = random.Random(2), []
    for i in range(120):
        _, _, template = rng.choice(TEMPLATES)
        held = brute.edited(rng, template, rng.choice((0, 0, 1, 2))) if rng.random() < 0.8 else ""
        rows.append((i, f"{brute.prose(rng, rng.randrange(80))}\n{held.upper() if i % 3 else held}\n{brute.prose(rng, rng.randrange(40))}"))
    got = {(r.id, r.license, r.template): (r.common, r.size) for r in scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == by_windows(rows) and len(got) > 50


def test_edge_rows(spark):
    mit = TEMPLATES[0][2]
    rows = [(1, None, 1), (2, "", 1), (3, "x " * 40_000 + mit, 1), (None, mit, 1), (4, mit, 1), (4, mit, 1), (5, "MIT", 1)]
    got = scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string, size int")).collect()
    assert sorted((r.id, r.license, r.common) for r in got) == [(3, "MIT", 1), (4, "MIT", 1)]
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).collect() == []
