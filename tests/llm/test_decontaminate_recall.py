import random

import brute
from finspark.llm.decontaminate import contaminated


def test_pairs_of_80_to_86_percent_equal_brute_force(spark):
    rng, items, docs = random.Random(5), [], []
    for i in range(300):
        words, kept = ((9, 8), (19, 16), (11, 10), (35, 31))[i % 4]
        own = [f"i{i}w{j}" for j in range(words)]
        items.append((i, " ".join(own)))
        docs.append((i, " ".join(own[:kept] if rng.random() < 0.5 else own[words - kept:])))
    items.append((900, " ".join("ab"[j % 2] for j in range(13))))
    docs.append((900, " ".join("ba"[j % 2] for j in range(13))))
    expected = brute.contaminated(docs, items)
    got = contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r.id, r.item): (r.common, r.total) for r in got.collect()} == expected
    assert (900, 900) in expected and len(expected) == 301
