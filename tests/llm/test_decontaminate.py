import random

import brute
from finspark.llm.decontaminate import contaminated

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def run(docs, items):
    return {(r.id, r.item): (r.common, r.total) for r in contaminated(docs, items).collect()}


def test_equals_brute_force_and_index_misses_nothing(spark):
    rng = random.Random(11)
    items = [(i, brute.prose(rng, n, 3000)) for i, n in enumerate((7, 12, 20, 35, 60, 60))]
    items.append((9, "again and again and again and again and again"))
    docs = []
    for i in range(70):
        body = brute.prose(rng, rng.randrange(0, 90), 3000)
        _, passage = rng.choice(items)
        own = passage.split()
        kind = rng.randrange(5)
        held = [passage, brute.edited(rng, passage, 1), " ".join(own[:-1]), " ".join(own[2:] + ["more"]), ""][kind]
        docs.append((i, f"{body} {held} {brute.prose(rng, 10, 3000)}" if rng.random() < 0.8 else held.upper()))
    expected = brute.contaminated(docs, items)
    got = run(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert got == expected and len(got) > 25


def test_edge_rows(spark):
    item = "one two three four five six seven"
    docs = [(1, None, 3), (2, "", 3), (3, item + " x" * 30_000, 3), (None, item, 3), (4, item, 3), (4, item, 3), (5, "a b", 3)]
    items = [(1, item, "c"), (1, item, "c"), (2, None, "c"), (3, "", "c"), (None, item, "c"), (4, "a b", "c")]
    got = run(spark.createDataFrame(docs, DOCS + ", h int"), spark.createDataFrame(items, ITEMS + ", length string"))
    assert got == {(3, 1): (3, 3), (4, 1): (3, 3), (5, 4): (1, 1)}


def test_empty_tables(spark):
    some = spark.createDataFrame([(1, "a b c d e f")], DOCS)
    assert run(spark.createDataFrame([], DOCS), some.toDF("item_id", "text")) == {}
    assert run(some, spark.createDataFrame([], ITEMS)) == {}
