import random

import brute
import numpy as np
import pytest
from finspark.llm import token_scan as T
from finspark.llm.queries import END_ID, SPLIT, TOKENIZER

SCHEMA = "doc_id bigint, text string"


@pytest.mark.parametrize("block", [7, 64, 1 << 16])
def test_counts_equal_encoding_each_text(spark, block):
    rng = random.Random(1)
    rows = [(i, brute.prose(rng, rng.randrange(0, 40))) for i in range(60)] + [(90, None), (91, ""), (92, "é " * 3000), (None, "x")]
    rows += [(1, rows[1][1])]
    ranks = T.read_ranks(spark, TOKENIZER)
    docs = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", block int").repartition(4)
    blocks, order = T.write_tokens(docs, ranks, SPLIT, END_ID, block=block)
    got = T.count_tokens(blocks, END_ID).join(order, ["stream", "ordinal"]).select("id", "n_tokens").collect()
    made = T.encoding(ranks, SPLIT)
    assert sorted(map(tuple, got), key=str) == sorted(((i, len(made.encode_ordinary(t or ""))) for i, t in rows), key=str)


def test_flat_files_without_index(spark, tmp_path):
    rng, expected = np.random.default_rng(3), []
    for name, n in (("a", 1), ("b", 1000), ("c", 1001), ("d", 0)):
        ids = rng.integers(0, 9, n).astype("<u4")
        ids.tofile(tmp_path / f"{name}.bin")
        lengths = np.diff(np.r_[-1, np.flatnonzero(ids == 4), n]) - 1
        expected += [(name, i, int(x)) for i, x in enumerate(lengths if lengths[-1] else lengths[:-1])]
    blocks = T.read_token_files(spark, str(tmp_path), 4, block=16)
    got = T.count_tokens(blocks, 4, "<u4").collect()
    assert sorted((r.stream[-5], r.ordinal, r.n_tokens) for r in got) == expected


def test_empty_table(spark):
    blocks, order = T.write_tokens(spark.createDataFrame([], SCHEMA), T.read_ranks(spark, TOKENIZER), SPLIT, END_ID)
    assert T.count_tokens(blocks, END_ID).collect() == [] and order.collect() == []
