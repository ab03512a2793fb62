"""The pipeline against plain Python, stage by stage, each on its own input."""

import brute
import corpus_pipeline as P
from conftest import SF_CHECK as SF, SF_SMALL
from finspark.llm.scratch import written
from finspark.llm.toxicity import labelled_rows, learn_lexicon, score_toxicity
from pyspark.sql import functions as F


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in P.STAGES:
        kept.append((name, docs.collect()))
        docs = written(stage(spark, docs, SF), "stage")
        assert name == P.STAGES[-1][0] or docs.columns == columns
    kept.append(("result", docs.collect()))
    rows = {name: {r.doc_id: r for r in some} for name, some in kept}
    start, clean, single, cut, pure, mixed = (rows[k] for k in (*(n for n, _ in P.STAGES), "result"))

    table = spark.read.parquet(f"{SF}/documents.parquet")
    lexicon = learn_lexicon(labelled_rows(table, spark.read.parquet(f"{SF}/labels.parquet")))
    assert set(clean) == {r.doc_id for r in score_toxicity(table, lexicon).collect() if r.predicted == 0}
    assert 0.8 * len(start) < len(clean) < len(start)
    assert set(single) == {i for i, _, c in brute.jaccard_components([(i, r.text) for i, r in clean.items()]) if c == i}
    expected = {i: (n, gone, digest) for i, n, gone, digest in brute.cut_repeats([(i, r.text) for i, r in single.items()], 50)}
    assert set(cut) == {i for i, (n, gone, _) in expected.items() if not gone or gone < n}
    for i, r in cut.items():
        n, gone, _ = expected[i]
        assert len(brute.words(r.text)) == n - gone and (gone or r.text == single[i].text)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(pure) == set(cut) - {i for i, _ in brute.contaminated([(i, r.text) for i, r in cut.items()], items)}
    assert set(mixed) == set(pure) and sum(r.taken for r in mixed.values()) > 0
    assert all(r.size == len(brute.words(r.text)) and r.taken <= 3 * r.size for r in mixed.values())


def test_columns_of_clashing_names_pass_every_filtering_stage(spark):
    names = ("score", "predicted", "n_words", "n_removed", "kept_text", "component", "id", "gone")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in names})
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        rows = out.select("doc_id", *names).collect()
        assert rows and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in names), name
