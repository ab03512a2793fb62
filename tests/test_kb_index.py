"""The persisted knowledge-base index: exact sums, its layout, and when it is written anew."""

import math
import re
import uuid
from collections import Counter

import pytest
from finspark.operators.kb_index import KnowledgeBase, documents_state, knowledge_base
from finspark.session import ensure_checkpoint_dir

WORDS = ["revenue", "churn", "refund", "cohort", "plan", "ledger", "invoice", "retry"]


def corpus_rows(n=40):
    line = lambda i, j: " ".join(WORDS[(i * 7 + j * k) % 8] for k in range(1, 12))
    return [(i, f"s/doc-{i}.md", "\n".join(line(i, j) for j in range(12))) for i in range(n)]


def write_corpus(spark, rows):
    path = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, "doc_id bigint, source_file string, text string").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def built(spark):
    path = write_corpus(spark, corpus_rows())
    return path, knowledge_base(spark, spark.read.parquet(path), path)


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, query_text string")


def test_search_equals_sums_over_all_chunks(spark, built):
    kb = built[1]
    asked = ["churn of a plan", "refund refund ledger", "no such thing", ""]
    got = kb.search(kb.embed(queries(spark, *asked)), 10, True).orderBy("query_id", "search_rank").collect()
    chunks = [((r["doc_id"], r["chunk_index"]), Counter(re.findall("[a-z0-9]+", r["text"].lower()))) for r in kb.chunks.collect()]
    df = Counter(t for _, c in chunks for t in c)
    idf = {t: math.log((1 + len(chunks)) / (1 + n)) + 1 for t, n in df.items()}

    def unit(counts):
        w = {t: n * idf[t] for t, n in counts.items() if t in idf}
        norm = math.sqrt(sum(x * x for x in w.values()))
        return {t: round(x / norm * 2 ** 30) for t, x in w.items()}

    vectors = [(key, unit(c)) for key, c in chunks]
    for q, text in enumerate(asked):
        own = unit(Counter(re.findall("[a-z0-9]+", text)))
        scored = [(-sum(v.get(t, 0) * x for t, x in own.items()), *key) for key, v in vectors if set(v) & set(own)]
        best = sorted(scored)[:10]
        mine = [r for r in got if r["query_id"] == q]
        assert [(r["doc_id"], r["chunk_index"]) for r in mine] == [b[1:] for b in best]
        assert all(abs(r["units"] + b[0]) <= 64 * 2 ** 30 for r, b in zip(mine, best))  # a unit or so per weight


def test_scores_are_summed_where_the_postings_lie(spark, built):
    kb = built[1]
    plan = kb.search(kb.embed(queries(spark, "churn plan")), 5, True)._jdf.queryExecution().executedPlan().toString()
    scored = plan[plan.index("Window"):plan.index("kb_postings")]
    assert "Exchange hashpartitioning(shard" not in plan and scored.count("Exchange hashpartitioning") == 1  # the top k
    assert re.search(r"PushedFilters: \[.*In\(term", plan) or "EqualTo(term" in plan or "term IN" in plan.replace("#", " ")


def test_many_terms_are_joined_instead_of_listed(spark, built, monkeypatch):
    import finspark.operators.kb_index as index
    kb = built[1]
    terms = kb.embed(queries(spark, "churn plan ledger"))
    few = kb.search(terms, 7, True).orderBy("search_rank").collect()
    monkeypatch.setattr(index, "LISTED_TERMS", 1)
    assert kb.search(terms, 7, True).orderBy("search_rank").collect() == few
    assert kb.search(terms, 7, False).orderBy("search_rank").collect() == few


def test_another_session_reads_the_same_files(spark, built):
    kb = built[1]
    other = KnowledgeBase(spark.newSession(), kb.folder, kb.shards)
    spark.sql(f"DROP TABLE IF EXISTS {next(t.name for t in spark.catalog.listTables() if t.name.startswith('kb_postings'))}")
    assert other.postings.count() > 0
    asked = queries(spark, "cohort refund")
    assert other.search(other.embed(asked), 3, True).count() == 3


def test_changed_documents_have_an_index_of_their_own(spark, monkeypatch):
    import finspark.operators.kb_index as index
    builds = []
    whole = index.build_index
    monkeypatch.setattr(index, "build_index", lambda *a: (builds.append(a[1]), whole(*a)))
    path = write_corpus(spark, corpus_rows(12))
    ask = lambda: knowledge_base(spark, spark.read.parquet(path), path)
    before, state = ask(), documents_state(spark, path)
    assert ask().folder == before.folder and len(builds) == 1
    spark.createDataFrame([(99, "s/new.md", "a new chunk on xylophones " * 20)], "doc_id bigint, source_file string, text string"
                          ).write.mode("append").parquet(path)
    assert documents_state(spark, path) != state
    after = ask()
    assert after.folder != before.folder and len(builds) == 2
    hit = after.search(after.embed(queries(spark, "xylophones")), 5, True).collect()
    assert [r["doc_id"] for r in hit] == [99]
    assert before.search(before.embed(queries(spark, "xylophones")), 5, True).count() == 0


def test_an_unfinished_index_is_written_anew(spark):
    path = write_corpus(spark, corpus_rows(8))
    corpus = spark.read.parquet(path)
    kb = knowledge_base(spark, corpus, path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    mark = jvm.org.apache.hadoop.fs.Path(f"{kb.folder}/postings/_SUCCESS")
    assert mark.getFileSystem(conf).delete(mark, False)
    again = knowledge_base(spark, corpus, path)
    assert mark.getFileSystem(conf).exists(mark) and again.chunks.count() == kb.chunks.count()


def test_empty_documents_and_ids_of_any_size(spark):
    path = write_corpus(spark, [])
    kb = knowledge_base(spark, spark.read.parquet(path), path)
    assert kb.search(kb.embed(queries(spark, "churn")), 5, True).count() == 0
    big = (1 << 62) + 1
    path = write_corpus(spark, [(big, "a.md", "churn " * 40), (big + 1, "b.md", "churn " * 40), (-5, "c.md", None)])
    kb = knowledge_base(spark, spark.read.parquet(path), path)
    assert [r["doc_id"] for r in kb.search(kb.embed(queries(spark, "churn")), 5, True).orderBy("search_rank").collect()] == [big, big + 1]


def test_dense_topk_has_no_limit_on_queries(spark):
    import numpy as np
    from finspark.operators.retrieval import dense_topk
    rng = np.random.default_rng(3)
    vectors, asked = rng.normal(size=(90, 4)), rng.normal(size=(20_000, 4))
    vdf = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)] + [(500, None), (None, [1.0] * 4), (501, [1.0, None, 1.0, 1.0])],
                                "vec_id bigint, embedding array<double>")
    qdf = spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(asked)], "query_id bigint, qvec array<double>")
    got = {r["query_id"]: r["vec_id"] for r in dense_topk(vdf, qdf, 1).collect()}
    assert got == dict(enumerate((asked @ vectors.T).argmax(axis=1).tolist()))
    assert dense_topk(vdf, qdf.limit(0), 1).count() == 0


def test_terms_are_counted_and_joined_within_their_shard(spark, built):
    from finspark.operators.kb_index import SHARD_KEY, chunk_counts, vector_rows
    kb = built[1]
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(chunk_counts(kb.chunks)) == 0
    assert shuffles(kb.weights().join(kb.chunks.select(*SHARD_KEY, "chunk_id").hint("shuffle_hash"), SHARD_KEY)) == 0
    assert shuffles(kb.chunks.join(vector_rows(kb), SHARD_KEY)) == 0


def test_an_index_shuffles_no_row_per_chunk_and_term(spark, tmp_path, monkeypatch):
    """Documents and the shards' terms are shuffled, postings are not."""
    import finspark.operators.kb_index as index
    plans = []
    write = index._write_shards
    monkeypatch.setattr(index, "_write_shards", lambda df, *a: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *a)))
    path = write_corpus(spark, corpus_rows(10))
    knowledge_base(spark, spark.read.parquet(path), path)
    chunks, own, norms, postings = plans
    assert chunks.count("Exchange hashpartitioning(shard") == chunks.count("Exchange") == 1
    # Only the dictionary comes through exchanges; joins and sums by chunk stay in the shard.
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", own + norms + postings)]
    assert "shard" in keys and set(keys) <= {"shard", "term"}


def test_documents_of_one_id_and_null_ids_as_before(spark):
    from finspark.operators.kb_index import chunk_counts
    path = write_corpus(spark, [(1, "a.md", "churn plan " * 20), (1, "a.md", "churn ledger " * 20), (None, "n.md", "churn plan " * 20)])
    kb = knowledge_base(spark, spark.read.parquet(path), path)
    counted = {(r["doc_id"], r["term"]): r["tf"] for r in chunk_counts(kb.chunks).collect()}
    assert counted == {(1, "churn"): 40, (1, "plan"): 20, (1, "ledger"): 20, (None, "churn"): 20, (None, "plan"): 20}
    assert {r["doc_id"] for r in kb.search(kb.embed(queries(spark, "churn")), 5, True).collect()} == {1, None}


def test_each_bucket_holds_one_shard(spark):
    """Numbers 0, 1, ... left a third of the buckets empty and put several shards into one task, which spilled."""
    import pyspark.sql.functions as F
    from finspark.operators.kb_index import build_index, shard_labels
    for n in (1, 7, 150):
        buckets = spark.createDataFrame([(x,) for x in shard_labels(spark, n)], "x int").select(F.pmod(F.hash("x"), F.lit(n)))
        assert [r[0] for r in buckets.collect()] == list(range(n))
    folder = f"{ensure_checkpoint_dir(spark)}/kb-{uuid.uuid4().hex}"
    build_index(spark.createDataFrame(corpus_rows(200), "doc_id bigint, source_file string, text string"), folder, 12)
    for name in ("chunks", "postings", "own", "norms"):
        files = spark.read.parquet(f"{folder}/{name}").groupBy(F.input_file_name()).agg(F.countDistinct("shard")).collect()
        assert [r[1] for r in files] == [1] * 12


def test_no_row_of_chunk_and_term_before_the_postings(spark, monkeypatch):
    """A shard is inverted as a whole: nothing is exploded, summed or sorted by (chunk, term) for the postings."""
    import finspark.operators.kb_index as index
    plans, write = {}, index._write_shards
    monkeypatch.setattr(index, "_write_shards", lambda df, folder, name, *a: (
        plans.update({name: df._jdf.queryExecution().executedPlan().toString()}), write(df, folder, name, *a)))
    path = write_corpus(spark, corpus_rows(10))
    knowledge_base(spark, spark.read.parquet(path), path)
    assert not re.search("Generate|Aggregate|Exchange|Join|Window", plans["postings"])
    assert plans["own"].count("Exchange hashpartitioning") == 2  # by term, and back


def test_words_are_cut_as_the_pattern_cuts_them():
    import pyarrow as pa
    from finspark.operators.kb_index import _words
    texts = ["", "a", "ab cd", "cd", "--", "x\u00e9y \u4e2d1\n2", "", "3_4", "tail "]
    for part in (pa.array(texts), pa.array(["skipped", *texts, "left out"]).slice(1, len(texts)), pa.array(["", ""]), pa.array([], pa.string())):
        words, of = _words(part)
        assert list(zip(words.to_pylist(), of.tolist())) == [(w, i) for i, t in enumerate(part.to_pylist()) for w in re.findall("[a-z0-9]+", t)]


def test_blocks_of_long_terms_and_rows_of_one_key():
    import pyarrow as pa
    from finspark.operators.kb_index import BLOCK, _inverted
    n = 2 * BLOCK + 5
    rows = [(7, i, 0, "plan plan x") for i in reversed(range(n))] + [(7, 3, 0, "plan"), (7, None, 2, "plan"), (7, None, 2, "y"), (7, 0, 1, "--")]
    schema = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("chunk_index", pa.int32()), ("text", pa.string())])
    out = _inverted(pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)).to_pylist()
    assert [len(r["entries"]) for r in out if r["term"] == "plan"] == [BLOCK, BLOCK, 6]
    got = Counter({(r["term"], e["doc_id"], e["chunk_index"]): e["tf"] for r in out for e in r["entries"]})
    want = Counter((w, d, c) for _, d, c, t in rows for w in re.findall("[a-z0-9]+", t))
    assert got == want and {r["shard"] for r in out} == {7}


def test_a_shard_hands_on_its_best_only(spark, monkeypatch):
    """Few queries: no row of (query, chunk) is formed in the plan; the same hits as by joins, in blocks of queries too."""
    import finspark.operators.kb_index as index
    rows = [(i, f"s/{i}.md", (f"{WORDS[i % 8]} {WORDS[i % 3]} plan " * (1 + i % 2) * 6).strip()) for i in range(60)]
    path = write_corpus(spark, [*rows, (None, "n.md", "churn plan " * 20), (5, "s/5.md", "ledger plan " * 20)])
    kb = knowledge_base(spark, spark.read.parquet(path), path)
    asked = spark.createDataFrame([(i, " ".join(WORDS[i % 8:][:1 + i % 3])) for i in range(9)] + [(None, "churn"), (-7, "plan plan refund")],
                                  "query_id bigint, query_text string")
    few = kb.search(kb.embed(asked, True), 6, True)
    assert not re.search(r"Generate explode\(entries", few._jdf.queryExecution().executedPlan().toString())
    want = Counter(map(tuple, kb.search(kb.embed(asked), 6, False).collect()))
    assert len(want) == 11 * 6 and Counter(map(tuple, few.select(*kb.search(kb.embed(asked), 6, False).columns).collect())) == want
    monkeypatch.setattr(index, "QUERY_BLOCK", 2)
    assert Counter(map(tuple, kb.search(kb.embed(asked, True), 6, True).select(*few.columns).collect())) == Counter(map(tuple, few.collect()))


def test_few_query_terms_leave_the_dictionary_where_it_is(spark, built):
    plan = built[1].embed(queries(spark, "churn plan"), True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_postings_meet_names_and_norms_in_one_join(spark):
    """Also for two documents of one id; chunks without doc_id have no name."""
    from finspark.operators.kb_index import SHARD_KEY
    path = write_corpus(spark, [*corpus_rows(12), (1, "b.md", "churn ledger " * 20), (None, "n.md", "churn plan " * 20)])
    kb = knowledge_base(spark, spark.read.parquet(path), path)
    got = kb.named_weights()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and plan[:plan.index("Generate explode")].count("ShuffledHashJoin") == 1
    want = kb.weights().join(kb.chunks.select(*SHARD_KEY, "chunk_id"), SHARD_KEY).select("chunk_id", "term", "weight")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and got.count() > 0


@pytest.mark.parametrize("name", ["kb_search", "kb_gate", "kb_rerank", "kb_dedupe_source", "kb_answer_sources", "kb_grounded_answer"])
def test_queries_on_the_search_form_no_row_of_query_and_chunk(spark, name):
    """What is dealt out is each shard's best, by query."""
    from conftest import SF_SMALL
    from finspark.plans.registry import load_all
    plan = load_all()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "Generate explode(entries" not in plan
    assert "Exchange hashpartitioning(shard" not in plan


def test_a_written_table_leaves_no_shuffle_files(spark, monkeypatch):
    """The documents' shuffle is gone when the postings are written, without a collection of the driver's garbage."""
    import finspark.operators.kb_index as index
    disk, write, left = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), index._write_shards, {}
    shuffled = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", disk.getAllFiles().mkString(" ")))
    monkeypatch.setattr(index, "_write_shards", lambda df, folder, name, *a: (
        before := shuffled(), write(df, folder, name, *a), left.update({name: shuffled() - before})))
    path, setting = write_corpus(spark, corpus_rows(30)), spark.conf.get(index.SHUFFLES_GO)
    knowledge_base(spark, spark.read.parquet(path), path)
    assert left == {"chunks": set(), "postings": set(), "own": set(), "norms": set()}
    assert spark.conf.get(index.SHUFFLES_GO) == setting


def test_terms_meet_as_rows_of_shards(spark, monkeypatch):
    """A row for each shard and term went both ways through the shuffles, next to the tables written before."""
    import finspark.operators.kb_index as index
    plans, write = {}, index._write_shards
    monkeypatch.setattr(index, "_write_shards", lambda df, folder, name, *a: (
        plans.update({name: df._jdf.queryExecution().executedPlan().toString()}), write(df, folder, name, *a)))
    rows = [*corpus_rows(60), *((i, f"s/own-{i}.md", f"plan word{i} " * 20) for i in range(100, 160)), (None, "n.md", "churn lone " * 20), (7, "e.md", "")]
    path = write_corpus(spark, rows)
    kb = knowledge_base(spark, spark.read.parquet(path), path)
    below = [plans["own"].split("Exchange hashpartitioning")[i].splitlines()[1] for i in (1, 2)]
    assert "FlatMapGroupsInArrow" in below[0] and "FlatMapGroupsInArrow" in below[1] and "Window" not in plans["own"]
    n_all, in_shard = Counter(), set()
    for r in kb.postings.collect():
        n_all[r["term"]] += len(r["entries"])
        in_shard.add((r["shard"], r["term"]))
    got, n = kb.own.collect(), kb.chunks.count()
    assert Counter((r["shard"], r["term"]) for r in got) == Counter(in_shard)
    assert all(r["n_all"] == n_all[r["term"]] and math.isclose(r["idf"], math.log((1 + n) / (1 + r["n_all"])) + 1) for r in got)
    assert {(r["shard"], r["term"]) for r in got if r["first"]} == {(min(s for s, t in in_shard if t == term), term) for term in n_all}
    assert {(r["term"], r["df"]) for r in kb.terms.collect()} == set(n_all.items()) and kb.terms.count() == len(n_all)


def test_packed_terms_come_back_with_their_sums():
    import pyarrow as pa
    import pyarrow.compute as pc
    from finspark.operators.kb_index import _pack_terms, _sum_owned, _unpack_terms
    schema = pa.schema([("shard", pa.int32()), ("owner", pa.int32()), ("term", pa.string()), ("n", pa.int32())])
    # Blocks of one term, in any order; shard 4 has the smaller number.
    shards = {9: [(1, "b", 1024), (0, "a", 2), (1, "b", 1024), (1, "c", 1), (1, "b", 5)], 4: [(0, "z", 1), (1, "b", 3)]}
    packed = pa.concat_tables([_pack_terms(pa.Table.from_pylist([dict(zip(schema.names, (s, *r))) for r in rows], schema)) for s, rows in shards.items()])
    assert sorted(zip(packed["shard"].to_pylist(), packed["of"].to_pylist())) == [(0, 4), (0, 9), (1, 4), (1, 9)]
    summed = pa.concat_tables([_sum_owned(packed.filter(pc.equal(packed["shard"], owner))) for owner in (0, 1)])
    got = {tuple(r.values()) for b in _unpack_terms(summed.to_batches()) for r in b.to_pylist()}
    assert got == {(9, "a", 2, True), (4, "z", 1, True), (4, "b", 2056, True), (9, "b", 2056, False), (9, "c", 1, True)}
