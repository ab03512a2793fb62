"""Knowledge-base build and retrieval as Spark jobs.

Build: documents -> markdown corpus -> chunks (native fold, no shuffle) -> TF-IDF weights,
L2-normalised per chunk -> the persisted index of :mod:`finspark.operators.kb_index`.
Scoring a query joins its terms with the index's blocks and sums per (query, chunk), so no pair
without a shared term is ever formed.

Retrieve: top ``search_k = max(6 * top_k, 30)`` per query (row_number <= k,
planned as partial + final WindowGroupLimit), then the rule-based gate,
penalty and bonuses, score threshold, best chunk per source, final top_k,
citation / preview strings and a grounded answer per query.  Ranks and the threshold use
whole scores; only shown scores are rounded.

Dense search multiplies blocks of vectors with blocks of queries (Arrow batches, numpy) and
keeps the best k of each block.
"""

from __future__ import annotations

import sys
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.config import (CHURN_GATE_TERMS, CHURN_HEADING_TERMS, CHURN_SOURCE_BONUS, CHURN_SQL_TERMS,
                             CONTENT_BONUS, GROUNDED_ANSWER_LINES, GROUNDED_FALLBACK, GROUNDED_NO_MATCH,
                             INTRO_PENALTY, INTRO_PENALTY_TERMS, RETRIEVE_MIN_SCORE, RETRIEVE_TOP_K)
from finspark.functions.text import contains_any, py_strip, term_bucket
from finspark.operators.chunking import chunk_documents
from finspark.operators.kb_index import CHUNK_KEY, SHARD_KEY, KnowledgeBase, knowledge_base, shown_weight, vector_rows
from finspark.plans.registry import query
from finspark.session import ensure_checkpoint_dir
from finspark.sources.tables import read_table, table_path

# Encoder functions run inside Python workers (mapInPandas); ship them by
# value so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCORE_DP = 5
# Broadcast a query-side relation only below this many rows (checked).
MAX_BROADCAST_ROWS = 200_000
# Questions asked of the knowledge base besides the benchmark passages.
DEMO_QUESTIONS = [(-1, "how is churn calculated")]

CHUNK_SCHEMA = T.StructType([
    T.StructField("chunk_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("source_file", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("start_line", T.IntegerType()),
    T.StructField("end_line", T.IntegerType()),
])


def broadcast_if_bounded(df: DataFrame, bound: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint when a proven upper bound on the rows is small."""
    return F.broadcast(df) if bound <= max_rows else df


def query_bounds(queries: DataFrame) -> tuple[int, int]:
    """(number of queries, upper bound on their distinct terms): a query of
    L characters holds at most L // 2 + 1 tokens.  One scan of the (small)
    query table."""
    r = queries.agg(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(F.floor(F.length("query_text") / 2) + 1), F.lit(0)).alias("t")).first()
    return int(r["n"]), int(r["t"])


# ------------------------------------------------------------------ corpus
def kb_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as markdown files: a ``# <source>`` title line + the text."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "source", "lang", "text"])
    return d.select(
        "doc_id",
        F.concat_ws("/", "source", "lang", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".md")))
        .alias("source_file"),
        F.concat(F.lit("# "), F.col("source"), F.lit("\n"), F.col("text")).alias("text"),
    )


def read_markdown_corpus(spark: SparkSession, root: str) -> DataFrame:
    """``*.md`` files under ``root`` (recursive), one row per file."""
    df = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return df.select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("text"))


def kb_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_documents(kb_corpus(spark, sf_dir), keep=("doc_id",)).select(*CHUNK_SCHEMA.fieldNames())


def kb_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as questions, plus the demo question(s)."""
    b = read_table(spark, sf_dir, "benchmark", ["item_id", "text"]).select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    demo = spark.createDataFrame(DEMO_QUESTIONS, "query_id bigint, query_text string")
    return b.unionByName(demo)


# ------------------------------------------------------------------ search
def build_kb(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> KnowledgeBase:
    """The index of the documents as they are now, written if there is none."""
    return knowledge_base(spark, kb_corpus(spark, sf_dir), table_path(sf_dir, "documents"), rebuild)


def search_hits(spark: SparkSession, sf_dir: str, top_k: int = RETRIEVE_TOP_K) -> tuple[KnowledgeBase, DataFrame, DataFrame, int]:
    """The index, the queries, their hits and a bound on the number of hits."""
    kb, queries = build_kb(spark, sf_dir), kb_queries(spark, sf_dir)
    n_queries, term_bound = query_bounds(queries)
    search_k = max(top_k * 6, 30)
    small = term_bound <= MAX_BROADCAST_ROWS
    hits = kb.search(kb.embed(queries, small), search_k, small)
    return kb, broadcast_if_bounded(queries, n_queries), hits, n_queries * search_k


def candidates(spark: SparkSession, sf_dir: str, top_k: int = RETRIEVE_TOP_K) -> DataFrame:
    """Search hits joined with their chunk text and query text.  Hits are at
    most (#queries x search_k) rows, so once the query table is counted they
    are broadcast against the chunk table instead of shuffling it."""
    kb, queries, hits, bound = search_hits(spark, sf_dir, top_k)
    return (kb.chunks.join(broadcast_if_bounded(hits, bound), CHUNK_KEY).join(queries, "query_id")
            .withColumn("score", F.round("raw", SCORE_DP))
            .withColumn("text_lower", F.lower("text")).withColumn("query_lower", F.lower("query_text")))


def gated(c: DataFrame) -> DataFrame:
    """In churn mode keep only chunks mentioning churn / cancellation."""
    churn_mode = F.col("query_lower").contains("churn")
    return c.where(~churn_mode | contains_any(F.col("text_lower"), CHURN_GATE_TERMS))


def reranked(c: DataFrame, min_score: float = RETRIEVE_MIN_SCORE) -> DataFrame:
    churn_mode = F.col("query_lower").contains("churn")
    how_calc = F.col("query_lower").contains("how is") & F.col("query_lower").contains("calculated")
    penalty = F.when(how_calc & contains_any(F.col("text_lower"), INTRO_PENALTY_TERMS), -INTRO_PENALTY).otherwise(0.0)
    source_bonus = None
    for suffix, bonus in CHURN_SOURCE_BONUS:
        cond = F.col("source_file").endswith(suffix)
        source_bonus = (F.when(cond, bonus) if source_bonus is None else source_bonus.when(cond, bonus))
    source_bonus = source_bonus.otherwise(0.0)
    content = (F.when(contains_any(F.col("text_lower"), CHURN_SQL_TERMS), CONTENT_BONUS).otherwise(0.0)
               + F.when(contains_any(F.col("text_lower"), CHURN_HEADING_TERMS), CONTENT_BONUS).otherwise(0.0))
    bonus = F.when(churn_mode, source_bonus + content).otherwise(0.0)
    adjusted = F.col("raw") + penalty + bonus
    return (gated(c).withColumn("adjusted", adjusted).where(F.col("adjusted") >= min_score)
            .withColumn("adjusted_score", F.round("adjusted", SCORE_DP)))


def best_per_source(r: DataFrame) -> DataFrame:
    w = Window.partitionBy("query_id", "source_file").orderBy(F.col("adjusted").desc(), "search_rank")
    return r.withColumn("source_rank", F.row_number().over(w)).where(F.col("source_rank") == 1).drop("source_rank")


def final_top_k(r: DataFrame, top_k: int = RETRIEVE_TOP_K) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("adjusted").desc(), "search_rank")
    return r.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= top_k)


def retrieve(spark: SparkSession, sf_dir: str, top_k: int = RETRIEVE_TOP_K, min_score: float = RETRIEVE_MIN_SCORE,
             dedupe_by_source: bool = True) -> DataFrame:
    r = reranked(candidates(spark, sf_dir, top_k), min_score)
    if dedupe_by_source:
        r = best_per_source(r)
    return final_top_k(r, top_k)


def citation(c: DataFrame) -> Column:
    return F.format_string("%s | %s | L%d-L%d", c["source_file"], c["section"], c["start_line"], c["end_line"])


def preview(text: Column, n: int = 350) -> Column:
    return F.regexp_replace(py_strip(F.substring(text, 1, n)), "\n", " ")


def answer_sources(r: DataFrame) -> DataFrame:
    return r.select("query_id", "rank", F.format_string("%.5f", F.col("adjusted_score")).alias("score"),
                    citation(r).alias("citation"), preview(F.col("text")).alias("preview"))


def grounded_answers(queries: DataFrame, r: DataFrame) -> DataFrame:
    flags = r.groupBy("query_id").agg(
        F.max(F.col("text_lower").contains("churn")).alias("has_churn"),
        F.max(F.col("text_lower").contains("canceled") | F.col("text_lower").contains("subscription_status"))
        .alias("has_cancel"))
    j = queries.join(flags, "query_id", "left")
    answer = (F.when(F.col("has_churn").isNull(), GROUNDED_NO_MATCH)
              .when(F.col("has_churn") & F.col("has_cancel"), "\n".join(GROUNDED_ANSWER_LINES))
              .otherwise(GROUNDED_FALLBACK))
    return j.select("query_id", answer.alias("answer"))


# ------------------------------------------------------------ dense search
def label_centroids(emb: DataFrame) -> DataFrame:
    """(label, unit-length mean vector) — one query per label."""
    e = emb.select("label", F.posexplode("embedding").alias("pos", "v"))
    m = e.groupBy("label", "pos").agg(F.avg(F.col("v").cast("double")).alias("v"))
    vec = m.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "v"))).alias("pv")).select(
        "label", F.transform("pv", lambda x: x["v"]).alias("vec"))
    norm = F.sqrt(F.aggregate(F.col("vec"), F.lit(0.0), lambda a, x: a + x * x))
    return vec.select(F.col("label").alias("query_id"), F.transform("vec", lambda x: x / norm).alias("qvec"))


#: Queries and vectors that are multiplied together.
QUERY_BATCH, VECTOR_BATCH = 256, 1024
#: Bytes of query vectors that may be broadcast; they are counted first.
BROADCAST_BYTES = 64 << 20
#: Dense scores are equal below this many decimals (sums of products differ in their last bits).
DENSE_DP = 9


def _packed(id_col: str, vector_col: str, size: int):
    """Rows to blocks: ids and vectors of up to ``size`` rows of one dimension."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                ids, vectors = part.column(id_col), part.column(vector_col)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")], pa.list_(pa.float64()))],
                    ["ids", "values"])
    return run


def _best_of_blocks(k: int):
    """The best ``k`` vectors of a block for each query of a block."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                vids, vs, qids, qs = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("ids", "values", "q_ids", "q_values"))
                vectors = vs.reshape(len(vids), -1)
                scores = np.round(qs.reshape(len(qids), -1) @ vectors.T, DENSE_DP)
                rank = np.argsort(vids, kind="stable")
                scores, vids = scores[:, rank], vids[rank]
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(qids, best.shape[1])), pa.array(vids[best].ravel()),
                    pa.array(np.take_along_axis(scores, best, axis=1).ravel())], ["query_id", "vec_id", "raw"])
    return run


def dense_topk(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact inner-product top-k of every query over all vectors, of one dimension.

    Vectors and queries are packed into blocks; every block of vectors meets every block of
    queries, as one matrix product, and gives its best ``k`` of each query; these are merged by a
    partial + final WindowGroupLimit.  Rows without id or vector, or with a null component, are left out."""
    whole = lambda df, i, v: df.where(F.col(i).isNotNull() & F.col(v).isNotNull() & F.forall(v, lambda x: x.isNotNull()))
    block = "ids array<bigint>, values array<double>"
    vs = whole(vectors, "vec_id", "embedding").select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(
        _packed("vec_id", "embedding", VECTOR_BATCH), block)
    queries = whole(queries, "query_id", "qvec").select(F.col("query_id").cast("bigint"), "qvec")
    known = queries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("qvec")), F.lit(0)).alias("dim")).first()
    qs = (queries.repartition(max(1, known["n"] // (4 * QUERY_BATCH)), "query_id")
          .mapInArrow(_packed("query_id", "qvec", QUERY_BATCH), block).toDF("q_ids", "q_values"))
    if known["n"] * known["dim"] * 8 <= BROADCAST_BYTES:
        qs = F.broadcast(qs)
    # A stated query set against all rows, block by block.
    best = vs.join(qs).mapInArrow(_best_of_blocks(k), "query_id bigint, vec_id bigint, raw double")
    w = Window.partitionBy("query_id").orderBy(F.col("raw").desc(), F.col("vec_id").asc())
    return (best.withColumn("rank", F.row_number().over(w).cast("bigint")).where(F.col("rank") <= k)
            .select("query_id", "vec_id", F.round("raw", SCORE_DP).alias("score"), "rank"))


# ------------------------------------------------------------------ queries
@query("kb_documents")
def kb_documents_q(spark, sf_dir):
    return kb_corpus(spark, sf_dir)


@query("kb_chunks")
def kb_chunks_q(spark, sf_dir):
    return kb_chunks(spark, sf_dir)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("kb_chunks_roundtrip")
def kb_chunks_roundtrip_q(spark, sf_dir):
    """Chunks written as JSON lines and read back with an explicit schema."""
    path = _scratch(spark, "kb-chunks-jsonl")
    kb_chunks(spark, sf_dir).write.mode("overwrite").json(path)
    return spark.read.schema(CHUNK_SCHEMA).json(path)


@query("kb_embed")
def kb_embed_q(spark, sf_dir):
    return build_kb(spark, sf_dir).named_weights().select(
        "chunk_id", term_bucket(F.col("term")).alias("bucket"), shown_weight(F.col("weight")).alias("weight"))


@query("kb_index")
def kb_index_q(spark, sf_dir):
    """The index written anew and read back: chunk rows with the size and norm of their vectors."""
    kb = build_kb(spark, sf_dir, rebuild=True)
    return kb.chunks.join(vector_rows(kb), SHARD_KEY).select(
        "chunk_id", "source_file", "section", "start_line", "end_line", "terms", F.round("norm_sq", 4).alias("norm_sq"))


@query("vector_topk")
def vector_topk_q(spark, sf_dir):
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return dense_topk(emb, label_centroids(emb), max(RETRIEVE_TOP_K * 6, 30))


@query("kb_search")
def kb_search_q(spark, sf_dir):
    kb, _, hits, bound = search_hits(spark, sf_dir)
    return kb.chunks.select(*CHUNK_KEY, "chunk_id").join(broadcast_if_bounded(hits, bound), CHUNK_KEY).select(
        "query_id", "chunk_id", F.round("raw", SCORE_DP).alias("score"), "search_rank")


@query("kb_gate")
def kb_gate_q(spark, sf_dir):
    return gated(candidates(spark, sf_dir)).select("query_id", "chunk_id", "score", "search_rank")


@query("kb_rerank")
def kb_rerank_q(spark, sf_dir):
    return reranked(candidates(spark, sf_dir)).select("query_id", "chunk_id", "source_file", "score",
                                                      "adjusted_score", "search_rank")


@query("kb_dedupe_source")
def kb_dedupe_source_q(spark, sf_dir):
    return best_per_source(reranked(candidates(spark, sf_dir))).select(
        "query_id", "chunk_id", "source_file", "adjusted_score", "search_rank")


@query("kb_answer_sources")
def kb_answer_sources_q(spark, sf_dir):
    return answer_sources(retrieve(spark, sf_dir))


@query("kb_grounded_answer")
def kb_grounded_answer_q(spark, sf_dir):
    return grounded_answers(kb_queries(spark, sf_dir), retrieve(spark, sf_dir))


# ------------------------------------------------------ pluggable encoders
def hashed_trigram_encoder(dim: int = 256):
    """A small deterministic batch encoder (character trigrams hashed into
    ``dim`` buckets) standing in for a neural model: ``list[str] -> ndarray``."""
    import zlib

    import numpy as np

    def encode(texts):
        out = np.zeros((len(texts), dim), dtype=np.float32)
        for i, t in enumerate(texts):
            s = f"  {(t or '').lower()} "
            for j in range(len(s) - 2):
                out[i, zlib.crc32(s[j:j + 3].encode("utf-8")) % dim] += 1.0
        return out

    return encode


ENCODERS = {"hashed-trigrams-256": lambda: hashed_trigram_encoder(256)}


def embed_with_encoder(df: DataFrame, id_col: str, text_col: str, encoder="hashed-trigrams-256") -> DataFrame:
    """Dense, L2-normalised embeddings from a batch encoder (a name in
    ``ENCODERS`` or a callable ``list[str] -> ndarray``), run once per Arrow
    batch with ``mapInPandas``: the model is loaded per task, rows stay in
    their partitions and only (id, vector) comes back."""
    make = ENCODERS[encoder] if isinstance(encoder, str) else (lambda: encoder)

    def run(batches):
        import numpy as np
        import pandas as pd
        enc = make()
        for pdf in batches:
            vecs = np.asarray(enc(pdf[text_col].tolist()), dtype=np.float32)
            norms = np.linalg.norm(vecs, axis=1, keepdims=True)
            norms[norms == 0] = 1.0
            yield pd.DataFrame({id_col: pdf[id_col], "embedding": list(vecs / norms)})

    schema = f"{id_col} {df.schema[id_col].dataType.simpleString()}, embedding array<float>"
    return df.select(id_col, text_col).mapInPandas(run, schema)
