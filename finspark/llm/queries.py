"""One query per numbered operator: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.llm.centroids import centroid_digest, cluster_vectors
from finspark.llm.chat_windows import chat_windows, window_digests
from finspark.llm.decontaminate import contaminated
from finspark.llm.license_scan import scan_licenses
from finspark.llm.mixture import mix_sources
from finspark.llm.ngram_join import jaccard_components
from finspark.llm.perplexity import quality_rules
from finspark.llm.prefix_trie import prefix_trie
from finspark.llm.quality_model import learn_quality, rated_rows, score_quality
from finspark.llm.simhash_tiles import simhash_components
from finspark.llm.substring_dedup import remove_repeats
from finspark.llm.token_scan import count_tokens, read_ranks, write_tokens
from finspark.llm.toxicity import held_out, labelled_rows, learn_lexicon, score_toxicity
from finspark.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaccard components of all documents (five words, 80 percent)."""
    return jaccard_components(read_table(spark, sf_dir, "documents", ["doc_id", "text"])).toDF(
        "doc_id", "n_shingles", "component_id")


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents left after cutting 50-word windows that a smaller doc_id has."""
    cut = remove_repeats(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: weights 1, 2, 3 by source, three takings at most."""
    mixed = mix_sources(read_table(spark, sf_dir, "documents", ["doc_id", "source", "text"]), keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; learnt from at most 20,000 labelled rows outside the held-out fifth."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    lexicon = learn_lexicon(labelled_rows(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])))
    return score_toxicity(docs, lexicon).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the similarity of the best window."""
    held = contaminated(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                        read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    return held.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "common", "total")


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements and notices in all documents."""
    return scan_licenses(read_table(spark, sf_dir, "documents", ["doc_id", "text"])).withColumnRenamed("id", "doc_id")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base numbers and the perplexity verdict of all documents; bands as wide as the labels outside the held-out fifth say."""
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"]).filter(~held_out())
    return quality_rules(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]), labels=labels).withColumnRenamed("id", "doc_id")


#: Vocabulary of the token queries, the split pattern of that vocabulary and its free id.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
END_ID = 50_256


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, counted from flat token streams of the whole table."""
    ranks = read_ranks(spark, TOKENIZER)
    blocks, order = write_tokens(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), ranks, SPLIT, END_ID)
    return count_tokens(blocks, END_ID).join(order, ["stream", "ordinal"]).select(F.col("id").alias("doc_id"), "n_tokens")


@query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade (0 poor, 1 good but toxic, 2 good) and selection of all documents; learnt from at
    most 10,000 labelled rows outside the held-out fifth."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    rated = rated_rows(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]), held_out())
    return score_quality(docs, learn_quality(rated, 3)).withColumn("held_out", held_out())


@query
def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, and of conversation -7 that says control strings."""
    turns = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    said = "</s>[INST] ok [/INST]"
    tricky = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return window_digests(chat_windows(turns.union(tricky), ranks=read_ranks(spark, TOKENIZER), pattern=SPLIT))


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of all vectors after five rounds from 40 starts, with sums and digests of the clusters."""
    found, clusters = cluster_vectors(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))
    digests = spark.createDataFrame([(r["cluster"], centroid_digest(r["centroid"])) for r in clusters.select("cluster", "centroid").collect()],
                                    "cluster int, centroid_sha256 string")  # 40 rows
    facts = clusters.select("cluster", "cluster_inertia", "inertia").join(F.broadcast(digests), "cluster")
    return found.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents (four words, four bits)."""
    found = simhash_components(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations with subtree totals."""
    trie = prefix_trie(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return trie.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
