"""An incremental knowledge base: only changed, new and removed files are chunked and counted again.

A store is a folder of versions.  Version ``v=N`` holds the ``chunks`` and term ``counts`` of the files that
changed with it, and ``files``, its manifest: every file of the corpus with the digest of its text and the version
in which its chunks lie.  The manifest is written last, so a version without it did not happen and
is written anew.  What a reader sees is a join of the manifest with the chunks of all versions:
chunks of replaced or removed files have no row in it.  ``compact`` writes the live ones into one version.

Defined cases: a path that occurs more than once is one file with several texts and changes when any of
them does; a null text is empty; rows without a path are left out; an unchanged corpus adds no version;
an empty corpus removes all files.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.operators.chunking import chunk_documents
from finspark.operators.ingest import scratch_dir
from finspark.operators.kb_index import dictionary, term_counts
from finspark.operators.retrieval import CHUNK_SCHEMA, kb_corpus
from finspark.plans.registry import query

#: Characters of texts of a bucket of chunks.
BUCKET_CHARS = 6 << 20
FILES = "source_file string, digest string, copies bigint, since int"
CHUNKS = "chunk_id string, text string, source_file string, section string, start_line int, end_line int, chunk_index int"
COUNTS = "source_file string, chunk_index int, term string, tf bigint"


class ChunkStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def versions(self) -> int:
        """The number of finished versions."""
        n, conf = 0, self.spark.sparkContext._jsc.hadoopConfiguration()
        while (p := self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/v={n}/files/_SUCCESS")).getFileSystem(conf).exists(p):
            n += 1
        return n

    def files(self, versions: int | None = None) -> DataFrame:
        """The manifest of the newest version."""
        n = self.versions() if versions is None else versions
        return self.spark.read.schema(FILES).parquet(f"{self.root}/v={n - 1}/files") if n else self.spark.createDataFrame([], FILES)

    def _live(self, name: str, schema: str) -> DataFrame:
        """Rows of the files as the newest manifest has them; versions that hold none of these are not read."""
        manifest = self.files()
        held = [r.since for r in manifest.select("since").distinct().collect()]
        if not held:
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(schema).parquet(f"{self.root}/v={n}/{name}").withColumn("since", F.lit(n)) for n in sorted(held)]
        now = manifest.select("source_file", "since").distinct()
        return reduce(DataFrame.unionAll, parts).join(now, ["source_file", "since"], "left_semi").select(
            *(c.split()[0] for c in schema.split(", ")))

    def chunks(self) -> DataFrame:
        return self._live("chunks", CHUNKS)

    def counts(self) -> DataFrame:
        return self._live("counts", COUNTS)

    def terms(self) -> DataFrame:
        """(term, df, idf) of the current chunks."""
        return dictionary(self.counts(), self.chunks().count())

    def _write(self, df: DataFrame, version: int, name: str) -> DataFrame:
        path = f"{self.root}/v={version}/{name}"
        df.write.mode("overwrite").parquet(path, compression="zstd")
        return self.spark.read.schema(df.schema).parquet(path)

    def _table(self, version: int) -> str:
        return "kb_version_" + hashlib.sha256(f"{self.root}/v={version}".encode()).hexdigest()[:24]

    def _write_by_file(self, texts: DataFrame, version: int) -> DataFrame:
        """The chunks of ``texts``, in buckets by file that are small enough to count in memory: terms are
        counted where the chunks lie, and no row per chunk and term is shuffled."""
        size = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        buckets = max(self.spark.sparkContext.defaultParallelism, -(-size // BUCKET_CHARS))
        chunks = chunk_documents(texts.repartition(buckets, "source_file")).select(
            *(F.col(c.split()[0]).cast(c.split()[1]) for c in CHUNKS.split(", ")))
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(version)}")
        (chunks.write.mode("overwrite").option("compression", "zstd").bucketBy(buckets, "source_file")
         .option("path", f"{self.root}/v={version}/chunks").saveAsTable(self._table(version)))
        return self.spark.table(self._table(version))

    def update(self, corpus: DataFrame) -> int:
        """Bring the store to ``corpus`` (source_file, text); returns how many files were chunked."""
        n = self.versions()
        corpus = corpus.where(F.col("source_file").isNotNull()).select("source_file", F.coalesce("text", F.lit("")).alias("text"))
        now = self._write(corpus.groupBy("source_file", F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("copies")), n, "digests")
        old = self.files(n)
        key = ["source_file", "digest", "copies"]
        came, gone = now.join(old, key, "left_anti"), old.join(now, key, "left_anti")
        touched = self._write(came.select("source_file").union(gone.select("source_file")).distinct(), n, "touched")
        if n and touched.isEmpty():
            return 0
        changed = self._write(touched.join(now, "source_file", "left_semi"), n, "changed")
        fresh_texts = corpus.join(changed, "source_file", "left_semi") if n else corpus
        chunks = self._write_by_file(fresh_texts, n)
        self._write(term_counts(chunks, ["source_file", "chunk_index"]), n, "counts")
        self.spark.sql(f"DROP TABLE {self._table(n)}")
        kept = old.join(touched, "source_file", "left_anti")
        fresh = now.join(changed, "source_file", "left_semi").withColumn("since", F.lit(n))
        self._write(kept.unionByName(fresh), n, "files")
        return changed.count()

    def compact(self) -> None:
        """All live chunks and counts in one new version."""
        n = self.versions()
        self._write(self.chunks(), n, "chunks")
        self._write(self.counts(), n, "counts")
        self._write(self.files(n).withColumn("since", F.lit(n)), n, "files")


@query("kb_chunks_incremental")
def kb_chunks_incremental_q(spark, sf_dir):
    """The chunks of the documents after two updates: the first corpus lacks some files, has others in an
    earlier form and holds some that are gone later."""
    corpus = kb_corpus(spark, sf_dir).select("source_file", "text")
    kind = F.pmod(F.xxhash64("source_file"), F.lit(50))
    early = corpus.where(kind != 0).select(
        F.when(kind == 1, F.concat("source_file", F.lit(".old"))).otherwise(F.col("source_file")).alias("source_file"),
        F.when(kind == 2, F.concat("text", F.lit("\nThis paragraph is to be taken out again."))).otherwise(F.col("text")).alias("text"))
    store = ChunkStore(spark, scratch_dir(spark, "kb-increment"))
    store.update(early)
    store.update(corpus)
    return store.chunks().select(*CHUNK_SCHEMA.fieldNames())
