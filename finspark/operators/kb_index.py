"""The knowledge base's persisted index: written once per state of the documents, read by every search.

Folder ``kb-<state>`` under the shared folder, where the state names the documents' files with
their sizes and times: changed documents get an index of their own, a finished one is found
again by any session, and an unfinished one (no ``_SUCCESS`` in one of its tables) is written anew.

* ``chunks`` — chunk rows, keyed by (doc_id, chunk_index), dealt over shards by document;
* ``postings`` — blocks of a term's chunks with their counts, in the same shards and
  sorted by term in each file.  A search for few terms hands them to the scan, which skips the row
  groups without them; all chunks of a document lie in one shard (``CLUSTERED BY``), so scores
  are summed without a shuffle;
* ``own`` — (shard, term, n_all, idf, first): the terms of each shard with their chunks in the whole corpus;
  ``first`` marks one of a term's rows;
* ``terms`` — (term, df, idf): those rows, the dictionary that queries are embedded with;
* ``norms`` — (shard, doc_id, chunk_index, norm) of each chunk's vector.

Documents are shuffled once, to their shards.  A shard's chunks are inverted where they lie, as one Arrow
table: no row of (chunk, term) is formed, shuffled or sorted on the way to the postings.  Terms are counted over the
corpus by owners: a shard sends each owner its terms as one row, compressed, and gets that row back with the counts.
A posting holds its count; its weight, count times idf by the chunk's norm, is worked out when it is
read.  Shards have labels that Spark's bucketing puts into a bucket each, so none shares its task with another
and its rows are summed and sorted in memory.

Weights are whole numbers of 2^-30: a score is then an exact sum, equal in any order and on any
engine, and chunks of equal text tie exactly.
"""

from __future__ import annotations

import hashlib
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finspark.functions.text import tokens
from finspark.operators.chunking import chunk_documents
from finspark.session import ensure_checkpoint_dir, input_bytes

# The blocks are made inside Python workers; ship the function by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: One weight unit, and one unit of a product of two weights.
WEIGHT_UNIT, SCORE_UNIT = float(1 << 30), float(1 << 60)
CHUNK_KEY = ["doc_id", "chunk_index"]
#: The key where the rows are joined within their shard.
SHARD_KEY = ["shard", *CHUNK_KEY]
#: Postings of a block, and bytes of documents for each shard.
BLOCK, SHARD_BYTES = 1024, 4 << 20
#: Terms that are handed to the scan as values, and queries that are scored together in a shard.
LISTED_TERMS, QUERY_BLOCK = 500, 256
#: Shards for each owner of terms, so that the terms which meet there stay as many in a larger corpus.
OWNED_SHARDS = 16
#: Whether the files of a query's shuffles go when it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# ---------------------------------------------------------------- weights
def term_counts(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, term, tf)"""
    return (df.select(*keys, F.explode(tokens(F.col(text_col))).alias("term"))
            .groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf")))


def _with_idf(terms: DataFrame, n_docs: int) -> DataFrame:
    return terms.withColumn("idf", F.log((F.lit(1) + F.lit(n_docs)) / (F.lit(1) + F.col("df"))) + 1)


def dictionary(counts: DataFrame, n_docs: int) -> DataFrame:
    """(term, df, idf), one row per term."""
    return _with_idf(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")), n_docs)


def weigh(counts: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, term, weight): tf * idf, L2-normalised per key; terms out of the dictionary drop."""
    w = counts.join(terms.select("term", "idf"), "term").withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*keys)))
    return w.select(*keys, "term", (F.col("w") / norm).alias("weight"))


def as_units(weight) -> F.Column:
    """Rounded half up; ``round`` goes through a decimal, which takes longer than all else that a posting needs."""
    return F.floor(weight * WEIGHT_UNIT + 0.5)


def shown_weight(weight) -> F.Column:
    """To 6 decimals, as SQL's round of a double: half up, without a decimal."""
    return F.floor(weight * 1e6 + 0.5) / 1e6


# ------------------------------------------------------------------ state
def documents_state(spark: SparkSession, path: str) -> str:
    """A hash of the names, sizes and times of the files under ``path`` (a listing, no read)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files, found = root.getFileSystem(conf).listFiles(root, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()[:24]


def _finished(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# ------------------------------------------------------------------ build
def join_within_shards(spark: SparkSession) -> None:
    """Joins on the shard and more read shard beside shard; Spark's default deals both sides anew by all the keys
    (``apply_session_conf`` sets it again for the next query)."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def shard_labels(spark: SparkSession, shards: int) -> list[int]:
    """For each bucket of ``shards`` the smallest number that Spark's hash puts there.  Plain numbers 0, 1, ... would
    leave a third of the buckets empty and put several shards into others."""
    found, tried = {}, 16 * shards
    while len(found) < shards:
        number = F.col("id").cast("int")
        found = dict(spark.range(tried).groupBy(F.pmod(F.hash(number), F.lit(shards))).agg(F.min(number)).collect())
        tried *= 2
    return [found[i] for i in range(shards)]


def _write_shards(df: DataFrame, folder: str, name: str, shards: int) -> None:
    """The files of the table's shuffles go once it is written; else they lie beside the next tables until the driver
    happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO)
    conf.set(SHUFFLES_GO, "true")
    try:
        (df.write.mode("overwrite").option("compression", "zstd").bucketBy(shards, "shard").sortBy(*ORDER[name])
         .option("path", f"{folder}/{name}").saveAsTable(_table(folder, name)))
    finally:
        conf.set(SHUFFLES_GO, before)


def _words(texts):
    """The runs of a-z and 0-9 in an Arrow array of texts, with the number of the text of each; the runs are cut out
    of the array's own bytes."""
    import numpy as np
    import pyarrow as pa
    lengths, data = texts.buffers()[1:]
    starts = np.frombuffer(lengths, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    low, high = int(starts[0]), int(starts[-1])
    if high == low:
        return pa.array([], pa.string()), np.empty(0, np.int64)
    of_word = np.zeros(256, bool)
    of_word[[*b"abcdefghijklmnopqrstuvwxyz0123456789"]] = True
    inside = of_word[np.frombuffer(data, np.uint8)[low:high]]
    new = np.zeros(high - low + 1, bool)
    new[1:-1] = inside[1:] != inside[:-1]
    new[starts - low] = True
    cuts = np.flatnonzero(new)
    used = inside[cuts[:-1]]
    runs = pa.StringArray.from_buffers(len(used), pa.py_buffer((cuts + low).astype(np.int32)), data)
    return runs.filter(pa.array(used)), np.searchsorted(starts - low, cuts[:-1][used], side="right") - 1


def _inverted(table):
    """A shard's chunks (shard, chunk key, text in lower case) to rows (shard, term, entries) of up to ``BLOCK``
    entries; rows of one key are one chunk."""
    import numpy as np
    import pyarrow as pa
    table = table.sort_by([(c, "ascending") for c in CHUNK_KEY]).combine_chunks()
    shard, doc_id, chunk_index, text = (table.column(c).combine_chunks() for c in [*SHARD_KEY, "text"])
    text = text.cast(pa.string())
    ids = np.column_stack([doc_id.is_null().to_numpy(zero_copy_only=False), doc_id.fill_null(0).to_numpy(), chunk_index.to_numpy()])
    new = np.append(True, (ids[1:] != ids[:-1]).any(axis=1))
    first = np.flatnonzero(new)
    words, of = _words(text)
    coded = words.dictionary_encode()
    # Sorted by term, then by chunk.
    met, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * len(first) + (np.cumsum(new) - 1)[of], return_counts=True)
    term, chunk = np.divmod(met, len(first))
    starts = np.searchsorted(term, np.arange(len(coded.dictionary)))
    cut = np.flatnonzero((np.arange(len(met)) - starts[term]) % BLOCK == 0)
    at = pa.array(first[chunk])
    entries = pa.StructArray.from_arrays([doc_id.take(at), chunk_index.take(at), pa.array(tf.astype(np.int64))], [*CHUNK_KEY, "tf"])
    return pa.Table.from_arrays([pa.repeat(shard[0], len(cut)), coded.dictionary.take(pa.array(term[cut])),
                                 pa.ListArray.from_arrays(np.append(cut, len(met)).astype(np.int32), entries)],
                                ["shard", "term", "entries"])


def chunk_postings(chunks: DataFrame) -> DataFrame:
    """(shard, term, entries): the blocks of each shard, made where its chunks lie."""
    return chunks.select(*SHARD_KEY, F.lower("text").alias("text")).groupBy("shard").applyInArrow(_inverted, COLUMNS["postings"])


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """(shard, chunk key, term, tf), counted where the chunks lie; rows of one key are one chunk."""
    return chunk_postings(chunks).select("shard", "term", F.explode("entries").alias("e")).select(
        "shard", "e.doc_id", "e.chunk_index", "term", "e.tf")


def _pack_terms(table):
    """A shard's postings (shard, owner, term, n) to a row for each owner: (shard: the owner, of: the shard, terms, size,
    held), the terms compressed from ``size`` bytes, and the shard's chunks with each."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    shard, owner, term, n = (table.column(c).combine_chunks() for c in ("shard", "owner", "term", "n"))
    # A term's code says where it is first met; a shard's file is in the order of its terms, which compress well so.
    coded = term.cast(pa.string()).dictionary_encode()
    code, held = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), np.int64)
    np.add.at(held, code, n.to_numpy())
    owners = np.empty(len(held), np.int32)
    owners[code] = owner.to_numpy()
    order = np.argsort(owners, kind="stable")
    owners = owners[order]
    cut = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
    ends = np.append(cut, len(owners)).astype(np.int32)
    # Terms are runs of a-z and 0-9.
    texts = [t.as_buffer() for t in pc.binary_join(pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(order))), " ")]
    return pa.Table.from_arrays([pa.array(owners[cut]), pa.repeat(shard[0], len(cut)),
                                 pa.array([pa.compress(t, "zstd", asbytes=True) for t in texts], pa.binary()),
                                 pa.array([len(t) for t in texts], pa.int32()), pa.ListArray.from_arrays(ends, pa.array(held[order]))],
                                ["shard", "of", "terms", "size", "held"])


def _unpacked(terms, size):
    import pyarrow as pa
    import pyarrow.compute as pc
    return pc.split_pattern(pa.array([pa.decompress(terms.as_buffer(), size.as_py(), "zstd", asbytes=True).decode()]), " ").flatten()


def _sum_owned(table):
    """An owner's rows from all shards back to them as (shard, terms, size, df, first): the chunks of the whole corpus
    with each term, and whether no smaller shard has the term."""
    import numpy as np
    import pyarrow as pa
    table = table.sort_by("of")
    of, terms, size, held = (table.column(c).combine_chunks() for c in ("of", "terms", "size", "held"))
    coded = pa.concat_arrays([_unpacked(*x) for x in zip(terms, size)]).dictionary_encode()
    term = coded.indices.to_numpy()
    df = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(df, term, held.flatten().to_numpy())
    # Codes are given in the order in which the terms are met.
    first = np.append(True, term[1:] > np.maximum.accumulate(term)[:-1])
    ends = np.append(0, np.cumsum(held.value_lengths().to_numpy())).astype(np.int32)
    return pa.Table.from_arrays([of, terms, size, pa.ListArray.from_arrays(ends, pa.array(df[term])),
                                 pa.ListArray.from_arrays(ends, pa.array(first))], ["shard", "terms", "size", "df", "first"])


def _unpack_terms(batches):
    """Rows (shard, terms, size, df, first) to one for each term."""
    import pyarrow as pa
    for batch in batches:
        shard, terms, size, df, first = (batch.column(c) for c in ("shard", "terms", "size", "df", "first"))
        for i in range(batch.num_rows):
            words = _unpacked(terms[i], size[i])
            yield pa.RecordBatch.from_arrays([pa.repeat(shard[i], len(words)), words, df[i].values, first[i].values],
                                             ["shard", "term", "df", "first"])


def corpus_counts(postings: DataFrame, shards: int) -> DataFrame:
    """(shard, term, df, first): the terms of each shard with their chunks in the whole corpus; ``first`` marks one of a
    term's rows.  Both ways, what is shuffled is a row for each shard and owner, not one for each shard and term."""
    spark = postings.sparkSession
    owners = min(shards, max(spark.sparkContext.defaultParallelism, -(-shards // OWNED_SHARDS)))
    labels = F.array(*map(F.lit, shard_labels(spark, owners)))
    owner = F.get(labels, F.pmod(F.xxhash64("term"), F.lit(owners)).cast("int"))
    packed = (postings.select("shard", owner.alias("owner"), "term", F.size("entries.tf").alias("n")).groupBy("shard")
              .applyInArrow(_pack_terms, "shard INT, of INT, terms BINARY, size INT, held ARRAY<BIGINT>"))
    summed = packed.repartition(owners, "shard").groupBy("shard").applyInArrow(
        _sum_owned, "shard INT, terms BINARY, size INT, df ARRAY<BIGINT>, first ARRAY<BOOLEAN>")
    return summed.repartition(shards, "shard").mapInArrow(_unpack_terms, "shard INT, term STRING, df BIGINT, first BOOLEAN")


def build_index(corpus: DataFrame, folder: str, shards: int) -> None:
    """Write the index of ``corpus`` (doc_id, source_file, text)."""
    spark, kb = corpus.sparkSession, KnowledgeBase(corpus.sparkSession, folder, shards)
    labels = F.array(*map(F.lit, shard_labels(spark, shards)))
    shard = F.get(labels, F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    dealt = corpus.withColumn("shard", shard).repartition(shards, "shard")
    _write_shards(chunk_documents(dealt, keep=("shard", "doc_id")), folder, "chunks", shards)
    _write_shards(chunk_postings(kb.chunks), folder, "postings", shards)
    own = _with_idf(corpus_counts(kb.postings, shards), kb.chunks.count()).select("shard", "term", F.col("df").alias("n_all"), "idf", "first")
    _write_shards(own, folder, "own", shards)
    (kb.own.where("first").select("term", F.col("n_all").alias("df"), "idf")
     .write.mode("overwrite").parquet(f"{folder}/terms", compression="zstd"))
    w = F.col("e.tf") * F.col("idf")
    norms = kb.entries(kb.postings, kb.own).groupBy("shard", "e.doc_id", "e.chunk_index").agg(F.sqrt(F.sum(w * w)).alias("norm"))
    _write_shards(norms, folder, "norms", shards)


def _best_of_shard(k: int):
    """A shard's postings with the queries that ask for their terms, and its norms, to the ``k`` best chunks of each
    query: sums of whole products, equal ones in the order of the chunks."""
    def run(postings, norms):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        names = ["query_id", *CHUNK_KEY, "units"]
        asked_type = postings.schema.field("asked").type.value_type.field("query_id").type
        if not (postings.num_rows and norms.num_rows):
            return pa.Table.from_arrays([pa.array([], t) for t in (asked_type, pa.int64(), pa.int32(), pa.int64())], names)
        norms = norms.take(pc.sort_indices(norms, sort_keys=[(c, "ascending") for c in CHUNK_KEY], null_placement="at_start")).combine_chunks()
        doc_id, chunk_index, norm = (norms.column(c).combine_chunks() for c in [*CHUNK_KEY, "norm"])
        docs, span = np.unique(doc_id.drop_null().to_numpy()), int(pc.max(chunk_index).as_py()) + 1

        def key(doc, chunk):
            of = np.where(doc.is_null().to_numpy(zero_copy_only=False), 0, np.searchsorted(docs, doc.fill_null(0).to_numpy()) + 1)
            return of * span + chunk.to_numpy()

        lists, asked = (postings.column(c).combine_chunks() for c in ("entries", "asked"))
        entry, want = lists.flatten(), asked.flatten()
        ends, wanted = (np.append(0, np.cumsum(x.value_lengths().to_numpy())) for x in (lists, asked))
        at = np.searchsorted(key(doc_id, chunk_index), key(*(pc.struct_field(entry, c) for c in CHUNK_KEY)))
        weight = pc.struct_field(entry, "tf").to_numpy() * np.repeat(postings.column("idf").to_numpy(), np.diff(ends)) / norm.to_numpy()[at]
        units = np.floor(weight * WEIGHT_UNIT + 0.5).astype(np.int64)
        coded = pc.struct_field(want, "query_id").dictionary_encode(null_encoding="encode")
        query, q = coded.indices.to_numpy(), pc.struct_field(want, "q").to_numpy()
        found = []
        for low in range(0, len(coded.dictionary), QUERY_BLOCK):
            n = min(QUERY_BLOCK, len(coded.dictionary) - low)
            scores, met = np.zeros((n, len(norm)), np.int64), np.zeros((n, len(norm)), bool)
            for i in range(len(lists)):
                mine, part = slice(wanted[i], wanted[i + 1]), slice(ends[i], ends[i + 1])
                here = (query[mine] >= low) & (query[mine] < low + n)
                for j, x in zip(query[mine][here] - low, q[mine][here]):
                    scores[j, at[part]] += units[part] * x
                    met[j, at[part]] = True
            for j in range(n):
                of = np.flatnonzero(met[j])
                of = of[np.argsort(-scores[j, of], kind="stable")[:k]]
                found.append((np.full(len(of), low + j), of, scores[j, of]))
        numbers, of, best = (np.concatenate(x) for x in zip(*found))
        return pa.Table.from_arrays([coded.dictionary.take(pa.array(numbers)), doc_id.take(pa.array(of)), chunk_index.take(pa.array(of)), pa.array(best)], names)
    return run


def _table(folder: str, name: str = "postings") -> str:
    return f"kb_{name}_" + hashlib.sha256(folder.rstrip("/").encode()).hexdigest()[:24]


#: Columns of the tables that are dealt over shards, and their order in a file.
COLUMNS = {"chunks": "chunk_id STRING, text STRING, source_file STRING, section STRING, start_line INT, end_line INT, "
                     "chunk_index INT, shard INT, doc_id BIGINT",
           "postings": "shard INT, term STRING, entries ARRAY<STRUCT<doc_id: BIGINT, chunk_index: INT, tf: BIGINT>>",
           "own": "shard INT, term STRING, n_all BIGINT, idf DOUBLE, first BOOLEAN",
           "norms": "shard INT, doc_id BIGINT, chunk_index INT, norm DOUBLE"}
ORDER = {"chunks": CHUNK_KEY, "postings": ["term"], "own": ["term"], "norms": CHUNK_KEY}


class KnowledgeBase:
    """A finished index, read from its folder."""

    def __init__(self, spark: SparkSession, folder: str, shards: int):
        join_within_shards(spark)
        self.spark, self.folder, self.shards = spark, folder, shards

    def _shards(self, name: str) -> DataFrame:
        """A table with its layout: another session names the files as a table first."""
        table = _table(self.folder, name)
        if not self.spark.catalog.tableExists(table):
            self.spark.sql(f"CREATE TABLE {table} ({COLUMNS[name]}) USING parquet CLUSTERED BY (shard) SORTED BY "
                           f"({', '.join(ORDER[name])}) INTO {self.shards} BUCKETS LOCATION '{self.folder}/{name}'")
        return self.spark.table(table)

    @property
    def chunks(self) -> DataFrame:
        return self._shards("chunks")

    @property
    def terms(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/terms")

    @property
    def postings(self) -> DataFrame:
        return self._shards("postings")

    @property
    def own(self) -> DataFrame:
        return self._shards("own")

    @property
    def norms(self) -> DataFrame:
        return self._shards("norms")

    @staticmethod
    def entries(postings: DataFrame, own: DataFrame) -> DataFrame:
        """(shard, term, idf, e): a row for each entry of ``postings``, in its shard."""
        return (postings.join(own.select("shard", "term", "idf").hint("shuffle_hash"), ["shard", "term"])
                .select("shard", "term", "idf", F.explode("entries").alias("e")))

    def weighed(self, rows: DataFrame, named: DataFrame | None = None) -> DataFrame:
        """Rows of entries (idf, e) with the chunk key and ``weight`` in units, by the norms of their shard.  ``named``:
        the norms with further columns of their chunks, which the rows then get in the same join (none without doc_id)."""
        norms = self.norms if named is None else named
        norms = norms.select(*(F.col(c).alias(f"_{c}") if c in SHARD_KEY else c for c in norms.columns)).hint("shuffle_hash")
        rows = rows.select(*rows.columns, "e.doc_id", "e.chunk_index", "e.tf")
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "doc_id" and named is None else F.col(c) == F.col(f"_{c}") for c in SHARD_KEY]
        weight = as_units(F.col("tf") * F.col("idf") / F.col("norm"))
        return rows.join(norms, same).withColumn("weight", weight).drop(*(f"_{c}" for c in SHARD_KEY), "norm", "e", "idf", "tf")

    def weights(self, named: DataFrame | None = None) -> DataFrame:
        """(shard, term, doc_id, chunk_index, weight) of all postings, and the further columns of ``named``."""
        return self.weighed(self.entries(self.postings, self.own), named).withColumn("weight", F.col("weight") / WEIGHT_UNIT)

    def named_weights(self) -> DataFrame:
        """(chunk_id, term, weight) of all postings: norms meet the chunks' names first, a row for each chunk."""
        names = self.chunks.select(*SHARD_KEY, "chunk_id").hint("shuffle_hash")
        return self.weights(self.norms.join(names, SHARD_KEY)).select("chunk_id", "term", "weight")

    def embed(self, queries: DataFrame, small: bool = False) -> DataFrame:
        """(query_id, term, weight) of rows (query_id, query_text).  ``small``: their terms are known to be few, and
        meet the dictionary without a shuffle of it."""
        counts = term_counts(queries, ["query_id"], "query_text")
        return weigh(F.broadcast(counts) if small else counts, self.terms, ["query_id"])

    def search(self, query_terms: DataFrame, search_k: int, small: bool) -> DataFrame:
        """The ``search_k`` best chunks of each query by inner product: (query_id, doc_id, chunk_index,
        units, raw, search_rank).  ``small``: the query terms are known to be few; each shard then hands on its best only."""
        q = query_terms.select("query_id", "term", as_units(F.col("weight")).alias("q"))
        postings, own = self.postings, self.own
        if small:
            listed = [r["term"] for r in q.select("term").distinct().limit(LISTED_TERMS + 1).collect()]
            if len(listed) <= LISTED_TERMS:
                postings, own = (x.where(F.col("term").isin(listed)) for x in (postings, own))
            asked = q.groupBy("term").agg(F.collect_list(F.struct("query_id", "q")).alias("asked"))
            met = (postings.join(F.broadcast(asked), "term")
                   .join(own.select("shard", "term", "idf").hint("shuffle_hash"), ["shard", "term"]).select("shard", "idf", "entries", "asked"))
            scored = met.groupBy("shard").cogroup(self.norms.groupBy("shard")).applyInArrow(
                _best_of_shard(search_k), f"query_id {q.schema['query_id'].dataType.simpleString()}, doc_id bigint, chunk_index int, units bigint")
        else:
            postings = postings.join(q.select("term").distinct(), "term", "left_semi")
            met = self.weighed(self.entries(postings, own)).join(q, "term")
            scored = met.groupBy("shard", "query_id", *CHUNK_KEY).agg(F.sum(F.col("weight") * F.col("q")).alias("units")).drop("shard")
        w = Window.partitionBy("query_id").orderBy(F.col("units").desc(), *CHUNK_KEY)
        return (scored.withColumn("search_rank", F.row_number().over(w).cast("bigint"))
                .where(F.col("search_rank") <= search_k).withColumn("raw", F.col("units") / SCORE_UNIT))


def knowledge_base(spark: SparkSession, corpus: DataFrame, source_path: str, rebuild: bool = False) -> KnowledgeBase:
    """The index of ``corpus`` as its files under ``source_path`` are now; built if there is none."""
    shards = max(spark.sparkContext.defaultParallelism, -(-input_bytes(spark, [source_path]) // SHARD_BYTES))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kb-{documents_state(spark, source_path)}{shards}"
    if rebuild or not all(_finished(spark, f"{folder}/{name}") for name in [*COLUMNS, "terms"]):
        for name in COLUMNS:
            spark.sql(f"DROP TABLE IF EXISTS {_table(folder, name)}")
        build_index(corpus, folder, shards)
    return KnowledgeBase(spark, folder, shards)


def vector_rows(kb: KnowledgeBase) -> DataFrame:
    """(shard, chunk key, terms, norm_sq): the sparse vector of each chunk, from the postings of its shard."""
    shown = shown_weight(F.col("weight"))
    return kb.weights().groupBy(*SHARD_KEY).agg(F.count(F.lit(1)).alias("terms"), F.sum(shown * shown).alias("norm_sq"))
