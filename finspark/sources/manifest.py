"""Tables whose merges rewrite only the files that can hold a key of the batch.

``<base>/writes/<id>/`` holds what one run wrote: ``rows`` and ``kept`` (data files, never
changed) and ``stats`` (Bloom filters of their keys).  ``<base>/manifest/v=<n>`` lists the files that
make up version ``n``: path, rows, range of keys, range of the clustering column.  A run
writes its files, then its manifest beside the others, and renames that into place: readers see the
version before or the one after, a run that dies between leaves only files that no manifest
names, and of two runs that end in the same version the second fails.

Data files are clustered by range of the clustering column (the load date), so its
ranges in the manifest prune reads and give the high-water mark without reading data (it is a
date or time, whose text sorts as it does).

Keys are tested part by part: a file's keys are dealt by hash over ``PARTS`` bitmaps, a key meets
one bitmap of each file, and of a file whose range and bitmap admit none nothing is read.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a data file; bitmaps of a file, their bits (fixed by bitmap_construct_agg), and bits set by a key.
ROWS_PER_FILE, PARTS, BITS, HASHES = 200_000, 64, 32_768, 3
#: Distinct keys of a batch that are broadcast (they are counted, and short).
BROADCAST_KEYS = 1_000_000
_FILES = "path string, n bigint, low string, high string, first string, last string"


def _part(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def _positions(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITS)) for i in range(HASHES)]


def _has_bit(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


@dataclass
class ManifestTable:
    """One table: its folder, key column and clustering column."""

    spark: SparkSession
    base: str
    key: str
    cluster: str = "ingestion_date"
    rows_per_file: int = ROWS_PER_FILE

    def __post_init__(self):
        self.base = self.base.rstrip("/")

    # ------------------------------------------------------------ versions
    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _conf(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def version(self) -> int:
        """The newest version; 0 for a table without any."""
        folder = self._path(f"{self.base}/manifest")
        fs = folder.getFileSystem(self._conf())
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(n[2:]) for n in names if n.startswith("v=")), default=0)

    def has_version(self, version: int) -> bool:
        path = self._path(f"{self.base}/manifest/v={version:08d}")
        return path.getFileSystem(self._conf()).exists(path)

    def files(self, version: int | None = None) -> DataFrame:
        """The files of a version (the newest one by default)."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], _FILES)
        return self.spark.read.schema(_FILES).parquet(f"{self.base}/manifest/v={version:08d}/files")

    def _read_files(self, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.base}/{p}" for p in paths])

    def schema(self, version: int | None = None) -> T.StructType:
        version = self.version() if version is None else version
        return T.StructType.fromJson(json.loads(
            self.spark.read.text(f"{self.base}/manifest/v={version:08d}/schema", wholetext=True).first()[0]))

    def read(self, version: int | None = None, since: object = None) -> DataFrame:
        """The rows of a version; with ``since`` those of files that reach that value of the clustering column, filtered."""
        version = self.version() if version is None else version
        files = self.files(version)
        if since is not None:
            files = files.where(F.col("last") >= F.lit(str(since)))
        df = self._read_files([r["path"] for r in files.select("path").orderBy("path").collect()], self.schema(version))
        return df if since is None else df.where(F.col(self.cluster) >= F.lit(since))

    def high_water_mark(self):
        """The greatest value of the clustering column, from the manifest."""
        top = self.files().agg(F.max("last").alias("last")).first()["last"]
        if top is None:
            return None
        kind = self.schema()[self.cluster].dataType
        return self.spark.range(1).select(F.lit(top).cast(kind).alias("v")).first()["v"]

    # -------------------------------------------------------------- writes
    def _store(self, df: DataFrame, folder: str, rows: int | None = None) -> DataFrame:
        """Write rows as clustered files; returns (path, key, cluster) of the rows written."""
        path = f"{self.base}/writes/{folder}"
        if rows is None:
            out = df.repartitionByRange(self.cluster, self.key)  # AQE sizes the partitions
        else:
            out = df.repartitionByRange(max(1, -(-rows // self.rows_per_file)), self.cluster, self.key)
        (out.sortWithinPartitions(self.cluster, self.key).write.mode("overwrite")
         .option("maxRecordsPerFile", self.rows_per_file).parquet(path))
        back = self.spark.read.schema(df.schema).parquet(path)
        return back.select(F.regexp_extract("_metadata.file_path", r"(writes/.*)$", 1).alias("path"),
                           F.col(self.key).cast("string").alias("key"), F.col(self.cluster).cast("string").alias("cluster"))

    def _entries(self, stored: DataFrame, write: str) -> DataFrame:
        """Manifest rows of new files; their Bloom filters are written beside them."""
        bits = stored.where("key is not null").select("path", _part(F.col("key")).alias("part"),
                                                      F.explode(F.array(*_positions(F.col("key")))).alias("bit"))
        (bits.groupBy("path", "part").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
         .write.mode("overwrite").parquet(f"{self.base}/writes/{write}/stats"))
        return stored.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"),
                                          F.min("cluster").alias("first"), F.max("cluster").alias("last"))

    def commit(self, files: DataFrame, schema: T.StructType, version: int) -> int:
        """Put a manifest in place as ``version`` by one rename that fails if there is one."""
        new = f"{self.base}/manifest/_new-{uuid.uuid4().hex}"
        files.select([c.split()[0] for c in _FILES.split(", ")]).coalesce(1).write.parquet(f"{new}/files")
        self.spark.createDataFrame([(schema.json(),)], "s string").coalesce(1).write.text(f"{new}/schema")
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        source, target = self._path(new), self._path(f"{self.base}/manifest/v={version:08d}")
        fs = source.getFileSystem(self._conf())
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self._conf())
        context.rename(source, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return version

    def append(self, df: DataFrame, version: int | None = None) -> int:
        """A version with the rows of ``df`` added; no file is rewritten."""
        before = self.version() if version is None else version - 1
        write = uuid.uuid4().hex
        entries = self._entries(self._store(df, f"{write}/rows"), write)
        return self.commit(self.files(before).union(entries), df.schema, before + 1)

    def candidates(self, keys: DataFrame, version: int) -> DataFrame:
        """Paths of the version's files that can hold a key of ``keys`` (column ``key``, distinct)."""
        files = self.files(version)
        writes = [r[0] for r in files.select(F.regexp_extract("path", r"writes/([^/]+)/", 1)).distinct().collect()]
        if not writes:
            return files.select("path").limit(0)
        stats = self.spark.read.schema("path string, part int, bitmap binary").parquet(*[f"{self.base}/writes/{w}/stats" for w in writes])
        bitmaps = stats.join(F.broadcast(files.select("path", "low", "high")), "path")  # one short row a file
        tested = keys.where("key is not null").withColumn("part", _part(F.col("key")))
        admits = (F.col("key") >= F.col("low")) & (F.col("key") <= F.col("high"))
        for position in _positions(F.col("key")):
            admits = admits & _has_bit(F.col("bitmap"), position)
        return tested.join(bitmaps, "part").where(admits).select("path").distinct()

    def merge(self, batch: DataFrame, version: int | None = None) -> int:
        """A version in which the rows of ``batch`` take the place of all rows of their keys.

        Rows without a key are added and replace nothing; repeated keys of a batch are all kept."""
        before = self.version() if version is None else version - 1
        if not before:
            return self.append(batch, before + 1)
        write = uuid.uuid4().hex
        stored = self._store(batch, f"{write}/rows")
        keys = stored.select("key").distinct()
        hit = self.candidates(keys, before)
        files = self.files(before).join(F.broadcast(hit.withColumn("hit", F.lit(True))), "path", "left")
        touched = files.where("hit").select("path", "n").orderBy("path").collect()
        if touched:
            few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
            gone = keys.withColumnRenamed("key", "__gone")
            kept = self._read_files([r["path"] for r in touched], batch.schema).join(
                F.broadcast(gone) if few else gone, F.col(self.key).cast("string") == F.col("__gone"), "left_anti")
            stored = stored.union(self._store(kept, f"{write}/kept", sum(r["n"] for r in touched)))
        entries = self._entries(stored, write)
        return self.commit(files.where("hit is null").drop("hit").union(entries), batch.schema, before + 1)
