"""Model registry and the per-run context that resolves ``ref(name)``.

Each model is a plain function ``Pipeline -> DataFrame`` registered under its
name.  ``ref`` memoises the (lazy) DataFrame, so a whole run — silver, gold,
platinum — is one family of logical plans that Catalyst optimises end to end;
nothing is materialised unless :meth:`Pipeline.materialize` is asked to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from finspark.config import PipelineConfig

MODELS: dict[str, Callable[["Pipeline"], DataFrame]] = {}
AUDIT_COLUMNS = ("bronze_loaded_at", "silver_loaded_at", "gold_loaded_at")


def model(name: str):
    def register(fn: Callable[["Pipeline"], DataFrame]):
        MODELS[name] = fn
        return fn
    return register


def _load_models() -> None:
    # Importing the layer modules fills MODELS.
    from finspark.operators import bronze, gold, platinum, silver, views  # noqa: F401


class Pipeline:
    def __init__(self, spark: SparkSession, sf_dir: str, config: PipelineConfig | None = None,
                 overrides: dict[str, DataFrame] | None = None, checkpoint: tuple[str, ...] = ()):
        """``checkpoint`` names models (or layer prefixes such as ``"silver_"``)
        to materialise in the shared checkpoint folder the first time they are
        referenced, so runs that build many models on top of them read them
        once instead of re-deriving them in every branch."""
        _load_models()
        self.spark = spark
        self.sf_dir = sf_dir
        self.config = config or PipelineConfig()
        self._memo: dict[str, DataFrame] = dict(overrides or {})
        self._checkpoint = tuple(checkpoint)
        # Metrics of a finished run and the models they cover (finspark.plans.metrics).
        self.metrics: DataFrame | None = None
        self.measured: set[str] = set()

    def ref(self, name: str) -> DataFrame:
        if name not in self._memo:
            if name not in MODELS:
                raise KeyError(f"unknown model {name!r}")
            df = MODELS[name](self)
            if any(name == c or (c.endswith("_") and name.startswith(c)) for c in self._checkpoint):
                df = df.checkpoint(eager=True)
            self._memo[name] = df
        return self._memo[name]

    @classmethod
    def from_materialized(cls, spark: SparkSession, sf_dir: str, out: str, layers=("silver", "gold", "platinum"),
                          config: PipelineConfig | None = None) -> "Pipeline":
        """A pipeline whose models of ``layers`` are read from ``out/<layer>/<model>``
        (as written by :func:`finspark.plans.run.build_all`); models not found
        there, and everything upstream of them, are still derived.  Checks of models
        that the run has measured read its metrics."""
        from finspark.plans.catalog import LAYER_MODELS
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        found = {}
        for layer in layers:
            for m in LAYER_MODELS[layer]:
                path = f"{out.rstrip('/')}/{layer}/{m}"
                hp = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
                if hp.getFileSystem(conf).exists(hp):
                    found[m] = spark.read.parquet(path)
        from finspark.plans.metrics import use_metrics
        return use_metrics(cls(spark, sf_dir, config, overrides=found), f"{out.rstrip('/')}/metrics")

    @classmethod
    def from_raw_files(cls, spark: SparkSession, raw_path: str, fmt: str = "csv",
                       config: PipelineConfig | None = None, file_pattern: str | None = None) -> "Pipeline":
        """A pipeline over raw entity files ``<raw_path>/<entity>.<fmt>`` (a
        file or a folder of parts) in CSV, JSON lines or parquet, read with
        the fixed schemas."""
        from finspark.sources.files import ENTITY_SCHEMAS, read_entity
        pattern = file_pattern or "{entity}." + fmt
        overrides = {f"raw_{e}": read_entity(spark, f"{raw_path.rstrip('/')}/{pattern.format(entity=e)}", e, fmt)
                     for e in ENTITY_SCHEMAS}
        return cls(spark, raw_path, config, overrides=overrides)

    @classmethod
    def from_raw_csv(cls, spark: SparkSession, raw_path: str, config: PipelineConfig | None = None,
                     file_pattern: str = "{entity}.csv") -> "Pipeline":
        """A pipeline over raw entity CSV files (``<raw_path>/<entity>.csv``)."""
        return cls.from_raw_files(spark, raw_path, "csv", config, file_pattern)

    def raw(self, entity: str) -> DataFrame:
        return self.ref(f"raw_{entity}")

    def override(self, name: str, df: DataFrame) -> None:
        """Swap in a materialised or hand-made relation for a model (call
        before anything downstream of it has been resolved)."""
        self._memo[name] = df

    def materialize(self, name: str, path: str, mode: str = "overwrite") -> DataFrame:
        """Write a model to ``path`` (parquet) and re-read it, cutting lineage
        for the models built on top of it."""
        self.ref(name).write.mode(mode).parquet(path)
        df = self.spark.read.parquet(path)
        self._memo[name] = df
        return df


def for_output(df: DataFrame) -> DataFrame:
    """Drop audit timestamps and render exact decimals as DOUBLE."""
    cols = []
    for f in df.schema.fields:
        if f.name in AUDIT_COLUMNS:
            continue
        if f.dataType.typeName() == "decimal":
            cols.append(df[f.name].cast("double").alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)
