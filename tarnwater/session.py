"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "tarnwater", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect: UTC and adaptive execution."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="tarnwater-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage, fixes values that depend on row order or partition
    ids, and survives the loss of any executor."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan with fewer splits than cores one partition per core, by the hash of a unique key; work per row that
    is heavy would otherwise sit in a few tasks. A scan of a large table has more splits than that and is left alone.
    Call it on scans and projections of scans: the split count is known there without running a job."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() * 2 > cores:
        return df
    return df.repartition(cores, *keys)


def gather(df: DataFrame, per_core: int = 2) -> DataFrame:
    """At most ``per_core`` partitions a core, without a shuffle: for rows that a fit reads in hundreds of rounds, where every partition sends
    its task result to the driver in every round. The number doesn't grow with the rows."""
    return df.coalesce(per_core * df.sparkSession.sparkContext.defaultParallelism)


def row_bound(df: DataFrame) -> int | None:
    """Upper bound of the row count as the analysed plan proves it (a limit, a global aggregate), or None. Runs no job."""
    bound = df._jdf.queryExecution().analyzed().maxRows()
    return int(bound.get()) if bound.isDefined() else None


class Tables:
    """Parquet tables of one directory, read on attribute access: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")
