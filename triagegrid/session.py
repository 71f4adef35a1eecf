"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "triagegrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the report plans expect; cluster sizing is left to the caller.

    Wide report rows make long generated methods, which HotSpot leaves uncompiled by default. A local session lifts that
    limit; on a cluster the same flag belongs in ``spark.executor.extraJavaOptions``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach. A temporary one is made only for a local session."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    current = context.getCheckpointDir()
    if current is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="triagegrid-"))
        current = context.getCheckpointDir()
    return current


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, so that no run overwrites what another one reads."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of executors and later readers do not recompute."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Files of a stored table for each core of the cluster, at most.
FILES_PER_CORE = 6


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Rows written below the shared folder and read back: cut lineage, columnar, and prunable by each reader.

    Partitions beyond a few per core are written by one task after the other, as every small file costs calls to the file system.
    ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.coalesce(FILES_PER_CORE * spark.sparkContext.defaultParallelism).write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
