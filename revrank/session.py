"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cores: str = "8", partitions: int = 8, app: str = "revrank") -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for written tables."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; invent a folder only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="revrank-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def cores(spark: SparkSession) -> int:
    """At least so many partitions keep every core busy."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def cut(df: DataFrame, read_as: StructType | None = None) -> DataFrame:
    """Write ``df`` to the checkpoint folder, forget its lineage, read it back.

    The files outlive the executors, so a lost executor costs a re-read, not a re-run of
    everything before. A written table is taken instead of ``checkpoint()`` because it has
    its true size: a checkpoint keeps the estimate of the plan before it, and estimates
    multiply at every join, so after a few epochs they are numbers too long to compute with.
    Readers also get only the columns they use. ``read_as`` names other types for the same
    stored fields.
    """
    return df.sparkSession.read.schema(read_as or df.schema).parquet(write_table(df))


def write_table(df: DataFrame) -> str:
    """The folder of ``df``, written in the checkpoint folder, for tables that are read under several types."""
    path = f"{checkpoint_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def cut_wide(df: DataFrame, read_as: StructType | None = None) -> DataFrame:
    """``cut`` into at least one partition per core, for work that is heavy per row.

    Adaptive execution sizes partitions by bytes; model fitting needs them by cores.
    """
    return cut(df.repartition(cores(df.sparkSession)), read_as)
