"""Session settings, the shared working folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(name: str = "millrace", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a folder of this machine.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(CHECKPOINT_DIR, base)
    return base


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, for tables and stream checkpoints."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Loops keep short plans, a lost executor never re-runs earlier rounds, and what
    several branches read is computed once.  Unlike a checkpoint the table keeps its
    columns apart, so each branch reads only those it needs.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
