"""Session construction and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def build_session(app: str = "tidemark", cores: str = "8", **conf: str) -> SparkSession:
    """Local session used by tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Recording the Python call site of every expression makes wide plans slow to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local-mode session that names none (tests) gets a temporary folder, once.
    On a cluster a missing setting is an error: a machine-local folder would be
    lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage in a way that survives executor loss, and gives the planner
    the table's true size, so that a join against it is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """:func:`written`, with the row count observed while writing."""
    seen = Observation()
    table = written(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return table, seen.get["n"]
