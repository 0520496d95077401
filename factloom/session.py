"""Session and shared-folder helpers for jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "factloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Recording the call site of every column expression costs several round trips
        # to the JVM each; error messages without it still name the expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="factloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path of its own for one run, below the shared folder."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a relation that several steps read to the shared folder and read it back.

    The steps then start from storage: nothing is computed twice, and a lost executor
    costs the step at hand instead of everything before it.
    """
    path = shared_path(spark, name)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(spark: SparkSession, *relations: DataFrame) -> None:
    """Delete what `stored` wrote, once nothing that will still be computed reads it."""
    for relation in relations:
        path = spark._jvm.org.apache.hadoop.fs.Path(relation._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
