"""Silver kept current: only keys with new facts are recomputed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.operators.dedup import PERIOD_KEY
from factloom.plans.silver import silver_financials

MERGED = "merged_to"


def keep_latest(facts: DataFrame, changes_path: str, checkpoint: str) -> StreamingQuery:
    """Maintain the resolved row of every key over a stream of extracted facts.

    The resolution is an aggregation of maxima, so its state is one small row per key;
    each micro-batch combines into it and writes the changed rows to a change log. A
    replayed batch overwrites its own folder and leaves the log as it was.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes_path}/log/batch_id={batch_id}")

    return (
        silver_financials(facts)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_table(spark: SparkSession, changes_path: str) -> DataFrame:
    """The newest row of each key: the last compaction and the batches after it."""
    files = _Folder(spark, changes_path)
    merged = files.last_merged()
    changes = None
    if any(b > merged for b in files.batches()):
        changes = spark.read.parquet(f"{changes_path}/log").filter(F.col("batch_id") > merged)
    if merged >= 0:
        base = spark.read.parquet(f"{changes_path}/{MERGED}={merged}").withColumn(
            "batch_id", F.lit(merged)
        )
        changes = base if changes is None else base.unionByName(changes)
    columns = [c for c in changes.columns if c not in (*PERIOD_KEY, "batch_id")]
    newest = changes.groupBy(*PERIOD_KEY).agg(
        F.max(F.struct("batch_id", *columns)).alias("r")
    )
    return newest.select(*PERIOD_KEY, *[F.col(f"r.{c}").alias(c) for c in columns])


def compact(spark: SparkSession, changes_path: str) -> int:
    """Merge the log up to its last batch into one table; returns that batch.

    Run it between runs of the stream. The merged table counts once it is complete; then the
    batches in it and the table before it go, so what is kept does not grow with the batches.
    """
    files = _Folder(spark, changes_path)
    before, last = files.last_merged(), max(files.batches(), default=-1)
    if last <= before:
        return before
    current_table(spark, changes_path).write.mode("overwrite").parquet(
        f"{changes_path}/{MERGED}={last}"
    )
    for batch in files.batches():
        if batch <= last:
            files.remove(f"log/batch_id={batch}")
    if before >= 0:
        files.remove(f"{MERGED}={before}")
    return last


class _Folder:
    """What a change log's folder holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.paths = spark._jvm.org.apache.hadoop.fs
        self.root = self.paths.Path(path)
        self.files = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _numbers(self, pattern: str) -> list[int]:
        found = self.files.globStatus(self.paths.Path(self.root, pattern)) or []
        # Only complete ones carry the mark.
        return sorted(int(f.getPath().getParent().getName().rpartition("=")[2]) for f in found)

    def batches(self) -> list[int]:
        return self._numbers("log/batch_id=*/_SUCCESS")

    def last_merged(self) -> int:
        return max(self._numbers(f"{MERGED}=*/_SUCCESS"), default=-1)

    def remove(self, name: str) -> None:
        self.files.delete(self.paths.Path(self.root, name), True)
