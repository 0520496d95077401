"""Landing of new and changed documents: each version of a file reaches bronze once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from factloom.operators.ingest import FAILED, FETCHED, SKIPPED
from factloom.params import DEFAULTS, Params
from factloom.schemas import CORRUPT, FACTS_DOCUMENT
from factloom.sources.documents import (
    GOOD,
    REJECTED,
    judge_documents,
    raw_company_facts,
    read_fact_documents,
    records,
)
from factloom.sources.layers import WIDE_ROW_OPTIONS


def document_stream(
    spark: SparkSession, path: str, multi_line: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    reader = records(spark.readStream.schema(FACTS_DOCUMENT), multi_line)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def land_stream(
    documents: DataFrame, bronze_path: str, checkpoint: str, params: Params = DEFAULTS
) -> StreamingQuery:
    """Append what arrived since the last run and stop; bronze is partitioned by status.

    For folders in which every version is a file of its own: files are known to the
    checkpoint by path. Where a file is replaced in place, use `land_changed`. The file sink
    commits each micro-batch as a whole, so a restart adds nothing twice.
    """
    return (
        raw_company_facts(judge_documents(documents, params))
        .writeStream.format("parquet")
        .options(**WIDE_ROW_OPTIONS)
        .option("checkpointLocation", checkpoint)
        .partitionBy("status")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(bronze_path)
    )


# A version of a file.
VERSION = ("source_path", "source_modified_at")
LEDGER = (
    "run long, batch long, source_path string, source_modified_at timestamp, cik_raw string, "
    "status string, error string, documents long, attempted_at timestamp"
)


def ledger_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}-ledger"


def read_ledger(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Every attempt: a row for each document of each version of a file.

    Rows that a failed batch may have left are no part of it: a batch that is run again writes
    its own folder anew, and one without its mark is not read.
    """
    found = _batches(spark, ledger_path(bronze_path))
    if not found:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("basePath", ledger_path(bronze_path)).parquet(
        *[f"{ledger_path(bronze_path)}/batch={b}" for b in found]
    )


def land_changed(
    spark: SparkSession,
    path: str,
    bronze_path: str,
    multi_line: bool = True,
    params: Params = DEFAULTS,
    pattern: str = "*.json",
    files_at_once: int = 10_000,
) -> int:
    """Land every file of `path` that is new or was replaced since; returns how many.

    A version of a file is its path and modification time; the ledger next to bronze says which
    were attempted, and how it went: `fetched` or `failed` for each document of a file that was
    due, `skipped` for those of a file that was not. Files are landed in batches of at most
    `files_at_once`, oldest first, so the names that the driver holds are bounded. A batch
    writes its documents, then its ledger rows, each into a folder of its own; what a failed one
    left is replaced when it is run again. Only the ledger is read to tell what is due. Files of
    no bytes are not listed, so they are due once something is written to them.
    """
    started = landed_files = 0
    run = batch = max(_batches(spark, ledger_path(bronze_path)), default=-1) + 1
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select(
        "path", F.col("_metadata.file_path").alias(VERSION[0]),
        F.col("_metadata.file_modification_time").alias(VERSION[1]),
    )
    before = read_ledger(spark, bronze_path).filter(F.col("status") != SKIPPED)
    while True:
        known = read_ledger(spark, bronze_path).select(*VERSION).distinct()
        due = listed.join(known, [*VERSION], "left_anti")
        chosen = due.orderBy(VERSION[1], "path").limit(files_at_once).collect()
        skipped = before.filter(F.col("batch") < run).join(listed.select(*VERSION), [*VERSION], "left_semi")
        if not chosen:
            if not started:
                _note(spark, bronze_path, run, batch, _skip(skipped))
            return landed_files
        judged = judge_documents(read_fact_documents(spark, [r["path"] for r in chosen], multi_line), params)
        folder = f"{bronze_path}/batch={batch}"
        raw_company_facts(judged).write.mode("overwrite").options(**WIDE_ROW_OPTIONS).partitionBy(
            "status"
        ).parquet(folder)
        files = spark.createDataFrame([(r[VERSION[0]], r[VERSION[1]]) for r in chosen], listed.select(*VERSION).schema)
        rows = _outcomes(spark.read.parquet(folder), files)
        _note(spark, bronze_path, run, batch, rows if started else rows.unionByName(_skip(skipped)))
        started, batch, landed_files = 1, batch + 1, landed_files + len(chosen)


def _outcomes(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Ledger rows of a batch; a file that gave no document at all failed."""
    good = F.col("status") == GOOD
    counted = documents.groupBy(*VERSION, "cik_raw", "status", "reason").agg(
        F.count(F.lit(1)).alias("documents"), F.min("loaded_at").alias("attempted_at")
    )
    return files.join(counted, [*VERSION], "left").select(
        *VERSION, "cik_raw", F.when(good, FETCHED).otherwise(FAILED).alias("status"),
        F.when(F.col("status").isNull(), "no document").otherwise(F.col("reason")).alias("error"),
        F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("attempted_at", F.current_timestamp()).alias("attempted_at"),
    )


def _skip(known: DataFrame) -> DataFrame:
    return known.drop("run", "batch").withColumns(
        {"status": F.lit(SKIPPED), "attempted_at": F.current_timestamp()}
    )


def _note(spark: SparkSession, bronze_path: str, run: int, batch: int, rows: DataFrame) -> None:
    noted = rows.withColumn("run", F.lit(run).cast("long"))
    noted.write.mode("overwrite").parquet(f"{ledger_path(bronze_path)}/batch={batch}")


def _batches(spark: SparkSession, folder: str) -> list[int]:
    """Batches of a folder that were written to their end."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    files = paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    marks = files.globStatus(paths(folder, "batch=*/_SUCCESS")) or []
    return sorted(int(m.getPath().getParent().getName().rpartition("=")[2]) for m in marks)


def landed(spark: SparkSession, bronze_path: str, since: int | None = None) -> DataFrame:
    """The good documents of a landed table; with `since` those of later batches only."""
    return landed_rows(spark, bronze_path, since).filter(F.col("status") == GOOD).drop(
        "status", "reason", CORRUPT
    )


def landed_rows(spark: SparkSession, bronze_path: str, since: int | None = None) -> DataFrame:
    """All landed documents, rejected ones too."""
    table = spark.read.parquet(bronze_path)
    return table if since is None else table.filter(F.col("batch") > since)


def newest_versions(documents: DataFrame) -> DataFrame:
    """Of each landed file the documents of the version that landed last and was modified last."""
    version = F.struct(*[c for c in ("batch", "source_modified_at") if c in documents.columns])
    last = documents.groupBy("source_path").agg(F.max(version).alias("_last"))
    return documents.withColumn("_version", version).join(last, "source_path").filter(
        "_version = _last"
    ).drop("_version", "_last")


def versions_with_rejects(documents: DataFrame) -> DataFrame:
    """(source_path, source_modified_at) of file versions that hold rejected documents."""
    return documents.filter(F.col("status") == REJECTED).select(*VERSION).distinct()
