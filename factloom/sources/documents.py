"""Reading, checking and landing JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from factloom.functions import pad_identifier
from factloom.params import DEFAULTS, Params
from factloom.schemas import CORRUPT, FACTS_DOCUMENT, SUBMISSIONS_DOCUMENT
from factloom.sources import discovery


GOOD, REJECTED = "good", "rejected"

# A file read by this separator is one record: its zero characters stand in no JSON text.
WHOLE_FILE = "\0" * 8 + "\1"


def records(reader: DataFrameReader | DataStreamReader, multi_line: bool) -> DataFrameReader | DataStreamReader:
    """Reads JSON by file or by line.

    A file, in UTF-8, is read as one long line. In Spark's own multi-line mode every number or raw object
    that becomes text is fetched from the file again, which opens it anew.
    """
    return reader.option("lineSep", WHOLE_FILE) if multi_line else reader


def _landed_with(documents: DataFrame) -> list[str]:
    """Columns that a landed document keeps where its reading or judging gave them."""
    judged = ("status", "reason", CORRUPT) if "status" in documents.columns else ()
    return [c for c in ("source_path", "source_modified_at", *judged) if c in documents.columns]


def read_fact_documents(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    """One row per document with `facts` kept as raw JSON text.

    `multi_line` reads one (possibly indented) object per file; switch it off for files
    with one object per line, which split into many tasks.
    """
    return (
        records(spark.read.schema(FACTS_DOCUMENT), multi_line).json(path)
        .withColumn("source_path", F.col("_metadata.file_path"))
        .withColumn("source_modified_at", F.col("_metadata.file_modification_time"))
        .withColumn("source_bytes", F.col("_metadata.file_size"))
    )


def read_submission_documents(
    spark: SparkSession, path: str | list[str], multi_line: bool = True
) -> DataFrame:
    return (
        records(spark.read.schema(SUBMISSIONS_DOCUMENT), multi_line).json(path)
        .withColumn("source_path", F.col("_metadata.file_path"))
        .withColumn("source_modified_at", F.col("_metadata.file_modification_time"))
    )


def discovered_submissions(
    spark: SparkSession, path: str | list[str], whole_files: bool = True
) -> DataFrame:
    """As `read_submission_documents`, with the columns that the documents turn out to have.

    The declared columns come in their declared types, null where no document has them; every
    other column that some document has stands beside them in the type found.
    """
    texts = discovery.read_texts(spark, path, whole_files)
    found = discovery.read_with(texts, discovery.discover_schema(texts))
    return discovery.aligned(found, SUBMISSIONS_DOCUMENT)


def rejection_reason(params: Params = DEFAULTS) -> Column:
    """Why a fact document cannot be used; null for good ones. Reads column `gaap`, its concepts.

    An object that repeats a concept key has no single reading, so it is set aside too.
    """
    concepts = F.map_keys("gaap")
    # Only looked at where no concepts came out: absent is fine, present is not.
    present = F.get_json_object("facts", "$['us-gaap']").isNotNull()
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(F.col("facts").isNull(), "missing facts")
        .when(~F.ltrim("facts").startswith("{"), "facts is no object")
    )
    if params.max_object_bytes is not None:
        reason = reason.when(F.octet_length("facts") > params.max_object_bytes, "too large")
    return reason.when(F.col("gaap").isNull() & present, "taxonomy is no object").when(
        F.size(concepts) > F.size(F.array_distinct(concepts)), "repeated concept"
    )


def judge_documents(documents: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Documents with `reason` (null when good) and `status`, good or rejected.

    Writing the outcome partitioned by status separates the two in one read of the input.
    """
    read = documents.withColumn("gaap", F.from_json("facts", "`us-gaap` MAP<STRING, STRING>")["us-gaap"])
    return _with_status(read.withColumn("reason", rejection_reason(params)).drop("gaap"))


def judge_submissions(documents: DataFrame) -> DataFrame:
    """As `judge_documents`, for company metadata: it must be readable and name its company."""
    known = F.col("cik").try_cast("bigint").isNotNull()
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed").when(~known, "missing cik")
    return _with_status(documents.withColumn("reason", reason))


def _with_status(judged: DataFrame) -> DataFrame:
    return judged.withColumn("status", F.when(F.col("reason").isNull(), GOOD).otherwise(REJECTED))


def split_documents(
    documents: DataFrame, params: Params = DEFAULTS
) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined); every document is in exactly one of the two."""
    judged = judge_documents(documents, params)
    good = judged.filter(F.col("status") == GOOD).drop("reason", "status", CORRUPT)
    return good, judged.filter(F.col("status") == REJECTED).drop("status")


def parse_document_text(texts: DataFrame, text: str = "document") -> DataFrame:
    """Documents that already are a text column, in the shape of `read_fact_documents`."""
    parsed = F.from_json(text, FACTS_DOCUMENT, {"columnNameOfCorruptRecord": CORRUPT})
    return texts.withColumn("_doc", parsed).select(
        *[c for c in texts.columns if c != text], "_doc.*"
    )


def concept_count(facts: Column | str = "facts") -> Column:
    """Concepts in one facts blob; 0 when the taxonomy is absent."""
    blob = F.col(facts) if isinstance(facts, str) else facts
    return F.coalesce(F.size(F.json_object_keys(F.get_json_object(blob, "$['us-gaap']"))), F.lit(0))


def raw_company_facts(documents: DataFrame) -> DataFrame:
    """Bronze fact documents: identifier unpadded, blob untouched."""
    return documents.select(
        F.col("cik").try_cast("bigint").cast("string").alias("cik_raw"),
        F.col("entityName").alias("entity_name"),
        F.col("facts").alias("facts_blob"),
        F.octet_length("facts").alias("facts_bytes"),
        F.current_timestamp().alias("loaded_at"),
        *_landed_with(documents),
    )


def raw_submissions(documents: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Bronze company metadata; tickers and exchanges stay arrays."""
    return documents.select(
        F.col("cik").try_cast("bigint").cast("string").alias("cik_raw"),
        F.col("name").alias("company_name_raw"),
        F.col("sic").alias("sic_raw"),
        F.col("sicDescription").alias("sic_description_raw"),
        F.col("stateOfIncorporation").alias("state_of_incorporation_raw"),
        F.col("tickers").alias("tickers_raw"),
        F.col("exchanges").alias("exchanges_raw"),
        F.col("filings").alias("filings_blob"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("loaded_at"),
        *_landed_with(documents),
    )


def fold_fact_documents(facts: DataFrame, part: str = "part") -> DataFrame:
    """Fact rows folded to one document per (cik, part).

    `part` bounds a document: without it a company with very many rows would have to fit
    into one group. One exchange serves the three nested aggregations.
    """
    entry = F.struct(
        F.col("reported_value").alias("val"),
        F.col("period_start").alias("start"),
        F.col("period_end").alias("end"),
        F.col("accession_number").alias("accn"),
        F.col("form_raw").alias("form"),
        F.col("filed_date").alias("filed"),
        F.col("fiscal_period_label").alias("fp"),
    )
    document = ["cik", "entity_name", part]
    by_unit = (
        facts.repartition("cik", part)
        .groupBy(*document, "raw_concept", "unit")
        .agg(F.collect_list(entry).alias("entries"))
    )
    by_concept = by_unit.groupBy(*document, "raw_concept").agg(
        F.struct(
            F.map_from_entries(F.collect_list(F.struct("unit", "entries"))).alias("units")
        ).alias("concept")
    )
    folded = by_concept.groupBy(*document).agg(
        F.map_from_entries(F.collect_list(F.struct("raw_concept", "concept"))).alias("us-gaap")
    )
    return folded.select(
        "cik",
        part,
        F.to_json(
            F.struct(
                F.col("cik").cast("bigint").alias("cik"),
                F.col("entity_name").alias("entityName"),
                F.struct("us-gaap").alias("facts"),
            )
        ).alias("document"),
    )


def land_documents(texts: DataFrame, path: str, text: str = "document") -> None:
    """Write one object per line; read back with `multi_line=False`."""
    texts.select(F.col(text).alias("value")).write.mode("overwrite").text(path)


def document_sizes(documents: DataFrame, text: str, *by: str) -> DataFrame:
    """Count, total and largest size of the documents in each group."""
    size = F.octet_length(text)
    return documents.groupBy(*by).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(size).alias("total_bytes"),
        F.max(size).alias("max_bytes"),
        (F.sum(size) / 1048576.0).alias("total_mb"),
    )


def split_oversize(documents: DataFrame, text: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """(within the limit, over it) by size in bytes; a null text is within."""
    over = F.coalesce(F.octet_length(text) > limit, F.lit(False))
    return documents.filter(~over), documents.filter(over)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """cik and last landing time, from files named by identifier."""
    stem = F.regexp_extract(F.col("path"), r"([^/]+)\.json$", 1)
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
        .select(pad_identifier(stem).alias("cik"), F.col("modificationTime").alias("landed_at"))
    )
