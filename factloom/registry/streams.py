"""Streaming jobs run to the end of their input, then read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.plans.refresh import refresh_silver
from factloom.plans.silver import SILVER_COLUMNS, facts_from_rows
from factloom.registry.base import fact_documents, query, rows, sql
from factloom.registry.silver import _SILVER_SQL
from factloom.session import shared_path
from factloom.sources import seeds
from factloom.sources.documents import concept_count, fold_fact_documents, land_documents
from factloom.sources.layers import LayerStore
from factloom.sources.tables import facts_from_orders, put_files, table
from factloom.streaming.landing import (
    document_stream,
    land_changed,
    land_stream,
    landed,
    newest_versions,
    read_ledger,
)
from factloom.streaming.latest import compact, current_table, keep_latest
from factloom.streaming.monitor import (
    append_to,
    arrival_windows,
    count_arrivals,
    silences,
    suppress_repeats,
)


def _table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


@query("stream_landing", sql("""
    SELECT CAST(CAST(cik AS BIGINT) AS VARCHAR) AS cik_raw, entity_name,
           count(DISTINCT part) AS documents, count(DISTINCT (part, raw_concept)) AS concepts
    FROM filing_rows GROUP BY ALL""", "filing_rows"))
def stream_landing(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_path(spark, "landing")
    land_documents(fact_documents(spark, folder), f"{root}/in")
    arriving = document_stream(spark, f"{root}/in", multi_line=False)
    land_stream(arriving, f"{root}/bronze", f"{root}/checkpoint").awaitTermination()
    return landed(spark, f"{root}/bronze").groupBy("cik_raw", "entity_name").agg(
        F.count("facts_blob").alias("documents"),
        F.sum(concept_count("facts_blob")).alias("concepts"),
    )


@query("stream_latest_per_key", sql(f"{_SILVER_SQL} FROM silver", "silver"))
def stream_latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_path(spark, "latest")
    orders = _table_stream(spark, folder, "orders")
    arriving = facts_from_orders(orders, table(spark, folder, "customer"))
    facts = facts_from_rows(arriving, seeds.synonyms(spark))
    keep_latest(facts, f"{root}/changes", f"{root}/checkpoint").awaitTermination()
    compact(spark, f"{root}/changes")
    return current_table(spark, f"{root}/changes").select(*SILVER_COLUMNS)


@query("stream_arrival_windows", """
    SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_seconds, event_type,
           count(*) AS arrivals
    FROM events GROUP BY ALL""")
def stream_arrival_windows(spark: SparkSession, folder: str) -> DataFrame:
    root = shared_path(spark, "arrivals")
    events = _table_stream(spark, folder, "events")
    count_arrivals(events, f"{root}/counts", f"{root}/checkpoint", "ts", ["event_type"]).awaitTermination()
    return arrival_windows(spark, f"{root}/counts", ["event_type"]).select(
        F.unix_seconds("window_start").alias("window_seconds"), "event_type", "arrivals"
    )


# Fixed value of the fixture: micro-batches that the events arrive in.
ARRIVAL_BATCHES = 12


@query("late_arrivals", f"""
    WITH delivered AS (
        SELECT ts, event_type, CASE WHEN event_id % 10 = 0 THEN {ARRIVAL_BATCHES} - 1
               ELSE event_id % {ARRIVAL_BATCHES} END AS batch FROM events),
    highest AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING) AS before FROM delivered GROUP BY batch)
    SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS window_seconds, event_type,
           count(*) AS arrivals,
           CAST(sum(coalesce(ts < before - INTERVAL 1 HOUR, false)::INT) AS BIGINT) AS late
    FROM delivered JOIN highest USING (batch) GROUP BY ALL""")
def late_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Events delivered out of order over several micro-batches, a tenth of them in the last."""
    root = shared_path(spark, "late")
    events = table(spark, folder, "events").select("event_id", "ts", "event_type")
    last = F.lit(ARRIVAL_BATCHES - 1)
    batch = F.when(F.col("event_id") % 10 == 0, last).otherwise(F.col("event_id") % ARRIVAL_BATCHES)
    put_files(spark, events.withColumn("batch", batch.cast("int")), "batch", f"{root}/in")
    stream = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    )
    count_arrivals(stream, f"{root}/counts", f"{root}/checkpoint", "ts", ["event_type"]).awaitTermination()
    return arrival_windows(spark, f"{root}/counts", ["event_type"]).select(
        F.unix_seconds("window_start").alias("window_seconds"), "event_type", "arrivals", "late"
    )


# Fixed value of the fixture: ranges of keys whose documents share a file, one of each filer.
PARTS_PER_FILE = 2


def _in_files(documents: DataFrame) -> DataFrame:
    """(file, value): documents dealt into files of a bounded number of documents."""
    file = F.floor(F.col("part") / PARTS_PER_FILE).cast("int")
    return documents.select(file.alias("file"), F.col("document").alias("value"))


def _arrive(spark: SparkSession, files: DataFrame, root: str) -> None:
    """Put files in place, or in the place of older ones, and land what is due."""
    put_files(spark, files, "file", f"{root}/in", "text")
    land_changed(spark, f"{root}/in", f"{root}/bronze", multi_line=False, pattern="*")


@query("stream_versions", sql("""
    SELECT CAST(CAST(cik AS BIGINT) AS VARCHAR) AS cik_raw, entity_name, 2 * count(DISTINCT part) AS versions,
           count(DISTINCT part) AS newest, count(DISTINCT (part, raw_concept)) AS concepts
    FROM filing_rows GROUP BY ALL""", "filing_rows"))
def stream_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's file is replaced in place by one with all its concepts."""
    root = shared_path(spark, "versions")
    whole = fact_documents(spark, folder)
    empty = F.regexp_replace("document", '"us-gaap":.*$', '"us-gaap":{}}}')
    for version in (whole.withColumn("document", empty), whole):
        _arrive(spark, _in_files(version), root)
    good = landed(spark, f"{root}/bronze")
    counted = good.groupBy("cik_raw", "entity_name").agg(F.count(F.lit(1)).alias("versions"))
    newest = newest_versions(good).groupBy("cik_raw", "entity_name").agg(
        F.count(F.lit(1)).alias("newest"), F.sum(concept_count("facts_blob")).alias("concepts")
    )
    return counted.join(newest, ["cik_raw", "entity_name"])


@query("stream_refresh", sql(f"""
    {_SILVER_SQL}, normalized_value FROM (
        SELECT s.*, a.reported_value AS normalized_value FROM silver s
        JOIN superseded a ON a.cik = s.cik AND a.canonical_concept = s.canonical_concept
             AND a.period_end = s.period_end AND a.base_form = regexp_replace(s.form_type, '/A$', ''))
    WHERE raw_concept IN (SELECT synonym_tag FROM synonyms)""", "silver", "superseded"))
def stream_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Silver after half of the files were replaced by versions that say something else.

    The first versions of those files lack a third of the facts, have wrong values and later
    filing dates in another third, and hold facts of periods that the second versions do not.
    So keys come in, change back and go; silver must be as if only the last versions had been.
    """
    root = shared_path(spark, "refresh")
    store = LayerStore(spark, f"{root}/tables")
    final = rows(spark, folder)
    replaced = F.floor(F.col("part") / PARTS_PER_FILE) % 2 == 0
    kind = F.col("accession_number").cast("bigint") % 3
    wrong = F.when(replaced & (kind == 1), F.col("reported_value") + 1e6).otherwise(F.col("reported_value"))
    late = F.when(replaced & (kind == 1), F.date_add("filed_date", 1000)).otherwise(F.col("filed_date"))
    first = final.filter(~replaced | (kind != 0)).withColumns({"reported_value": wrong, "filed_date": late})
    unknown = final.filter(replaced & (kind == 2)).withColumn("period_end", F.add_months("period_end", 480))
    _arrive(spark, _in_files(fold_fact_documents(first.unionByName(unknown))), root)
    seed = seeds.synonyms(spark)
    refresh_silver(spark, store, f"{root}/bronze", seed)
    _arrive(spark, _in_files(fold_fact_documents(final.filter(replaced))), root)
    return refresh_silver(spark, store, f"{root}/bronze", seed).select(*SILVER_COLUMNS, "normalized_value")


@query("ledger_summary", sql("""
    SELECT run,
           CASE WHEN run = 1 AND NOT replaced THEN 'skipped'
                WHEN run = 0 AND damaged THEN 'failed' ELSE 'fetched' END AS status,
           CASE WHEN damaged AND (run = 0 OR NOT replaced) THEN 'malformed' END AS error, count(*) AS documents
    FROM (SELECT DISTINCT cik, part, CAST(cik AS BIGINT) % 5 = 2 AS damaged, (part // :parts) % 2 = 0 AS replaced
          FROM filing_rows), (VALUES (0), (1)) AS runs(run)
    GROUP BY ALL""".replace(":parts", str(PARTS_PER_FILE)), "filing_rows"))
def ledger_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs: documents of every fifth filer are cut off, then half of the files are mended."""
    root = shared_path(spark, "ledger")
    whole = fact_documents(spark, folder)
    cut = F.when(F.col("cik").cast("bigint") % 5 == 2, F.left("document", F.length("document") - 3))
    _arrive(spark, _in_files(whole.withColumn("document", F.coalesce(cut, "document"))), root)
    _arrive(spark, _in_files(whole).filter(F.col("file") % 2 == 0), root)
    attempts = read_ledger(spark, f"{root}/bronze")
    return attempts.groupBy(F.col("run").cast("int").alias("run"), "status", "error").agg(
        F.sum("documents").alias("documents")
    )


# Fixed values of the fixture: sources that stop, and when.
STOPPED, STOPPED_AT = 10, "2024-01-20"


@query("stream_silence", f"""
    WITH arrivals AS (
        SELECT user_id, CASE WHEN event_type IN ('view', 'click') THEN 'submissions' ELSE 'facts' END AS kind, ts
        FROM events WHERE user_id % {STOPPED} <> 0 OR ts < TIMESTAMP '{STOPPED_AT}'),
    begun AS (SELECT *, coalesce(ts > lag(ts) OVER w + INTERVAL 25 HOUR, true)::INT AS opens
              FROM arrivals WINDOW w AS (PARTITION BY user_id, kind ORDER BY ts)),
    stretches AS (SELECT *, sum(opens) OVER (PARTITION BY user_id, kind ORDER BY ts) AS stretch FROM begun)
    SELECT kind, user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS arrivals
    FROM stretches GROUP BY kind, user_id, stretch
    HAVING max(ts) + INTERVAL 26 HOUR <= (SELECT max(ts) FROM arrivals)""")
def stream_silence(spark: SparkSession, folder: str) -> DataFrame:
    """Filers and kinds of document that fell silent for over 25 hours; every tenth filer stops."""
    root = shared_path(spark, "silence")
    kind = F.when(F.col("event_type").isin("view", "click"), "submissions").otherwise("facts")
    events = table(spark, folder, "events").select("user_id", kind.alias("kind"), F.col("ts").cast("timestamp").alias("ts"))
    events = events.filter((F.col("user_id") % STOPPED != 0) | (F.col("ts") < F.lit(STOPPED_AT).cast("timestamp")))
    week = F.floor(F.unix_seconds("ts") / (7 * 86400)).cast("int")
    put_files(spark, events.withColumn("week", week), "week", f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    append_to(silences(stream, "ts", ["kind", "user_id"]), f"{root}/silences", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/silences").select(
        "kind", "user_id", F.unix_micros("first_seen").alias("first_us"), F.unix_micros("last_seen").alias("last_us"),
        "arrivals",
    )


@query("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event is delivered twice, as overlapping polls do; one delivery survives."""
    root = shared_path(spark, "dedup")
    delivered = _table_stream(spark, folder, "events").withColumn(
        "delivery", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    unique = suppress_repeats(delivered, "ts", ["event_id"])
    append_to(
        unique.select("event_id", "user_id", "event_type", "value"),
        f"{root}/events", f"{root}/checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/events")
