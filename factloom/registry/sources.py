"""Scans, landing, seeds and ingest checks."""

from __future__ import annotations

import time
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.functions import catalog, pad_identifier
from factloom.operators import ingest
from factloom.operators.extract import read_entries, unnest_all, unreadable
from factloom.params import ALL_UNITS
from factloom.plans import gold
from factloom.registry.base import fact_documents, query, rows, silver, sql
from factloom.schemas import CORRUPT, FACTS_DOCUMENT, SUBMISSIONS_DOCUMENT, all_concepts_type
from factloom.session import shared_path, stored
from factloom.sources import documents as docs
from factloom.sources import seeds
from factloom.sources.layers import LayerStore
from factloom.sources.partitions import PartitionedTable
from factloom.sources.tables import submission_documents, table


@query("src_json_blob", sql("""
    SELECT CAST(CAST(cik AS BIGINT) AS VARCHAR) AS cik_raw, entity_name,
           count(DISTINCT part) AS documents, count(DISTINCT (part, raw_concept)) AS concepts
    FROM filing_rows GROUP BY ALL""", "filing_rows"))
def src_json_blob(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "facts")
    docs.land_documents(fact_documents(spark, folder), path)
    bronze = docs.raw_company_facts(docs.read_fact_documents(spark, path, multi_line=False))
    return bronze.groupBy("cik_raw", "entity_name").agg(
        F.count("facts_blob").alias("documents"),
        F.sum(docs.concept_count("facts_blob")).alias("concepts"),
    )


@query("src_json_submissions", sql("""
    SELECT CAST(c_custkey AS VARCHAR) AS cik_raw, company_name AS company_name_raw,
           sic_code AS sic_raw, sic_description AS sic_description_raw,
           state_of_incorporation AS state_of_incorporation_raw, primary_ticker,
           CASE WHEN primary_ticker IS NULL THEN 0 ELSE 2 END AS tickers
    FROM submissions""", "submissions"))
def src_json_submissions(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "submissions")
    docs.land_documents(submission_documents(spark, folder), path)
    raw = docs.raw_submissions(docs.read_submission_documents(spark, path, multi_line=False))
    return raw.select(
        "cik_raw", "company_name_raw", "sic_raw", "sic_description_raw",
        "state_of_incorporation_raw",
        F.try_element_at("tickers_raw", F.lit(1)).alias("primary_ticker"),
        F.size("tickers_raw").alias("tickers"),
    )


@query("src_json_files", sql("""
    SELECT CAST(CAST(cik AS BIGINT) AS VARCHAR) AS cik_raw, entity_name,
           count(DISTINCT raw_concept) AS concepts, count(*) AS entries
    FROM filing_rows GROUP BY ALL""", "filing_rows"))
def src_json_files(spark: SparkSession, folder: str) -> DataFrame:
    """One indented object per file, read whole; a company has many files."""
    files = fact_files(spark, folder, PARTS_PER_OBJECT)
    bronze = docs.raw_company_facts(docs.judge_documents(docs.read_fact_documents(spark, files)))
    # Two aggregations read it: opening many small files is what takes longest here.
    bronze = stored(spark, bronze, "bronze")
    count = unnest_all(bronze, ALL_UNITS).groupBy("cik").agg(F.count(F.lit(1)).alias("entries"))
    named = F.json_object_keys(F.get_json_object("facts_blob", "$['us-gaap']"))
    good = bronze.filter("status = 'good'").select("cik_raw", "entity_name", F.explode_outer(named).alias("name"))
    good = good.groupBy("cik_raw", "entity_name").agg(F.count_distinct("name").alias("concepts"))
    return good.join(count, good["cik_raw"].cast("bigint") == count["cik"].cast("bigint")).drop("cik")


# Fixed value of the fixture: ranges of keys that share an object and so a file. It bounds an object to that many
# ranges; with one range each, creating the files would take longer than all the rest.
PARTS_PER_OBJECT = 16


def fact_files(spark: SparkSession, folder: str, parts: int = 1) -> str:
    """Folder of a file for each filer and `parts` ranges of keys, which bound its size."""
    path = shared_path(spark, "facts")
    facts = rows(spark, folder).withColumn("part", F.floor(F.col("part") / parts).cast("int"))
    _one_a_file(docs.fold_fact_documents(facts).select(_indented("document").alias("value")), path)
    return path


def _one_a_file(texts: DataFrame, path: str) -> None:
    """Every text as a file, all in one folder: a folder for each would be made, moved and listed one by one."""
    texts.write.option("maxRecordsPerFile", 1).text(path)


@query("src_submission_files", sql("""
    SELECT CAST(c_custkey AS VARCHAR) AS cik_raw, company_name AS company_name_raw, sic_code AS sic_raw
    FROM submissions""", "submissions"))
def src_submission_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files that hold an indented list of objects, read whole."""
    read = docs.read_submission_documents(spark, submission_files(spark, folder))
    return docs.raw_submissions(docs.judge_submissions(read)).filter("status = 'good'").select(
        "cik_raw", "company_name_raw", "sic_raw"
    )


# Fixed values of the fixture: documents of one load that share a file, and keys of the companies that they are dealt from.
KEYS_PER_LIST = 256
KEYS_PER_RANGE = 64 * KEYS_PER_LIST


def submission_files(spark: SparkSession, folder: str) -> str:
    """Folder of files with a bounded number of documents each; a company has one document in a load.

    Lists are cut from the documents of a load and a wide range of companies, so that their
    number follows that of the documents and not that of the ranges of companies times the loads.
    """
    path = shared_path(spark, "submissions")
    filer = F.get_json_object("document", "$.cik").cast("bigint")
    texts = submission_documents(spark, folder).select(
        F.floor(filer / KEYS_PER_RANGE).alias("keys"), F.unix_seconds("loaded_at").alias("load"), filer.alias("filer"),
        "document",
    )
    place = F.row_number().over(Window.partitionBy("keys", "load").orderBy("filer", "document"))
    dealt = texts.withColumn("list", F.floor((place - 1) / KEYS_PER_LIST))
    lists = dealt.groupBy("keys", "load", "list").agg(
        F.array_join(F.collect_list(_indented("document")), ",\n").alias("l")
    )
    _one_a_file(lists.select(F.concat(F.lit("[\n"), "l", F.lit("\n]")).alias("value")), path)
    return path


def _indented(document: str) -> Column:
    text = F.col(document)
    for mark in "{[,":
        text = F.replace(text, F.lit(mark), F.lit(f"{mark}\n  "))
    return text


@query("submission_quarantine", sql("""
    SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN 'malformed' WHEN 2 THEN 'missing cik'
                                         WHEN 3 THEN 'missing cik' ELSE 'good' END AS outcome,
           count(*) AS documents
    FROM submissions GROUP BY ALL""", "submissions"))
def submission_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Documents cut off, without an identifier, with one that is no number, and whole ones."""
    whole = submission_documents(spark, folder)
    filer = F.get_json_object("document", "$.cik").cast("bigint")
    text, kind = F.col("document"), F.col("filer") % 4
    damaged = (
        F.when(kind == 1, F.left(text, F.length(text) - 3))
        .when(kind == 2, F.replace(text, F.lit('"cik":'), F.lit('"was":')))
        .when(kind == 3, F.replace(text, F.lit('"cik":'), F.lit('"cik":"x","was":')))
        .otherwise(text)
    )
    received = whole.withColumn("filer", filer).select("filer", damaged.alias("document"))
    parsed = F.from_json("document", SUBMISSIONS_DOCUMENT, {"columnNameOfCorruptRecord": CORRUPT})
    judged = docs.judge_submissions(received.select("filer", parsed.alias("d")).select("filer", "d.*"))
    outcome = F.coalesce("reason", "status")
    return judged.groupBy(F.col("filer").alias("c_custkey"), outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("documents")
    )


@query("unreadable_concepts", sql("""
    SELECT cik, 'Assets' AS raw_concept,
           CASE WHEN kind >= 3 THEN 'USD' END AS unit,
           CASE kind WHEN 1 THEN 'concept is no object' WHEN 2 THEN 'units is no object'
                WHEN 3 THEN 'unit is no array' WHEN 4 THEN 'entry is no object'
                ELSE 'repeated unit' END AS reason,
           count(DISTINCT part) * CASE kind WHEN 5 THEN 2 ELSE 1 END AS n
    FROM (SELECT *, CAST(cik AS BIGINT) % 6 AS kind FROM filing_rows) WHERE raw_concept = 'Assets' AND kind > 0
    GROUP BY cik, kind
    UNION ALL
    SELECT cik, raw_concept, CASE raw_concept WHEN 'EarningsPerShareBasic' THEN 'USD/shares' ELSE 'USD' END,
           'read', count(*)
    FROM filing_rows WHERE raw_concept IN (SELECT synonym_tag FROM synonyms)
         AND NOT (raw_concept = 'Assets' AND CAST(cik AS BIGINT) % 6 IN (1, 2, 3, 5))
    GROUP BY cik, raw_concept""", "filing_rows", "synonyms"))
def unreadable_concepts(spark: SparkSession, folder: str) -> DataFrame:
    """Five of six filers have one concept damaged, each in another way; the rest is read."""
    opening = '"Assets":{"units":{"USD":['
    damages = {
        1: '"Assets":"text","Former":{"units":{"USD":[',
        2: '"Assets":{"units":[1],"former":{"USD":[',
        3: '"Assets":{"units":{"USD":{"val":1},"former":[',
        4: opening + "5,",
        5: '"Assets":{"units":{"USD":[],"USD":[',
    }
    damaged, kind = F.col("document"), F.col("cik").cast("bigint") % 6
    for k, text in damages.items():
        damaged = F.when(kind == k, F.replace("document", F.lit(opening), F.lit(text))).otherwise(damaged)
    received = fact_documents(spark, folder).select(damaged.alias("document"))
    judged = docs.judge_documents(docs.parse_document_text(received))
    bronze = docs.raw_company_facts(judged).filter("status = 'good'")
    entries = stored(spark, read_entries(bronze, seeds.synonyms(spark), ALL_UNITS), "entries")
    read = entries.filter("reason IS NULL").groupBy("cik", "raw_concept", "unit").agg(
        F.count(F.lit(1)).alias("n")
    )
    return unreadable(entries).unionByName(read.withColumn("reason", F.lit("read")))


@query("union_by_name", """
    SELECT c_custkey AS party, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
    FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    buyers = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("party"),
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
    )
    sellers = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.col("s_suppkey").alias("party"),
    )
    return buyers.unionByName(sellers, allowMissingColumns=True)


@query("src_oversize_split", """
    SELECT source, CASE WHEN strlen(text) > 4096 THEN 'oversize' ELSE 'accepted' END AS outcome,
           count(*) AS documents, CAST(sum(strlen(text)) AS BIGINT) AS bytes
    FROM documents GROUP BY ALL""")
def src_oversize_split(spark: SparkSession, folder: str) -> DataFrame:
    within, over = docs.split_oversize(table(spark, folder, "documents"), "text", 4096)
    outcomes = within.withColumn("outcome", F.lit("accepted")).unionByName(
        over.withColumn("outcome", F.lit("oversize"))
    )
    return outcomes.groupBy("source", "outcome").agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.octet_length("text")).alias("bytes")
    )


def _seed_path(spark: SparkSession, name: str) -> str:
    """The packaged seed as a file that the executors read."""
    text = resources.files("factloom.seeds").joinpath(name).read_text(encoding="utf-8")
    path = shared_path(spark, "seed")
    lines = spark.createDataFrame([(text.rstrip("\n"),)], "value string")
    lines.coalesce(1).write.text(path)
    return path


@query("seed_synonyms", sql("""
    SELECT s.*, coalesce(n, 0) AS reported_facts
    FROM synonyms s LEFT JOIN (SELECT raw_concept, count(*) AS n FROM filing_rows GROUP BY 1)
         ON raw_concept = synonym_tag""", "synonyms", "filing_rows"))
def seed_synonyms(spark: SparkSession, folder: str) -> DataFrame:
    used = rows(spark, folder).groupBy("raw_concept").agg(F.count(F.lit(1)).alias("n"))
    seed = seeds.synonyms(spark, _seed_path(spark, "gaap_tag_synonyms.csv"))
    return seed.join(used, seed["synonym_tag"] == used["raw_concept"], "left").select(
        *seed.columns, F.coalesce("n", F.lit(0)).alias("reported_facts")
    )


@query("seed_companies", sql("""
    SELECT t.cik, t.ticker, t.company_name, t.industry, t.sic_code,
           coalesce(n, 0) AS filings
    FROM tracked t
    LEFT JOIN (SELECT o_custkey % 100 AS slot, count(*) AS n FROM orders GROUP BY 1) u
         ON u.slot = CAST(t.cik AS BIGINT) % 100""", "tracked"))
def seed_companies(spark: SparkSession, folder: str) -> DataFrame:
    """Every order counts for the tracked companies whose identifier ends like its customer's."""
    tracked = seeds.tracked_companies(spark, _seed_path(spark, "companies.csv"))
    used = table(spark, folder, "orders").groupBy((F.col("o_custkey") % 100).alias("slot")).agg(
        F.count(F.lit(1)).alias("n")
    )
    slot = F.col("cik").cast("bigint") % 100
    return tracked.withColumn("slot", slot).join(used, "slot", "left").select(
        *tracked.columns, F.coalesce("n", F.lit(0)).alias("filings")
    )


@query("sink_roundtrip", sql("""
    SELECT cik, canonical_concept, CAST(period_end AS VARCHAR) AS period_end, reported_value,
           form_type, accession_number, period_year FROM silver""", "silver"))
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    store = LayerStore(spark, shared_path(spark, "layers"))
    chosen = silver(spark, folder).select(
        "cik", "canonical_concept", "period_end", "reported_value", "form_type",
        "accession_number", "period_year",
    )
    return store.write(
        chosen.repartitionByRange("period_year", "cik"), "silver", "stg_financials",
        partition_by=("period_year",),
    )


@query("layer_tables", sql("""
    SELECT n.cik, c.display_label, c.kind, count(*) AS facts, round(sum(n.reported_value), 2) AS total
    FROM (SELECT * FROM silver
          QUALIFY period_end = max(period_end) OVER (PARTITION BY cik, canonical_concept)) n
    JOIN concepts c ON c.canonical_tag = n.canonical_concept GROUP BY ALL""", "silver", "concepts"))
def layer_tables(spark: SparkSession, folder: str) -> DataFrame:
    """SQL text over tables of two layers, named as the catalog names them, in a chain of steps."""
    store = LayerStore(spark, shared_path(spark, "layers"))
    store.write(silver(spark, folder), "silver", "stg_financials")
    store.write(gold.dim_gaap_concepts(seeds.synonyms(spark)), "gold", "dim_gaap_concepts")
    store.register("silver", "stg_financials")
    store.register("gold", "dim_gaap_concepts")
    return spark.sql("""
        WITH latest_ends AS (
            SELECT cik, canonical_concept, max(period_end) AS last_end FROM silver.stg_financials GROUP BY ALL),
        newest AS (
            SELECT s.* FROM silver.stg_financials s
            JOIN latest_ends l ON l.cik = s.cik AND l.canonical_concept = s.canonical_concept AND l.last_end = s.period_end)
        SELECT n.cik, c.display_label, c.kind, count(*) AS facts, round(sum(n.reported_value), 2) AS total
        FROM newest n JOIN gold.dim_gaap_concepts c ON c.canonical_tag = n.canonical_concept GROUP BY ALL""")


@query("load_stamps", sql("""
    SELECT CAST(CAST(cik AS BIGINT) AS VARCHAR) AS cik_raw, count(DISTINCT part) AS documents, 1 AS instants,
           true AS in_this_run
    FROM filing_rows GROUP BY cik""", "filing_rows"))
def load_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of a load carries the one instant at which the load ran."""
    begun, path = int(time.time() * 1e6), shared_path(spark, "stamped")
    docs.raw_company_facts(docs.parse_document_text(fact_documents(spark, folder).drop("cik"))).select(
        "cik_raw", "loaded_at"
    ).write.parquet(path)
    ended = int(time.time() * 1e6)
    moment = F.unix_micros("loaded_at")
    return spark.read.parquet(path).groupBy("cik_raw").agg(
        F.count(F.lit(1)).alias("documents"), F.count_distinct("loaded_at").cast("int").alias("instants"),
        F.every(moment.between(begun - 1000, ended + 1000)).alias("in_this_run"),
    )


@query("merge_partitions", sql("""
    SELECT cik, canonical_concept, CAST(period_end AS VARCHAR) AS period_end, reported_value,
           form_type, accession_number, period_year FROM silver
    WHERE NOT (CAST(cik AS BIGINT) % 5 = 4 AND period_year % 3 = 1)""", "silver"))
def merge_partitions(spark: SparkSession, folder: str) -> DataFrame:
    """Silver of two years in three, then those years' rows changed, missing ones added, others removed."""
    final = silver(spark, folder).select(
        "cik", "canonical_concept", "period_end", "reported_value", "form_type", "accession_number", "period_year"
    )
    final = stored(spark, final, "silver")
    filer, year, key = F.col("cik").cast("bigint"), F.col("period_year"), ["cik", "canonical_concept", "period_end"]
    stale = (filer % 5 == 2) & (year % 3 == 1)
    wrong = F.when(stale, F.col("reported_value") - 1).otherwise(F.col("reported_value"))
    target = PartitionedTable(spark, shared_path(spark, "merged"), ("period_year",))
    target.replace(final.filter((filer % 5 != 3) | (year % 3 != 1)).withColumn("reported_value", wrong))
    changes = final.filter((filer % 5).isin(2, 3) & (year % 3 == 1))
    gone = final.filter((filer % 5 == 4) & (year % 3 == 1))
    return target.merge(changes, key, removed=gone)


@query("discovered_schema", sql("""
    SELECT CAST(c_custkey AS VARCHAR) AS cik_raw, company_name AS company_name_raw,
           CASE c_custkey % 4 WHEN 1 THEN 'SIC ' || sic_code ELSE sic_code END AS sic_raw,
           CASE WHEN c_custkey % 4 <> 2 THEN state_of_incorporation END AS state_of_incorporation_raw, primary_ticker,
           CAST(CASE WHEN c_custkey % 4 = 3 THEN 1231 WHEN c_custkey % 4 = 2 THEN 0.5 END AS DOUBLE) AS fiscal_year_end,
           CASE c_custkey % 4 WHEN 3 THEN 'Street ' || CAST(c_custkey AS VARCHAR) END AS street
    FROM submissions""", "submissions"))
def discovered_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of four kinds of filers differ in their columns and in the types of these.

    One kind has a code that is text and no number, one lacks a column and has a fraction where
    another has a whole number, one has an object that no other has.
    """
    filer, text = F.get_json_object("document", "$.cik").cast("bigint") % 4, F.col("document")
    more = F.concat(
        F.left(text, F.length(text) - 1),
        F.lit(',"fiscalYearEnd":1231,"addresses":{"mailing":{"street":"Street '),
        F.get_json_object("document", "$.cik"), F.lit('"}}}'),
    )
    less = F.regexp_replace(text, '"stateOfIncorporation":[^,]*,', '"fiscalYearEnd":0.5,')
    less = F.when(less == text, F.regexp_replace(text, '"tickers":', '"fiscalYearEnd":0.5,"tickers":')).otherwise(less)
    varied = (
        F.when(filer == 1, F.regexp_replace(text, r'"sic":(\d+)', '"sic":"SIC $1"'))
        .when(filer == 2, less).when(filer == 3, more).otherwise(text)
    )
    path = shared_path(spark, "submissions")
    docs.land_documents(submission_documents(spark, folder).select(varied.alias("document")), path)
    read = docs.discovered_submissions(spark, path, whole_files=False)
    return read.select(
        F.col("cik").alias("cik_raw"), F.col("name").alias("company_name_raw"), F.col("sic").alias("sic_raw"),
        F.col("stateOfIncorporation").alias("state_of_incorporation_raw"),
        F.try_element_at("tickers", F.lit(1)).alias("primary_ticker"),
        F.col("fiscalYearEnd").cast("double").alias("fiscal_year_end"),
        F.col("addresses.mailing.street").alias("street"),
    )


@query("sql_functions", sql("""
    SELECT coalesce(canonical_tag, raw_concept) AS canonical_concept, quarter(period_end)::INTEGER AS quarter,
           regexp_replace(upper(form_raw), '/A$', '') AS form, lpad(CAST(CAST(cik AS BIGINT) AS VARCHAR), 10, '0') AS cik,
           CAST(strftime(period_end, '%Y%m%d') AS INTEGER) AS period_key, count(*) AS facts,
           max((reported_value - 1000.0) / 1000.0) AS change,
           (SELECT count(*) FROM synonyms WHERE canonical_tag = 'Revenues') AS revenue_tags
    FROM filing_rows LEFT JOIN synonyms ON synonym_tag = raw_concept GROUP BY ALL""", "filing_rows", "synonyms"))
def sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Plain SQL over the registered functions."""
    catalog.register(spark, seeds.synonyms(spark))
    rows(spark, folder).createOrReplaceTempView("filing_rows")
    return spark.sql("""
        SELECT normalize_gaap_tag(raw_concept) AS canonical_concept, fiscal_quarter(period_end) AS quarter,
               base_form(upper(form_raw)) AS form, pad_identifier(CAST(CAST(cik AS BIGINT) AS STRING)) AS cik,
               period_key(period_end) AS period_key, count(*) AS facts,
               max(pct_change(reported_value, 1000.0D)) AS change,
               (SELECT count(*) FROM synonyms_of('Revenues')) AS revenue_tags
        FROM filing_rows GROUP BY ALL""")


@query("json_fold_per_key", sql("""
    SELECT cik, part, count(DISTINCT raw_concept) AS concepts, count(*) AS entries
    FROM filing_rows GROUP BY cik, part""", "filing_rows"))
def json_fold_per_key(spark: SparkSession, folder: str) -> DataFrame:
    folded = fact_documents(spark, folder)
    blob = F.from_json("document", FACTS_DOCUMENT)["facts"]
    gaap = F.from_json(blob, all_concepts_type())["us-gaap"]
    per_concept = F.transform(
        F.map_values("gaap"),
        lambda c: F.aggregate(
            F.map_values(c["units"]), F.lit(0), lambda n, entries: n + F.size(entries)
        ),
    )
    return folded.select("cik", "part", gaap.alias("gaap")).select(
        "cik",
        F.col("part").cast("bigint").alias("part"),
        F.size("gaap").cast("bigint").alias("concepts"),
        F.aggregate(per_concept, F.lit(0), lambda n, m: n + m).cast("bigint").alias("entries"),
    )


def _landings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        pad_identifier("user_id").alias("cik"),
        F.col("ts").cast("timestamp").alias("landed_at"), "event_type",
    )


def _tracked_customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        pad_identifier("c_custkey").alias("cik"), F.col("c_name").alias("ticker")
    )


@query("refresh_candidates", """
    SELECT cik, ticker, epoch_us(landed_at) AS landed_us
    FROM (SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_name AS ticker,
                 (SELECT max(ts) FROM events) AS as_of, landed_at
          FROM customer LEFT JOIN (SELECT user_id, max(ts) AS landed_at FROM events GROUP BY 1)
               ON user_id = c_custkey)
    WHERE landed_at IS NULL OR landed_at <= as_of - INTERVAL 6 HOUR""")
def refresh_candidates(spark: SparkSession, folder: str) -> DataFrame:
    landed = _landings(spark, folder)
    as_of = landed.agg(F.max("landed_at")).scalar()
    due = ingest.refresh_candidates(_tracked_customers(spark, folder), landed, as_of)
    return due.select("cik", "ticker", F.unix_micros("landed_at").alias("landed_us"))


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    landed = _landings(spark, folder)
    as_of = landed.agg(F.max("landed_at")).scalar()
    last = landed.groupBy("cik").agg(
        F.max("landed_at").alias("landed_at"), F.max_by("event_type", "landed_at").alias("outcome")
    )
    fresh = F.col("landed_at") > as_of - F.expr("INTERVAL 6 HOURS")
    status = (
        F.when(fresh, "skipped").when(F.col("outcome") == "error", "failed").otherwise("fetched")
    )
    joined = _tracked_customers(spark, folder).join(last, "cik", "left")
    return joined.withColumn("status", status).withColumn(
        "error", F.when(F.col("status") == "failed", F.col("outcome"))
    )


_OUTCOMES_SQL = """(
    SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_name AS ticker, outcome,
           CASE WHEN landed_at > (SELECT max(ts) FROM events) - INTERVAL 6 HOUR THEN 'skipped'
                WHEN outcome = 'error' THEN 'failed' ELSE 'fetched' END AS status
    FROM customer LEFT JOIN (SELECT user_id, max(ts) AS landed_at, arg_max(event_type, ts) AS outcome
                             FROM events GROUP BY 1) ON user_id = c_custkey)"""


@query("ingest_summary",
       f"SELECT status, count(*) AS companies FROM {_OUTCOMES_SQL} GROUP BY status")
def ingest_summary(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.ingest_summary(_outcomes(spark, folder))


@query("ingest_failures",
       f"SELECT cik, ticker, outcome AS error FROM {_OUTCOMES_SQL} WHERE status = 'failed'")
def ingest_failures(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.ingest_failures(_outcomes(spark, folder))


@query("ingest_gate", f"""
    SELECT count(*) = 0 AS passed, count(*) AS failures FROM {_OUTCOMES_SQL} WHERE status = 'failed'""")
def ingest_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the gate lets a run pass, and the failures that it names."""
    outcomes = _outcomes(spark, folder)
    try:
        ingest.fail_on_any_failure(outcomes)
        passed, failures = True, 0
    except RuntimeError as stopped:
        passed, failures = False, int(str(stopped).split()[0])
    return spark.createDataFrame([(passed, failures)], "passed boolean, failures long")


@query("payload_quarantine", sql("""
    SELECT cik, CASE CAST(cik AS BIGINT) % 5 WHEN 1 THEN 'missing facts' WHEN 2 THEN 'malformed'
                     WHEN 3 THEN 'repeated concept' ELSE 'good' END AS outcome,
           count(DISTINCT part) AS documents
    FROM filing_rows GROUP BY ALL""", "filing_rows"))
def payload_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of four filers in five are damaged in one of three ways or left whole."""
    whole = fact_documents(spark, folder)
    text, kind = F.col("document"), F.col("cik").cast("bigint") % 5
    twice = '"us-gaap":{"Assets":{},"Assets":{},'
    damaged = (
        F.when(kind == 1, F.concat(F.split_part(text, F.lit(',"facts"'), F.lit(1)), F.lit("}")))
        .when(kind == 2, F.left(text, F.length(text) - 3))
        .when(kind == 3, F.replace(text, F.lit('"us-gaap":{'), F.lit(twice)))
        .otherwise(text)
    )
    received = whole.select(F.col("cik").alias("filer"), damaged.alias("document"))
    judged = docs.judge_documents(docs.parse_document_text(received))
    outcome = F.coalesce("reason", "status")
    return judged.groupBy(F.col("filer").alias("cik"), outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("documents")
    )


@query("concept_count", sql("""
    SELECT cik, CAST(part AS BIGINT) AS part, count(DISTINCT raw_concept) AS concepts
    FROM filing_rows GROUP BY cik, part""", "filing_rows"))
def concept_count(spark: SparkSession, folder: str) -> DataFrame:
    blob = F.from_json("document", FACTS_DOCUMENT)["facts"]
    return fact_documents(spark, folder).select(
        "cik", F.col("part").cast("bigint").alias("part"),
        docs.concept_count(blob).cast("bigint").alias("concepts"),
    )


@query("doc_size_stats", """
    SELECT source, lang, count(*) AS documents, CAST(sum(strlen(text)) AS BIGINT) AS total_bytes,
           CAST(max(strlen(text)) AS INTEGER) AS max_bytes,
           sum(strlen(text)) / 1048576.0 AS total_mb
    FROM documents GROUP BY source, lang""")
def doc_size_stats(spark: SparkSession, folder: str) -> DataFrame:
    return docs.document_sizes(table(spark, folder, "documents"), "text", "source", "lang")
