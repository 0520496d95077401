"""Projections, filters, scalar functions, JSON access and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import (
    fiscal_quarter, pad_identifier, quarter_index, strict_date, strict_double, value_type,
    zfill_identifier,
)
from factloom.operators import companies as co
from factloom.operators.extract import extract_entries, unnest_all, unnest_tracked, usable_facts
from factloom.operators.normalize import distinct_tags as tags_of
from factloom.operators.normalize import normalize_tag, tracked_only
from factloom.params import ALL_UNITS
from factloom.registry.base import bronze_facts, bronze_submissions, query, rows, sql
from factloom.sources import seeds
from factloom.sources.tables import table


@query("project_rename", """
    SELECT CAST(c_custkey AS VARCHAR) AS cik_raw, c_name AS company_name_raw,
           CAST(c_nationkey AS VARCHAR) AS sic_raw, c_mktsegment AS sic_description_raw
    FROM customer""")
def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("cik_raw"),
        F.col("c_name").alias("company_name_raw"),
        F.col("c_nationkey").cast("string").alias("sic_raw"),
        F.col("c_mktsegment").alias("sic_description_raw"),
    )


@query("pad_identifier", """
    SELECT o_orderkey, lpad(id, 10, '0') AS padded,
           CASE WHEN length(id) >= 10 THEN id ELSE lpad(id, 10, '0') END AS zfilled
    FROM (SELECT o_orderkey, CAST(o_orderkey * 100000037 AS VARCHAR) AS id FROM orders)""")
def pad(spark: SparkSession, folder: str) -> DataFrame:
    identifier = F.col("o_orderkey") * 100000037
    return table(spark, folder, "orders").select(
        "o_orderkey",
        pad_identifier(identifier).alias("padded"),
        zfill_identifier(identifier).alias("zfilled"),
    )


@query("calendar_parts", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS period_year,
           CAST(ceil(month(o_orderdate) / 3.0) AS INTEGER) AS calendar_quarter,
           CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INTEGER) AS q_idx
    FROM orders""")
def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("period_year"),
        fiscal_quarter("o_orderdate").alias("calendar_quarter"),
        quarter_index("o_orderdate").alias("q_idx"),
    )


@query("filter_not_in_forms", sql("""
    SELECT accession_number, upper(form) AS form_type
    FROM (SELECT accession_number, CASE WHEN o_orderkey % 11 <> 0 THEN form_raw END AS form
          FROM filing_rows)
    WHERE upper(form) NOT IN ('8-K', '8-K/A')""", "filing_rows"))
def filter_not_in_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Every eleventh filing has no form; null forms are dropped with the excluded ones."""
    known = F.col("accession_number").cast("bigint") % 11 != 0
    typed = rows(spark, folder).withColumn("form_type", F.upper(F.when(known, F.col("form_raw"))))
    return usable_facts(typed).select("accession_number", "form_type")


@query("case_value_type", sql("""
    SELECT accession_number, CASE WHEN period_start IS NULL THEN 'instant' ELSE 'duration' END
           AS value_type FROM filing_rows""", "filing_rows"))
def case_value_type(spark: SparkSession, folder: str) -> DataFrame:
    return rows(spark, folder).select(
        "accession_number", value_type("period_start").alias("value_type")
    )


@query("typed_extract_filter", """
    SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL
                            ELSE o_totalprice END AS reported_value,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS period_end
    FROM orders WHERE o_orderkey % 7 > 1 AND o_orderkey % 5 > 2""")
def typed_extract_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Prices and dates as text, some of it malformed, through the parity casts."""
    key = F.col("o_orderkey")
    price, day = F.col("o_totalprice").cast("string"), F.col("o_orderdate").cast("date").cast("string")
    val = F.when(key % 7 == 0, F.concat(price, F.lit("d"))).when(key % 7 == 1, "abc")
    val = val.when(key % 7 == 2, F.concat(F.lit(" "), price, F.lit(" "))).otherwise(price)
    end = F.when(key % 5 == 0, "2020-02-30").when(key % 5 == 1, F.left(day, F.lit(4)))
    end = end.when(key % 5 == 2, F.concat(day, F.lit(" x")))
    end = end.when(key % 5 == 3, F.concat(day, F.lit("T10:00:00"))).otherwise(day)
    typed = table(spark, folder, "orders").select(
        "o_orderkey",
        strict_double(val).alias("reported_value"),
        strict_date(end).alias("period_end"),
        F.lit("10-Q").alias("form_type"),
    )
    return usable_facts(typed).drop("form_type")


@query("json_text_field", """
    SELECT event_id, props ->> '$.k' AS k, CAST(props ->> '$.k' AS INTEGER) AS k_number
    FROM events""")
def json_text_field(spark: SparkSession, folder: str) -> DataFrame:
    parsed = F.from_json("props", "k STRING")["k"]
    return table(spark, folder, "events").select("event_id", parsed.alias("k")).withColumn(
        "k_number", F.col("k").try_cast("int")
    )


@query("json_unnest_facts", sql("""
    SELECT cik, entity_name, raw_concept, reported_value, CAST(period_start AS VARCHAR) AS period_start,
           CAST(period_end AS VARCHAR) AS period_end, accession_number, upper(form_raw) AS form_type,
           CAST(filed_date AS VARCHAR) AS filed_date, fiscal_period_label,
           CASE WHEN period_start IS NULL THEN 'instant' ELSE 'duration' END AS value_type
    FROM filing_rows""", "filing_rows"))
def json_unnest_facts(spark: SparkSession, folder: str) -> DataFrame:
    return extract_entries(unnest_all(bronze_facts(spark, folder), ALL_UNITS))


@query("tracked_concepts_semi", sql("""
    SELECT cik, raw_concept, count(*) AS entries, min(accession_number) AS first_accession
    FROM filing_rows WHERE raw_concept IN (SELECT synonym_tag FROM synonyms)
    GROUP BY cik, raw_concept""", "filing_rows", "synonyms"))
def tracked_concepts_semi(spark: SparkSession, folder: str) -> DataFrame:
    entries = unnest_tracked(bronze_facts(spark, folder), seeds.synonyms(spark), ALL_UNITS)
    return entries.groupBy("cik", "raw_concept").agg(
        F.count(F.lit(1)).alias("entries"), F.min("entry.accn").alias("first_accession")
    )


@query("default_units", sql("""
    SELECT cik, raw_concept, count(*) AS entries FROM filing_rows
    WHERE raw_concept IN (SELECT synonym_tag FROM synonyms)
      AND raw_concept <> 'EarningsPerShareBasic'
    GROUP BY cik, raw_concept""", "filing_rows", "synonyms"))
def default_units(spark: SparkSession, folder: str) -> DataFrame:
    """Only the money unit is read by default, so per-share concepts give no rows."""
    entries = unnest_tracked(bronze_facts(spark, folder), seeds.synonyms(spark))
    return entries.groupBy("cik", "raw_concept").agg(F.count(F.lit(1)).alias("entries"))


@query("union_all_branches", sql(" UNION ALL ".join(
    f"SELECT cik, '{tag}' AS raw_concept, accession_number, reported_value FROM filing_rows "
    f"WHERE raw_concept = '{tag}'"
    for tag in ("Assets", "EarningsPerShareBasic", "NetIncomeLoss", "Revenues", "SalesRevenueNet")
), "filing_rows"))
def union_all_branches(spark: SparkSession, folder: str) -> DataFrame:
    """One pass that gives what a union of one branch per tag gives."""
    tracked = tracked_only(seeds.synonyms(spark))(rows(spark, folder))
    return tracked.select("cik", "raw_concept", "accession_number", "reported_value")


@query("empty_seed_relation", sql("""
    SELECT cik, count(*) AS facts, CAST(0 AS BIGINT) AS tracked
    FROM filing_rows GROUP BY cik""", "filing_rows"))
def empty_seed_relation(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing is tracked when the seed is empty; the relation keeps its columns."""
    all_rows = rows(spark, folder)
    empty = seeds.synonyms(spark).filter(F.lit(False))
    kept = tracked_only(empty)(all_rows).groupBy("cik").agg(F.count(F.lit(1)).alias("n"))
    counted = all_rows.groupBy("cik").agg(F.count(F.lit(1)).alias("facts"))
    return counted.join(kept, "cik", "left").select(
        "cik", "facts", F.coalesce("n", F.lit(0)).alias("tracked")
    )


@query("normalize_tag", sql("""
    SELECT accession_number, raw_concept, coalesce(canonical_tag, raw_concept) AS canonical_concept
    FROM filing_rows LEFT JOIN synonyms ON synonym_tag = raw_concept""", "filing_rows", "synonyms"))
def normalize(spark: SparkSession, folder: str) -> DataFrame:
    mapped = rows(spark, folder).transform(normalize_tag(seeds.synonyms(spark)))
    return mapped.select("accession_number", "raw_concept", "canonical_concept")


@query("distinct_tags", sql(
    "SELECT DISTINCT raw_concept AS synonym_tag FROM filing_rows ORDER BY 1", "filing_rows"))
def distinct_tags(spark: SparkSession, folder: str) -> DataFrame:
    return tags_of(rows(spark, folder).withColumnRenamed("raw_concept", "synonym_tag"))


@query("first_array_element", sql("""
    SELECT CAST(c_custkey AS VARCHAR) AS cik_raw, company_name, primary_ticker, primary_exchange
    FROM submissions""", "submissions"))
def first_array_element(spark: SparkSession, folder: str) -> DataFrame:
    return bronze_submissions(spark, folder).select(
        "cik_raw",
        F.col("company_name_raw").alias("company_name"),
        F.try_element_at("tickers_raw", F.lit(1)).alias("primary_ticker"),
        F.try_element_at("exchanges_raw", F.lit(1)).alias("primary_exchange"),
    )


@query("filings_flatten", sql("""
    SELECT cik, accession_number, form_type, CAST(filed_date AS VARCHAR) AS filed_date
    FROM filings""", "filings"))
def filings_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return co.flatten_filings(bronze_submissions(spark, folder))


_REQUESTS_SQL = """(
    SELECT lower(CASE WHEN event_type = 'error' THEN 'Missing#' ELSE 'Customer#' END
                 || lpad(CAST(user_id AS VARCHAR), 9, '0')) AS ticker, count(*) AS requests
    FROM events GROUP BY 1)"""


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requested tickers with their frequency: counted first, so the join sees each once."""
    prefix = F.when(F.col("event_type") == "error", "Missing#").otherwise("Customer#")
    ticker = F.lower(F.concat(prefix, F.lpad(F.col("user_id").cast("string"), 9, "0")))
    return table(spark, folder, "events").groupBy(ticker.alias("ticker")).agg(
        F.count(F.lit(1)).alias("requests")
    )


def _directory(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_name").alias("ticker"), pad_identifier("c_custkey").alias("cik")
    )


@query("ticker_lookup", f"""
    SELECT ticker, requests, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik
    FROM {_REQUESTS_SQL} JOIN customer ON upper(c_name) = upper(ticker)""")
def ticker_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return co.ticker_lookup(_requests(spark, folder), _directory(spark, folder))


@query("ticker_unmatched_anti", f"""
    SELECT ticker, requests FROM {_REQUESTS_SQL}
    WHERE upper(ticker) NOT IN (SELECT upper(c_name) FROM customer)""")
def ticker_unmatched_anti(spark: SparkSession, folder: str) -> DataFrame:
    return co.ticker_unmatched(_requests(spark, folder), _directory(spark, folder))
