"""Deduplication, coverage and company queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import coverage, dedup
from factloom.operators.companies import companies
from factloom.operators.extract import extracted_facts
from factloom.params import ALL_UNITS, Params
from factloom.plans import gold
from factloom.plans.silver import SILVER_COLUMNS, silver_financials
from factloom.registry.base import bronze_facts, bronze_submissions, facts, query, silver, sql
from factloom.sources import seeds

_SILVER_SQL = """SELECT cik, entity_name, raw_concept, canonical_concept, reported_value,
    CAST(period_start AS VARCHAR) AS period_start, CAST(period_end AS VARCHAR) AS period_end,
    accession_number, form_type, CAST(filed_date AS VARCHAR) AS filed_date, fiscal_period_label,
    value_type, calendar_quarter, period_year"""
_FACT_COLUMNS = ("cik", "canonical_concept", "period_end", "form_type", "filed_date",
                 "accession_number", "reported_value")
_FACT_SQL = """SELECT cik, canonical_concept, CAST(period_end AS VARCHAR) AS period_end, form_type,
    CAST(filed_date AS VARCHAR) AS filed_date, accession_number, reported_value"""


@query("latest_per_key", sql(f"{_FACT_SQL} FROM latest", "latest"))
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.latest_per_key(facts(spark, folder)).select(*_FACT_COLUMNS)


@query("form_preference", sql(f"""
    {_FACT_SQL}, CAST(quarter(period_end) AS INTEGER) AS calendar_quarter FROM facts
    QUALIFY row_number() OVER (
        PARTITION BY cik, canonical_concept, period_end
        ORDER BY CASE WHEN quarter(period_end) <= 3 AND form_type = '10-Q' THEN 1
                      WHEN quarter(period_end) = 4 AND form_type = '10-K' THEN 1
                      WHEN fiscal_period_label = 'FY' AND form_type = '10-K' THEN 1 ELSE 2 END,
                 filed_date DESC, accession_number DESC) = 1""", "facts"))
def form_preference(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.prefer_form(facts(spark, folder)).select(*_FACT_COLUMNS, "calendar_quarter")


@query("silver_financials", sql(f"{_SILVER_SQL} FROM silver", "silver"))
def silver_rows(spark: SparkSession, folder: str) -> DataFrame:
    return silver(spark, folder).select(*SILVER_COLUMNS)


@query("silver_from_documents", sql(f"""
    {_SILVER_SQL} FROM silver
    WHERE raw_concept IN (SELECT synonym_tag FROM synonyms)""", "silver"))
def silver_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The whole silver chain starting at JSON text; only tracked concepts come through."""
    entries = extracted_facts(
        bronze_facts(spark, folder), seeds.synonyms(spark), Params(units=ALL_UNITS)
    )
    return silver_financials(entries).select(*SILVER_COLUMNS)


@query("amendment_supersede", sql(f"{_FACT_SQL}, base_form FROM superseded", "superseded"))
def amendment_supersede(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.amendment_supersede(facts(spark, folder)).select(*_FACT_COLUMNS, "base_form")


@query("latest_load_per_company", sql("""
    SELECT cik, company_name, sic_code, sic_description, state_of_incorporation, primary_ticker,
           primary_exchange, loaded_seconds FROM companies""", "companies"))
def latest_load_per_company(spark: SparkSession, folder: str) -> DataFrame:
    latest = companies(bronze_submissions(spark, folder))
    return latest.withColumn("loaded_seconds", F.unix_seconds("loaded_at")).drop("loaded_at")


@query("coverage_span", sql("""
    SELECT cik, CAST(min(period_end) AS VARCHAR) AS first_period,
           CAST(max(period_end) AS VARCHAR) AS last_period FROM facts GROUP BY cik""", "facts"))
def coverage_span(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.coverage_span(facts(spark, folder))


_COVERAGE_SQL = """
    SELECT cik, CAST(min(period_end) AS VARCHAR) AS first_period,
           CAST(max(period_end) AS VARCHAR) AS last_period,
           count(DISTINCT period_end) AS actual_quarters,
           datediff('quarter', min(period_end), max(period_end)) + 1 AS expected_quarters,
           datediff('quarter', min(period_end), max(period_end)) + 1 - count(DISTINCT period_end)
               AS missing_quarters,
           datediff('quarter', min(period_end), max(period_end)) + 1 > count(DISTINCT period_end)
               AS has_gaps
    FROM silver WHERE canonical_concept = '{concept}' GROUP BY cik"""


@query("coverage_gaps", sql(_COVERAGE_SQL.format(concept="Revenues"), "silver"))
def coverage_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.filing_periods(silver(spark, folder))


@query("coverage_gaps_unmapped", sql(_COVERAGE_SQL.format(concept="UnmappedTag"), "silver"))
def coverage_gaps_unmapped(spark: SparkSession, folder: str) -> DataFrame:
    """A thinly reported concept, so that quarters really are missing."""
    return coverage.filing_periods(silver(spark, folder), "UnmappedTag")


@query("missing_quarters_list", sql("""
    , present AS (SELECT DISTINCT cik, q_idx FROM silver WHERE canonical_concept = 'UnmappedTag'),
    spine AS (SELECT cik, unnest(generate_series(min(q_idx), max(q_idx))) AS q_idx
              FROM present GROUP BY cik)
    SELECT cik, CAST(q_idx AS INTEGER) AS q_idx FROM spine
    WHERE (cik, q_idx) NOT IN (SELECT (cik, q_idx) FROM present)""", "silver"))
def missing_quarters_list(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.missing_quarters(silver(spark, folder), "UnmappedTag")


@query("fact_gap_flags", sql("""
    SELECT s.cik, canonical_concept, CAST(period_end AS VARCHAR) AS period_end,
           expected_quarters - actual_quarters AS missing_quarters,
           expected_quarters > actual_quarters AS has_gaps
    FROM silver s LEFT JOIN coverage c ON c.cik = s.cik""", "coverage"))
def fact_gap_flags(spark: SparkSession, folder: str) -> DataFrame:
    return gold.with_gap_flags(silver(spark, folder)).select(
        "cik", "canonical_concept", "period_end", "missing_quarters", "has_gaps"
    )
