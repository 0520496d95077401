"""The whole build: documents -> bronze -> silver -> gold -> checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import ingest, quality
from factloom.operators.companies import companies, flatten_filings, last_filing
from factloom.operators.coverage import filing_periods
from factloom.operators.extract import good_entries, read_entries, typed_facts, unreadable
from factloom.operators.ordering import clustered
from factloom.params import ALL_UNITS, DEFAULTS, Params
from factloom.plans import anomalies, gold
from factloom.plans.silver import silver_financials
from factloom.session import stored
from factloom.sources import seeds
from factloom.sources.documents import (
    GOOD,
    REJECTED,
    judge_documents,
    judge_submissions,
    raw_company_facts,
    raw_submissions,
    read_fact_documents,
    read_submission_documents,
)
from factloom.sources.layers import LayerStore


def build(
    spark: SparkSession,
    store: LayerStore,
    facts_path: str,
    submissions_path: str,
    as_of: Column | None = None,
    now: Column | None = None,
    params: Params = Params(units=ALL_UNITS),
    multi_line: bool = True,
    stop_on_failure: bool = False,
) -> DataFrame:
    """Rebuild every table and return the check report.

    `bronze.ingest_ledger` says how each document fared. With `stop_on_failure` the build ends
    there when one of them failed; without, the report counts them and the rest is built.

    Each table is written and read back, so later layers start from storage: a lost
    executor costs a stage and never the parse of the documents.
    """
    as_of = F.current_date() if as_of is None else as_of
    now = F.current_timestamp() if now is None else now
    seed = store.write(seeds.synonyms(spark), "seeds", "gaap_tag_synonyms")
    tracked = store.write(seeds.tracked_companies(spark), "seeds", "companies")

    judged = judge_documents(read_fact_documents(spark, facts_path, multi_line), params)
    landed = store.write(
        raw_company_facts(judged), "bronze", "raw_company_facts", ("status",), wide_rows=True
    )
    documents = judge_submissions(read_submission_documents(spark, submissions_path, multi_line))
    received = store.write(raw_submissions(documents), "bronze", "raw_submissions", ("status",))
    submissions = received.filter(F.col("status") == GOOD)
    attempts = store.write(document_attempts(landed, received), "bronze", "ingest_ledger")
    if stop_on_failure:
        ingest.fail_on_any_failure(ingest.run_outcomes(attempts, tracked))

    # One parse of the documents serves the facts and the account of what could not be read.
    entries = read_entries(landed.filter(F.col("status") == GOOD), seed, params.units)
    entries = store.write(
        entries.withColumn("status", F.when(F.col("reason").isNull(), GOOD).otherwise(REJECTED)),
        "bronze", "concept_entries", ("status",),
    )
    rejected = store.write(unreadable(entries), "bronze", "rejected_concepts")
    facts = store.write(typed_facts(good_entries(entries), seed, params), "silver", "fact_entries")
    silver = store.write(
        silver_financials(facts).repartitionByRange("period_year", "cik"),
        "silver", "stg_financials", partition_by=("period_year",),
    )
    company = store.write(companies(submissions), "silver", "stg_companies")
    store.write(filing_periods(silver), "silver", "stg_filing_periods")
    filings = store.write(flatten_filings(submissions), "silver", "stg_filings")

    dim_company = store.write(
        gold.dim_companies(company, last_filing(filings), as_of, params), "gold", "dim_companies"
    )
    dim_period = store.write(gold.dim_fiscal_periods(silver), "gold", "dim_fiscal_periods")
    dim_concept = store.write(gold.dim_gaap_concepts(seed), "gold", "dim_gaap_concepts")
    fact = store.write(gold.fact_financials(silver), "gold", "fact_financials")
    flags = stored(spark, anomalies.anomaly_flags(silver, facts, params), "flags")
    # So that a page's filter by company, concept or quarter skips most of the table.
    store.write(clustered(flags, ["cik", "canonical_concept", "q_idx"]), "gold", "rpt_anomaly_flags")
    tables = Tables(landed, received, rejected, silver, company, fact, dim_company, dim_period, dim_concept)
    return checks(tables, now, params)


def document_attempts(facts: DataFrame, submissions: DataFrame) -> DataFrame:
    """A ledger row for each document that was read, of either kind."""
    status = F.when(F.col("status") == GOOD, ingest.FETCHED).otherwise(ingest.FAILED)
    columns = [
        "source_path", "source_modified_at", "cik_raw", status.alias("status"),
        F.col("reason").alias("error"), F.col("loaded_at").alias("attempted_at"),
    ]
    return facts.select(F.lit("facts").alias("kind"), *columns).unionByName(
        submissions.select(F.lit("submissions").alias("kind"), *columns)
    )


@dataclass(frozen=True)
class Tables:
    """What the checks look at."""

    documents: DataFrame
    submissions: DataFrame
    rejected_concepts: DataFrame
    silver: DataFrame
    company: DataFrame
    fact: DataFrame
    dim_company: DataFrame
    dim_period: DataFrame
    dim_concept: DataFrame


def checks(tables: Tables, now: Column, params: Params = DEFAULTS) -> DataFrame:
    """Report of every check over the built tables; `failing_rows` counts rows.

    The rules of a table's rows are judged in one pass over the columns they name. Documents
    are judged by their size in bytes; their text is not read again.
    """
    good = F.col("status") == GOOD
    raw, companies_raw = tables.documents, tables.submissions
    stale_before = now - F.expr(f"INTERVAL {params.freshness_hours} HOURS")
    rows = [
        quality.failing_rows(raw, {
            "documents rejected": ~good,
            "not_null raw_company_facts": good
            & quality.any_null(["cik_raw", "entity_name", "facts_bytes", "loaded_at"]),
            "documents fresh": good & (F.col("source_modified_at") < stale_before),
        }),
        quality.failing_rows(companies_raw, {
            "submissions rejected": ~good,
            "not_null raw_submissions": good & quality.any_null(["cik_raw", "company_name_raw", "loaded_at"]),
            "submissions fresh": good & (F.col("source_modified_at") < stale_before),
        }),
        quality.failing_rows(tables.silver, {
            "not_null stg_financials": quality.any_null(
                ["cik", "canonical_concept", "reported_value", "period_end", "form_type",
                 "value_type", "accession_number", "filed_date"]
            ),
            "accepted form_type": quality.outside("form_type", params.accepted_forms),
            "accepted value_type": quality.outside("value_type", params.accepted_value_types),
            "revenue not negative": quality.is_negative_revenue(),
            "values finite": quality.is_non_finite(),
        }),
        quality.failing_rows(
            tables.company, {"not_null stg_companies": quality.any_null(["cik", "company_name"])}
        ),
        quality.failing_rows(
            tables.fact,
            {"not_null fact_financials": quality.any_null(["financial_key", "cik", "period_end"])},
        ),
    ]
    found = {
        "concepts unreadable": tables.rejected_concepts,
        "unique raw_company_facts": quality.duplicates(raw.filter(good), ["cik_raw"]),
        "unique raw_submissions": quality.duplicates(companies_raw.filter(good), ["cik_raw"]),
        "unique stg_companies": quality.duplicates(tables.company, ["cik"]),
        "unique financial_key": quality.duplicates(tables.fact, ["financial_key"]),
        "relationship company": quality.orphans(tables.fact, "cik", tables.dim_company, "cik"),
        "relationship period": quality.orphans(tables.fact, "period_key", tables.dim_period, "period_key"),
        "relationship concept": quality.orphans(
            tables.fact, "canonical_concept", tables.dim_concept, "canonical_tag"
        ),
        "no duplicate periods": quality.duplicates(
            tables.silver, ["cik", "canonical_concept", "period_end"]
        ),
    }
    return quality.report(found, *rows)
