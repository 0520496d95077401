"""Silver relations from bronze documents or from fact-shaped rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from factloom.operators.dedup import latest_per_key, prefer_form, resolve_filings
from factloom.operators.extract import extracted_facts, usable_facts
from factloom.operators.normalize import normalize_tag
from factloom.params import DEFAULTS, Params

SILVER_COLUMNS = (
    "cik", "entity_name", "raw_concept", "canonical_concept", "reported_value",
    "period_start", "period_end", "accession_number", "form_type", "filed_date",
    "fiscal_period_label", "value_type", "calendar_quarter", "period_year",
)


def typed_rows(rows: DataFrame, seed: DataFrame) -> DataFrame:
    """Rows (with `form_raw`) of all forms, typed and normalised like the entries of a document."""
    typed = rows.selectExpr(
        "cik",
        "entity_name",
        "raw_concept",
        "reported_value",
        "period_start",
        "period_end",
        "accession_number",
        "upper(form_raw) AS form_type",
        "filed_date",
        "fiscal_period_label",
        "if(period_start IS NULL, 'instant', 'duration') AS value_type",
    )
    return normalize_tag(seed)(typed)


def facts_from_rows(rows: DataFrame, seed: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The usable ones of `typed_rows`."""
    return usable_facts(typed_rows(rows, seed), params)


def silver_financials(facts: DataFrame) -> DataFrame:
    """One row per (cik, canonical_concept, period_end), plus `normalized_value`."""
    return resolve_filings(facts).select(*SILVER_COLUMNS, "normalized_value")


def silver_stepwise(facts: DataFrame) -> DataFrame:
    """The same rows from the two separate steps; the plain reading of the rules."""
    return prefer_form(latest_per_key(facts)).select(*SILVER_COLUMNS)


def stg_financials(bronze: DataFrame, seed: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    return silver_financials(extracted_facts(bronze, seed, params))
