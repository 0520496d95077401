"""Star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import expected_quarters, fiscal_quarter, period_key, surrogate_key
from factloom.operators.coverage import COVERAGE_CONCEPT
from factloom.params import DEFAULTS, Params


def dim_companies(
    companies: DataFrame, last_filings: DataFrame, as_of: Column, params: Params = DEFAULTS
) -> DataFrame:
    """Companies with an activity flag: a filing in the months before `as_of`."""
    since = F.add_months(as_of, -params.inactive_after_months)
    return companies.join(last_filings, "cik", "left").withColumn(
        "is_active", F.coalesce(F.col("last_filed") >= since, F.lit(False))
    )


def dim_fiscal_periods(facts: DataFrame) -> DataFrame:
    """One row per period end; the fiscal label most filers give it."""
    # Count per (period, label) first: a handful of rows per period reach the second step.
    labels = facts.groupBy("period_end", "fiscal_period_label").agg(F.count(F.lit(1)).alias("n"))
    periods = labels.groupBy("period_end").agg(
        F.max_by(
            "fiscal_period_label",
            F.when(F.col("fiscal_period_label").isNotNull(), F.struct("n", "fiscal_period_label")),
        ).alias("fiscal_label")
    )
    return periods.select(
        period_key("period_end").alias("period_key"),
        "period_end",
        F.year("period_end").alias("calendar_year"),
        fiscal_quarter("period_end").alias("calendar_quarter"),
        "fiscal_label",
    )


def dim_gaap_concepts(seed: DataFrame) -> DataFrame:
    """One row per canonical concept; BS concepts are snapshots, the others flows."""
    return seed.groupBy("canonical_tag").agg(
        F.min("statement_type").alias("statement_type"),
        F.min("display_label").alias("display_label"),
        F.count(F.lit(1)).alias("synonym_count"),
    ).withColumn("kind", F.when(F.col("statement_type") == "BS", "balance").otherwise("flow"))


def with_gap_flags(silver: DataFrame, concept: str = COVERAGE_CONCEPT) -> DataFrame:
    """Coverage of the company on each of its silver rows, without a second read of silver.

    Silver is unique per (cik, concept, period end), so a company's window is bounded by
    concepts times calendar, and counting rows counts distinct period ends.
    """
    company = Window.partitionBy("cik")
    end = F.when(F.col("canonical_concept") == concept, F.col("period_end"))
    expected = expected_quarters(F.min(end).over(company), F.max(end).over(company))
    missing = expected.cast("bigint") - F.count(end).over(company)
    return silver.withColumn("missing_quarters", missing).withColumn(
        "has_gaps", F.col("missing_quarters") > 0
    )


def fact_financials(silver: DataFrame) -> DataFrame:
    """Fact table with surrogate key, dimension keys, lineage columns and restated value."""
    return with_gap_flags(silver).select(
        surrogate_key("cik", "canonical_concept", "period_end").alias("financial_key"),
        "cik",
        "canonical_concept",
        period_key("period_end").alias("period_key"),
        "period_end",
        "reported_value",
        "normalized_value",
        (F.col("reported_value") != F.col("normalized_value")).alias("is_restated"),
        "value_type",
        "form_type",
        "filed_date",
        "accession_number",
        "raw_concept",
        "fiscal_period_label",
        "missing_quarters",
        "has_gaps",
    )


def star_join(
    facts: DataFrame, companies: DataFrame, periods: DataFrame, concepts: DataFrame, how: str = "inner"
) -> DataFrame:
    """Facts with their dimensions; `how="left"` keeps facts whose keys have no parent.

    Dimensions carry no broadcast hint: their sizes are known to the planner or measured
    at run time, and a company dimension that outgrew the threshold would be shuffled.
    """
    return (
        facts.join(concepts, facts["canonical_concept"] == concepts["canonical_tag"], how)
        .drop("canonical_tag")
        .join(periods.drop("period_end"), "period_key", how)
        .join(companies, "cik", how)
    )
