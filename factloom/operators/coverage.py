"""Period coverage per company, and which quarters are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import expected_quarters, quarter_index

COVERAGE_CONCEPT = "Revenues"


def coverage_span(facts: DataFrame) -> DataFrame:
    return facts.groupBy("cik").agg(
        F.min("period_end").alias("first_period"), F.max("period_end").alias("last_period")
    )


def filing_periods(silver: DataFrame, concept: str = COVERAGE_CONCEPT) -> DataFrame:
    """First, last, actual and expected quarters per company; one concept stands for all.

    Silver has one row per period, but the distinct count holds for any input. Extra ends
    that are no quarter ends make `missing_quarters` negative.
    """
    periods = silver.filter(F.col("canonical_concept") == concept).select("cik", "period_end")
    # Distinct first: the per-company step then counts calendar days at most.
    summary = periods.distinct().groupBy("cik").agg(
        F.min("period_end").alias("first_period"),
        F.max("period_end").alias("last_period"),
        F.count("period_end").alias("actual_quarters"),
    )
    expected = expected_quarters("first_period", "last_period").cast("bigint")
    return summary.withColumn("expected_quarters", expected).withColumns(
        {
            "missing_quarters": F.col("expected_quarters") - F.col("actual_quarters"),
            "has_gaps": F.col("expected_quarters") > F.col("actual_quarters"),
        }
    )


def missing_quarters(silver: DataFrame, concept: str = COVERAGE_CONCEPT) -> DataFrame:
    """(cik, q_idx) between a company's first and last period for which nothing was reported."""
    present = (
        silver.filter(F.col("canonical_concept") == concept)
        .select("cik", quarter_index("period_end").alias("q_idx"))
        .distinct()
    )
    spine = present.groupBy("cik").agg(F.min("q_idx").alias("lo"), F.max("q_idx").alias("hi"))
    expected = spine.select("cik", F.explode(F.sequence("lo", "hi")).alias("q_idx"))
    return expected.join(present, ["cik", "q_idx"], "left_anti")
