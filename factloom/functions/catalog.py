"""The column functions and lookups under names that SQL text can call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factloom.functions.columns import IDENTIFIER_WIDTH

SEED_VIEW = "gaap_tag_synonyms"

# Name and parameters, result, body. A body is an expression (or a query for a table) that the
# planner puts in the place of the call, so SQL plans like the same DataFrame code.
SCALARS = {
    "fiscal_quarter(day DATE)": ("INT", "quarter(day)"),
    "quarter_index(day DATE)": ("INT", "year(day) * 4 + quarter(day)"),
    "expected_quarters(first_day DATE, last_day DATE)": (
        "INT", "(year(last_day) - year(first_day)) * 4 + quarter(last_day) - quarter(first_day) + 1",
    ),
    "pad_identifier(identifier STRING)": ("STRING", f"lpad(identifier, {IDENTIFIER_WIDTH}, '0')"),
    "base_form(form STRING)": ("STRING", "regexp_replace(form, '/A$', '')"),
    "pct_change(value DOUBLE, previous DOUBLE)": (
        "DOUBLE", "(value - previous) / nullif(abs(previous), 0.0D)",
    ),
    "period_key(day DATE)": ("INT", "year(day) * 10000 + month(day) * 100 + day(day)"),
    # One row for each synonym, so the maximum is the only one; the planner makes it a join.
    "normalize_gaap_tag(tag STRING)": (
        "STRING",
        f"coalesce((SELECT max(canonical_tag) FROM {SEED_VIEW} WHERE synonym_tag = tag), tag)",
    ),
}
TABLES = {
    "synonyms_of(canonical STRING)": (
        "synonym_tag STRING, statement_type STRING",
        f"SELECT synonym_tag, statement_type FROM {SEED_VIEW} WHERE canonical_tag = canonical",
    ),
}


def register(spark: SparkSession, seed: DataFrame) -> None:
    """Make the functions known to the session's SQL, over the synonyms given."""
    seed.createOrReplaceTempView(SEED_VIEW)
    for signature, (kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")
    for signature, (columns, body) in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS TABLE ({columns}) RETURN {body}")
