"""Resolving amendments, overlapping forms and repeated loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import base_form, fiscal_quarter

PERIOD_KEY = ("cik", "canonical_concept", "period_end")

# Most recent filing first; the columns after filed_date only make the order total.
RECENCY = ("filed_date", "accession_number", "raw_concept", "period_start", "reported_value")


def _most_recent_first() -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in RECENCY]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key.

    The planner puts a group limit before the shuffle, so a hot key sends one row per
    input task and never gathers in one place. The leading hash changes no group; it
    gives the sorts a distinctive number where zero-padded keys all begin alike.
    """
    window = Window.partitionBy("_hash", *keys).orderBy(*order)
    numbered = df.withColumn("_hash", F.xxhash64(*keys)).withColumn(
        "_rn", F.row_number().over(window)
    )
    return numbered.filter("_rn = 1").drop("_rn", "_hash")


def latest_per_key(facts: DataFrame, include_start: bool = False) -> DataFrame:
    """Most recently filed row per (cik, concept, period end, form).

    `include_start` keeps values of different length that end on one day apart.
    """
    keys = [*PERIOD_KEY, "form_type"] + (["period_start"] if include_start else [])
    return first_per_key(facts, keys, _most_recent_first())


def amendment_supersede(facts: DataFrame) -> DataFrame:
    """As `latest_per_key`, with an amendment competing against the form it amends."""
    keyed = facts.withColumn("base_form", base_form("form_type"))
    return first_per_key(keyed, [*PERIOD_KEY, "base_form"], _most_recent_first())


def form_rank(period_end: str = "period_end") -> Column:
    """1 for the preferred source: 10-Q in Q1-Q3, 10-K in Q4 or for a full year; else 2."""
    quarter, form = fiscal_quarter(period_end), F.col("form_type")
    return (
        F.when(quarter.isin(1, 2, 3) & (form == "10-Q"), 1)
        .when((quarter == 4) & (form == "10-K"), 1)
        .when((F.col("fiscal_period_label") == "FY") & (form == "10-K"), 1)
        .otherwise(2)
    )


def prefer_form(facts: DataFrame) -> DataFrame:
    """One row per (cik, concept, period end), from the preferred form."""
    chosen = first_per_key(facts, list(PERIOD_KEY), [form_rank(), *_most_recent_first()])
    return with_calendar(chosen)


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"calendar_quarter": fiscal_quarter("period_end"), "period_year": F.year("period_end")}
    )


def resolve_filings(facts: DataFrame) -> DataFrame:
    """`prefer_form(latest_per_key(facts))` in one aggregation, plus `normalized_value`.

    Which row wins depends only on the latest row of each of five form classes, so each
    class is one maximum of a struct that starts with the recency columns. Maxima combine
    before the shuffle: a key moves one row per input task however many filings it has,
    and both steps and the restated value share a single exchange. As in `first_per_key`,
    the hash is only there for the sort.

    `normalized_value` is the latest value of the winner's form, amendments included.
    """
    payload = [c for c in facts.columns if c not in PERIOD_KEY and c not in RECENCY]
    row = f"struct({', '.join([*RECENCY, *payload])})"
    classes = {
        "quarterly": "form_type = '10-Q'",
        "annual": "form_type = '10-K'",
        "quarterly_amended": "form_type = '10-Q/A'",
        "annual_amended": "form_type = '10-K/A'",
        "other": "coalesce(form_type NOT IN ('10-Q', '10-K', '10-Q/A', '10-K/A'), true)",
    }
    latest = facts.groupBy(F.expr(f"xxhash64({', '.join(PERIOD_KEY)})").alias("_hash"), *PERIOD_KEY).agg(
        *[F.expr(f"max(CASE WHEN {c} THEN {row} END)").alias(n) for n, c in classes.items()]
    )
    winner = f"""coalesce(
        greatest(CASE WHEN quarter(period_end) < 4 THEN quarterly END,
                 CASE WHEN quarter(period_end) = 4 OR annual.fiscal_period_label = 'FY'
                      THEN annual END),
        greatest({', '.join(classes)}))"""
    normalized = """CASE w.form_type
        WHEN '10-Q' THEN greatest(quarterly, quarterly_amended).reported_value
        WHEN '10-K' THEN greatest(annual, annual_amended).reported_value
        ELSE w.reported_value END"""
    return latest.withColumn("w", F.expr(winner)).selectExpr(
        *PERIOD_KEY,
        *[f"w.{c} AS {c}" for c in facts.columns if c not in PERIOD_KEY],
        "quarter(period_end) AS calendar_quarter",
        "year(period_end) AS period_year",
        f"{normalized} AS normalized_value",
    )


def latest_load_per_company(raw: DataFrame) -> DataFrame:
    """Freshest record per unpadded identifier."""
    order = [F.col("loaded_at").desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in raw.columns if c.endswith("_raw") and c != "cik_raw"]
    return first_per_key(raw, ["cik_raw"], order)
