"""Data behind the overview, financials, anomalies and benchmark pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import pct_change, quarter_index
from factloom.operators.selection import exact_quantile
from factloom.plans.anomalies import ASSETS, EPS, INCOME, REVENUE, yoy_change
from factloom.session import stored
from factloom.sources.partitions import same_keys

OPERATING_INCOME = "OperatingIncomeLoss"


def _latest_of(concept: str) -> Column:
    """Value of one concept at its latest period end within the group."""
    mine = F.col("canonical_concept") == concept
    return F.max(F.when(mine, F.struct("period_end", "reported_value")))["reported_value"]


def overview_cards(silver: DataFrame) -> DataFrame:
    """Latest revenue, net income, EPS and assets per company."""
    return silver.groupBy("cik").agg(
        _latest_of(REVENUE).alias("revenue"),
        _latest_of(INCOME).alias("net_income"),
        _latest_of(EPS).alias("eps"),
        _latest_of(ASSETS).alias("assets"),
    )


def sparkline(silver: DataFrame, quarters: int = 8) -> DataFrame:
    """The last values per (company, concept), oldest first, as an array."""
    newest = Window.partitionBy("cik", "canonical_concept").orderBy(F.col("period_end").desc())
    last = silver.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= quarters)
    point = F.struct("period_end", "reported_value")
    return last.groupBy("cik", "canonical_concept").agg(
        F.sort_array(F.collect_list(point)).alias("points")
    )


def trend_lines(silver: DataFrame) -> DataFrame:
    """Revenue, operating income and net income by quarter, with year-over-year change."""
    shown = silver.filter(F.col("canonical_concept").isin(REVENUE, OPERATING_INCOME, INCOME))
    return yoy_change(shown).select(
        "cik", "canonical_concept", "period_end", "q_idx", "reported_value", "yoy"
    )


def annual_rollup(silver: DataFrame) -> DataFrame:
    """Complete years: flows summed over four quarters, balances taken at the last end."""
    years = silver.groupBy("cik", "canonical_concept", "value_type", "period_year").agg(
        F.count_distinct("calendar_quarter").alias("quarters"),
        F.sum("reported_value").alias("total"),
        F.max_by("reported_value", "period_end").alias("closing"),
    )
    value = F.when(F.col("value_type") == "instant", F.col("closing")).otherwise(F.col("total"))
    return years.filter("quarters = 4").select(
        "cik", "canonical_concept", "period_year", value.alias("annual_value")
    )


def quarter_matrix(silver: DataFrame) -> DataFrame:
    """One row per (company, quarter) with its concepts side by side and their changes."""
    # One exchange by company serves the grouping, the window and a later join by company.
    by_company = silver.repartition("cik")
    wide = by_company.groupBy("cik", quarter_index("period_end").alias("q_idx")).agg(
        _latest_of(REVENUE).alias("revenue"),
        _latest_of(INCOME).alias("net_income"),
    )
    # Range frames of one quarter back: a quarter without data gives null, not an older one.
    before = Window.partitionBy("cik").orderBy("q_idx").rangeBetween(-1, -1)
    return wide.withColumns(
        {
            "revenue_qoq": pct_change("revenue", F.max("revenue").over(before)),
            "income_qoq": pct_change("net_income", F.max("net_income").over(before)),
            "margin": F.col("net_income") / F.nullif("revenue", F.lit(0.0)),
        }
    )


def income_vs_revenue(silver: DataFrame) -> DataFrame:
    """Quarters that report both concepts."""
    both = quarter_matrix(silver).filter("revenue IS NOT NULL AND net_income IS NOT NULL")
    return both.select("cik", "q_idx", "revenue", "net_income", "revenue_qoq", "income_qoq")


def margin_trend(silver: DataFrame) -> DataFrame:
    return quarter_matrix(silver).filter("margin IS NOT NULL").select("cik", "q_idx", "margin")


# Values that a task may hold for one median; groups with more of them are counted through.
MEDIAN_BUFFER = 100_000


def peer_benchmark(
    silver: DataFrame, companies: DataFrame, buffer: int = MEDIAN_BUFFER
) -> DataFrame:
    """Mean growth, mean and median margin per industry code and quarter, over the companies
    that have one of the two.

    Means combine before the shuffle. The median of a group of up to `buffer` companies is
    taken from its values; that of a larger one is found by counting (`exact_quantile`), so no
    task holds a group without a bound. Both give the same value.
    """
    known = quarter_matrix(silver).filter("revenue_qoq IS NOT NULL OR margin IS NOT NULL")
    group = ["sic_code", "q_idx"]
    rows = known.join(companies.select("cik", "sic_code"), "cik").select(*group, "revenue_qoq", "margin")
    rows = stored(silver.sparkSession, rows, "peers")
    large = rows.groupBy(*group).agg(F.count("margin").alias("n")).filter(F.col("n") > buffer).select(*group)
    large = stored(silver.sparkSession, large, "large_groups")
    means = [
        F.count(F.lit(1)).alias("companies"), F.avg("revenue_qoq").alias("avg_growth"),
        F.avg("margin").alias("avg_margin"),
    ]
    median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY margin)").alias("median_margin")
    if large.isEmpty():
        return rows.groupBy(*group).agg(*means, median)
    is_large = same_keys(rows, large, group)
    small = rows.join(large, is_large, "left_anti").groupBy(*group).agg(*means, median)
    rows = rows.join(large, is_large, "left_semi")
    counted = exact_quantile(rows, group, "margin", 0.5, "median_margin")
    mean = rows.groupBy(*group).agg(*means)
    return small.unionByName(
        mean.join(counted, same_keys(mean, counted, group)).select(mean["*"], counted["median_margin"])
    )


def growth_index(silver: DataFrame, concept: str = REVENUE) -> DataFrame:
    """A concept relative to the company's first period, which is 100."""
    series = Window.partitionBy("cik").orderBy("period_end")
    base = F.first("reported_value").over(series)
    return silver.filter(F.col("canonical_concept") == concept).select(
        "cik",
        "period_end",
        (F.col("reported_value") * 100.0 / F.nullif(base, F.lit(0.0))).alias("growth_index"),
    )
