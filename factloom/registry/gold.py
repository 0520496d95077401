"""Star schema, measures, anomaly rules and report queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import ordering
from factloom.operators.companies import companies, flatten_filings, last_filing
from factloom.operators.extract import usable_facts
from factloom.params import Params
from factloom.plans import anomalies, gold, reports
from factloom.plans.silver import silver_financials, typed_rows
from factloom.registry.base import CTES, bronze_submissions, facts, query, rows, silver, sql
from factloom.session import stored
from factloom.sources import seeds


def _company_dimension(spark: SparkSession, folder: str) -> DataFrame:
    raw = stored(spark, bronze_submissions(spark, folder), "raw_submissions")
    last = stored(spark, last_filing(flatten_filings(raw)), "last_filings")
    as_of = last.agg(F.max("last_filed")).scalar()
    return gold.dim_companies(companies(raw), last, as_of)


@query("dim_companies", sql("""
    SELECT c.cik, company_name, sic_code, sic_description, state_of_incorporation,
           primary_ticker, primary_exchange, CAST(last_filed AS VARCHAR) AS last_filed,
           coalesce(last_filed >= (SELECT max(filed_date) FROM filings) - INTERVAL 18 MONTH, false)
               AS is_active
    FROM companies c
    LEFT JOIN (SELECT cik, max(filed_date) AS last_filed FROM filings GROUP BY cik) f
         ON f.cik = c.cik""", "companies", "filings"))
def dim_companies(spark: SparkSession, folder: str) -> DataFrame:
    return _company_dimension(spark, folder).drop("loaded_at")


@query("dim_fiscal_periods", sql("""
    SELECT period_key, CAST(period_end AS VARCHAR) AS period_end, calendar_year,
           calendar_quarter, fiscal_label FROM periods""", "periods"))
def dim_fiscal_periods(spark: SparkSession, folder: str) -> DataFrame:
    return gold.dim_fiscal_periods(silver(spark, folder))


@query("dim_gaap_concepts", sql("""
    SELECT c.*, coalesce(n, 0) AS reported_facts
    FROM concepts c LEFT JOIN (SELECT canonical_concept, count(*) AS n FROM facts GROUP BY 1)
         ON canonical_concept = canonical_tag""", "concepts", "facts"))
def dim_gaap_concepts(spark: SparkSession, folder: str) -> DataFrame:
    concepts = gold.dim_gaap_concepts(seeds.synonyms(spark))
    used = facts(spark, folder).groupBy("canonical_concept").agg(F.count(F.lit(1)).alias("n"))
    joined = concepts.join(used, F.col("canonical_tag") == F.col("canonical_concept"), "left")
    return joined.select(*concepts.columns, F.coalesce("n", F.lit(0)).alias("reported_facts"))


@query("fact_financials", sql("""
    SELECT financial_key, cik, canonical_concept, period_key,
           CAST(period_end AS VARCHAR) AS period_end, reported_value, normalized_value,
           is_restated, value_type, form_type, CAST(filed_date AS VARCHAR) AS filed_date,
           accession_number, raw_concept, fiscal_period_label, missing_quarters, has_gaps
    FROM fact""", "fact"))
def fact_financials(spark: SparkSession, folder: str) -> DataFrame:
    return gold.fact_financials(silver(spark, folder))


_STAR_SQL = """
    SELECT financial_key, f.canonical_concept, reported_value, display_label, kind, fiscal_label,
           company_name, primary_ticker
    FROM fact f {how} JOIN concepts k ON k.canonical_tag = f.canonical_concept
    {how} JOIN periods p ON p.period_key = f.period_key
    {how} JOIN companies c ON c.cik = f.cik"""


def _star(spark: SparkSession, folder: str, how: str) -> DataFrame:
    resolved = stored(spark, silver(spark, folder), "silver")
    joined = gold.star_join(
        gold.fact_financials(resolved),
        companies(bronze_submissions(spark, folder)),
        gold.dim_fiscal_periods(resolved),
        gold.dim_gaap_concepts(seeds.synonyms(spark)),
        how,
    )
    return joined.select(
        "financial_key", "canonical_concept", "reported_value", "display_label", "kind",
        "fiscal_label", "company_name", "primary_ticker",
    )


@query("fact_star_join", sql(_STAR_SQL.format(how=""), "fact", "concepts", "periods", "companies"))
def fact_star_join(spark: SparkSession, folder: str) -> DataFrame:
    return _star(spark, folder, "inner")


@query("fact_star_left", sql(_STAR_SQL.format(how="LEFT"), "fact", "concepts", "periods", "companies"))
def fact_star_left(spark: SparkSession, folder: str) -> DataFrame:
    return _star(spark, folder, "left")


# Measures --------------------------------------------------------------------------------

_PERIOD_SQL = "SELECT cik, canonical_concept, CAST(period_end AS VARCHAR) AS period_end"


@query("qoq_change", sql(f"{_PERIOD_SQL}, reported_value, prev_value, qoq FROM qoq", "qoq"))
def qoq_change(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.qoq_change(silver(spark, folder)).select(
        "cik", "canonical_concept", "period_end", "reported_value", "prev_value", "qoq"
    )


@query("yoy_same_quarter", sql("""
    SELECT a.cik, a.canonical_concept, CAST(a.period_end AS VARCHAR) AS period_end,
           b.reported_value AS prior_year_value,
           (a.reported_value - b.reported_value) / nullif(abs(b.reported_value), 0) AS yoy
    FROM silver a LEFT JOIN silver b ON b.cik = a.cik AND b.q_idx = a.q_idx - 4
         AND b.canonical_concept = a.canonical_concept""", "silver"))
def yoy_same_quarter(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.yoy_change(silver(spark, folder)).select(
        "cik", "canonical_concept", "period_end", "prior_year_value", "yoy"
    )


@query("trailing_stats", sql(f"""
    {_PERIOD_SQL}, CASE WHEN prior_rows = 8 THEN round(mean8, 6) END AS trailing_mean,
           CASE WHEN prior_rows = 8 THEN round(dev8, 3) END AS trailing_stddev
    FROM trailing8""", "trailing8"))
def trailing_stats(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.trailing_stats(silver(spark, folder)).select(
        "cik", "canonical_concept", "period_end",
        F.round("trailing_mean", 6).alias("trailing_mean"),
        F.round("trailing_stddev", 3).alias("trailing_stddev"),
    )


@query("restatements", sql(f"""
    {_PERIOD_SQL}, raw_concept, accession_number, prev_accession_number, reported_value,
           prev_reported_value, change FROM restated""", "restated"))
def restatements(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.restatements(facts(spark, folder)).select(
        "cik", "canonical_concept", "period_end", "raw_concept", "accession_number",
        "prev_accession_number", "reported_value", "prev_reported_value", "change",
    )


# Rules -----------------------------------------------------------------------------------

_FLAG_SQL = """SELECT cik, canonical_concept, CAST(period_end AS VARCHAR) AS period_end, q_idx,
    accession_number, rule, round(observed, 6) AS observed, threshold,
    round(severity, 6) AS severity"""


def _rounded(flags: DataFrame) -> DataFrame:
    return flags.withColumns(
        {c: F.round(c, 6) for c in ("observed", "severity")}
    )


def _one_rule(spark: SparkSession, folder: str, rule: Column, *concepts: str) -> DataFrame:
    """A rule over the concepts it looks at."""
    return _rounded(anomalies.fired_rules(silver(spark, folder, *concepts), [rule]))


@query("anomaly_revenue_spike", sql(f"{_FLAG_SQL} FROM r1", "r1"))
def anomaly_revenue_spike(spark: SparkSession, folder: str) -> DataFrame:
    return _one_rule(spark, folder, anomalies.revenue_spike(), anomalies.REVENUE)


# Fixed value of the query: a threshold other than the usual one.
STRICT = 0.5


@query("anomaly_strict_params", sql(
    f"{_FLAG_SQL} FROM ({CTES['r1'].partition('(')[2].rpartition(')')[0].replace('0.3', str(STRICT))})", "qoq"))
def anomaly_strict_params(spark: SparkSession, folder: str) -> DataFrame:
    """The revenue rule under parameters of the caller's own."""
    params = Params(revenue_qoq_threshold=STRICT)
    fired = anomalies.fired_rules(silver(spark, folder, anomalies.REVENUE), [anomalies.revenue_spike(params)], params)
    return _rounded(fired)


@query("anomaly_sign_flip", sql(f"{_FLAG_SQL} FROM r2", "r2"))
def anomaly_sign_flip(spark: SparkSession, folder: str) -> DataFrame:
    return _one_rule(spark, folder, anomalies.income_sign_flip(), anomalies.INCOME, anomalies.REVENUE)


@query("anomaly_eps_drop", sql(f"{_FLAG_SQL} FROM r3", "r3"))
def anomaly_eps_drop(spark: SparkSession, folder: str) -> DataFrame:
    return _one_rule(spark, folder, anomalies.eps_drop(), anomalies.EPS)


@query("anomaly_asset_jump", sql(f"{_FLAG_SQL} FROM r4", "r4"))
def anomaly_asset_jump(spark: SparkSession, folder: str) -> DataFrame:
    return _one_rule(spark, folder, anomalies.asset_jump(), anomalies.ASSETS)


def _flags(spark: SparkSession, folder: str) -> DataFrame:
    """The facts serve twice and are built once."""
    base = stored(spark, facts(spark, folder), "facts")
    return anomalies.anomaly_flags(silver_financials(base), base)


@query("anomaly_flags", sql(f"{_FLAG_SQL} FROM flags", "flags"))
def anomaly_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(_flags(spark, folder))


_FEED_ORDER = "ORDER BY severity DESC NULLS LAST, cik, canonical_concept, period_end, rule"


@query("anomaly_feed", sql(f"""
    {_FLAG_SQL}, 'filings/' || cik || '/' || accession_number AS filing_link
    FROM flags {_FEED_ORDER}""", "flags"))
def anomaly_feed(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(anomalies.anomaly_feed(_flags(spark, folder)))


# Fixed value of the page: flags that it shows at a time.
PAGE = 25


@query("anomaly_page", sql(f"""
    SELECT *, (rank - 1) // {PAGE} + 1 AS page FROM (
        SELECT *, row_number() OVER ({_FEED_ORDER}) AS rank FROM ({_FLAG_SQL} FROM flags))""", "flags"))
def anomaly_page(spark: SparkSession, folder: str) -> DataFrame:
    """Every flag with its rank in the feed and the page that shows it."""
    ranks = ordering.ranked(_rounded(_flags(spark, folder)), anomalies.feed_order())
    return ranks.withColumn("page", F.floor((F.col("rank") - 1) / PAGE) + 1)


@query("anomaly_feed_filtered", sql(f"""
    {_FLAG_SQL}, 'filings/' || cik || '/' || accession_number AS filing_link
    FROM flags WHERE cik = '0000000007' AND canonical_concept = 'Revenues'""", "flags"))
def anomaly_feed_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """The feed for one company and concept chosen on the page."""
    chosen = anomalies.anomaly_feed(_flags(spark, folder), cik="0000000007", concept="Revenues")
    return _rounded(chosen)


@query("event_window_join", sql("""
    SELECT f.cik, f.canonical_concept, CAST(f.period_end AS VARCHAR) AS period_end, f.rule,
           count(*) AS events, CAST(min(e.filed_date) AS VARCHAR) AS first_event,
           CAST(max(e.filed_date) AS VARCHAR) AS last_event
    FROM flags f JOIN filing_rows e ON e.cik = f.cik AND upper(e.form_raw) = '8-K'
         AND e.filed_date BETWEEN f.period_end AND f.period_end + 90
    GROUP BY f.cik, f.canonical_concept, f.period_end, f.rule""", "flags", "filing_rows"))
def event_window_join(spark: SparkSession, folder: str) -> DataFrame:
    """One stored relation, of all forms, serves the facts and the events."""
    filed = stored(spark, typed_rows(rows(spark, folder), seeds.synonyms(spark)), "filed")
    base = usable_facts(filed)
    events = filed.filter("form_type = '8-K'").select("cik", F.col("filed_date").alias("event_date"))
    flags = anomalies.anomaly_flags(silver_financials(base), base)
    return anomalies.events_near_anomalies(flags, events)


# Pages -----------------------------------------------------------------------------------

_CARDS = (anomalies.REVENUE, anomalies.INCOME, anomalies.EPS, anomalies.ASSETS)
_MARGIN = (anomalies.REVENUE, anomalies.INCOME)


@query("overview_cards", sql("""
    SELECT cik,
           arg_max(reported_value, period_end) FILTER (canonical_concept = 'Revenues') AS revenue,
           arg_max(reported_value, period_end) FILTER (canonical_concept = 'NetIncomeLoss')
               AS net_income,
           arg_max(reported_value, period_end) FILTER (canonical_concept = 'EarningsPerShareBasic')
               AS eps,
           arg_max(reported_value, period_end) FILTER (canonical_concept = 'Assets') AS assets
    FROM silver GROUP BY cik""", "silver"))
def overview_cards(spark: SparkSession, folder: str) -> DataFrame:
    return reports.overview_cards(silver(spark, folder, *_CARDS))


@query("sparkline_last8", sql("""
    SELECT cik, canonical_concept, count(*) AS quarters,
           string_agg(CAST(period_end AS VARCHAR) || '=' ||
                      CAST(CAST(round(reported_value * 100) AS BIGINT) AS VARCHAR), ','
                      ORDER BY period_end) AS points
    FROM (SELECT * FROM silver QUALIFY row_number() OVER (
              PARTITION BY cik, canonical_concept ORDER BY period_end DESC) <= 8)
    GROUP BY cik, canonical_concept""", "silver"))
def sparkline_last8(spark: SparkSession, folder: str) -> DataFrame:
    """Points as text in cents, so that both engines write them alike."""
    lines = reports.sparkline(silver(spark, folder))
    cents = lambda p: F.round(p["reported_value"] * 100).cast("bigint").cast("string")
    text = F.transform("points", lambda p: F.concat_ws("=", p["period_end"].cast("string"), cents(p)))
    return lines.select(
        "cik", "canonical_concept", F.size("points").cast("bigint").alias("quarters"),
        F.array_join(text, ",").alias("points"),
    )


@query("trend_lines", sql("""
    SELECT a.cik, a.canonical_concept, CAST(a.period_end AS VARCHAR) AS period_end, a.q_idx,
           a.reported_value,
           (a.reported_value - b.reported_value) / nullif(abs(b.reported_value), 0) AS yoy
    FROM silver a LEFT JOIN silver b ON b.cik = a.cik AND b.q_idx = a.q_idx - 4
         AND b.canonical_concept = a.canonical_concept
    WHERE a.canonical_concept IN ('Revenues', 'OperatingIncomeLoss', 'NetIncomeLoss')""", "silver"))
def trend_lines(spark: SparkSession, folder: str) -> DataFrame:
    return reports.trend_lines(silver(spark, folder))


@query("annual_rollup", sql("""
    SELECT cik, canonical_concept, period_year,
           round(CASE WHEN value_type = 'instant' THEN arg_max(reported_value, period_end)
                      ELSE sum(reported_value) END, 2) AS annual_value
    FROM silver GROUP BY cik, canonical_concept, value_type, period_year
    HAVING count(DISTINCT calendar_quarter) = 4""", "silver"))
def annual_rollup(spark: SparkSession, folder: str) -> DataFrame:
    rolled = reports.annual_rollup(silver(spark, folder))
    return rolled.withColumn("annual_value", F.round("annual_value", 2))


@query("income_vs_revenue", sql("""
    SELECT cik, q_idx, revenue, net_income, revenue_qoq, income_qoq FROM matrix
    WHERE revenue IS NOT NULL AND net_income IS NOT NULL""", "matrix"))
def income_vs_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.income_vs_revenue(silver(spark, folder, *_MARGIN))


@query("margin_trend", sql(
    "SELECT cik, q_idx, margin FROM matrix WHERE margin IS NOT NULL", "matrix"))
def margin_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.margin_trend(silver(spark, folder, *_MARGIN))


@query("peer_benchmark", sql("""
    SELECT sic_code, q_idx, count(*) AS companies, round(avg(revenue_qoq), 6) AS avg_growth,
           round(avg(margin), 6) AS avg_margin,
           round(quantile_disc(margin, 0.5), 6) AS median_margin
    FROM matrix m JOIN companies c ON c.cik = m.cik
    WHERE revenue_qoq IS NOT NULL OR margin IS NOT NULL GROUP BY sic_code, q_idx""",
    "matrix", "companies"))
def peer_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    directory = companies(bronze_submissions(spark, folder))
    peers = reports.peer_benchmark(silver(spark, folder, *_MARGIN), directory)
    return peers.withColumns(
        {c: F.round(c, 6) for c in ("avg_growth", "avg_margin", "median_margin")}
    )


@query("growth_index", sql("""
    SELECT cik, CAST(period_end AS VARCHAR) AS period_end,
           reported_value * 100 / nullif(first(reported_value) OVER (
               PARTITION BY cik ORDER BY period_end), 0) AS growth_index
    FROM silver WHERE canonical_concept = 'Revenues'""", "silver"))
def growth_index(spark: SparkSession, folder: str) -> DataFrame:
    return reports.growth_index(silver(spark, folder))
