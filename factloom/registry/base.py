"""Registration, shared relations and their SQL twins."""

from __future__ import annotations

import csv
from collections.abc import Callable
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.plans import silver as silver_plan
from factloom.sources import documents as docs
from factloom.sources import seeds, tables

Query = Callable[[SparkSession, str], DataFrame]

queries: dict[str, Query] = {}
oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; dates leave it as ISO text, which every engine writes alike."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return with_text_dates(build(spark, folder))

        queries[name] = run
        if sql is not None:
            oracles[name] = sql
        return build

    return register


def with_text_dates(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({d: F.col(d).cast("string") for d in dates}) if dates else df


# Relations -------------------------------------------------------------------------------


def rows(spark: SparkSession, folder: str) -> DataFrame:
    return tables.filing_facts(spark, folder)


def facts(spark: SparkSession, folder: str) -> DataFrame:
    return silver_plan.facts_from_rows(rows(spark, folder), seeds.synonyms(spark))


def silver(spark: SparkSession, folder: str, *concepts: str) -> DataFrame:
    """Resolved facts; with `concepts` only theirs, left out before anything is resolved."""
    found = facts(spark, folder)
    return silver_plan.silver_financials(
        found.filter(F.col("canonical_concept").isin(*concepts)) if concepts else found
    )


def fact_documents(spark: SparkSession, folder: str) -> DataFrame:
    return docs.fold_fact_documents(rows(spark, folder))


def bronze_facts(spark: SparkSession, folder: str) -> DataFrame:
    parsed = docs.parse_document_text(fact_documents(spark, folder).drop("cik"))
    return docs.raw_company_facts(parsed)


def bronze_submissions(spark: SparkSession, folder: str) -> DataFrame:
    texts = tables.submission_documents(spark, folder)
    parsed = F.from_json("document", docs.SUBMISSIONS_DOCUMENT)
    expanded = texts.select("loaded_at", parsed.alias("d")).select("loaded_at", "d.*")
    return docs.raw_submissions(expanded, F.col("loaded_at"))


# SQL twins -------------------------------------------------------------------------------


def _values(name: str) -> str:
    text = resources.files("factloom.seeds").joinpath(name).read_text(encoding="utf-8")
    reader = csv.reader(line for line in text.splitlines() if not line.startswith("#"))
    header = next(reader)
    body = ", ".join(
        "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in reader
    )
    return f"({', '.join(header)}) AS (VALUES {body})"


CTES = {
    "synonyms": "synonyms" + _values("gaap_tag_synonyms.csv"),
    "tracked": "tracked" + _values("companies.csv"),
    "filing_rows": """filing_rows AS (
        SELECT o_orderkey,
               lpad(CAST(c_nationkey AS VARCHAR), 10, '0') AS cik,
               'Entity ' || CAST(c_nationkey AS VARCHAR) AS entity_name,
               CASE o_orderpriority
                   WHEN '1-URGENT' THEN 'Revenues'
                   WHEN '2-HIGH' THEN 'SalesRevenueNet'
                   WHEN '3-MEDIUM' THEN 'NetIncomeLoss'
                   WHEN '4-NOT SPECIFIED' THEN 'Assets'
                   ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'EarningsPerShareBasic'
                             ELSE 'UnmappedTag' END END AS raw_concept,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_totalprice - 150000.0
                    ELSE o_totalprice END AS reported_value,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
                    THEN CAST(date_trunc('quarter', o_orderdate) AS DATE) END AS period_start,
               last_day(CAST(date_trunc('quarter', o_orderdate) AS DATE) + INTERVAL 2 MONTH)
                   AS period_end,
               lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS accession_number,
               CASE WHEN o_orderkey % 10 = 0 THEN '8-k'
                    WHEN o_orderkey % 10 = 1 THEN '10-K/A'
                    WHEN o_orderkey % 10 = 2 THEN '10-Q/A'
                    WHEN o_orderkey % 10 IN (3, 4, 5) THEN '10-K' ELSE '10-Q' END AS form_raw,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INTEGER) AS filed_date,
               CASE WHEN quarter(o_orderdate) = 4 THEN 'FY'
                    ELSE 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) END AS fiscal_period_label,
               o_orderkey // :facts_keys AS part
        FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "facts": """facts AS (
        SELECT r.* EXCLUDE (form_raw), upper(form_raw) AS form_type,
               coalesce(s.canonical_tag, raw_concept) AS canonical_concept,
               CASE WHEN period_start IS NULL THEN 'instant' ELSE 'duration' END AS value_type,
               CAST(year(period_end) * 4 + quarter(period_end) AS INTEGER) AS q_idx
        FROM filing_rows r LEFT JOIN synonyms s ON s.synonym_tag = r.raw_concept
        WHERE upper(form_raw) NOT IN ('8-K', '8-K/A'))""",
    "latest": """latest AS (
        SELECT * FROM facts
        QUALIFY row_number() OVER (
            PARTITION BY cik, canonical_concept, period_end, form_type
            ORDER BY filed_date DESC NULLS LAST, accession_number DESC) = 1)""",
    "silver": """silver AS (
        SELECT *, CAST(quarter(period_end) AS INTEGER) AS calendar_quarter,
               CAST(year(period_end) AS INTEGER) AS period_year
        FROM latest
        QUALIFY row_number() OVER (
            PARTITION BY cik, canonical_concept, period_end
            ORDER BY CASE WHEN quarter(period_end) IN (1, 2, 3) AND form_type = '10-Q' THEN 1
                          WHEN quarter(period_end) = 4 AND form_type = '10-K' THEN 1
                          WHEN fiscal_period_label = 'FY' AND form_type = '10-K' THEN 1
                          ELSE 2 END,
                     filed_date DESC NULLS LAST, accession_number DESC) = 1)""",
    "superseded": """superseded AS (
        SELECT *, regexp_replace(form_type, '/A$', '') AS base_form FROM facts
        QUALIFY row_number() OVER (
            PARTITION BY cik, canonical_concept, period_end, regexp_replace(form_type, '/A$', '')
            ORDER BY filed_date DESC NULLS LAST, accession_number DESC) = 1)""",
    "coverage": """coverage AS (
        SELECT cik, min(period_end) AS first_period, max(period_end) AS last_period,
               count(DISTINCT period_end) AS actual_quarters,
               datediff('quarter', min(period_end), max(period_end)) + 1 AS expected_quarters
        FROM silver WHERE canonical_concept = 'Revenues' GROUP BY cik)""",
    "fact": """fact AS (
        SELECT sha256(concat_ws('|', s.cik, s.canonical_concept, CAST(s.period_end AS VARCHAR)))
                   AS financial_key,
               CAST(strftime(s.period_end, '%Y%m%d') AS INTEGER) AS period_key,
               s.*, a.reported_value AS normalized_value,
               s.reported_value <> a.reported_value AS is_restated,
               c.expected_quarters - c.actual_quarters AS missing_quarters,
               c.expected_quarters > c.actual_quarters AS has_gaps
        FROM silver s
        JOIN superseded a ON a.cik = s.cik AND a.canonical_concept = s.canonical_concept
             AND a.period_end = s.period_end
             AND a.base_form = regexp_replace(s.form_type, '/A$', '')
        LEFT JOIN coverage c ON c.cik = s.cik)""",
    "changes": """changes AS (
        SELECT *, CASE WHEN q_idx - lag(q_idx) OVER w = 1 THEN lag(reported_value) OVER w END
                   AS prev_value
        FROM silver WINDOW w AS (PARTITION BY cik, canonical_concept ORDER BY period_end))""",
    "qoq": """qoq AS (
        SELECT *, (reported_value - prev_value) / nullif(abs(prev_value), 0) AS qoq FROM changes)""",
    "trailing8": """trailing8 AS (
        SELECT *, count(*) OVER w AS prior_rows, avg(reported_value) OVER w AS mean8,
               stddev_pop(reported_value) OVER w AS dev8
        FROM silver WINDOW w AS (PARTITION BY cik, canonical_concept ORDER BY period_end
                                 ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))""",
    "r1": """r1 AS (
        SELECT a.cik, a.canonical_concept, a.period_end, a.q_idx, a.accession_number,
               'revenue_spike' AS rule, a.qoq AS observed, CAST(0.3 AS DOUBLE) AS threshold,
               abs(a.qoq) / CAST(0.3 AS DOUBLE) AS severity
        FROM qoq a LEFT JOIN qoq b ON b.cik = a.cik AND b.q_idx = a.q_idx - 4
             AND b.canonical_concept = a.canonical_concept
        WHERE a.canonical_concept = 'Revenues' AND abs(a.qoq) > CAST(0.3 AS DOUBLE)
          AND NOT coalesce(abs(b.qoq) > CAST(0.3 AS DOUBLE) AND sign(b.qoq) = sign(a.qoq), false))""",
    "r2": """r2 AS (
        SELECT a.cik, a.canonical_concept, a.period_end, a.q_idx, a.accession_number,
               'income_sign_flip' AS rule, a.reported_value AS observed,
               CAST(0 AS DOUBLE) AS threshold, CAST(1 AS DOUBLE) AS severity
        FROM qoq a LEFT JOIN qoq r ON r.cik = a.cik AND r.q_idx = a.q_idx
             AND r.canonical_concept = 'Revenues'
        WHERE a.canonical_concept = 'NetIncomeLoss'
          AND sign(a.reported_value) * sign(a.prev_value) < 0
          AND NOT coalesce(r.qoq < 0, false))""",
    "r3": """r3 AS (
        SELECT cik, canonical_concept, period_end, q_idx, accession_number, 'eps_drop' AS rule,
               (mean8 - reported_value) / nullif(dev8, 0) AS observed,
               CAST(2 AS DOUBLE) AS threshold,
               (mean8 - reported_value) / nullif(dev8, 0) / 2 AS severity
        FROM trailing8
        WHERE canonical_concept = 'EarningsPerShareBasic' AND prior_rows = 8
          AND reported_value < mean8 - 2 * dev8)""",
    "r4": """r4 AS (
        SELECT cik, canonical_concept, period_end, q_idx, accession_number, 'asset_jump' AS rule,
               qoq AS observed, CAST(0.4 AS DOUBLE) AS threshold,
               abs(qoq) / CAST(0.4 AS DOUBLE) AS severity
        FROM qoq WHERE canonical_concept = 'Assets' AND abs(qoq) > CAST(0.4 AS DOUBLE))""",
    "restated": """restated AS (
        SELECT *, (reported_value - prev_reported_value) / nullif(abs(prev_reported_value), 0)
                   AS change
        FROM (SELECT *, lag(reported_value) OVER w AS prev_reported_value,
                     lag(accession_number) OVER w AS prev_accession_number
              FROM facts
              WINDOW w AS (PARTITION BY cik, raw_concept, period_start, period_end
                           ORDER BY filed_date ASC NULLS FIRST, accession_number))
        WHERE form_type LIKE '%/A'
          AND abs((reported_value - prev_reported_value) / nullif(abs(prev_reported_value), 0))
              > CAST(0.1 AS DOUBLE))""",
    "r5": """r5 AS (
        SELECT cik, canonical_concept, period_end, q_idx, accession_number,
               'restatement' AS rule, change AS observed, CAST(0.1 AS DOUBLE) AS threshold,
               abs(change) / CAST(0.1 AS DOUBLE) AS severity
        FROM restated
        QUALIFY row_number() OVER (PARTITION BY cik, canonical_concept, period_end
                                   ORDER BY abs(change) DESC, accession_number DESC) = 1)""",
    "flags": """flags AS (
        SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3
        UNION ALL SELECT * FROM r4 UNION ALL SELECT * FROM r5)""",
    "matrix": """matrix AS (
        SELECT *, net_income / nullif(revenue, 0) AS margin,
               (revenue - prev_revenue) / nullif(abs(prev_revenue), 0) AS revenue_qoq,
               (net_income - prev_income) / nullif(abs(prev_income), 0) AS income_qoq
        FROM (SELECT m.*, p.revenue AS prev_revenue, p.net_income AS prev_income
              FROM wide m LEFT JOIN wide p ON p.cik = m.cik AND p.q_idx = m.q_idx - 1))""",
    "wide": """wide AS (
        SELECT cik, q_idx,
               max(CASE WHEN canonical_concept = 'Revenues' THEN reported_value END) AS revenue,
               max(CASE WHEN canonical_concept = 'NetIncomeLoss' THEN reported_value END)
                   AS net_income
        FROM silver GROUP BY cik, q_idx)""",
    "submissions": """submissions AS (
        SELECT c_custkey, part, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik,
               c_name || ' part ' || CAST(part AS VARCHAR) AS company_name,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN '3711' WHEN 'BUILDING' THEN '1520'
                    WHEN 'FURNITURE' THEN '2510' WHEN 'HOUSEHOLD' THEN '2840' ELSE '3530' END
                   AS sic_code,
               c_mktsegment AS sic_description,
               CASE WHEN c_nationkey < 10 THEN 'DE' END AS state_of_incorporation,
               CASE WHEN c_nationkey < 20 THEN 'T' || CAST(c_custkey AS VARCHAR) END
                   AS primary_ticker,
               CASE WHEN c_nationkey < 10 THEN 'NYSE' WHEN c_nationkey < 20 THEN 'Nasdaq' END
                   AS primary_exchange,
               1704067200 + part * 3600 AS loaded_seconds
        FROM (SELECT DISTINCT o_custkey, o_orderkey // :submission_keys * 2 + o_orderkey % 2 AS part FROM orders)
        JOIN customer ON c_custkey = o_custkey)""",
    "companies": """companies AS (
        SELECT * FROM submissions
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY loaded_seconds DESC) = 1)""",
    "filings": """filings AS (
        SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
               lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS accession_number,
               CASE WHEN o_orderkey % 10 = 0 THEN '8-K' WHEN o_orderkey % 10 <= 3 THEN '10-K'
                    ELSE '10-Q' END AS form_type,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 120 AS INTEGER) AS filed_date
        FROM orders JOIN customer ON c_custkey = o_custkey)""",
    "concepts": """concepts AS (
        SELECT canonical_tag, min(statement_type) AS statement_type,
               min(display_label) AS display_label, count(*) AS synonym_count,
               CASE WHEN min(statement_type) = 'BS' THEN 'balance' ELSE 'flow' END AS kind
        FROM synonyms GROUP BY canonical_tag)""",
    "periods": """periods AS (
        SELECT CAST(strftime(period_end, '%Y%m%d') AS INTEGER) AS period_key, period_end,
               CAST(year(period_end) AS INTEGER) AS calendar_year,
               CAST(quarter(period_end) AS INTEGER) AS calendar_quarter,
               mode(fiscal_period_label) AS fiscal_label
        FROM silver GROUP BY period_end)""",
}

# The fixture's document sizes are fixed values of the relations; stated there.
CTES = {
    name: text.replace(":facts_keys", str(tables.KEYS_PER_FACTS_DOCUMENT)).replace(
        ":submission_keys", str(tables.KEYS_PER_SUBMISSION)
    )
    for name, text in CTES.items()
}

_NEEDS = {
    "facts": ["filing_rows", "synonyms"],
    "latest": ["facts"],
    "silver": ["latest"],
    "superseded": ["facts"],
    "coverage": ["silver"],
    "fact": ["silver", "superseded", "coverage"],
    "changes": ["silver"],
    "qoq": ["changes"],
    "trailing8": ["silver"],
    "r1": ["qoq"],
    "r2": ["qoq"],
    "r3": ["trailing8"],
    "r4": ["qoq"],
    "restated": ["facts"],
    "r5": ["restated"],
    "flags": ["r1", "r2", "r3", "r4", "r5"],
    "wide": ["silver"],
    "matrix": ["wide"],
    "companies": ["submissions"],
    "concepts": ["synonyms"],
    "periods": ["silver"],
}


def sql(body: str, *uses: str) -> str:
    """`body` preceded by the relations it uses, and those that they use."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        add(name)
    return f"WITH {', '.join(CTES[n] for n in ordered)} {body}" if ordered else body
