"""Data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import quality
from factloom.params import DEFAULTS
from factloom.plans import gold
from factloom.plans.silver import silver_financials
from factloom.registry.base import CTES, facts, query, rows, sql
from factloom.session import stored
from factloom.sources import seeds
from factloom.sources.tables import table

_CHECKED = ("cik", "raw_concept", "reported_value", "period_start", "period_end",
            "accession_number", "form_raw", "filed_date")


@query("dq_not_null", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows FROM filing_rows"
    for c in _CHECKED), "filing_rows"))
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return quality.not_null(rows(spark, folder), _CHECKED)


@query("dq_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


# The list below are fixed values: accepted form codes, stated apart from the code they check.
@query("dq_accepted_values", sql("""
    SELECT 'form_type' AS column_name, upper(form_raw) AS value, count(*) AS n FROM filing_rows
    WHERE upper(form_raw) NOT IN ('10-K', '10-Q', '10-K/A', '10-Q/A', '20-F', '40-F', '10-K405',
                                  '10-KSB', '10-KSB/A', '10-QSB', '10-KT')
    GROUP BY 2
    UNION ALL
    SELECT 'value_type', value_type, count(*) FROM facts
    WHERE value_type NOT IN ('instant', 'duration') GROUP BY 2""", "filing_rows", "facts"))
def dq_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    forms = rows(spark, folder).select(F.upper("form_raw").alias("form_type"))
    return quality.unaccepted_values(forms, "form_type", DEFAULTS.accepted_forms).unionByName(
        quality.unaccepted_values(
            facts(spark, folder), "value_type", DEFAULTS.accepted_value_types
        )
    )


@query("dq_relationships", sql("""
    SELECT 'canonical_concept' AS fk, canonical_concept AS value, count(*) AS n FROM facts
    WHERE canonical_concept NOT IN (SELECT canonical_tag FROM concepts) GROUP BY 2
    UNION ALL
    SELECT 'l_orderkey', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 2""", "facts", "concepts"))
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    concepts = gold.dim_gaap_concepts(seeds.synonyms(spark))
    unknown = quality.orphans(facts(spark, folder), "canonical_concept", concepts, "canonical_tag")
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return unknown.unionByName(quality.orphans(lines, "l_orderkey", orders, "o_orderkey"))


@query("dq_duplicate_periods", sql("""
    SELECT cik, canonical_concept, CAST(period_end AS VARCHAR) AS period_end, count(*) AS n
    FROM facts GROUP BY ALL HAVING count(*) > 1""", "facts"))
def dq_duplicate_periods(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicates(facts(spark, folder), ["cik", "canonical_concept", "period_end"])


@query("dq_revenue_nonnegative", sql("""
    SELECT accession_number, reported_value - 100000 AS reported_value FROM facts
    WHERE canonical_concept = 'Revenues' AND reported_value - 100000 < 0""", "facts"))
def dq_revenue_nonnegative(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue less a fixed charge, so that some of it is negative."""
    charged = facts(spark, folder).withColumn("reported_value", F.col("reported_value") - 100000)
    return quality.negative_revenue(charged).select("accession_number", "reported_value")


@query("dq_freshness", """
    SELECT user_id, epoch_us(max(ts)) AS last_us,
           max(ts) < (SELECT max(ts) FROM events) - INTERVAL 25 HOUR AS is_stale
    FROM events GROUP BY user_id""")
def dq_freshness(spark: SparkSession, folder: str) -> DataFrame:
    loads = table(spark, folder, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    as_of = loads.agg(F.max("ts")).scalar()
    judged = quality.freshness(loads, ["user_id"], "ts", as_of, DEFAULTS.freshness_hours)
    return judged.select("user_id", F.unix_micros("last_loaded").alias("last_us"), "is_stale")


def _number(name: str) -> str:
    return f"CAST(accession_number AS BIGINT) % {name}"


_DAMAGED_SQL = f""", charged AS (
        SELECT * REPLACE (CASE WHEN {_number(97)} = 0 THEN CAST('Infinity' AS DOUBLE)
                               WHEN canonical_concept = 'Revenues' THEN reported_value - 100000
                               ELSE reported_value END AS reported_value) FROM facts),
    damaged AS (SELECT * FROM charged UNION ALL SELECT * FROM charged WHERE {_number(83)} = 0),
    {CTES["latest"].replace("latest AS", "latest_damaged AS").replace("FROM facts", "FROM damaged")},
    {CTES["silver"].replace("silver AS", "silver_damaged AS").replace("FROM latest", "FROM latest_damaged")},
    resolved AS (SELECT * FROM silver_damaged
                 UNION ALL SELECT * FROM silver_damaged WHERE {_number(89)} = 0)"""


def _repeated(relation: str, keys: str) -> str:
    return f"""(SELECT coalesce(sum(n), 0) FROM (
        SELECT count(*) AS n FROM {relation} GROUP BY {keys} HAVING count(*) > 1))"""


@query("dq_report", sql(f"""{_DAMAGED_SQL}
    SELECT check_name, CAST(failing_rows AS BIGINT) AS failing_rows,
           CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (SELECT 'not null' AS check_name, (SELECT count(*) FROM damaged WHERE cik IS NULL
              OR period_start IS NULL OR period_end IS NULL OR reported_value IS NULL
              OR filed_date IS NULL) AS failing_rows
          UNION ALL SELECT 'accepted form', (SELECT count(*) FROM damaged
              WHERE form_type NOT IN ('10-K', '10-Q'))
          UNION ALL SELECT 'unique accession', {_repeated("damaged", "accession_number")}
          UNION ALL SELECT 'duplicate periods', {_repeated("damaged", "cik, canonical_concept, period_end")}
          UNION ALL SELECT 'silver periods', {_repeated("resolved", "cik, canonical_concept, period_end")}
          UNION ALL SELECT 'concept known', (SELECT count(*) FROM damaged
              WHERE canonical_concept NOT IN (SELECT canonical_tag FROM concepts))
          UNION ALL SELECT 'revenue not negative', (SELECT count(*) FROM resolved
              WHERE canonical_concept = 'Revenues' AND reported_value < 0)
          UNION ALL SELECT 'values finite', (SELECT count(*) FROM resolved
              WHERE isinf(reported_value) OR isnan(reported_value)))""", "facts", "concepts"))
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    """Every check, over facts damaged so that each finds something: a charge on revenue,
    infinite values, repeated facts and, after resolving, repeated periods."""
    value = f"""CASE WHEN {_number(97)} = 0 THEN double('Infinity')
                     WHEN canonical_concept = 'Revenues' THEN reported_value - 100000
                     ELSE reported_value END"""
    charged = facts(spark, folder).withColumn("reported_value", F.expr(value))
    damaged = stored(spark, charged.unionByName(charged.filter(f"{_number(83)} = 0")), "facts")
    silver = stored(spark, silver_financials(damaged), "silver")
    resolved = silver.unionByName(silver.filter(f"{_number(89)} = 0"))
    key = ["cik", "canonical_concept", "period_end"]
    concepts = gold.dim_gaap_concepts(seeds.synonyms(spark))
    required = ["cik", "period_start", "period_end", "reported_value", "filed_date"]
    return quality.report(
        {
            "unique accession": quality.duplicates(damaged, ["accession_number"]),
            "duplicate periods": quality.duplicates(damaged, key),
            "silver periods": quality.duplicates(resolved, key),
            "concept known": quality.orphans(
                damaged, "canonical_concept", concepts, "canonical_tag"
            ),
        },
        quality.failing_rows(damaged, {
            "not null": quality.any_null(required),
            "accepted form": quality.outside("form_type", ("10-K", "10-Q")),
        }),
        quality.failing_rows(resolved, {
            "revenue not negative": quality.is_negative_revenue(),
            "values finite": quality.is_non_finite(),
        }),
    )
