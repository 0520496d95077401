"""Period-over-period measures and the five anomaly rules.

Input is silver: one row per (cik, concept, period end). The rows of a company are
therefore bounded by concepts times calendar, and one exchange by company serves every
window below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import pct_change, quarter_index
from factloom.operators.ordered import lag_in_chunks
from factloom.params import DEFAULTS, Params
from factloom.session import stored
from factloom.sources.partitions import same_keys

REVENUE, INCOME, EPS, ASSETS = "Revenues", "NetIncomeLoss", "EarningsPerShareBasic", "Assets"


# Filer and year at the beginning of an accession number.
SERIES_LENGTH = 13

# Filings of one key from which its days are looked at, and those of a day that one task takes.
HOT_KEY, HOT_DAY = 100_000, 20_000

_SERIES = "PARTITION BY cik, canonical_concept ORDER BY period_end"

# Looks the quarter up by number, so gaps cannot shift it, and needs no self-join. Of
# several ends in that quarter the latest counts.
_YEAR_AGO = """(PARTITION BY cik, canonical_concept ORDER BY q_idx
                RANGE BETWEEN 4 PRECEDING AND 4 PRECEDING)"""


def quarterly_values(silver: DataFrame) -> DataFrame:
    """Only snapshots and values that span about one quarter."""
    return silver.filter(
        "period_start IS NULL OR date_diff(period_end, period_start) BETWEEN 80 AND 100"
    )


def _prepared(silver: DataFrame, params: Params) -> DataFrame:
    chosen = quarterly_values(silver) if params.quarterly_only else silver
    # A table stored in buckets by company stands as the windows need it.
    placed = chosen if params.bucketed_by_company else chosen.repartition("cik")
    return placed.withColumn("q_idx", quarter_index("period_end"))


def qoq_change(silver: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Adds `prev_value` and `qoq`, both null unless the previous row is the quarter before."""
    previous = f"""CASE WHEN q_idx - lag(q_idx) OVER ({_SERIES}) = 1
                   THEN lag(reported_value) OVER ({_SERIES}) END"""
    return (
        _prepared(silver, params)
        .selectExpr("*", f"{previous} AS prev_value")
        .withColumn("qoq", pct_change("reported_value", "prev_value"))
    )


def yoy_change(silver: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Adds the value of the same quarter one year before and the change since."""
    year_ago = f"max(struct(period_end, reported_value)) OVER {_YEAR_AGO}.reported_value"
    return (
        _prepared(silver, params)
        .selectExpr("*", f"{year_ago} AS prior_year_value")
        .withColumn("yoy", pct_change("reported_value", "prior_year_value"))
    )


def trailing_stats(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Mean and population deviation of the rows before the current one; null until full."""
    n = params.eps_trailing_quarters
    before = f"({_SERIES} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    full = f"count(reported_value) OVER {before} = {n}"
    return df.selectExpr(
        "*",
        f"if({full}, avg(reported_value) OVER {before}, NULL) AS trailing_mean",
        f"if({full}, stddev_pop(reported_value) OVER {before}, NULL) AS trailing_stddev",
    )


def measures(silver: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Everything rules 1-4 look at, on each silver row."""
    changed = trailing_stats(qoq_change(silver, params), params)
    revenue = f"if(canonical_concept = '{REVENUE}', struct(period_end, qoq), NULL)"
    return changed.selectExpr(
        "*",
        f"max(struct(period_end, qoq)) OVER {_YEAR_AGO}.qoq AS prior_year_qoq",
        f"max({revenue}) OVER (PARTITION BY cik, q_idx).qoq AS revenue_qoq",
    )


def _rule(name: str, fires: str, observed: str, threshold: float, severity: str) -> Column:
    return F.expr(
        f"""CASE WHEN {fires} THEN named_struct(
            'rule', '{name}', 'observed', cast({observed} AS double),
            'threshold', {float(threshold)}D, 'severity', cast({severity} AS double)) END"""
    )


def revenue_spike(params: Params = DEFAULTS) -> Column:
    t = f"{params.revenue_qoq_threshold}D"
    fires = f"""canonical_concept = '{REVENUE}' AND abs(qoq) > {t} AND NOT coalesce(
        abs(prior_year_qoq) > {t} AND signum(prior_year_qoq) = signum(qoq), false)"""
    return _rule("revenue_spike", fires, "qoq", params.revenue_qoq_threshold, f"abs(qoq) / {t}")


def income_sign_flip() -> Column:
    fires = f"""canonical_concept = '{INCOME}' AND signum(reported_value) * signum(prev_value) < 0
        AND NOT coalesce(revenue_qoq < 0, false)"""
    return _rule("income_sign_flip", fires, "reported_value", 0.0, "1.0D")


def eps_drop(params: Params = DEFAULTS) -> Column:
    """Observed is the drop in deviations; null when the window did not vary at all."""
    k = f"{params.eps_sigmas}D"
    fires = f"canonical_concept = '{EPS}' AND reported_value < trailing_mean - {k} * trailing_stddev"
    drop = "(trailing_mean - reported_value) / nullif(trailing_stddev, 0.0D)"
    return _rule("eps_drop", fires, drop, params.eps_sigmas, f"{drop} / {k}")


def asset_jump(params: Params = DEFAULTS) -> Column:
    t = f"{params.asset_qoq_threshold}D"
    fires = f"canonical_concept = '{ASSETS}' AND abs(qoq) > {t}"
    return _rule("asset_jump", fires, "qoq", params.asset_qoq_threshold, f"abs(qoq) / {t}")


_RECORD = ("cik", "canonical_concept", "period_end", "q_idx", "accession_number")


def fired_rules(silver: DataFrame, rules: list[Column], params: Params = DEFAULTS) -> DataFrame:
    """One row per (record, fired rule), all rules judged in one pass."""
    fired = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return measures(silver, params).select(*_RECORD, F.inline(fired))


def silver_rules(params: Params = DEFAULTS) -> list[Column]:
    return [revenue_spike(params), income_sign_flip(), eps_drop(params), asset_jump(params)]


_HISTORY_KEY = ["cik", "canonical_concept", "raw_concept", "period_start", "period_end"]
_HISTORY_ORDER = ["accession_number", "form_type", "reported_value"]


def _split_hot_days(history: DataFrame, hot_key: int, hot_day: int) -> DataFrame:
    """`series` of the days on which one key has very many filings: ranges of their order.

    Counts combine before the shuffle, and days are counted for hot keys only. The rows of hot
    days are dealt by their whole order, so that a range holds a bounded number of them, and
    keep the number of their range; it is written down, since it decides which rows meet.
    """
    spark = history.sparkSession
    keys = history.groupBy(*_HISTORY_KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_key)
    keys = stored(spark, keys.drop("n"), "hot_keys")
    if keys.isEmpty():
        return history
    day = [*_HISTORY_KEY, "filed_date", "series"]
    hot = history.join(keys, same_keys(history, keys, _HISTORY_KEY), "left_semi")
    days = hot.groupBy(*day).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_day)
    days = stored(spark, days, "hot_days")
    rows = days.agg(F.sum("n")).first()[0]
    if rows is None:
        return history
    many = history.join(days, same_keys(history, days, day), "left_semi")
    # Copies collapse first: rows that are equal must not come to stand in two ranges.
    dealt = many.distinct().repartitionByRange(-(-rows // hot_day), *day, *_HISTORY_ORDER)
    number = F.lpad(F.spark_partition_id().cast("string"), 10, "0")
    dealt = stored(spark, dealt.withColumn("series", F.concat("series", F.lit("#"), number)), "hot_rows")
    few = history.join(days, same_keys(history, days, day), "left_anti")
    return few.unionByName(dealt)


def restatements(
    facts: DataFrame, params: Params = DEFAULTS, hot_key: int = HOT_KEY, hot_day: int = HOT_DAY
) -> DataFrame:
    """Amended values that differ from the value reported before by more than the threshold.

    Works on extracted facts, before any of them are resolved away. Copies of an entry,
    which every new load of a document brings, collapse; a key with very many filings is
    split by filing date, those without a date by the beginning of their number, and a day
    with very many of them by ranges of their order.
    """
    series = f"if(filed_date IS NULL, left(accession_number, {SERIES_LENGTH}), '') AS series"
    history = facts.selectExpr(*_HISTORY_KEY, "filed_date", series, *_HISTORY_ORDER)
    history = _split_hot_days(history, hot_key, hot_day)
    chunks, carry = ["filed_date", "series"], ["reported_value", "accession_number"]
    lagged = lag_in_chunks(history, _HISTORY_KEY, chunks, _HISTORY_ORDER, carry).drop("series")
    change = pct_change("reported_value", "prev_reported_value")
    return lagged.withColumn("change", change).filter(
        F.col("form_type").endswith("/A") & (F.abs("change") > params.restatement_threshold)
    )


def restatement_flags(restated: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """The largest restatement of each (company, concept, period) as a fired rule."""
    t = params.restatement_threshold
    size = F.abs("change")
    largest = restated.groupBy("cik", "canonical_concept", "period_end").agg(
        F.max(F.struct(size.alias("size"), "accession_number", "change")).alias("m")
    )
    return largest.select(
        "cik",
        "canonical_concept",
        "period_end",
        quarter_index("period_end").alias("q_idx"),
        F.col("m.accession_number").alias("accession_number"),
        F.lit("restatement").alias("rule"),
        F.col("m.change").alias("observed"),
        F.lit(t).alias("threshold"),
        (F.col("m.size") / t).alias("severity"),
    )


def anomaly_flags(silver: DataFrame, facts: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """rpt_anomaly_flags: one row per (record, fired rule)."""
    flagged = fired_rules(silver, silver_rules(params), params)
    return flagged.unionByName(restatement_flags(restatements(facts, params), params))


def feed_order() -> list[Column]:
    """Falling severity; the columns after it only make the order total."""
    return [F.col("severity").desc_nulls_last(), *map(F.col, ("cik", "canonical_concept", "period_end", "rule"))]


def anomaly_feed(
    flags: DataFrame,
    cik: str | None = None,
    concept: str | None = None,
    quarter: int | None = None,
    top: int | None = None,
) -> DataFrame:
    """Flags by falling severity, optionally filtered and cut to the top, with a filing link."""
    chosen = flags
    for column, wanted in (("cik", cik), ("canonical_concept", concept), ("q_idx", quarter)):
        if wanted is not None:
            chosen = chosen.filter(F.col(column) == wanted)
    ordered = chosen.orderBy(*feed_order())
    limited = ordered if top is None else ordered.limit(top)
    return limited.withColumn("filing_link", F.concat_ws("/", F.lit("filings"), "cik", "accession_number"))


def events_near_anomalies(
    flags: DataFrame, events: DataFrame, params: Params = DEFAULTS
) -> DataFrame:
    """Per flagged record, the events of its company in the days after the period end.

    `events` is (cik, event_date). Events are counted per day before the join, and the
    join is an equi-join on (cik, quarter): a day can only matter for period ends in its
    own quarter or the few before it.
    """
    days = params.event_window_days
    reach = days // 90 + 1
    daily = events.groupBy("cik", "event_date").agg(F.count(F.lit(1)).alias("n"))
    candidates = daily.withColumn(
        "q_idx",
        F.explode(F.sequence(quarter_index("event_date") - reach, quarter_index("event_date"))),
    )
    records = flags.select("cik", "canonical_concept", "period_end", "q_idx", "rule")
    near = records.join(candidates, ["cik", "q_idx"]).filter(
        F.col("event_date").between(F.col("period_end"), F.date_add("period_end", days))
    )
    return near.groupBy("cik", "canonical_concept", "period_end", "rule").agg(
        F.sum("n").alias("events"),
        F.min("event_date").alias("first_event"),
        F.max("event_date").alias("last_event"),
    )
