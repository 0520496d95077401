"""What to fetch again, and how a run went."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import pad_identifier
from factloom.params import DEFAULTS, Params

# How an attempt went.
FETCHED, SKIPPED, FAILED = "fetched", "skipped", "failed"


def _hours_before(as_of: Column, hours: int) -> Column:
    return as_of - F.expr(f"INTERVAL {hours} HOURS")


def refresh_candidates(
    tracked: DataFrame,
    landed: DataFrame,
    as_of: datetime | Column,
    force: bool = False,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Tracked companies never landed, or landed `stale_after_hours` or longer before `as_of`.

    `landed` may list a company many times; only its last landing counts.
    """
    last = landed.groupBy("cik").agg(F.max("landed_at").alias("landed_at"))
    joined = tracked.join(last, "cik", "left")
    if force:
        return joined
    moment = as_of if isinstance(as_of, Column) else F.lit(as_of)
    limit = _hours_before(moment, params.stale_after_hours)
    return joined.filter(F.col("landed_at").isNull() | (F.col("landed_at") <= limit))


def ingest_summary(outcomes: DataFrame) -> DataFrame:
    """Companies per status: fetched, skipped or failed."""
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("companies"))


def ingest_failures(outcomes: DataFrame) -> DataFrame:
    """The failures themselves, as rows: their number has no bound."""
    return outcomes.filter(F.col("status") == FAILED).select("cik", "ticker", "error")


def last_run(ledger: DataFrame) -> DataFrame:
    """Attempts of the run that was begun last."""
    last = ledger.agg(F.max("run").alias("run"))
    return ledger.join(F.broadcast(last), "run")


def run_outcomes(attempts: DataFrame, tracked: DataFrame) -> DataFrame:
    """(cik, ticker, status, error): how each company of a run fared.

    `attempts` are ledger rows; a company with several documents failed if one of them did, and
    was fetched if one was. A document that names no company is a row of its own, and tracked
    companies without any document are not part of the run.
    """
    named = attempts.withColumn("cik", pad_identifier("cik_raw"))
    each = F.when(F.col("cik").isNull(), F.col("source_path"))
    worst = F.max_by(
        F.struct("status", "error"),
        F.struct(
            F.when(F.col("status") == FAILED, 2).when(F.col("status") == FETCHED, 1).otherwise(0), "error", "source_path"
        ),
    )
    found = named.groupBy("cik", each.alias("source_path")).agg(worst.alias("w"))
    tickers = tracked.groupBy("cik").agg(F.min("ticker").alias("ticker"))
    return found.join(tickers, "cik", "left").select("cik", "ticker", "source_path", "w.status", "w.error")


def last_landings(ledger: DataFrame) -> DataFrame:
    """(cik, landed_at) of every landing that succeeded, for `refresh_candidates`."""
    return ledger.filter(F.col("status") == FETCHED).select(
        pad_identifier("cik_raw").alias("cik"), F.col("attempted_at").alias("landed_at")
    )


def fail_on_any_failure(outcomes: DataFrame) -> None:
    failures = ingest_failures(outcomes)
    first = failures.limit(5).collect()
    if first:
        raise RuntimeError(f"{failures.count()} companies failed, e.g. {[tuple(r) for r in first]}")
