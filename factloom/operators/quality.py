"""Data checks as DataFrames of offending rows or counts, and a report over them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """(column_name, null_rows) for each column, all counted in one pass."""
    names = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counts.unpivot([], names, "column_name", "null_rows")


def failing_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check_name, failing_rows) of row rules, all judged in one pass.

    A rule says which rows fail; a null is no failure.
    """
    names = list(rules)
    counts = df.agg(*[F.count_if(rule).alias(f"c{k}") for k, rule in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', c{k}" for k, name in enumerate(names))
    return counts.selectExpr(f"stack({len(names)}, {pairs}) AS (check_name, failing_rows)")


def any_null(columns: Iterable[str]) -> Column:
    """Rows with a null in one of the columns."""
    bad = F.lit(False)
    for column in columns:
        bad = bad | F.col(column).isNull()
    return bad


def outside(column: str, accepted: Iterable[str]) -> Column:
    return ~F.col(column).isin(*accepted)


def is_negative_revenue() -> Column:
    return (F.col("canonical_concept") == "Revenues") & (F.col("reported_value") < 0)


def is_non_finite(column: str = "reported_value") -> Column:
    return F.isnan(column) | (F.abs(column) == float("inf"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found more than once; keys with a null part are ignored."""
    present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unaccepted_values(df: DataFrame, column: str, accepted: Iterable[str]) -> DataFrame:
    """(column_name, value, n) for values outside the accepted set; nulls are not judged."""
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
    return bad.groupBy(F.lit(column).alias("column_name"), F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )


def orphans(df: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """(fk, value, n) for foreign keys without a parent row.

    Counted before the join, so a hot key is one row in it.
    """
    used = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("value")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = parent.select(F.col(parent_key).alias("_known"))
    missing = used.join(known, F.col("value") == F.col("_known"), "left_anti")
    return missing.select(F.lit(key).alias("fk"), F.col("value").cast("string").alias("value"), "n")


def negative_revenue(df: DataFrame) -> DataFrame:
    return df.filter(is_negative_revenue())


def non_finite_values(df: DataFrame, column: str = "reported_value") -> DataFrame:
    """Values that passed the cast but are NaN or infinite."""
    return df.filter(is_non_finite(column))


def freshness(loads: DataFrame, by: list[str], loaded_at: str, as_of: Column, hours: int) -> DataFrame:
    """Last load per source and whether it is older than the limit at `as_of`."""
    last = loads.groupBy(*by).agg(F.max(loaded_at).alias("last_loaded"))
    return last.withColumn(
        "is_stale", F.col("last_loaded") < as_of - F.expr(f"INTERVAL {hours} HOURS")
    )


def counted_rows(found: DataFrame, name: str) -> DataFrame:
    """(check_name, failing_rows) of offending rows or of counts of them (`n`, `null_rows`)."""
    count = next((c for c in ("null_rows", "n") if c in found.columns), None)
    rows = F.coalesce(F.sum(count), F.lit(0)) if count else F.count(F.lit(1))
    return found.agg(rows.cast("bigint").alias("failing_rows")).select(
        F.lit(name).alias("check_name"), "failing_rows"
    )


def report(checks: dict[str, DataFrame], *judged: DataFrame) -> DataFrame:
    """(check_name, failing_rows, status) from DataFrames of offending rows or counts of them,
    and from the results of `failing_rows`."""
    parts = [counted_rows(df, name) for name, df in checks.items()] + list(judged)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(
        "check_name",
        "failing_rows",
        F.when(F.col("failing_rows") == 0, "pass").otherwise("fail").alias("status"),
    )


def require_pass(checked: DataFrame) -> None:
    """Raise when a check failed. A report has one row per check."""
    failed = [r for r in checked.collect() if r["status"] == "fail"]
    if failed:
        raise AssertionError(
            "; ".join(f"{r['check_name']}: {r['failing_rows']}" for r in failed)
        )
