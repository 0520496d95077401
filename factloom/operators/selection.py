"""Exact quantiles by counting, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factloom.session import stored
from factloom.sources.partitions import same_keys

# Buckets that a range of values is cut into on each pass.
SLICES = 1024


def exact_quantile(rows: DataFrame, by: list[str], value: str, q: float = 0.5, name: str = "quantile") -> DataFrame:
    """(by, name): for each group the smallest value that at least the share q of its values reach.

    That is `percentile_disc`, without a buffer of the group's values. All groups are treated at
    once: the values of a group are counted in slices of its range, the slice that holds the one
    looked for becomes the range, and so on until a slice holds a single value. Counts combine
    before the shuffle, so a task gets at most `SLICES` rows of a group from each other task,
    however large the group is; a pass narrows the range to a slice. Null values do not count,
    a group of nulls gives null, and NaN is larger than all numbers. Null group keys are a group.
    """
    spark = rows.sparkSession
    values = stored(spark, rows.select(*by, F.col(value).cast("double").alias("_v")), "values")
    finite = F.abs("_v") < float("inf")
    low, high = (f(F.when(finite, F.col("_v"))) for f in (F.min, F.max))
    state = values.groupBy(*by).agg(
        F.greatest(F.ceil(F.count("_v") * q), F.lit(1)).alias("_k"), low.alias("_low"), high.alias("_high"),
    )
    # Where a group has one value only, it is known; all others are looked for.
    found = []
    first = True
    state = stored(spark, state, "ranges")
    while not state.isEmpty():
        some = values.filter("_v IS NOT NULL")
        joined = some.join(state, same_keys(some, state, by)).select(
            *[state[c] for c in by], "_v", "_k", "_low", "_high"
        )
        if not first:
            joined = joined.filter(F.col("_v").between(F.col("_low"), F.col("_high")))
        first = False
        # Halved, so that the width of the widest range is a number too.
        width = F.col("_high") / 2 - F.col("_low") / 2
        share = F.when(width > 0, (F.col("_v") / 2 - F.col("_low") / 2) / width).otherwise(0.0)
        at = (
            F.when(F.isnan("_v"), SLICES + 1).when(F.col("_v") == float("inf"), SLICES)
            .when(F.col("_v") == float("-inf"), -1)
            .otherwise(F.least(F.floor(share * SLICES), F.lit(SLICES - 1)))
        )
        slices = joined.groupBy(*by, at.cast("int").alias("_at")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_from"), F.max("_v").alias("_to"), F.any_value("_k").alias("_k"),
        )
        order = Window.partitionBy(*by).orderBy("_at")
        upto = F.sum("_n").over(order)
        reached = slices.withColumn("_upto", upto).filter(
            (F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_n") < F.col("_k"))
        )
        reached = stored(spark, reached, "slices")
        one = (F.col("_from") == F.col("_to")) | (F.col("_at") < 0) | (F.col("_at") >= SLICES)
        found.append(reached.filter(one).select(*by, F.col("_from").alias(name)))
        state = reached.filter(~one).select(
            *by, (F.col("_k") - F.col("_upto") + F.col("_n")).alias("_k"), F.col("_from").alias("_low"), F.col("_to").alias("_high")
        )
        state = stored(spark, state, "ranges")
    known = None
    for part in found:
        known = part if known is None else known.unionByName(part)
    groups = values.select(*by).distinct()
    if known is None:
        return groups.withColumn(name, F.lit(None).cast("double"))
    return groups.join(known, same_keys(groups, known, by), "left").select(
        *[groups[c] for c in by], known[name]
    )
