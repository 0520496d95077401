"""Global ranks and multi-column clustering without a task that sees all rows."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.session import stored

# Place of a row within its partition, as `monotonically_increasing_id` counts: the lower bits.
PLACE_BITS = 33


def ranked(df: DataFrame, order: list[Column], name: str = "rank", parts: int | None = None) -> DataFrame:
    """`df` with the rank of each row, from 1, in the order given.

    Rows are dealt into ranges of the order and numbered where they stand; a range begins after
    the rows of all ranges before it, and there are only as many sums of those as there are
    ranges. The rows are written once, so numbers and rows stay together whatever is lost. The
    order should be total: ties are ranked as they come.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    placed = dealt.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    placed = stored(spark, placed, "ranked")
    part = F.shiftright("_id", PLACE_BITS)
    counts = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for key in sorted(counts):
        offsets.append((key, before))
        before += counts[key]
    starts = F.broadcast(spark.createDataFrame(offsets, "_part long, _before long"))
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return placed.withColumn("_part", part).join(starts, "_part").withColumn(
        name, F.col("_before") + place + 1
    ).drop("_id", "_part", "_before")


def page(ranks: DataFrame, number: int, size: int, name: str = "rank") -> DataFrame:
    """Page `number`, from 1, of ranked rows; a filter, so it costs the same for every page."""
    return ranks.filter(F.col(name).between((number - 1) * size + 1, number * size))


def z_value(ids: list[Column], bits: int) -> Column:
    """The bits of several numbers dealt in turn, the uppermost of each first."""
    width, one = len(ids), F.lit(1).cast("long")
    taken = [
        F.call_function("shiftleft", F.shiftright(number.cast("long"), b).bitwiseAND(one), F.lit(b * width + width - 1 - j))
        for b in range(bits) for j, number in enumerate(ids)
    ]
    return functools.reduce(lambda a, b: a.bitwiseOR(b), taken)


def gray_rank(code: Column) -> Column:
    """Place of a number among those ordered so that neighbours differ in one bit."""
    for step in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, step))
    return code


def clustered(df: DataFrame, columns: list[str], bits: int = 10, parts: int | None = None) -> DataFrame:
    """`df` in an order that keeps equal values of each of `columns` in few places.

    A value's number is its rank among the distinct values of its column, scaled to `bits`
    bits; the rows are ordered by the numbers' interleaved bits, along the path on which
    neighbouring cells differ in one column only. Files and row groups of the result then span a
    small box of values, so that a filter on any of the columns skips most of them by their
    statistics. Nulls come first.
    """
    if bits * len(columns) > 62:
        raise ValueError("more bits than a long has")
    rows, ids = df, []
    for n, column in enumerate(columns):
        values = df.select(F.col(column).alias(f"_v{n}")).distinct()
        order = ranked(values, [F.col(f"_v{n}").asc_nulls_first()], f"_r{n}")
        total = max(1, order.count())
        scaled = F.floor((F.col(f"_r{n}") - 1) * (1 << bits) / total).alias(f"_n{n}")
        rows = rows.join(order.select(f"_v{n}", scaled), F.col(column).eqNullSafe(F.col(f"_v{n}"))).drop(f"_v{n}")
        ids.append(F.col(f"_n{n}"))
    curve = rows.withColumn("_z", gray_rank(z_value(ids, bits)))
    dealt = curve.repartitionByRange(parts, "_z") if parts else curve.repartitionByRange("_z")
    return dealt.sortWithinPartitions("_z", *columns).select(*df.columns)
