"""Previous-row lookups that survive a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lag_in_chunks(
    df: DataFrame, keys: list[str], chunks: list[str], order: list[str], carry: list[str]
) -> DataFrame:
    """Each distinct row with `prev_<column>` of the row before it, per key, by (chunks, order).

    A plain lag needs all rows of a key in one task. Here rows meet only the rows of
    their own (key, chunks); across chunks just one row per chunk travels. `chunks` are
    coarse leading parts of the order, such as a date; nulls come first. Copies of a row
    collapse where their chunk is placed, without another shuffle; (keys, chunks, order)
    must be unique among what remains. The first row of a key has null in every `prev_` column.
    """
    columns = df.columns
    placed = df.repartition(*keys, *chunks).distinct()
    key, rest = ", ".join(keys), [c for c in columns if c not in (*keys, *chunks, *order)]
    chunk = ", ".join(chunks)
    ahead = ", ".join(f"{c} AS prev_{c}" for c in carry)

    inside = f"(PARTITION BY {key}, {chunk} ORDER BY {', '.join(order)})"
    numbered = placed.selectExpr(
        "*", f"lag(struct({ahead})) OVER {inside} AS _prev", f"row_number() OVER {inside} AS _rn"
    )
    later = numbered.filter("_rn > 1").select(*columns, "_prev.*")

    row = f"struct({', '.join([*order, *rest])})"
    ends = placed.groupBy(*keys, *chunks).agg(
        F.expr(f"min({row})").alias("_first"), F.expr(f"max({row})").alias("_last")
    )
    last = ", ".join(f"{c if c in chunks else '_last.' + c} AS prev_{c}" for c in carry)
    across = f"(PARTITION BY {key} ORDER BY {', '.join(f'{c} ASC NULLS FIRST' for c in chunks)})"
    first = ends.selectExpr("*", f"lag(struct({last})) OVER {across} AS _prev").selectExpr(
        *[f"_first.{c} AS {c}" if c in order or c in rest else c for c in columns], "_prev.*"
    )
    return first.unionByName(later)
