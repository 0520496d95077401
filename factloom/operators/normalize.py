"""Tag normalisation and tracked-concept restriction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_tag(
    seed: DataFrame, tag: str = "raw_concept", output: str = "canonical_concept"
) -> Callable[[DataFrame], DataFrame]:
    """Synonym tag -> canonical tag; unknown tags pass through unchanged.

    `seed` has one row per synonym (see `seeds.synonyms`), so facts never multiply.
    No broadcast hint: the planner knows the size of the seed and broadcasts it when it is
    below its threshold, and joins by sort-merge with skew handling when it is not.
    """

    def apply(df: DataFrame) -> DataFrame:
        lookup = seed.selectExpr("synonym_tag", "canonical_tag AS _canonical")
        joined = df.join(lookup, F.col(tag) == F.col("synonym_tag"), "left")
        return joined.withColumn(output, F.coalesce("_canonical", tag)).drop(
            "synonym_tag", "_canonical"
        )

    return apply


def distinct_tags(seed: DataFrame) -> DataFrame:
    return seed.select("synonym_tag").distinct().orderBy("synonym_tag")


def tracked_only(
    seed: DataFrame, tag: str = "raw_concept"
) -> Callable[[DataFrame], DataFrame]:
    """Keep rows whose tag the seed lists; an empty seed keeps none."""

    def apply(df: DataFrame) -> DataFrame:
        return df.join(seed.select("synonym_tag"), F.col(tag) == F.col("synonym_tag"), "left_semi")

    return apply
