"""Silver kept up to date from landed versions of documents, including what they take back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import pad_identifier
from factloom.operators.dedup import PERIOD_KEY
from factloom.operators.extract import extracted_facts
from factloom.params import ALL_UNITS, Params
from factloom.plans.silver import silver_financials
from factloom.session import discard, stored
from factloom.sources.layers import LayerStore
from factloom.sources.partitions import PartitionedTable, same_keys
from factloom.streaming.landing import VERSION, landed, landed_rows, newest_versions, versions_with_rejects

# Parts of the facts in force, by filer. A refresh reads and writes the parts of the filers whose
# documents changed. For 100 TB some thousands are right; a table keeps the number it began with.
BUCKETS = 64
SOURCE = ("source_path",)
APPLIED = "batch"


def facts_in_force(spark: SparkSession, store: LayerStore) -> PartitionedTable:
    """Typed facts of the documents in force, before resolution, with the file they come from."""
    return PartitionedTable(spark, store.path("silver", "facts_in_force"), ("bucket",))


def silver_in_force(spark: SparkSession, store: LayerStore) -> PartitionedTable:
    return PartitionedTable(spark, store.path("silver", "financials_in_force"), ("period_year",))


def refresh_silver(
    spark: SparkSession,
    store: LayerStore,
    bronze_path: str,
    seed: DataFrame,
    params: Params = Params(units=ALL_UNITS),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Bring silver up to the batches that landed since the last refresh; returns silver.

    A file's newest version with a good document is in force; it replaces the facts of the one
    before. Filers whose document of that version was rejected keep their last good one. What a
    maximum has once seen cannot be taken from it, so facts are not added to a result: the
    entries of both versions are compared, the keys (company, concept, period end) of those that
    differ are collected, and only these keys are resolved anew from all facts in force. Facts
    that a new version drops or changes so leave silver; a version that says the same costs the
    comparison.

    Read: the new documents, the parts of the filers they name, and no other. Written: those
    parts, and the years of silver that hold a touched key. Silver is switched before the
    facts, which note the last batch applied; so a refresh that failed between is run again and
    finds the same differences.
    """
    facts, silver = facts_in_force(spark, store), silver_in_force(spark, store)
    begun = facts.exists()
    applied = facts.properties()[APPLIED] if begun else -1
    buckets = facts.properties()["buckets"] if begun else buckets
    rows = landed_rows(spark, bronze_path, applied)
    last = rows.agg(F.max("batch")).first()[0]
    if last is None:
        return silver.read()

    documents = newest_versions(landed(spark, bronze_path, applied))
    new = extracted_facts(documents, seed, params, SOURCE).withColumn("bucket", bucket_of("cik", buckets))
    new = stored(spark, new, "new_facts")
    if not begun:
        silver.replace(silver_financials(new.drop(*SOURCE, "bucket")))
        facts.replace(new, **{APPLIED: last, "buckets": buckets})
        discard(spark, new)
        return silver.read()

    # Which filers the new versions speak for: those they name, and those that a whole version
    # no longer names.
    filer = pad_identifier("cik_raw").alias("cik")
    named = documents.select("source_path", filer).distinct()
    whole = documents.select(*VERSION).distinct().join(versions_with_rejects(rows), [*VERSION], "left_anti")
    every = landed(spark, bronze_path).select("source_path", filer).distinct()
    spoken = stored(
        spark,
        named.union(every.join(whole.select("source_path"), "source_path", "left_semi")).distinct()
        .withColumn("bucket", bucket_of("cik", buckets)),
        "replaced_documents",
    )
    touched_buckets = [r["bucket"] for r in spoken.select("bucket").distinct().collect()]
    current = facts.read().filter(F.col("bucket").isin(touched_buckets))
    old = current.join(spoken, same_keys(current, spoken, [*SOURCE, "cik"]), "left_semi")

    touched = stored(spark, differing_keys(old, new), "touched_keys")
    after = current.join(spoken, same_keys(current, spoken, [*SOURCE, "cik"]), "left_anti").unionByName(new)
    after = after.join(touched, same_keys(after, touched, list(PERIOD_KEY)), "left_semi")
    silver.merge(
        silver_financials(after.drop(*SOURCE, "bucket")), list(PERIOD_KEY),
        removed=touched.withColumn("period_year", F.year("period_end")),
    )
    facts.merge(new, [*SOURCE, "cik"], removed=spoken, **{APPLIED: last})
    discard(spark, new, spoken, touched)
    return silver.read()


def bucket_of(cik: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(cik), F.lit(buckets)).cast("int")


def differing_keys(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys of the facts that stand in one of the two relations more often than in the other."""
    columns = [c for c in new.columns if c not in (*SOURCE, "bucket")]
    both = new.select(*columns, F.lit(1).alias("sign")).unionByName(
        old.select(*columns, F.lit(-1).alias("sign"))
    )
    differing = both.groupBy(*columns).agg(F.sum("sign").alias("n")).filter("n != 0")
    return differing.select(*PERIOD_KEY).distinct()
