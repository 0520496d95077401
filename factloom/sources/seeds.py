"""Seed tables. All columns are text, so zero-padded identifiers keep their zeros."""

from __future__ import annotations

import csv
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.schemas import COMPANY_SEED, SYNONYM_SEED


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A seed CSV from a path that the executors can reach; `#` lines are comments."""
    return spark.read.schema(schema).option("header", True).option("comment", "#").csv(path)


def _packaged(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    # A local relation has a known size, which lets the planner decide on the broadcast.
    text = resources.files("factloom.seeds").joinpath(name).read_text(encoding="utf-8")
    rows = csv.DictReader(line for line in text.splitlines() if not line.startswith("#"))
    fields = pa.schema([(f, pa.string()) for f in schema.names])
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=fields))


def unique_synonyms(seed: DataFrame) -> DataFrame:
    """The first row of each synonym by canonical tag."""
    rest = ["canonical_tag", "statement_type", "display_label"]
    first = seed.groupBy("synonym_tag").agg(F.min(F.struct(*rest)).alias("r"))
    return first.select("r.canonical_tag", "synonym_tag", "r.statement_type", "r.display_label")


def synonyms(spark: SparkSession, path: str | None = None) -> DataFrame:
    """canonical_tag, synonym_tag, statement_type, display_label; one row per synonym_tag.

    The packaged seed is unique as it stands. One from elsewhere is made so here, once,
    so that no lookup has to.
    """
    if path:
        return unique_synonyms(read_seed(spark, path, SYNONYM_SEED))
    return _packaged(spark, "gaap_tag_synonyms.csv", SYNONYM_SEED)


def tracked_companies(spark: SparkSession, path: str | None = None) -> DataFrame:
    """cik, ticker, company_name, industry, sic_code."""
    if path:
        return read_seed(spark, path, COMPANY_SEED)
    return _packaged(spark, "companies.csv", COMPANY_SEED)
