"""Documents -> packed training sequences: language, toxicity, copies, near copies, packing.

Each stage takes (spark, docs, folder); `run` writes what it returns to the shared folder and
reads it back for the next one, so a lost executor costs the stage at hand. Every stage but
the last returns the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from factloom.llm import exact_dedup, language_id, ngram_join, packing, toxicity
from factloom.llm.common import bound_batches, stored, table


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language that the model knows; it learns from all rows outside its fold."""
    bound_batches(spark)
    model = language_id.train(language_id.training_rows(docs))
    return language_id.keep_identified(docs, model)


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    bound_batches(spark)
    labels = toxicity.training_labels(table(spark, folder, "labels"))
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    bound_batches(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    bound_batches(spark)
    return ngram_join.drop_near_copies(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    bound_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

# The learned models and the packing rule cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
