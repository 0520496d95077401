"""Token counts (5): pre-tokens that are proven whole tokens count one, only the rest is merged."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import byte_pairs
from factloom.llm.common import by_batch, query, table, texts_of

DEFAULT_VOCABULARY = "byte_bpe_50k.json"


def count_tokens(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 1024
) -> DataFrame:
    """One row per row of `docs`: key, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Every text is counted whole; a null text is an empty one with no tokens. Nulls and
    repeats in the key pass through, other columns are not read. No shuffle: each task
    holds one batch, the vocabulary and a bounded table of words it has merged.
    """
    counter = byte_pairs.shared(docs.sparkSession, tokenizer, byte_pairs.token_counter)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def task(batches):
        count = counter()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = texts_of(batch)
            tokens = [count(t) for t in texts]
            columns = {
                key: batch.column("key"),
                "n_bytes": pa.array([len(t.encode()) for t in texts], pa.int64()),
                "n_tokens": pa.array(tokens, pa.int64()),
                "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
            }
            return pa.RecordBatch.from_pydict(columns)

        return by_batch(work)(batches)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(task, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


@query("op5_token_counts")
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(
        table(spark, folder, "documents"), public_tokenizers.path(DEFAULT_VOCABULARY)
    )
