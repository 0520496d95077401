"""What several of the operators share: reading, registering, small helpers for tasks."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom import session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# One Arrow batch, and so what a Python task holds at once, stays near this many bytes
# however long the texts are (a single longer text is a batch of its own).
BATCH_BYTES = 8 << 20


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register an operator's query and, where SQL can state it, its twin."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            bound_batches(spark)
            return build(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def bound_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a relation to the shared folder and read it back (see `session.stored`).

    Spark deletes the shuffle files behind it when the driver collects its garbage; asking
    for that here keeps them from piling up over an operator's steps.
    """
    found = session.stored(spark, df, name)
    spark._jvm.System.gc()
    return found


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids fall in no fold."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


# What more than one of so many parts of all rows share is broadcast: there can be no more
# such values than this, whatever the data.
HOT_PARTS = 20_000


def join_values(
    rows: DataFrame, values: DataFrame, key: str, uses: str, total: int, hot: int = HOT_PARTS
) -> DataFrame:
    """`rows` with the columns of `values` (one row per key, with its number of uses).

    Values that many rows use are few and come by broadcast, so that no task gathers their
    rows; the others are joined by their key.
    """
    often = F.broadcast(values.filter(F.col(uses) > total / hot).drop(uses))
    seldom = values.filter(F.col(uses) <= total / hot).drop(uses)
    rest = rows.join(often.select(key), key, "left_anti")
    return rows.join(often, key).unionByName(rest.join(seldom, key))


class Memo(dict):
    """Values by key, computed on first use; emptied when full, so its size is bounded.

    Keys longer than `longest` are computed each time and not kept.
    """

    def __init__(self, fill: Callable, limit: int = 300_000, longest: int = 48):
        super().__init__()
        self.fill, self.limit, self.longest = fill, limit, longest

    def __missing__(self, key):
        value = self.fill(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[key] = value
        return value


def by_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    """`mapInArrow` function that treats every batch alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return run


def give_back() -> None:
    """Return what the worker has freed to the system, which both allocators put off."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def per_worker(spark: SparkSession, value, build: Callable) -> Callable:
    """A function for tasks that gives `build(value)`, made once in each Python worker.

    The value is broadcast, so it must be of bounded size. What was made last stays with the
    worker for its next tasks and makes room when something else is asked for.
    """
    sent, name = spark.sparkContext.broadcast(cloudpickle.dumps(value)), uuid.uuid4().hex

    def get():
        holder = sys.modules.setdefault("_factloom_worker", types.ModuleType("_factloom_worker"))
        made = holder.__dict__.setdefault("made", {})
        if name not in made:
            made.clear()
            give_back()
            made[name] = build(pickle.loads(sent.value))
            # The pickled form is of no more use here; it would be loaded again if it were.
            sent.__dict__.pop("_value", None)
        return made[name]

    return get
