"""Best-fit packing (2) by the best-two-fit rule, over the histogram of lengths.

Only lengths decide how documents are packed, and there are at most `capacity` of them. So
the corpus is reduced to one count per length, the rule runs once on those counts (a bin
filled in one way is repeated as often as the counts allow), and every document finds its
place by its number among the documents of its length. The histogram and the plan are
bounded by `capacity`, whatever the corpus holds.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm import byte_pairs
from factloom.llm.common import by_batch, per_worker, query, stored, table, texts_of

CAPACITY = 2048
SEPARATOR = 0


def best_pair(lengths: list[int], free: Counter, room: int, above: int) -> tuple[int, int] | None:
    """Two free lengths with the largest sum that is over `above` and at most `room`."""
    best, pair = above, None
    low, high = 0, bisect_right(lengths, room) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > room or not free[b]:
            high -= 1
        elif not free[a]:
            low += 1
        else:
            if a + b > best and (low < high or free[a] > 1):
                best, pair = a + b, (a, b)
                if best == room:
                    break
            low += 1
    return pair


def plan_bins(histogram: dict[int, int], capacity: int) -> list[tuple[Counter, int]]:
    """(lengths in a bin, number of such bins) that use up the histogram.

    A bin is filled greedily with the largest length that fits. Then, while its gap is not
    zero, its smallest document gives way to two unpacked ones that fill the gap it leaves
    more tightly, and goes back to the unpacked ones.
    """
    left = Counter({n: c for n, c in histogram.items() if c > 0})
    lengths = sorted(left)
    plan = []
    while lengths:
        filled: Counter = Counter()
        gap = capacity
        place = len(lengths) - 1
        while place >= 0:
            n = lengths[place]
            fits = min(gap // n, left[n] - filled[n])
            if fits > 0:
                filled[n] += fits
                gap -= fits * n
            place = min(place, bisect_right(lengths, gap)) - 1
        while gap:
            smallest = min(filled)
            free = Counter({n: left[n] - filled[n] for n in lengths})
            pair = best_pair(lengths, free, gap + smallest, smallest)
            if pair is None:
                break
            filled -= Counter([smallest])
            filled.update(pair)
            gap += smallest - sum(pair)
        times = min(left[n] // c for n, c in filled.items())
        plan.append((filled, times))
        for n, c in filled.items():
            left[n] -= c * times
            if not left[n]:
                lengths.pop(bisect_left(lengths, n))
    return plan


def places(plan: list[tuple[Counter, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, ascending runs: first number, documents in a bin, first sequence, first offset."""
    runs, used, first = defaultdict(list), Counter(), 0
    for filled, times in plan:
        offset = 0
        for n in sorted(filled, reverse=True):
            runs[n].append((used[n], filled[n], first, offset))
            used[n] += filled[n] * times
            offset += n * filled[n]
        first += times
    return {n: tuple(np.array(x, dtype=np.int64).T) for n, x in runs.items()}


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Documents as pieces: key, piece, start, length, ids_crc32, task, number (in its task and length)."""
    packer = byte_pairs.shared(docs.sparkSession, tokenizer, byte_pairs.token_packer)
    end = SEPARATOR.to_bytes(4, "little")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def task(batches):
        pack = packer()
        here, seen = TaskContext.get().partitionId(), Counter()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = {n: [] for n in ("row", "piece", "start", "length", "crc", "number", "ids")}
            for row, value in enumerate(texts_of(batch)):
                ids = pack(value) + end
                total = len(ids) // 4
                # Only the first piece may be shorter than the others.
                edges = [0, *range(total % capacity or capacity, total + 1, capacity)]
                for piece, (start, stop) in enumerate(zip(edges, edges[1:], strict=False)):
                    part = ids[4 * start : 4 * stop]
                    values = (row, piece, start, stop - start, zlib.crc32(part), seen[stop - start])
                    for name, v in zip(found, values, strict=False):
                        found[name].append(v)
                    seen[stop - start] += 1
                    if with_ids:
                        found["ids"].append(np.frombuffer(part, "<i4"))
            columns = {
                "key": batch.column("key").take(pa.array(found["row"], pa.int64())),
                "piece": pa.array(found["piece"], pa.int32()),
                "start": pa.array(found["start"], pa.int64()),
                "length": pa.array(found["length"], pa.int64()),
                "ids_crc32": pa.array(found["crc"], pa.int64()),
                "task": pa.array([here] * len(found["row"]), pa.int32()),
                "number": pa.array(found["number"], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array(found["ids"], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(columns)

        return by_batch(work)(batches)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, task int, number long"
    return rows.mapInArrow(task, schema + (", ids array<int>" if with_ids else ""))


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset (and `ids`).

    A document is its ids and one separator; a null text is an empty one and so a piece of
    length 1. Each row is a document of its own, also where keys repeat or are null; an
    empty table gives no rows. Other columns are not read.

    Texts are tokenised once: the pieces are stored and only they are read afterwards.
    """
    spark = docs.sparkSession
    pieces = stored(spark, cut_pieces(docs, tokenizer, capacity, key, text, with_ids), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # Numbers run within a task; what earlier tasks have of the length comes before.
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    histogram = dict(pieces.groupBy("length").count().collect())  # `capacity` rows at most
    runs = places(plan_bins(histogram, capacity))

    def put(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths = batch.column("length").to_numpy()
        numbers = batch.column("number").to_numpy() + batch.column("before").to_numpy()
        sequence, offset = np.empty_like(numbers), np.empty_like(numbers)
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            start, fold, first, where = runs[int(n)]
            run = np.searchsorted(start, numbers[at], side="right") - 1
            bins, slot = np.divmod(numbers[at] - start[run], fold[run])
            sequence[at], offset[at] = first[run] + bins, where[run] + slot * n
        kept = batch.drop_columns(["task", "number", "before"])
        renamed = kept.rename_columns([key if c == "key" else c for c in kept.schema.names])
        return renamed.append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset)
        )

    placed = pieces.join(counts.drop("n"), ["task", "length"])
    names = [c for c in pieces.columns if c not in ("task", "number")]
    kinds = {c: pieces.schema[c].dataType.simpleString() for c in names}
    schema = ", ".join(f"`{key if c == 'key' else c}` {kinds[c]}" for c in names)
    return placed.select(*names, "task", "number", "before").mapInArrow(
        by_batch(put), schema + ", sequence_id long, offset long"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ids -> one row per sequence: sequence_id, ids. A group holds `capacity` ids at most."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
