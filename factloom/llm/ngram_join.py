"""N-gram Jaccard join (3): T-occurrence search with DivideSkip over inverted lists.

1. Every document becomes its set of shingles (64-bit hashes). Documents with the same set
   are one class from here on, known by a 64-bit hash of the set.
2. Classes that can be linked are brought together: two sets with the required overlap share
   one of the first few shingles in a common order, rare ones first. Classes that share such
   a shingle and have fitting sizes form potential groups; each is in one group only, so the
   sets travel once, however many shingles they share.
3. In each group, T-occurrence search: a set looks for the smaller ones that share at least T
   of its shingles. The long lists are set aside, the short ones are merged on a heap that
   skips what cannot reach the count, and candidates are probed in the long lists by halving.
   Pairs whose link would join nothing new are passed over. Groups beyond the size for one
   task are split into blocks, and each pair of blocks is a task of its own.
4. The links found give the components.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import (
    Memo, join_values, per_worker, query, stored, table, texts_of,
)
from factloom.llm.components import components

# Fixed value: the weight of the logarithm in DivideSkip's number of long lists.
MU = 0.0085
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MIX = np.uint64(0x9E3779B97F4A7C15)
# Leading bits by which shingles are counted over the whole corpus.
KEPT_BITS = 36


@dataclass(frozen=True)
class Settings:
    """`words`: length of a shingle. `percent`: least similarity. `frequent`: shingles whose
    frequency the common order knows, at most (the others count as rare; any order gives
    the same links). `window`: shingles a task counts at a time. `bits`: two to this power
    are the bits that tell shared shingles, of which the part `filled` is used at most;
    `per_range`: documents for each range that they are counted in. `block`, `volume`: sets and
    shingles of a group that one task takes. `broadcast`: classes up to which their keys are
    broadcast to the texts; more of them are joined by key."""

    words: int = 5
    percent: int = 75
    frequent: int = 500_000
    window: int = 2_000_000
    bits: int = 28
    filled: float = 0.1
    per_range: int = 4096
    block: int = 2_000
    volume: int = 3_000_000
    broadcast: int = 200_000

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """How many of n shingles to index: as many as two linked sets cannot both avoid."""
        return n - -(-n * self.percent // 100) + 1


class Shingler:
    """Text -> ascending array of its distinct shingles as 64-bit hashes."""

    def __init__(self, width: int):
        self.width, self.hashes = width, Memo(xxhash.xxh3_64_intdigest, 250_000)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().translate(LOWER).split()
        count = len(words)
        if not count:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, count)
        width = min(self.width, count)
        places = count - width + 1
        mixed = np.full(places, width, np.uint64)
        for k in range(width):
            mixed = (mixed ^ h[k : k + places]) * MIX
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def row_key(key: str, text: str) -> Column:
    """Tells rows apart by id and text, whatever is null."""
    return F.concat_ws("~", F.col(key).cast("string"), F.hex(F.xxhash64(F.col(text))))


def thinned(values: np.ndarray, ranges: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Ascending shingles by range of their leading bits, as (range, low, high).

    Of each only the first 36 bits are kept, as its distance from the one before: two bytes
    in `low`, and the few that need more as (place, rest) in `high`.
    """
    short = values >> np.uint64(64 - KEPT_BITS)
    width = (1 << KEPT_BITS) // ranges
    edges = np.searchsorted(short, np.arange(ranges + 1, dtype=np.uint64) * np.uint64(width))
    for k in np.flatnonzero(np.diff(edges)):
        part = short[edges[k] : edges[k + 1]].astype(np.int64) - int(k) * width
        gaps = np.diff(part, prepend=0)
        far = np.flatnonzero(gaps >> 16)
        high = np.column_stack([far, gaps[far] >> 16]).astype("<u4")
        yield int(k), (gaps & 0xFFFF).astype("<u2").tobytes(), high.tobytes()


def restored(low: bytes, high: bytes) -> np.ndarray:
    """What `thinned` kept of a range, counted from the range's beginning."""
    gaps = np.frombuffer(low, "<u2").astype(np.int64)
    far = np.frombuffer(high, "<u4").reshape(-1, 2)
    gaps[far[:, 0]] += far[:, 1].astype(np.int64) << 16
    return np.cumsum(gaps)


def classes(docs: DataFrame, ranges: int, settings: Settings) -> DataFrame:
    """_key, id, n, class of every row; and rows without a class for the common order.

    Those are a window's shingles that many of its sets have, with their number in n, and
    all its shingles in short, by range.
    """
    made = per_worker(docs.sparkSession, settings.words, Shingler)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = made()
        held, size, done = [], 0, set()

        def rows(id_type: pa.DataType, count: int, **columns: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    name: columns.get(name, pa.nulls(count, kind))
                    for name, kind in (
                        ("_key", pa.string()), ("id", id_type), ("n", pa.int64()), ("class", pa.int64()),
                        ("shingle", pa.int64()), ("range", pa.int32()), ("low", pa.binary()),
                        ("high", pa.binary()),
                    )
                }
            )

        def window() -> Iterator[pa.RecordBatch]:
            flat = np.concatenate(held)
            held.clear()
            flat.sort()
            first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
            counts = np.diff(first, append=len(flat))
            often = counts > 2
            yield rows(
                id_type, int(often.sum()), n=pa.array(counts[often], pa.int64()),
                shingle=pa.array(flat[first[often]].view(np.int64)),
            )
            del first, counts, often
            parts = list(thinned(flat, ranges))
            at, low, high = zip(*parts, strict=True)
            yield rows(
                id_type, len(parts), range=pa.array(at, pa.int32()),
                low=pa.array(low, pa.binary()), high=pa.array(high, pa.binary()),
            )

        for batch in batches:
            id_type = batch.schema.field("id").type
            sets = [shingler(t) for t in texts_of(batch)]
            names = [class_of(s) for s in sets]
            yield rows(
                id_type, len(sets), _key=batch.column("_key"), id=batch.column("id"),
                n=pa.array([len(s) for s in sets], pa.int64()), **{"class": pa.array(names, pa.int64())},
            )
            for name, found in zip(names, sets, strict=True):
                if len(found) and name not in done:
                    done.add(name)
                    held.append(found)
                    size += len(found)
            if size > settings.window:
                yield from window()
                held, size, done = [], 0, set()
        if size:
            yield from window()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(
        task,
        f"_key string, id {kind}, n long, class long, shingle long, range int, low binary, high binary",
    )


def shared_bits(marked: DataFrame, ranges: int, settings: Settings) -> np.ndarray:
    """A bit for each value of the leading bits of a shingle: set where two sets or more have one.

    Counted over all sets, by range. Where a range has more such shingles than a part of its
    bits, only the commoner ones count.
    """
    bits = (1 << settings.bits) // ranges
    shift = KEPT_BITS - settings.bits

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def segment() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            least = 2
            while (found := values[counts >= least]).size > bits * settings.filled:
                least += 1
            marks = np.zeros(bits, np.uint8)
            marks[found >> shift] = 1
            return pa.RecordBatch.from_pydict(
                {"range": pa.array([at], pa.int32()), "marks": pa.array([np.packbits(marks).tobytes()])}
            )

        for batch in batches:
            for where, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if where != at:
                    if held:
                        yield segment()
                    at, held = where, []
                held.append(restored(low, high))
        if held:
            yield segment()

    # As many bits in all as `settings.bits` says.
    dealt = marked.select("range", "low", "high").repartition("range").sortWithinPartitions("range")
    segments = dealt.mapInArrow(task, "range int, marks binary").toArrow()
    whole = np.zeros((ranges, bits // 8), np.uint8)
    for where, marks in zip(segments["range"].to_pylist(), segments["marks"].to_pylist(), strict=True):
        whole[where] = np.frombuffer(marks, np.uint8)
    return whole.reshape(-1)


def common_order(marked: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, ascending, and their counts; `settings.frequent` of them at most.

    Those with the highest counts: from the count on that leaves no more than that many.
    """
    spark = marked.sparkSession
    found = stored(spark, marked.groupBy("shingle").agg(F.sum("n").alias("n")), "frequent")
    many = found.groupBy(F.least("n", F.lit(1 << 16)).alias("n")).agg(F.count(F.lit(1)).alias("shingles"))
    least, kept = 1 << 62, 0
    for count, shingles in sorted(many.collect(), reverse=True):  # 65,536 rows at most
        kept += shingles
        if kept > settings.frequent:
            break
        least = count
    picked = found.filter(F.col("n") >= least).toArrow()
    shingles = picked["shingle"].to_numpy().view(np.uint64)
    counts = picked["n"].to_numpy()
    ascending = np.argsort(shingles)
    return shingles[ascending], counts[ascending].astype(np.int32)


def postings(
    docs: DataFrame, order: tuple[np.ndarray, np.ndarray, np.ndarray], settings: Settings
) -> DataFrame:
    """shingle, n, class: the first shingles of every class in the common order.

    Shingles that no two sets share come first, then the shared ones, then those whose
    frequency is known, by it; among equals the hash decides.
    """
    made = per_worker(
        docs.sparkSession, order, lambda value: (Shingler(settings.words), *value)
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, known, counts, shared = made()
        shift = np.uint64(64 - settings.bits)
        done: set[int] = set()
        for batch in batches:
            sets, names = [], []
            for text in texts_of(batch):
                found = shingler(text)
                if len(found) and (name := class_of(found)) not in done:
                    done.add(name)
                    sets.append(found)
                    names.append(name)
            if len(done) > 200_000:
                done.clear()
            if not sets:
                continue
            flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
            owner = np.repeat(np.arange(len(sets)), sizes)
            place = (flat >> shift).astype(np.int64)
            rank = ((shared[place >> 3] >> (7 - (place & 7))) & 1).astype(np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, flat), len(known) - 1)
                rank = np.where(known[at] == flat, counts[at], rank)
            # Within a set hashes ascend already, and the sort keeps that among equals.
            placed = np.lexsort((rank, owner))
            number = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            kept = placed[number < settings.prefix(sizes)[owner]]
            yield pa.RecordBatch.from_pydict(
                {
                    "shingle": pa.array(flat[kept].view(np.int64)),
                    "n": pa.array(sizes[owner[kept]], pa.int32()),
                    "class": pa.array(np.array(names, np.int64)[owner[kept]]),
                }
            )

    return docs.select("text").mapInArrow(task, "shingle long, n int, class long")


def potential_edges(indexed: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): classes that share an indexed shingle, as stars of classes of fitting sizes.

    In a list by size, a class that is too small for the next one is too small for all that
    follow; so runs without such a gap hold every pair that may be linked.
    """
    ordered = indexed.repartition("shingle").sortWithinPartitions("shingle", "n", "class")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row of the batch before, and the head of its run.
        last = (None, 0, 0, 0)
        for batch in batches:
            shingle = batch.column("shingle").to_numpy()
            n = batch.column("n").to_numpy().astype(np.int64)
            name = batch.column("class").to_numpy()
            new = np.ones(len(n), bool)
            new[1:] = (shingle[1:] != shingle[:-1]) | (100 * n[:-1] < settings.percent * n[1:])
            if last[0] is not None:
                new[0] = shingle[0] != last[0] or 100 * last[1] < settings.percent * n[0]
            heads = np.flatnonzero(new)
            at = np.cumsum(new) - 1
            head = np.where(at >= 0, name[heads[np.maximum(at, 0)]] if len(heads) else 0, last[3])
            last = (shingle[-1], n[-1], name[-1], head[-1])
            kept = head != name
            pairs = np.unique(np.column_stack([head[kept], name[kept]]), axis=0)
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])}
            )

    return ordered.mapInArrow(task, "a long, b long")


def merge_skip(lists: list[array], least: int) -> list[tuple[int, int]]:
    """(id, count) for the ids on at least `least` of the ascending lists."""
    if sum(map(len, lists)) > 20_000:
        # Where lists hold nearly all ids there is nothing to skip, and counting is quicker.
        counts = np.bincount(np.concatenate([np.frombuffer(ids, np.int32) for ids in lists]))
        found = np.flatnonzero(counts >= least)
        return list(zip(found.tolist(), counts[found].tolist(), strict=True))
    heap = [(ids[0], k) for k, ids in enumerate(lists)]
    heapq.heapify(heap)
    at = [0] * len(lists)
    found = []
    while len(heap) >= max(least, 1):
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            found.append((top, len(popped)))
            for k in popped:
                at[k] += 1
        else:
            # With what is left, no id below the next top can reach the count.
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            following = heap[0][0]
            for k in popped:
                at[k] = bisect_left(lists[k], following, at[k])
        for k in popped:
            if at[k] < len(lists[k]):
                heapq.heappush(heap, (lists[k][at[k]], k))
    return found


class Lists:
    """Inverted lists of several sets, as ranges of one array of set numbers in shingle order."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets)
        self.edge = np.cumsum([0] + [len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), np.diff(self.edge))
        order = np.argsort(flat, kind="stable")  # numbers ascend within a list
        ids, ordered = owner[order], flat[order]
        new = np.ones(len(flat), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(flat)), 0))
        # For each shingle of each set: where its list begins, and how many smaller sets are on it.
        self.begin, self.before = np.empty_like(first), np.empty_like(first)
        self.begin[order] = first
        self.before[order] = np.arange(len(flat)) - first
        self.ids = array("i", ids.tobytes())

    def of(self, x: int) -> tuple[np.ndarray, np.ndarray]:
        """Begins and lengths of the lists of set x, cut before x itself, shortest first."""
        mine = slice(self.edge[x], self.edge[x + 1])
        begin, length = self.begin[mine], self.before[mine]
        used = np.flatnonzero(length)
        used = used[np.argsort(length[used], kind="stable")]
        return begin[used], length[used]


def search(sets: list[np.ndarray], sides: list[int] | None, percent: int) -> list[tuple[int, int]]:
    """Links between sets (ascending by size), as many as join something new.

    With `sides`, only sets of different sides are compared.
    """
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    lists, found = Lists(sets), []
    for x, shingles in enumerate(sets):
        n = len(shingles)
        least = -(-n * percent // 100)
        begin, length = lists.of(x)
        if len(begin) < least:
            continue
        aside = min(least - 1, int(least / (MU * log2(max(int(length[-1]), 2)) + 1)))
        cut = len(begin) - aside
        spans = [(b, b + k) for b, k in zip(begin.tolist(), length.tolist(), strict=True)]
        short = [lists.ids[b:e] for b, e in spans[:cut]]
        for y, count in merge_skip(short, least - aside):
            if (sides and sides[x] == sides[y]) or root(x) == root(y):
                continue
            # 100 * both >= percent * (n + m - both)
            need = -(-percent * (n + len(sets[y])) // (100 + percent))
            left = aside
            for b, e in spans[cut:]:
                if count >= need or count + left < need:
                    break
                at = bisect_left(lists.ids, y, b, e)
                count += at < e and lists.ids[at] == y
                left -= 1
            if count >= need:
                parent[root(x)] = root(y)
                found.append((y, x))
    return found


def links(grouped: DataFrame, settings: Settings) -> DataFrame:
    """Rows of (label, i, j, side, n, class, text), sorted, -> (a, b) links between classes."""
    made = per_worker(grouped.sparkSession, settings.words, Shingler)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = made()
        at, names, sets, sides = None, [], [], []
        found: list[tuple[int, int]] = []

        def solve() -> None:
            apart = sides if at and at[1] != at[2] else None
            found.extend((names[a], names[b]) for a, b in search(sets, apart, settings.percent))

        def out() -> pa.RecordBatch:
            a, b = zip(*found, strict=True) if found else ((), ())
            found.clear()
            return pa.RecordBatch.from_pydict(
                {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
            )

        for batch in batches:
            for label, i, j, side, _, name, text in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                if at != (label, i, j):
                    if sets:
                        solve()
                    at, names, sets, sides = (label, i, j), [], [], []
                if not names or names[-1] != name:  # copies follow each other
                    names.append(name)
                    sets.append(shingler(text))
                    sides.append(side)
            yield out()
        if sets:
            solve()
            yield out()

    return grouped.mapInArrow(task, "a long, b long")


def group_rows(
    docs: DataFrame, members: DataFrame, labels: DataFrame, settings: Settings
) -> DataFrame:
    """Texts of the classes in potential groups, in the blocks that are compared with each other.

    Texts travel and not sets: they are smaller, and made into sets where they are compared.
    """
    spark = docs.sparkSession
    picked = members.join(labels.withColumnRenamed("node", "class"), "class")
    blocks = F.greatest(F.count(F.lit(1)) / settings.block, F.sum("n") / settings.volume)
    sizes = picked.groupBy("label").agg(
        F.ceil(blocks).cast("int").alias("blocks"), F.count(F.lit(1)).alias("size")
    )
    picked = join_values(picked, sizes, "label", "size", labels.count())
    picked = stored(spark, picked.select("first_key", "class", "n", "label", "blocks"), "picked")
    if picked.count() <= settings.broadcast:
        picked = F.broadcast(picked)
    rows = docs.join(picked, docs["_key"] == picked["first_key"])
    side = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(F.col("side"), o).alias("i"), F.greatest(F.col("side"), o).alias("j")),
    )
    spread = rows.withColumn("side", side).withColumn("pair", F.explode(others))
    return (
        spread.select("label", "pair.i", "pair.j", "side", "n", "class", "text")
        .repartition("label", "i", "j")
        .sortWithinPartitions("label", "i", "j", "n", "class")
    )


def near_copies(
    docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: key, _key, n_shingles, component_id, component_key.

    component_id is the smallest key reachable by links of at least the similarity, a row's
    own included. A text without words, and a null one, has an empty set, is linked with
    nothing and is a component of its own. Rows with the same set are linked whatever their
    key. Null keys count last: component_id is null where a component has no other. _key and
    component_key tell rows with the same or no key apart by their text. Other columns are
    not read. Sets are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(row_key("id", "text").alias("_key"), "id", "text")
    ranges = 64
    while ranges < min(docs.count() // settings.per_range, 1 << 16):
        ranges *= 2
    marked = stored(spark, classes(rows, ranges, settings), "classes")
    every = marked.filter("class IS NOT NULL").select("_key", "id", "n", "class")
    order = common_order(marked.filter("shingle IS NOT NULL"), settings)
    order = (*order, shared_bits(marked.filter("range IS NOT NULL"), ranges, settings))
    # One row per class; the smallest row stands for it.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_key"))
    members = every.filter("n > 0").groupBy("class").agg(
        F.min("n").alias("n"), F.count(F.lit(1)).alias("rows"), first.alias("first")
    )
    members = stored(
        spark,
        members.select("class", "n", "rows", F.col("first.id").alias("first_id"),
                       F.col("first._key").alias("first_key")),
        "members",
    )
    edges = potential_edges(postings(rows, order, settings), settings)
    labels = components(edges)
    found = links(group_rows(rows, members, labels, settings), settings)
    joined = components(found).withColumnRenamed("node", "class")
    linked = members.join(joined, "class", "left").withColumn("label", F.coalesce("label", "class"))
    least = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "first_key"))
    heads = linked.groupBy("label").agg(least.alias("head"), F.count(F.lit(1)).alias("size"))
    answers = join_values(linked.select("label", "class", "rows"), heads, "label", "size", members.count())
    answers = stored(
        spark,
        answers.select("class", "rows", F.col("head.first_id").alias("component_id"),
                       F.col("head.first_key").alias("component_key")),
        "answers",
    )
    total = answers.agg(F.sum("rows")).first()[0] or 0
    full = join_values(every.filter("n > 0"), answers, "class", "rows", total)
    empty = every.filter("n = 0").withColumns({"component_id": F.col("id"), "component_key": F.col("_key")})
    return full.unionByName(empty).select(
        F.col("id").alias(key), "_key", F.col("n").alias("n_shingles"), "component_id", "component_key"
    )


def drop_near_copies(
    docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each component (its smallest) and every row without words; all columns."""
    spark = docs.sparkSession
    inner = [f"c{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, inner, strict=True))
    found = near_copies(docs, settings, key, text)
    kept = stored(
        spark, found.filter("_key = component_key").groupBy("_key").agg(F.count(F.lit(1)).alias("n")), "kept"
    )
    rows = docs.toDF(*inner)
    rows = rows.withColumn("_text", F.coalesce(F.col(at[text]), F.lit("")))
    rows = rows.withColumn("_key", row_key(at[key], "_text"))
    rows = rows.join(kept.select("_key"), "_key", "left_semi")
    if not kept.filter("n > 1").isEmpty():
        # Rows that repeat in id and text; those without words all stay.
        words = F.trim(F.translate("_text", "\t\n\x0b\x0c\r", "     ")) != ""
        rows = rows.filter(words).dropDuplicates(["_key"]).unionByName(rows.filter(~words))
    return rows.select(*inner).toDF(*docs.columns)


@query("op3_ngram_jaccard_join")
def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = near_copies(table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
