"""Hard-negative mining (11): best-first search of an STR-packed R-tree by inner product.

Rows are dealt into tiles by sort-tile-recursive order, by the first two coordinates across
the cluster and by the others inside a tile. A tile is a row that holds a packed R-tree: leaves
with their vectors and bounding boxes. Each coordinate of a box times the anchor's coordinate
is an interval, and the sum of the intervals bounds every inner product in the box. Anchors
come in blocks of a fixed size; each task searches its tiles for each anchor of a block with a
queue that takes the most promising box first.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import query, stored, table
from factloom.session import shared_path

# Vectors in a leaf, boxes in a node, vectors in a tile, anchors in a block.
LEAF, FAN, TILE, BLOCK = 128, 8, 8192, 8192
# Anchors whose bounds against a tile's boxes are held at once.
ANCHORS_AT_ONCE = 256
LONG = (1 << 63) - 1

ROWS_ARROW = pa.schema([
    ("key", pa.int64()), ("label", pa.string()), ("size", pa.int32()), ("slab", pa.int32()),
    ("second", pa.float64()), ("vector", pa.binary()),
])
PACK_ARROW = pa.schema([
    ("size", pa.int32()), ("keys", pa.list_(pa.int64())), ("labels", pa.list_(pa.string())),
    ("vectors", pa.binary()), ("ends", pa.list_(pa.int32())), ("low", pa.binary()), ("high", pa.binary()),
])
PACK = ("size int, keys array<long>, labels array<string>, vectors binary, ends array<int>, "
        "low binary, high binary")
FOUND_ARROW = pa.schema([
    ("block", pa.int64()), ("anchor", pa.int32()), ("place", pa.int32()), ("anchor_id", pa.int64()),
    ("score", pa.int64()), ("key", pa.int64()),
])
FOUND = "block long, anchor int, place int, anchor_id long, score long, key long"


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers held as doubles, in 16 bits each where they fit."""
    fits = not numbers.size or np.abs(numbers).max() < 1 << 15
    return numbers.astype("<i2" if fits else "<f8").tobytes()


def unpacked(data: bytes, size: int, n: int) -> np.ndarray:
    return np.frombuffer(data, "<i2" if len(data) == 2 * size * n else "<f8").reshape(n, size).astype(np.float64)


def sort_tile(vectors: np.ndarray, leaf: int) -> Iterator[np.ndarray]:
    """Row numbers of each leaf: sorted and cut by one coordinate after the other.

    The widest coordinates come first; there are about as many slabs in each as there are
    coordinates left to cut by.
    """

    def tile(rows: np.ndarray, by: list[int]) -> Iterator[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1:
            yield rows
            return
        slabs = math.ceil(round(leaves ** (1 / len(by)), 9))
        rows = rows[np.argsort(vectors[rows, by[0]], kind="stable")]
        step = leaf * -(-leaves // slabs)
        for start in range(0, len(rows), step):
            yield from tile(rows[start : start + step], by[1:] or by)

    if len(vectors):
        yield from tile(np.arange(len(vectors)), np.argsort(-vectors.var(axis=0), kind="stable").tolist())


def pack(rows: list[dict]) -> dict:
    """Rows of one size as a packed tree."""
    size = rows[0]["size"]
    vectors = np.concatenate([unpacked(r["vector"], size, 1) for r in rows])
    leaves = list(sort_tile(vectors, LEAF))
    order = np.concatenate(leaves)
    boxes = [(vectors[leaf].min(axis=0), vectors[leaf].max(axis=0)) for leaf in leaves]
    return {
        "size": size, "keys": [rows[i]["key"] for i in order], "labels": [rows[i]["label"] for i in order],
        "vectors": packed(vectors[order]), "ends": np.cumsum([len(leaf) for leaf in leaves]).tolist(),
        "low": packed(np.stack([low for low, _ in boxes])), "high": packed(np.stack([high for _, high in boxes])),
    }


class Tree:
    """A tile, with boxes of boxes up to one root."""

    def __init__(self, row: dict):
        size, leaves = row["size"], len(row["ends"])
        self.keys = np.array(row["keys"], np.int64)
        self.names, self.labels = np.unique(np.array(row["labels"], dtype=str), return_inverse=True)
        self.vectors = unpacked(row["vectors"], size, len(self.keys))
        self.starts, self.ends = [0, *row["ends"][:-1]], row["ends"]
        low, high = (unpacked(row[side], size, leaves) for side in ("low", "high"))
        self.levels = [(low, high)]
        while len(low) > 1:
            starts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            self.levels.append((low, high))
        self.largest = float(np.abs(self.vectors).max())

    def exact(self) -> Tree:
        """The same tree in whole numbers of any length, for products that doubles cannot hold."""
        if self.vectors.dtype != object:
            self.vectors = whole(self.vectors)
            self.levels = [(whole(low), whole(high)) for low, high in self.levels]
        return self


def whole(numbers: np.ndarray) -> np.ndarray:
    found = np.empty(numbers.shape, object)
    found[...] = [[int(x) for x in row] for row in numbers.tolist()]
    return found


class Best:
    """The first `k` of the rows with low <= score <= high: (-score, key) in order."""

    def __init__(self, k: int, low=-math.inf, high=math.inf):
        self.k, self.low, self.high, self.rows = k, low, high, []

    def least(self):
        """What a score must reach to count; an equal one still may, by its key."""
        return max(self.low, -self.rows[-1][0]) if len(self.rows) == self.k else self.low

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        new = np.flatnonzero((scores >= self.least()) & (scores <= self.high))
        if len(new):
            rows = self.rows + [(-int(s), int(k)) for s, k in zip(scores[new], keys[new], strict=True)]
            self.rows = sorted(rows)[: self.k]


def bounds(tree: Tree, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(lowest, highest) inner product of each anchor with each box, level by level.

    A coordinate's interval runs from one edge of the box to the other, which one by its sign.
    """
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in tree.levels]


def search(tree: Tree, anchor: np.ndarray, limits, allowed: np.ndarray, wanted: list[Best]) -> None:
    """Take into each of `wanted` the rows of the tree that are `allowed` and within its limits.

    `limits` are the anchor's bounds. Of all boxes still open the one with the highest bound is
    opened first. A box stays closed that no one in `wanted` can use: its scores lie outside the
    limits or strictly below the last row kept.
    """
    top = len(tree.levels) - 1
    waiting = [(-limits[top][1][0], top, 0)]
    while waiting:
        best, level, node = heapq.heappop(waiting)
        if all(-best < w.least() for w in wanted):
            return
        lowest = limits[level][0][node]
        if not any(-best >= w.least() and lowest <= w.high for w in wanted):
            continue
        if level:
            highest = limits[level - 1][1]
            for child in range(node * FAN, min((node + 1) * FAN, len(highest))):
                heapq.heappush(waiting, (-highest[child], level - 1, child))
            continue
        rows = slice(tree.starts[node], tree.ends[node])
        here = allowed[rows]
        if here.any():
            scores, keys = (tree.vectors[rows] @ anchor)[here], tree.keys[rows][here]
            for w in wanted:
                w.add(scores, keys)


def within(score: int, low: int, high: int, base: int) -> tuple[int, int]:
    """Scores s with low * score <= base * s <= high * score."""
    return -(-low * score // base), high * score // base


def find(tiles: DataFrame, block: DataFrame, k: int, same: bool, shares: tuple[int, int, int] | None) -> DataFrame:
    """FOUND rows: of each anchor and place the first `k`, as far as each task knows.

    Places are the block's windows (low, high and base of `shares` times a positive's score), or
    a single one without limits. Each task keeps its best over all its tiles, so boxes close
    earlier with every tile.
    """

    def task(batches):
        kept: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                treat(row, kept)
        for start in range(0, len(kept), 1 << 16):
            rows = [
                {"block": block, "anchor": n, "place": place, "anchor_id": name,
                 "score": max(-LONG - 1, min(LONG, -score)), "key": key}
                for (block, n, name), wanted in list(kept.items())[start : start + (1 << 16)]
                for place, best in wanted for score, key in best.rows
            ]
            yield pa.RecordBatch.from_pylist(rows, FOUND_ARROW)

    def treat(row: dict, kept: dict) -> None:
        tree = Tree(row)
        names = row["anchor_keys"]
        anchors = unpacked(row["anchor_vectors"], row["size"], len(names))
        if float(np.abs(anchors).max()) * tree.largest * row["size"] >= 1 << 53:
            tree, anchors = tree.exact(), whole(anchors)
        places: dict[int, list] = {}
        for w in row["windows"] or ():
            places.setdefault(w["anchor"], []).append((w["place"], w["score"]))
        code = {name: i for i, name in enumerate(tree.names.tolist())}
        for start in range(0, len(names), ANCHORS_AT_ONCE):
            limits = bounds(tree, anchors[start : start + ANCHORS_AT_ONCE])
            for n in range(start, min(start + ANCHORS_AT_ONCE, len(names))):
                if shares is None:
                    made = [(0, Best(k))]
                else:
                    made = [(place, Best(k, *within(score, *shares))) for place, score in places.get(n, ())]
                wanted = kept.setdefault((row["block"], n, names[n]), made)
                if not wanted:
                    continue
                alike = tree.labels == code.get(row["anchor_labels"][n], -1)
                allowed = (alike if same else ~alike) & (tree.keys != names[n])
                own = [(low[n - start], high[n - start]) for low, high in limits]
                search(tree, anchors[n], own, allowed, [best for _, best in wanted])

    local = tiles.join(F.broadcast(block), "size").mapInArrow(task, FOUND)
    order = Window.partitionBy("block", "anchor", "place").orderBy(F.col("score").desc(), "key")
    return local.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def numbered(rows: DataFrame, scale: int, first_bounds: list[float]) -> DataFrame:
    """Rows of ROWS_ARROW: components floor(scale * x), with their place in the tiling."""

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            values = np.floor(float(scale) * vectors.flatten().to_numpy(zero_copy_only=False))
            ends = np.cumsum(sizes)
            starts = ends - sizes
            second = np.where(sizes > 1, values[np.minimum(starts + 1, len(values) - 1)], 0.0)
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), batch.column("label"), pa.array(sizes, pa.int32()),
                pa.array(np.searchsorted(first_bounds, values[starts]), pa.int32()), pa.array(second),
                pa.array([packed(values[a:z]) for a, z in zip(starts, ends, strict=True)], pa.binary()),
            ], schema=ROWS_ARROW)

    return rows.mapInArrow(task, "key long, label string, size int, slab int, second double, vector binary")


def by_size(rows: DataFrame, limit: int, build) -> DataFrame:
    """`build` of up to `limit` rows of one size at a time, in the order they come in."""

    def task(batches):
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (len(held) == limit or held[0]["size"] != row["size"]):
                    yield pa.RecordBatch.from_pylist([build(held)], PACK_ARROW)
                    held = []
                held.append(row)
        if held:
            yield pa.RecordBatch.from_pylist([build(held)], PACK_ARROW)

    return rows.mapInArrow(task, PACK)


def as_block(rows: list[dict]) -> dict:
    vectors = np.concatenate([unpacked(r["vector"], r["size"], 1) for r in rows])
    return {
        "size": rows[0]["size"], "keys": [r["key"] for r in rows], "labels": [r["label"] for r in rows],
        "vectors": packed(vectors), "ends": [], "low": b"", "high": b"",
    }


def usable(rows: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """key, label, vector of the rows that take part."""
    named = rows.select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float("inf")))
    return named.filter(F.col("key").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & finite)


def mine(
    rows: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    shares: tuple[int, int, int] = (80, 100, 100),
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchors` is a condition on column `key`. A row's score is its inner product with the anchor
    in components floor(scale * x). An anchor's positives are its first `positives` other rows of
    its label, by score and then by smaller key; for each of them the first `negatives` rows of
    other labels whose score s satisfies low * positive <= base * s <= high * positive, with
    (low, high, base) = `shares`. All rows are searched, nothing is approximate.

    Rows with a null key, label or vector, an empty vector, or a component that is null or not
    finite (scaled, too) take no part. Only vectors of one length are compared. Every row counts by itself, repeated
    ones too, but rows that share the anchor's key are not its partners, and each anchor that is
    repeated is served again. Scores are exact whatever the components; those beyond 64 bits are
    given as the nearest long. Other columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    usable_rows = usable(rows, key, vector, label, scale)
    total, = usable_rows.agg(F.count(F.lit(1))).first()
    tiles_wanted = max(1, -(-total // TILE))
    slabs = math.isqrt(tiles_wanted - 1) + 1
    cuts = []
    if slabs > 1:
        shares_of = [i / slabs for i in range(1, slabs)]
        cuts = usable_rows.agg(F.percentile_approx(F.col("vector")[0], shares_of, 10_000)).first()[0]
    first_bounds = sorted({math.floor(scale * x) for x in cuts})

    place = ["size", "slab", "second", "key"]
    dealt = numbered(usable_rows, scale, first_bounds).repartitionByRange(tiles_wanted, *place)
    tiles = stored(spark, by_size(dealt.sortWithinPartitions(*place), TILE, pack), "tiles")
    chosen = stored(spark, numbered(usable_rows.filter(anchors), scale, first_bounds), "anchors")
    blocks_wanted = max(1, -(-chosen.count() // BLOCK))
    spread = chosen.repartition(blocks_wanted).sortWithinPartitions("size", "key")
    blocks = by_size(spread, BLOCK, as_block).withColumn("block", F.monotonically_increasing_id()).select(
        "block", "size", F.col("keys").alias("anchor_keys"), F.col("labels").alias("anchor_labels"),
        F.col("vectors").alias("anchor_vectors"),
    )
    blocks = stored(spark, blocks, "blocks")

    # One block after the other: a task then holds one of its tiles and one block.
    path = shared_path(spark, "negatives")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], result).write.parquet(f"{path}/block=none")
    for number in [r["block"] for r in blocks.select("block").toLocalIterator()]:
        block = blocks.filter(F.col("block") == number)
        windows = F.lit(None).cast("array<struct<anchor: int, place: int, score: long>>")
        near = find(tiles, block.withColumn("windows", windows), positives, True, None).select(
            "block", "anchor", "anchor_id", F.col("rank").alias("place"), F.col("key").alias("positive_id"),
            F.col("score").alias("positive_score"),
        )
        near = stored(spark, near, "positives")
        asked = near.groupBy("block").agg(
            F.collect_list(F.struct("anchor", "place", F.col("positive_score").alias("score"))).alias("windows")
        )
        hard = find(tiles, block.join(asked, "block"), negatives, False, shares)
        hard = hard.join(near.drop("anchor_id"), ["block", "anchor", "place"]).select(
            "anchor_id", "positive_id", "rank", F.col("key").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
        hard.write.mode("overwrite").parquet(f"{path}/block={number}")
    return spark.read.schema(result).parquet(f"{path}/block=*")


_SQL = """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id,
               CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
        FROM v a JOIN v b ON b.vec_id <> a.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY rank <= 5"""


@query("op11_hard_negatives", _SQL)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, folder, "embeddings").withColumn("label", moved)
    return mine(vectors, F.col("key") % 100 == 0)
