"""Exact dedup (1): texts meet in partitions by length and content hash, where compressed
radix tries over their bytes hold the smallest identifier at each end.

Each task first collapses the copies among its own rows, so a text that makes up a third of
the corpus reaches its trie once per task and not once per row. The rows of the task keep a
number of their own for that text, over which the trie's answer comes back to them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.common import query, stored, table

# Bytes of distinct text that a task holds, in its table of own copies and in its trie.
HELD_BYTES = 32 << 20


def normalised(text: Column) -> Column:
    """Null as empty; each run of space, tab, line feed and the like as one space."""
    # A lone space is its own replacement, so it need not match.
    runs = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


class Terminal:
    """The end of a text: the best row so far and its bytes, the number of rows, and who asked."""

    __slots__ = ("asked", "best", "rows", "weight")

    def __init__(self):
        self.best, self.rows, self.asked, self.weight = None, 0, [], 0

    def add(self, rank: tuple, rows: int, asked: int, payload: object) -> None:
        if self.best is None or rank < self.best[0]:
            self.best = (rank, payload)
        self.rows += rows
        self.asked.append(asked)

    def beaten_by(self, rank: tuple) -> bool:
        return self.best is None or rank < self.best[0]


class Node:
    """Edges by first byte, each a label and the node behind it; the end of a text, if one ends here."""

    __slots__ = ("edges", "end")

    def __init__(self, edges: dict | None = None, end: Terminal | None = None):
        self.edges, self.end = edges or {}, end

    def ends(self) -> Iterator[Terminal]:
        """Ends at and below this node."""
        waiting = [self]
        while waiting:
            node = waiting.pop()
            if node.end is not None:
                yield node.end
            waiting += [child for _, child in node.edges.values()]

    def size(self) -> int:
        """Bytes on the edges below."""
        total, waiting = 0, [self]
        while waiting:
            for label, child in waiting.pop().edges.values():
                total += len(label)
                waiting.append(child)
        return total


class RadixTrie:
    """Compressed trie over byte strings: an edge carries every byte up to the next branch."""

    def __init__(self):
        self.root, self.held = Node(), 0

    def terminal(self, text: bytes) -> Terminal:
        """The end of the text, a new one if there was none."""
        node, at = self.root, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = Node(end=Terminal())
                node.edges[text[at]] = [text[at:], leaf]
                self.held += len(text) - at
                return leaf.end
            label = edge[0]
            if not text.startswith(label, at):
                same = shared(label, text[at : at + len(label)])
                # The edge splits where the texts part.
                edge[1] = Node({label[same]: [label[same:], edge[1]]})
                edge[0] = label = label[:same]
            node, at = edge[1], at + len(label)
        if node.end is None:
            node.end = Terminal()
        return node.end

    def spill(self, limit: int) -> Iterator[Terminal]:
        """Take out the largest subtree, and again, until at most `limit` bytes are held; its ends.

        Subtrees hang on the first branch below the root.
        """
        branch = self.root
        while branch.end is None and len(branch.edges) == 1:
            ((_, branch),) = branch.edges.values()
        sizes = [(len(label) + child.size(), first) for first, (label, child) in branch.edges.items()]
        for size, first in sorted(sizes, reverse=True):
            if self.held <= limit:
                return
            _, child = branch.edges.pop(first)
            ends = list(child.ends())
            self.held -= size + sum(end.weight for end in ends)
            yield from ends


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def rank(key, uid) -> tuple:
    """Order in which a row is preferred: smallest key, nulls last, then the row's own number."""
    return (key is None, 0 if key is None else key, uid)


def collapse(names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one task -> its members, and one owner row for each text that they hold.

    `names` are the columns that an owner row carries on.
    """
    schema, held, size = None, {}, 0

    def owners() -> pa.RecordBatch:
        """The best rows, each with its count and number, gathered from what was copied of each batch."""
        by_copy: dict[int, list] = {}
        for copy, place, _, rows, local in held.values():
            by_copy.setdefault(id(copy), [copy, [], [], []])
            for kept, value in zip(by_copy[id(copy)][1:], (place, rows, local), strict=True):
                kept.append(value)
        picked = [
            copy.take(pa.array(places, pa.int64())).append_column("rows", pa.array(rows, pa.int64()))
            .append_column("local", pa.array(locals_, pa.int64()))
            for copy, places, rows, locals_ in by_copy.values()
        ]
        flat = pa.Table.from_batches(picked).combine_chunks().to_batches()[0]
        return member_or_owner(flat, "owner", schema)

    for batch in batches:
        schema = schema or union_schema(batch.schema)
        locals_, better = [], {}
        values = zip(
            batch.column("_norm").to_pylist(), batch.column("_key").to_pylist(),
            batch.column("_uid").to_pylist(), strict=True,
        )
        for row, (text, key, uid) in enumerate(values):
            found = held.get(text)
            if found is None:
                held[text] = [None, 0, rank(key, uid), 1, uid]
                better[text] = row
                size += len(text)
                locals_.append(uid)
            else:
                if rank(key, uid) < found[2]:
                    found[2], better[text] = rank(key, uid), row
                found[3] += 1
                locals_.append(found[4])
        if better:
            # A copy of the rows that matter: a slice would keep the whole batch.
            copy = batch.select(names).take(pa.array(list(better.values()), pa.int64()))
            size += copy.nbytes
            for place, text in enumerate(better):
                held[text][:2] = copy, place
        members = batch.select(["_key", "_uid", "_sha"]).append_column(
            "local", pa.array(locals_, pa.int64())
        )
        yield member_or_owner(members, "member", schema)
        if size > HELD_BYTES:
            yield owners()
            held, size = {}, 0
    if held:
        yield owners()


def union_schema(given: pa.Schema) -> pa.Schema:
    kept = [f.with_nullable(True) for f in given if f.name != "_norm"]
    more = [("local", pa.int64()), ("rows", pa.int64()), ("kind", pa.string())]
    return pa.schema([*kept, *(pa.field(*f) for f in more)])


def member_or_owner(batch: pa.RecordBatch, kind: str, schema: pa.Schema) -> pa.RecordBatch:
    names = batch.schema.names
    columns = [
        pa.array([kind] * batch.num_rows) if f.name == "kind"
        else batch.column(f.name).cast(f.type) if f.name in names
        else pa.nulls(batch.num_rows, f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def own(survivors: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Owner rows sorted by (length, hash) -> for every asker the row that stays; or, with
    `survivors`, those columns of the rows that stay.

    A trie holds the texts of one length. Past the held bytes, its largest subtrees are written
    out until half of them are left: rows come in the order of their hashes, so but for the text
    at hand every end in them is complete. Spark's sort holds on disk what is not yet read.
    """
    trie, at = RadixTrie(), None

    def leave(ends: Iterator[Terminal]) -> Iterator[pa.RecordBatch]:
        found = list(ends)
        if not found:
            return
        if survivors:
            yield pa.Table.from_batches([e.best[1] for e in found]).combine_chunks().to_batches()[0]
            return
        flat = [(a, *e.best[1], e.rows) for e in found for a in e.asked]
        names = ("local", "keep_id", "keep_uid", "group_size")
        kinds = (pa.int64(), key_type, pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*flat, strict=True), kinds, strict=True)], names
        )

    for batch in batches:
        key_type = batch.schema.field("_key").type
        columns = ("_norm", "_bytes", "_sha", "_key", "_uid", "local", "rows")
        values = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
        for row, (text, n, sha, key, uid, local, rows) in enumerate(values):
            if at is not None and n != at[0]:
                yield from leave(trie.root.ends())
                trie = RadixTrie()
            elif trie.held > HELD_BYTES and sha != at[1]:
                yield from leave(trie.spill(HELD_BYTES // 2))
            at = (n, sha)
            end = trie.terminal(text.encode())
            payload = key, uid
            if survivors and end.beaten_by(rank(key, uid)):
                payload = batch.select(survivors).take(pa.array([row], pa.int64()))
                trie.held += payload.nbytes - end.weight
                end.weight = payload.nbytes
            end.add(rank(key, uid), rows, local, payload)
    yield from leave(trie.root.ends())


def prepared(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, list[str]]:
    """Stored members and owner rows, and the names that `docs` has inside them."""
    inner = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*inner)
    at = dict(zip(docs.columns, inner, strict=True))
    rows = rows.select(
        *inner,
        F.col(at[key]).alias("_key"),
        F.monotonically_increasing_id().alias("_uid"),
        normalised(F.col(at[text])).alias("_norm"),
    )
    rows = rows.withColumn("_sha", F.sha2("_norm", 256))
    carried = [*inner, "_key", "_uid", "_sha"]
    schema = T.StructType(
        [T.StructField(c, rows.schema[c].dataType) for c in carried]
    ).add("local", "long").add("rows", "long").add("kind", "string")
    both = stored(
        docs.sparkSession, rows.mapInArrow(partial(collapse, carried), schema), "copies"
    )
    return both, inner


def owner_rows(both: DataFrame, text: str) -> DataFrame:
    """Owner rows in their partitions by length and content hash, sorted there."""
    return (
        both.filter("kind = 'owner'").drop("kind")
        .withColumn("_norm", normalised(F.col(text)))
        .withColumn("_bytes", F.octet_length("_norm"))
        .repartition("_bytes", "_sha")
        .sortWithinPartitions("_bytes", "_sha")
    )


def find_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are; a null text is an empty one. The row
    with the smallest key stays; null keys come last (keep_id is null where a group has no
    other), and of rows with the same key and text one stays. Other columns are not read.
    """
    both, (_, inner_text) = prepared(docs.select(F.col(key), F.col(text).alias("_text")), key, "_text")
    kind = both.schema["_key"].dataType.simpleString()
    answers = owner_rows(both, inner_text).mapInArrow(
        partial(own, []), f"local long, keep_id {kind}, keep_uid long, group_size long"
    )
    members = both.filter("kind = 'member'").select("_key", "_uid", "_sha", "local")
    return members.join(answers, "local").select(
        F.col("_key").alias(key),
        "keep_id",
        "group_size",
        (F.col("_uid") == F.col("keep_uid")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    both, inner = prepared(docs, key, text)
    inner_text = inner[docs.columns.index(text)]
    schema = T.StructType([T.StructField(c, both.schema[c].dataType) for c in inner])
    return owner_rows(both, inner_text).mapInArrow(partial(own, inner), schema).toDF(*docs.columns)


@query(
    "op1_exact_dedup",
    """
    WITH n AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t
      FROM documents
    )
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t)
    """,
)
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return find_copies(table(spark, folder, "documents"))
