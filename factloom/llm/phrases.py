"""Phrase collocation mining (13): Misra-Gries summaries per hash partition, then exact counts.

Texts are cut once into chunks of numbered words. Each chunk sends, for every hash partition,
the sorted hashes of its n-grams; a partition merges them into a Misra-Gries summary whose
capacity exceeds its mass divided by the threshold, so every frequent n-gram survives, and
answers each chunk with a bit per hash. The second pass goes over the chunks again, counts the
words of the n-grams that survived, and only those reach the exact aggregation.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import join_values, query, stored, table
from factloom.session import shared_path

# Words of a chunk; what a task holds of a chunk's n-grams is about 100 bytes a word.
CHUNK_WORDS = 1_000_000
# A longer text is cut at separators into stretches of about so many characters.
STRETCH = 1 << 20
# Words of the corpus for each hash partition: some ten million n-grams, below 50 MB as sent.
PARTITION_WORDS = 2_500_000
# More partitions than this would cut a chunk's hashes into rows of a few n-grams each; a larger
# corpus has larger partitions instead (at 16 trillion words, some 60 million words each).
LEAST_PARTITIONS, MOST_PARTITIONS = 16, 1 << 18
# Counters of a summary for each that the guarantee needs; more of them let fewer n-grams
# survive that are not frequent.
SPARE = 4

SEPARATORS = re.compile(r"[.,;:!?\x0A-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
# A separator, so never a word: stands between two pieces.
BREAK = "."
# A reader holds a row group; a row is a chunk.
CHUNK_OPTIONS = {"parquet.block.size": str(16 << 20), "compression": "none"}

HALF, LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def words_of(text: str) -> list[str]:
    """The words of a text, with a BREAK between pieces; A-Z become lower case."""
    text = text.lower() if text.isascii() else text.translate(LOWER)
    text = SEPARATORS.sub(f" {BREAK} ", text).replace("\t", " ")
    return [w for w in text.split(" ") if w]


def stretches(text: str) -> Iterator[str]:
    """Parts of a long text, cut behind separators only."""
    at = 0
    while len(text) - at > STRETCH:
        cut = SEPARATORS.search(text, at + STRETCH)
        if cut is None:
            break
        yield text[at : cut.end()]
        at = cut.end()
    yield text[at:] if at else text


class Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def squeezed(data: bytes | np.ndarray) -> bytes:
    return pa.compress(memoryview(data).cast("B") if isinstance(data, np.ndarray) else data, "zstd", asbytes=True)


def planes(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers by place of their bytes, compressed."""
    return squeezed(np.ascontiguousarray(numbers.astype("<u4").view("u1").reshape(-1, 4).T))


def from_planes(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, 4 * n, "zstd"), "u1").reshape(4, n)
    return np.ascontiguousarray(raw.T).view("<u4").ravel()


class Chunk:
    """Words of texts of one language, numbered in the order of their first use; 0 is the break."""

    def __init__(self, lang: str):
        self.lang, self.numbers, self.parts, self.words = lang, Numbers({BREAK: 0}), [], 0

    def add(self, text: str) -> None:
        found = words_of(text)
        part = np.fromiter(map(self.numbers.__getitem__, found), np.uint32, len(found))
        self.words += int(np.count_nonzero(part))
        self.parts += [part, np.zeros(1, np.uint32)]

    def row(self) -> dict:
        sequence = np.concatenate(self.parts)
        names = "\n".join(self.numbers).encode()
        return {
            "chunk": uuid.uuid4().hex, "lang": self.lang, "words": self.words,
            "vocabulary": squeezed(names), "vocabulary_bytes": len(names),
            "sequence": planes(sequence), "places": len(sequence),
        }


CHUNK = ("chunk string, lang string, words long, vocabulary binary, vocabulary_bytes long, "
         "sequence binary, places long")
CHUNK_ARROW = pa.schema([
    ("chunk", pa.string()), ("lang", pa.string()), ("words", pa.int64()), ("vocabulary", pa.binary()),
    ("vocabulary_bytes", pa.int64()), ("sequence", pa.binary()), ("places", pa.int64()),
])


def chunked(docs: DataFrame, text: str, lang: str, other: str, size: int = CHUNK_WORDS) -> DataFrame:
    """Rows of CHUNK: every text's words, each language apart, about `size` words to a row."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(other)).alias("lang"), F.col(text).alias("text"))

    def task(batches):
        open_chunks: dict[str, Chunk] = {}
        held = 0

        def close(names) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([open_chunks.pop(n).row() for n in names], CHUNK_ARROW)

        for batch in batches:
            for name, whole in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for part in stretches(whole or ""):
                    chunk = open_chunks.setdefault(name, Chunk(name))
                    held -= chunk.words
                    chunk.add(part)
                    held += chunk.words
                    if chunk.words >= size:
                        held -= chunk.words
                        yield close([name])
            # Many small languages together fill a task as one large one does.
            if held >= 2 * size or len(open_chunks) > 1000:
                held = 0
                yield close(list(open_chunks))
        if open_chunks:
            yield close(list(open_chunks))

    return rows.mapInArrow(task, CHUNK)


class Grams:
    """N-grams of a chunk row: their 64-bit keys, partition in the upper half, and their words."""

    def __init__(self, row: dict, partitions: int, longest: int):
        self.lang, self.longest = row["lang"], longest
        self.sequence = from_planes(row["sequence"], row["places"])
        self.names = pa.decompress(row["vocabulary"], row["vocabulary_bytes"], "zstd", asbytes=True).decode().split("\n")
        seed = xxhash.xxh3_64_intdigest(self.lang.encode())
        hashes = [xxhash.xxh3_64_intdigest(w.encode(), seed) for w in self.names]
        self.hashes, self.partitions = np.array(hashes, np.uint64), np.uint64(partitions)

    def keys(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, places where such an n-gram begins, its keys)."""
        words, inside = self.hashes[self.sequence], self.sequence != 0
        mixed, whole = words, inside
        for n in range(1, self.longest + 1):
            if n > 1:
                m = len(words) - n + 1
                if m <= 0:
                    return
                mixed = mixed[:m] * np.uint64(0x9E3779B97F4A7C15) + words[n - 1 :]
                mixed ^= mixed >> np.uint64(29)
                whole = whole[:m] & inside[n - 1 :]
            places = np.flatnonzero(whole)
            x = mixed[places] * np.uint64(0xBF58476D1CE4E5B9)
            x ^= x >> HALF
            part = ((x >> HALF) * self.partitions) >> HALF
            yield n, places, part << HALF | x & LOW

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys in order, and how often each occurs."""
        found = [k for _, _, k in self.keys()]
        return np.unique(np.concatenate(found), return_counts=True)

    def counted(self, alive: np.ndarray) -> Iterator[tuple[np.ndarray, list[str], np.ndarray]]:
        """(partitions, phrases, counts) of the n-grams whose key is one of `alive` (in order).

        Told apart by their words, not by their keys; in the order of their partitions.
        """
        for n, places, keys in self.keys():
            here = among(keys, alive)
            places, parts = places[here], (keys[here] >> HALF).astype(np.int64)
            if not len(places):
                continue
            code = self.sequence[places].astype(np.uint64)
            for step in range(1, n):
                # Prefixes are renumbered densely, so that the next word fits in beside them.
                _, code = np.unique(code, return_inverse=True)
                code = code.astype(np.uint64) << HALF | self.sequence[places + step]
            _, first, counts = np.unique(code, return_index=True, return_counts=True)
            order = np.argsort(parts[first], kind="stable")
            first, counts = first[order], counts[order]
            columns = [self.sequence[places[first] + step].tolist() for step in range(n)]
            name = self.names.__getitem__
            yield parts[first], [" ".join(map(name, gram)) for gram in zip(*columns, strict=True)], counts


def summary(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counters as sortable numbers: key in the upper half, count in the lower."""
    return keys.astype(np.uint64) << HALF | counts.astype(np.uint64)


def merged(summaries: list[np.ndarray], capacity: int) -> tuple[np.ndarray, int]:
    """One Misra-Gries summary of at most `capacity` counters, and how much each count lost.

    Counts of equal keys add up; then the largest count that has no room left is taken from
    every counter, and those that drop to zero go. What any key loses over all mergers is at
    most the mass of all summaries divided by `capacity` + 1.
    """
    together = np.sort(np.concatenate(summaries))
    if not len(together):
        return together, 0
    keys = together >> HALF
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, counts = keys[starts], np.add.reduceat(together & LOW, starts)
    over = len(keys) - capacity
    if over <= 0:
        return summary(keys, counts), 0
    lost = int(np.partition(counts, over - 1)[over - 1])
    kept = counts > lost
    return summary(keys[kept], counts[kept] - np.uint64(lost)), lost


def survivors(parts: Iterable[tuple[np.ndarray, np.ndarray]], mass: int, threshold: int) -> np.ndarray:
    """Keys, in order, that hold every one whose counts over all `parts` sum to the threshold.

    A part counts a key `threshold` times at most, and `mass` is the sum of what the parts
    count: a sum that reaches the threshold still does, and a very frequent n-gram cannot
    crowd out the others. Whole sums are told from the summary by what it may have lost.
    """
    capacity = SPARE * (mass // threshold) + 1
    held, waiting, size, lost = np.empty(0, np.uint64), [], 0, 0
    for keys, counts in parts:
        waiting.append(summary(keys, counts))
        size += len(keys)
        if size >= capacity:
            held, less = merged([held, *waiting], capacity)
            lost, waiting, size = lost + less, [], 0
    held, less = merged([held, *waiting], capacity)
    return (held >> HALF)[(held & LOW) + np.uint64(lost + less) >= threshold]


def among(keys: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Which of `keys` are in `alive`, which is in order."""
    if not len(alive):
        return np.zeros(len(keys), bool)
    near = np.searchsorted(alive, keys)
    near[near == len(alive)] = 0
    return alive[near] == keys


def by_part(parts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(partition, from, to) of partitions in order."""
    if len(parts):
        starts = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])).tolist()
        for a, z in zip(starts, [*starts[1:], len(parts)], strict=True):
            yield int(parts[a]), a, z


HASHES_ARROW = pa.schema([
    ("part", pa.int64()), ("chunk", pa.string()), ("n", pa.int64()), ("mass", pa.int64()),
    ("keys", pa.binary()), ("counts", pa.binary()),
])
MASK_ARROW = pa.schema([("chunk", pa.string()), ("part", pa.int64()), ("n", pa.int64()), ("mask", pa.binary())])
COUNTED_ARROW = pa.schema([
    ("part", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("phrases", pa.binary()), ("bytes", pa.int64()),
    ("counts", pa.binary()),
])


def hashed(chunks: DataFrame, partitions: int, longest: int, threshold: int) -> DataFrame:
    """A row for each chunk and hash partition: its keys in order, as steps, and their counts."""

    def task(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = Grams(row, partitions, longest).distinct()
                counts, rows = np.minimum(counts, threshold), []
                for part, a, z in by_part(keys >> HALF):
                    low = (keys[a:z] & LOW).astype(np.int64)
                    rows.append({
                        "part": part, "chunk": row["chunk"], "n": z - a, "mass": int(counts[a:z].sum()),
                        "keys": planes(np.diff(low, prepend=0)), "counts": planes(counts[a:z]),
                    })
                    if len(rows) == 1024:
                        yield pa.RecordBatch.from_pylist(rows, HASHES_ARROW)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, HASHES_ARROW)

    return chunks.mapInArrow(task, "part long, chunk string, n long, mass long, keys binary, counts binary")


def marked(hashes: DataFrame, threshold: int) -> DataFrame:
    """(chunk, part, n, mask): a bit for each key that a chunk sent, set where it survived.

    A task holds the compressed hashes of one partition, whose size `PARTITION_WORDS` bounds
    (up to `MOST_PARTITIONS` of them) however often single n-grams occur, and its summary.
    """

    def keys_of(row: dict) -> np.ndarray:
        return np.cumsum(from_planes(row["keys"], row["n"]).astype(np.uint64))

    def decide(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        parts = ((keys_of(row), from_planes(row["counts"], row["n"])) for row in rows)
        alive = survivors(parts, sum(row["mass"] for row in rows), threshold)
        found = []
        for row in rows:
            bits = among(keys_of(row), alive)
            if bits.any():
                found.append({**{k: row[k] for k in ("chunk", "part", "n")}, "mask": squeezed(np.packbits(bits))})
        return pa.Table.from_pylist(found, MASK_ARROW)

    return hashes.groupBy("part").applyInArrow(decide, "chunk string, part long, n long, mask binary")


def counted(chunks: DataFrame, masks: DataFrame, partitions: int, longest: int) -> DataFrame:
    """(part, lang, n, phrases, bytes, counts): what survived of a chunk, a row for each partition.

    Phrases stand in one text, a line each, so that the exchange moves rows as large as those
    of `hashed` and not one for every phrase of every chunk.
    """

    def task(batches):
        for batch in batches:
            for row in batch.to_pylist():
                grams = Grams(row, partitions, longest)
                keys, _ = grams.distinct()
                masks = {m["part"]: m for m in row["masks"]}
                alive = [
                    keys[a:z][np.unpackbits(np.frombuffer(
                        pa.decompress(masks[part]["mask"], (z - a + 7) // 8, "zstd"), "u1"), count=z - a).view(bool)]
                    for part, a, z in by_part(keys >> HALF) if part in masks
                ]
                for parts, phrases, counts in grams.counted(np.concatenate(alive)):
                    rows = []
                    for part, a, z in by_part(parts):
                        names = "\n".join(phrases[a:z]).encode()
                        rows.append({
                            "part": part, "lang": grams.lang, "n": z - a, "phrases": squeezed(names),
                            "bytes": len(names), "counts": planes(counts[a:z]),
                        })
                    yield pa.RecordBatch.from_pylist(rows, COUNTED_ARROW)

    # A chunk gets at most one mask for each partition, and a bit for each of its n-grams.
    of_chunk = masks.groupBy("chunk").agg(F.collect_list(F.struct("part", "n", "mask")).alias("masks"))
    return chunks.join(of_chunk, "chunk").mapInArrow(
        task, "part long, lang string, n long, phrases binary, bytes long, counts binary"
    )


def summed(found: DataFrame, threshold: int) -> DataFrame:
    """(lang, words, phrase, f): the exact counts of a partition's phrases that reach the threshold.

    A phrase has one partition. What a task holds is bounded as in `marked`.
    """

    def add(group: pa.Table) -> pa.Table:
        tables = []
        for row in group.to_pylist():
            names = pa.decompress(row["phrases"], row["bytes"], "zstd", asbytes=True).decode().split("\n")
            counts = from_planes(row["counts"], row["n"]).astype(np.int64)
            lang = pa.DictionaryArray.from_arrays(np.zeros(row["n"], np.int32), [row["lang"]]).cast(pa.string())
            tables.append(pa.table({"lang": lang, "phrase": pa.array(names, pa.string()), "f": counts}))
        total = pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([("f", "sum")])
        total = total.filter(pc.greater_equal(total["f_sum"], threshold))
        words = pc.add(pc.count_substring(total["phrase"], " "), 1).cast(pa.int32())
        return pa.table({"lang": total["lang"], "words": words, "phrase": total["phrase"], "f": total["f_sum"]})

    return found.groupBy("part").applyInArrow(add, "lang string, words int, phrase string, f long")


def frequent_phrases(chunks: DataFrame, threshold: int, longest: int) -> DataFrame:
    """(lang, words, phrase, f): every n-gram of 1 to `longest` words with f >= threshold."""
    total = chunks.agg(F.sum("words")).first()[0] or 0
    partitions = min(MOST_PARTITIONS, max(LEAST_PARTITIONS, -(-total // PARTITION_WORDS)))
    masks = marked(hashed(chunks, partitions, longest, threshold), threshold)
    return summed(counted(chunks, masks, partitions, longest), threshold)


def _gram(lang: str, phrase: str) -> Column:
    # No phrase holds a line break.
    return F.concat_ws("\n", lang, phrase)


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    other: str = "und",
    threshold: int = 30,
    longest: int = 4,
    share: int = 80,
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score: phrases of 2 to `longest` words that belong together.

    Words and pieces are as in `words_of`; counts are per language, null ones being `other`.
    A phrase occurs `a` >= threshold times; its weakest cut has parts that occur l and r times
    and gives score = floor(2,000,000 a / (l + r)); n counts the language's words. Phrases that
    stand in a longer frequent one at least `share` percent as frequent are left out. Null and
    empty texts have no words; repeated texts and ids count each time; other columns are not
    read. No table, no rows.
    """
    spark = docs.sparkSession
    path = shared_path(spark, "chunks")
    chunked(docs, text, lang, other, chunk_words).write.options(**CHUNK_OPTIONS).parquet(path)
    chunks = spark.read.schema(CHUNK).parquet(path)
    found = stored(spark, frequent_phrases(chunks, threshold, longest), "phrases")
    found = found.withColumn("gram", _gram("lang", "phrase"))
    totals = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
    every = totals.agg(F.sum("n")).first()[0] or 0

    parts = found.filter("words > 1").select("*", F.split("phrase", " ").alias("w"))
    cuts = parts.select("lang", "gram", F.col("f").alias("a"), "w", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select(
        "gram", "a", "k",
        F.concat_ws("\n", "lang", F.expr("array_join(slice(w, 1, k), ' ')")).alias("first"),
        F.concat_ws("\n", "lang", F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')")).alias("rest"),
    )
    # A part that begins or ends many phrases is itself frequent: f bounds its uses.
    for side, name in (("first", "l"), ("rest", "r")):
        counts = found.select(F.col("gram").alias(side), F.col("f").alias(name), F.col("f").alias("uses"))
        cuts = join_values(cuts, counts, side, "uses", every)
    wide = "CAST({} AS DECIMAL(20, 0))".format
    score = F.expr(f"{wide('a')} * 2000000 DIV ({wide('l')} + {wide('r')})").alias("score")
    weakest = cuts.select("gram", "a", "k", "l", "r", score).groupBy("gram").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("cut")
    )

    inner = """flatten(transform(sequence(2, words - 1), m -> transform(
        sequence(1, words - m + 1), s -> array_join(slice(w, s, m), ' '))))"""
    covers = parts.filter("words > 2").select("lang", F.explode(F.expr(inner)).alias("phrase"), "f")
    covers = covers.groupBy(_gram("lang", "phrase").alias("gram")).agg(F.max("f").alias("longer"))
    kept = weakest.join(covers, "gram", "left").filter(
        f"longer IS NULL OR {wide('longer')} * 100 < {wide('cut.a')} * {share}"
    )
    named = parts.select("gram", "lang", "phrase", "words")
    return named.join(kept, "gram").join(totals, "lang").select(
        "lang", "phrase", "words", "cut.a", "cut.l", "cut.r", "n", "cut.score"
    )


def best_of_each(scored: DataFrame, top: int) -> DataFrame:
    """The first `top` phrases of each language, with their rank from 1.

    Rows are cut to `top` a language in each task before they meet.
    """
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


_SQL = """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
            coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM pieces),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
    grams AS (
        SELECT lang, g.k AS words, array_to_string(w[s:s + g.k - 1], ' ') AS phrase
        FROM worded, (SELECT unnest([1, 2, 3, 4]) AS k) g, unnest(range(1, len(w) - g.k + 2)) AS u(s)),
    f AS (SELECT lang, words, phrase, count(*)::HUGEINT AS f, string_split(phrase, ' ') AS w
          FROM grams GROUP BY ALL HAVING count(*) >= 30),
    cuts AS (
        SELECT c.lang, c.phrase, c.f AS a, u.k, l.f AS l, r.f AS r, 2000000 * c.f // (l.f + r.f) AS score
        FROM f c, unnest(range(1, c.words)) AS u(k)
        JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:u.k], ' ')
        JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[u.k + 1:], ' ')
        WHERE c.words > 1),
    weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    covered AS (
        SELECT b.lang, array_to_string(b.w[s.s:s.s + m.m - 1], ' ') AS phrase, max(b.f) AS longer
        FROM f b, unnest(range(2, b.words)) AS m(m), unnest(range(1, b.words - m.m + 2)) AS s(s)
        WHERE b.words > 2 GROUP BY ALL)
    SELECT c.lang, row_number() OVER (PARTITION BY c.lang ORDER BY score DESC, a DESC, c.phrase) AS rank, c.phrase,
           a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
    FROM weakest c LEFT JOIN covered v ON v.lang = c.lang AND v.phrase = c.phrase JOIN totals t ON t.lang = c.lang
    WHERE longer IS NULL OR 100 * longer < 80 * a
    QUALIFY rank <= 2000"""


@query("op13_phrase_collocations", _SQL)
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    best = best_of_each(collocations(table(spark, folder, "documents")), top=2000)
    return best.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
