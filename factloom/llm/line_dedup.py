"""Line dedup (6): exact set-similarity join of lines, in DataFrame operations only.

Lines become sets of words. Lines with equal sets are one from then on. The words of a set
are ordered by rarity; two sets that are alike share several of the first few. Sets that share
so many, fit in length (prefix and length filters) and whose sketches do not differ
in too many bits are compared word by word. A line goes when an earlier line, by document and
place, is at least as alike as the threshold.

A sketch has a bit for every 64th of all words: whether the set has an odd number of them. A
word that only one of two sets has turns one bit, so they differ in no more bits than words.
Long sets have another sketch of half of their words, which makes two of the one.

Whether a set goes needs one earlier match and not all of them. So every set is compared
first with the best of the few that stand just before it in three of its lists; only sets
without a match there meet all earlier ones. A large group of near copies thus costs its size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import join_values, query, stored, table
from factloom.session import discard

# White space inside a line.
SPACES = "\x20\x09\x0B\x0C\x0D"
# Word frequencies are counted by hash, in this many counters.
COUNTERS = 1 << 16
# The bits of a word's hash that the index keeps.
KEPT = 0x7FFFFFFF
# Sets of more words have sketches of twice as many bits.
LONG = 90
# What tells a line apart, in the order of lines.
LINE = ("id", "row", "place")


@dataclass(frozen=True)
class Settings:
    """`percent`: least Jaccard similarity of two lines' words. `shared`: words that the
    beginnings of two alike sets share (beginnings are longer for it). `near`: earlier sets of
    a list that a set is compared with first. `broadcast`: sets up to which the places of
    their lines are broadcast; more of them are joined by place."""

    percent: int = 80
    shared: int = 1
    near: int = 2
    broadcast: int = 500_000

    def least(self, n: Column) -> Column:
        """Common words of n words and any set that is alike, at least."""
        return F.ceil(n.cast("long") * self.percent / 100).cast("int")

    def prefix(self, n: Column) -> Column:
        return n - self.least(n) + self.shared

    def overlap(self, n: Column, m: Column) -> Column:
        """Least common words of two alike sets of n and m words."""
        return F.ceil((n.cast("long") + m) * self.percent / (100 + self.percent)).cast("int")

    def fits(self, n: Column, m: Column) -> Column:
        n, m = n.cast("long"), m.cast("long")
        return (n * 100 >= m * self.percent) & (m * 100 >= n * self.percent)

    def close(self, one: str, other: str) -> Column:
        """Whether the sketches of two sets allow that they are alike; the halves tell if both have them."""
        n, m = (F.col(f"{k}.n").cast("long") for k in (one, other))
        apart, half = (F.col(f"{one}.{c}").bitwiseXOR(F.col(f"{other}.{c}")) for c in ("sketch", "half"))
        most = (n + m) * (100 - self.percent)
        whole = F.bit_count(apart) * (100 + self.percent) <= most
        halves = (F.bit_count(half) + F.bit_count(apart.bitwiseXOR(half))) * (100 + self.percent) <= most
        return whole & F.coalesce(halves, F.lit(True))

    def alone(self, n: Column) -> Column:
        """Whether sets of n words are too small to be alike to any but their equals."""
        return n.cast("long") * 100 < (n + 1) * self.percent


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, row, place (from 0), line: the lines of every document, without its line feeds."""
    cut = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    told = docs.select(F.col(key).alias("id"), row_of(text).alias("row"), cut.alias("cut"))
    return told.select("id", "row", F.posexplode("cut").alias("place", "line"))


def row_of(text: str) -> Column:
    """Tells rows of the same id, or of none, apart."""
    return F.xxhash64(F.col(text))


def hashes(line: Column) -> Column:
    """64-bit hashes of the distinct words of a line.

    A split at one plain character needs no pattern, which halves its cost.
    """
    line = F.lower(line)
    for space in SPACES[1:]:
        line = F.replace(line, F.lit(space), F.lit(SPACES[0]))
    found = F.transform(F.split(line, SPACES[0]), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(found), F.xxhash64(F.lit("")))


def rarity(cut: DataFrame) -> Column:
    """By the last 16 bits of a word's hash, how often words that have them occur: a level in the
    upper bits of a long, so that it leads when the hash is added."""
    counts = cut.select(F.explode(hashes(F.col("line"))).alias("word")).groupBy(
        F.col("word").bitwiseAND(F.lit(COUNTERS - 1)).alias("at")
    )
    counted = {r.at: r.n for r in counts.agg(F.count(F.lit(1)).alias("n")).collect()}
    levels = [int(4 * math.log2(1 + counted.get(at, 0))) << 31 for at in range(COUNTERS)]
    # One literal, which the optimizer folds into an array once.
    return F.split(F.lit(",".join(map(str, levels))), ",").cast("array<bigint>")


def ordered(hashed: Column, levels: Column) -> Column:
    """Short hashes, rarest first; the level leads, the hash tells words of one level apart.

    Words whose short hashes are the same bring more sets together, never fewer; what is brought
    together is compared by longer hashes.
    """
    return F.sort_array(F.transform(
        hashed, lambda w: levels[w.bitwiseAND(F.lit(COUNTERS - 1))].bitwiseOR(w.bitwiseAND(F.lit(KEPT)))
    ))


def sketch(hashed: Column) -> Column:
    """One bit for every 64th of all words: set if the number of words there is odd."""
    def bit(w: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(w, 58).cast("int"))

    return F.aggregate(hashed, F.lit(0).cast("long"), lambda bits, w: bits.bitwiseXOR(bit(w)))


def half_sketch(hashed: Column) -> Column:
    """The sketch of the words in one half of all; null for short sets."""
    half = F.filter(hashed, lambda w: w.bitwiseAND(F.lit(1 << 57)) != 0)
    return F.when(F.size(hashed) > LONG, sketch(half))


def near_candidates(sets: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): for each set b the closest of the few before it in three of its lists, if any may be alike.

    The lists are those of the last word of its beginning and of two that hashes choose there;
    near copies share at least one of them mostly, and what they share is not a frequent word.
    """
    own = F.array(F.element_at("prefix", -1), F.array_min("prefix"), F.array_max("prefix"))
    told = sets.filter(F.size("prefix") > 0)
    told = told.select(F.struct("number", "n", "sketch", "half").alias("b"), F.posexplode(own).alias("kind", "word"))
    before = Window.partitionBy("kind", "word").orderBy("b.number")
    few = F.array(*(F.lag("b", k).over(before) for k in range(1, settings.near + 1)))
    met = told.select("b", few.alias("few"))
    met = met.filter(F.col("few")[0].isNotNull()).select("b", F.explode("few").alias("a"))
    met = met.filter(settings.fits(F.col("a.n"), F.col("b.n")) & settings.close("a", "b"))
    apart = F.bit_count(F.col("a.sketch").bitwiseXOR(F.col("b.sketch")))
    best = met.groupBy(F.col("b.number").alias("b")).agg(F.min(F.struct(apart.alias("apart"), F.col("a.number").alias("a"))).alias("best"))
    return best.select(F.col("best.a").alias("a"), "b")


def all_candidates(sets: DataFrame, gone: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): for each set b that is not `gone` yet every earlier set a that may be alike.

    The one of two beginnings that ends first, in the order of words, shares with the other all
    that it shares with the other set. So a pair that meets in too few words is not alike.

    Both sides of the join are the same rows, which are shuffled once: `set` is twice the number,
    and one more if the set is not gone.
    """
    over = gone.withColumn("gone", F.lit(True))
    told = sets.filter(F.size("prefix") > 0).join(over, "number", "left")
    indexed = told.select(
        (F.col("number") * 2 + F.when(F.col("gone"), 0).otherwise(1)).alias("set"), "n", "sketch", "half",
        F.explode("prefix").alias("word"),
    )
    a, b = indexed.alias("a"), indexed.alias("b")
    number, n, m = F.shiftright("b.set", 1), F.col("a.n"), F.col("b.n")
    earlier = F.shiftright("a.set", 1) < number * F.col("b.set").bitwiseAND(F.lit(1))
    fits = settings.fits(n, m) & settings.close("a", "b")
    met = a.join(b, (F.col("a.word") == F.col("b.word")) & earlier & fits)
    pairs = met.groupBy(F.shiftright("a.set", 1).alias("a"), number.alias("b")).agg(
        F.count(F.lit(1)).alias("shared"), F.max(n).alias("n"), F.max(m).alias("m")
    )
    n, m = F.col("n"), F.col("m")
    behind = F.greatest(settings.least(n), settings.least(m), F.lit(settings.shared)) - settings.shared
    return pairs.filter(F.col("shared") + behind >= settings.overlap(n, m)).select("a", "b")


def alike(pairs: DataFrame, cut: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The sets b of the pairs (a, b) that are alike, by all the words of their first lines; stored."""
    spark = pairs.sparkSession
    used = pairs.select(F.col("a").alias("number")).union(pairs.select("b")).distinct()
    first = ["number", "first.id", "first.row", "first.place"]
    firsts = stored(spark, sets.join(used, "number").select(*first), "used")
    used = firsts.withColumnRenamed("id", "_id")
    picked = F.broadcast(used) if used.count() <= settings.broadcast else used
    found = cut.withColumnsRenamed({"row": "_row", "place": "_place"}).join(
        picked,
        F.col("id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("row")) & (F.col("_place") == F.col("place")),
    )
    found = stored(spark, found.select("number", hashes(F.col("line")).alias("words")), "words")
    discard(spark, firsts)
    left = found.select(F.col("number").alias("a"), F.col("words").alias("x"))
    right = found.select(F.col("number").alias("b"), F.col("words").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - both
    met = pairs.join(left, "a").join(right, "b").filter(both * 100 >= union * settings.percent)
    gone = stored(spark, met.select(F.col("b").alias("number")).distinct(), "gone")
    discard(spark, found)
    return gone


def later_matches(
    docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """id, row, place of every line that an earlier line is alike to.

    Lines without words match none. Lines are ordered by key, row and place, null keys first;
    `row` tells documents with equal or no keys apart by their texts. Rows that are the same
    in key and text are one document: their lines do not go for each other.
    """
    spark = docs.sparkSession
    cut = lines(docs, key, text)
    levels = rarity(cut)
    # The second pass over all words: what is left of them are the sets and their beginnings.
    hashed, n = F.col("hashed"), F.size("hashed")
    told = cut.select(*LINE, hashes(F.col("line")).alias("hashed"))
    # Sets are equal when the 64-bit hashes of their words are.
    whole = F.xxhash64(n, F.sort_array("hashed")).alias("set")
    sketches = sketch(hashed).alias("sketch"), half_sketch(hashed).alias("half")
    told = told.select(*LINE, whole, n.alias("n"), *sketches, ordered(hashed, levels).alias("words"))
    n = F.col("n")
    begin = F.slice("words", 1, F.when(settings.alone(n), 0).otherwise(settings.prefix(n)))
    prefix = F.transform(begin, lambda w: w.bitwiseAND(F.lit(KEPT)).cast("int")).alias("prefix")
    told = stored(spark, told.select(*LINE, "set", "n", "sketch", "half", prefix), "lines")
    sets = told.filter("n > 0").groupBy("set").agg(
        F.min(F.struct(*LINE)).alias("first"), F.count(F.lit(1)).alias("uses"),
        *(F.any_value(c).alias(c) for c in ("n", "sketch", "half", "prefix")),
    )
    sets = stored(spark, sets, "sets")
    # Their beginnings are in the sets from here on; what is written and done with goes at once.
    known = stored(spark, told.filter("n > 0").select(*LINE, "set"), "places")
    discard(spark, told)
    # Numbered in the order of their first lines, so that a smaller number is an earlier set.
    inorder = sets.repartitionByRange("first").sortWithinPartitions("first", "set")
    numbered = stored(spark, inorder.withColumn("number", F.monotonically_increasing_id()), "numbered")
    discard(spark, sets)
    sets = numbered

    near = stored(spark, near_candidates(sets, settings), "near")
    gone = alike(near, cut, sets, settings)
    rest = stored(spark, all_candidates(sets, gone, settings), "rest")
    discard(spark, near)
    more = alike(rest, cut, sets, settings)
    all_gone = gone.union(more).withColumn("gone", F.lit(True))
    judged = sets.join(all_gone, "number", "left").select("set", "first", "uses", "gone")
    judged = stored(spark, judged, "judged")
    discard(spark, rest, gone, more, sets)
    sets = judged
    total = sets.agg(F.sum("uses")).first()[0] or 0
    judged = join_values(known, sets, "set", "uses", total)
    later = F.struct(*LINE) > F.col("first")
    return judged.filter(F.coalesce("gone", F.lit(False)) | later).select(*LINE)


def drop_lines(
    docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` without the lines that an earlier line is alike to; all columns."""
    inner = [f"c{k}" for k in range(len(docs.columns))]
    at = dict(zip(docs.columns, inner, strict=True))
    found = later_matches(docs, settings, key, text)
    found = found.groupBy("id", "row").agg(F.collect_set("place").alias("_gone"))
    rows = docs.toDF(*inner).withColumn("_row", row_of(at[text])).join(
        found, F.col(at[key]).eqNullSafe(F.col("id")) & (F.col("_row") == F.col("row")), "left"
    )
    cut = F.split(F.col(at[text]), "\n")
    kept = F.filter(cut, lambda _, place: ~F.array_contains("_gone", place))
    clean = F.when(F.col("_gone").isNull(), F.col(at[text])).otherwise(F.array_join(kept, "\n"))
    return rows.withColumn(at[text], clean).select(*inner).toDF(*docs.columns)


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its lines, how many of them go, and their places."""
    return removed_places(table(spark, folder, "documents"))


def removed_places(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed, removed: one row per row of `docs`, null and repeated ids too."""
    gone = later_matches(docs).groupBy("id", "row").agg(
        F.sort_array(F.collect_set("place")).alias("removed")
    )
    count = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).alias("n_lines")
    found = docs.select("doc_id", row_of("text").alias("_row"), count).join(
        gone, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("_row") == F.col("row")), "left"
    )
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    return found.select("doc_id", "n_lines", F.size(removed).alias("n_removed"), removed.alias("removed"))
