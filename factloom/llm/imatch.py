"""Document fingerprints (4): I-Match with randomised lexicons, in DataFrame operations only.

Terms whose inverse document frequency lies in a band form the lexicon. The distinct terms
of a text that are in it, sorted, are hashed once for each of several random subsets of the
lexicon; two texts are as alike as the share of subsets in which their hashes agree. A text
that no subset has a term of is hashed over all its own terms instead.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import query, stored, table


@dataclass(frozen=True)
class Settings:
    """`rarest`, `commonest`: share of all documents that a term of the lexicon is in; their
    negative logarithms are the band's ends. Copies and near copies of one text count as
    twice `rarest` at most, so that no group drives its own terms out. The share also bounds the
    lexicon: it has at most the mean number of distinct terms of a text, divided by `rarest`. `rates`: one in
    so many terms is in a subset, for each of `per_rate` subsets. `broadcast`: rows up to
    which the lexicon is broadcast; a larger one is joined by term."""

    rarest: float = 0.001
    commonest: float = 0.02
    rates: tuple[int, ...] = (8, 32, 128)
    per_rate: int = 8
    broadcast: int = 1_000_000

    @property
    def subsets(self) -> list[tuple[int, int]]:
        return list(enumerate(r for r in self.rates for _ in range(self.per_rate)))


def terms(text: Column) -> Column:
    """Distinct runs of letters and digits, lower case; the empty term is always among them."""
    found = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.concat(F.array(F.lit("")), found))


def drawn(term: Column, settings: Settings) -> Column:
    """The subsets that the hash of a term is in, as bits. Each subset draws the terms anew."""
    bits = F.lit(0).cast("long")
    for k, rate in settings.subsets:
        mine = F.pmod(F.xxhash64(term, F.lit(k)), F.lit(rate)) == 0
        bits = bits.bitwiseOR(F.when(mine, F.lit(1 << k)).otherwise(0).cast("long"))
    return bits


# What a text weighs that belongs to no large group of copies.
WHOLE = 1000
# Sketches of a text, and the minima that each is made of.
SKETCHES, MINIMA = 4, 3


def sketches(found: Column) -> list[Column]:
    """Hashes of a text's terms -> several hashes of it; near copies agree in one at least.

    Each is made of the terms that are smallest in a few random orders. A text of 80 terms that
    lacks one of another's keeps nine in ten of its sketches; texts that merely share common
    terms seldom agree in any.
    """

    def least(order: int) -> Column:
        return F.array_min(F.transform(found, lambda h: F.xxhash64(h, F.lit(order))))

    return [F.xxhash64(*[least(j * MINIMA + i) for i in range(MINIMA)]) for j in range(SKETCHES)]


def weighed(docs: DataFrame, settings: Settings, text: str) -> DataFrame:
    """(words, weight): the terms of each row, and what it weighs. A group of copies or near copies
    weighs twice `rarest` of all rows at most, so that its terms come to lie in the band.

    Rows that agree in a sketch are a group; of the groups that a row is in the largest counts.
    """
    spark = docs.sparkSession
    words = docs.select(terms(F.col(text)).alias("words"))
    hashed = F.transform(F.filter("words", lambda w: w != ""), lambda w: F.xxhash64(w))
    # A column of its own: each of the minima would hash the words again.
    hashed = words.select("words", hashed.alias("hashed"))
    # Of many terms a fixed quarter of all hashes tells copies as well.
    quarter = F.filter("hashed", lambda h: h.bitwiseAND(F.lit(3)) == 0)
    drawn_from = F.when(F.size("hashed") > 64, quarter).otherwise(F.col("hashed")).alias("hashed")
    sketched = hashed.select("words", drawn_from)
    sketched = sketched.select("words", F.array(*sketches(F.col("hashed"))).alias("sketches"))
    most = max(3, math.ceil(2 * settings.rarest * docs.count()))
    # The outer form: for the plain one the optimizer would test the sketches for null, below, anew.
    groups = sketched.select(F.posexplode_outer("sketches").alias("kind", "sketch")).groupBy("kind", "sketch")
    groups = groups.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    # Proven bound: fewer than rows / `most` for each kind, some hundreds.
    large: dict[int, list] = {}
    for row in groups.collect():
        large.setdefault(row["kind"], []).append((row["sketch"], max(1, WHOLE * most // row["n"])))
    if not large:
        return words.withColumn("weight", F.lit(WHOLE))
    weight = [F.lit(WHOLE), F.lit(WHOLE)]
    for kind, found in large.items():
        sizes = F.broadcast(spark.createDataFrame(found, f"_s{kind} long, _w{kind} int"))
        sketched = sketched.join(sizes, F.col("sketches")[kind] == F.col(f"_s{kind}"), "left")
        weight.append(F.coalesce(f"_w{kind}", F.lit(WHOLE)))
    return sketched.select("words", F.least(*weight).alias("weight"))


def band(docs: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """(term, subsets): hashes of the terms in the band and, as bits, the subsets they are in.

    Counted over every text, groups of copies up to a bound (`weighed`); equal terms of a task
    combine before the shuffle. A table too small for a band holds the terms of weight two. The
    empty term is in it with no subset, so that a text without terms keeps its row.
    """
    spark = docs.sparkSession
    seen = weighed(docs, settings, text).select("weight", F.explode("words").alias("term"))
    counts = seen.groupBy(F.xxhash64("term").alias("term")).agg(F.sum("weight").alias("n"))
    counts = stored(spark, counts, "terms")
    empty = F.xxhash64(F.lit(""))
    # Every row has the empty term, so it weighs what all rows weigh.
    every = counts.filter(F.col("term") == empty).agg(F.max("n")).first()[0] or 0
    least = max(2 * WHOLE, settings.rarest * every)
    within = F.col("n").between(least, max(least, settings.commonest * every))
    bits = F.when(F.col("term") == empty, F.lit(0).cast("long")).otherwise(drawn(F.col("term"), settings))
    kept = counts.filter(within | (F.col("term") == empty))
    lexicon = stored(spark, kept.select("term", bits.alias("subsets")), "lexicon")
    return F.broadcast(lexicon) if lexicon.count() <= settings.broadcast else lexicon


def hashes(found: Column, settings: Settings) -> Column:
    """Sorted (term, subsets) of a text -> one hash per subset; 0 where it has none of its terms."""

    def one(k: int) -> Column:
        mine = F.filter(found, lambda t: t["subsets"].bitwiseAND(F.lit(1 << k)) != 0)
        return F.when(F.size(mine) > 0, F.xxhash64(mine["term"])).otherwise(0).cast("long")

    return F.array(*[one(k) for k, _ in settings.subsets])


def own_hashes(text: Column, settings: Settings) -> Column:
    """One hash per subset over all terms of a text, for texts that the lexicon has nothing
    of. Each term is in one subset at least, so only a text without terms has none."""

    def placed(word: Column) -> Column:
        term = F.xxhash64(word)
        one = F.pmod(term, F.lit(len(settings.subsets))).cast("int")
        return F.struct(
            term.alias("term"),
            drawn(term, settings).bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), one)).alias("subsets"),
        )

    found = F.transform(F.filter(terms(text), lambda w: w != ""), placed)
    return hashes(F.sort_array(found), settings)


def bare(prints: Column) -> Column:
    """Whether no subset has a term of the text."""
    return ~F.exists(prints, lambda h: h != 0)


def shown(prints: Column) -> Column:
    return F.array_join(F.transform(prints, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing hashes among the subsets that at least one of the two has terms of.

    0 when there is no such subset.
    """
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    used = F.filter(pairs, lambda p: (p["a"] != 0) | (p["b"] != 0))
    equal = F.size(F.filter(used, lambda p: p["a"] == p["b"]))
    return F.when(F.size(used) > 0, equal / F.size(used)).otherwise(F.lit(0.0))


def fingerprint(
    docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per distinct non-null key: key, fingerprint. The lexicon is that of `docs`."""
    docs = single(docs, key, text)
    known = docs.select("id", F.explode(terms(F.col("text"))).alias("word"))
    known = known.select("id", F.xxhash64("word").alias("term")).join(band(docs, settings), "term")
    found = known.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("term", "subsets"))).alias("found")
    )
    prints = found.select("id", hashes(F.col("found"), settings).alias("prints"))
    prints = stored(docs.sparkSession, prints, "prints")
    left = docs.join(prints.filter(bare(F.col("prints"))).select("id"), "id")
    left = left.select("id", own_hashes(F.col("text"), settings).alias("own"))
    prints = prints.join(left, "id", "left").select("id", F.coalesce("own", "prints").alias("prints"))
    return prints.select(F.col("id").alias(key), shown(F.col("prints")).alias("fingerprint"))


def single(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, text), null texts as empty. Rows without a key have no place in an order and are
    left out; of rows with the same key the one with the least text counts."""
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.filter(F.col("id").isNotNull())
    # Looked for among the keys alone; texts are only grouped where it is needed.
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return rows if repeated.isEmpty() else rows.groupBy("id").agg(F.min("text").alias("text"))


def receivers(docs: DataFrame) -> DataFrame:
    """id, receiver, half: whose edited text takes its new half from this one, and its length.

    The receiver of a document is the next larger key, of the largest the smallest. Keys and
    lengths are dealt into ranges; only the first row of each range is looked at beyond it.
    """
    spark = docs.sparkSession
    ids = docs.select("id", F.floor(F.char_length("text") / 2).cast("int").alias("half"))
    ids = ids.repartitionByRange("id").withColumn("part", F.spark_partition_id())
    ids = stored(spark, ids, "ids")
    # One row per range, as many as there were partitions.
    first = ids.groupBy("part").agg(F.min(F.struct("id", "half")).alias("first"))
    order = Window.orderBy("part")
    following = F.coalesce(
        F.lead("first").over(order),
        F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    )
    first = F.broadcast(first.select("part", following.alias("after")))
    within = F.lead(F.struct("id", "half")).over(Window.partitionBy("part").orderBy("id"))
    linked = ids.withColumn("next", within).join(first, "part")
    taker = F.coalesce("next", "after")
    return linked.select("id", taker["id"].alias("receiver"), taker["half"].alias("half"))


def edits(rows: DataFrame, links: DataFrame) -> DataFrame:
    """id, text, edited: the rows of `links`, with the edited text of those whose giver is in it too."""
    # The one shuffle of whole texts; all that follows but the halves stays where it is.
    placed = rows.join(links.hint("shuffle_merge"), "id")
    half = F.floor(F.char_length("text") / 2).cast("int")
    given = placed.select(F.col("receiver").alias("id"), F.left("text", "half").alias("given"))
    own = placed.select("id", "text", F.left("text", F.char_length("text") - half).alias("head"))
    both = own.join(given.hint("shuffle_merge"), "id")
    return both.select("id", "text", F.concat("head", "given").alias("edited"))


def without_lexicon(
    prints: DataFrame, rows: DataFrame, links: DataFrame, settings: Settings
) -> DataFrame:
    """id, all_own, all_edited, whole, same: of rows where the lexicon has nothing of the text
    or of its edited form, the hashes over all terms, the text's SHA-256 and whether both are
    the same text."""
    needed = prints.filter(bare(F.col("own")) | bare(F.col("edited"))).select("id")
    needed = stored(prints.sparkSession, needed, "bare")
    givers = links.join(needed.withColumnRenamed("id", "receiver"), "receiver").select("id")
    few = links.join(needed.union(givers).distinct(), "id")
    texts = edits(rows.join(few.select("id"), "id", "left_semi"), few).join(needed, "id", "left_semi")
    return texts.select(
        "id",
        own_hashes(F.col("text"), settings).alias("all_own"),
        own_hashes(F.col("edited"), settings).alias("all_edited"),
        F.sha2("text", 256).alias("whole"),
        (F.col("text") == F.col("edited")).alias("same"),
    )


def compare_edits(
    docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per distinct non-null key: key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next document by descending key; the first document follows the last. A
    null text is an empty one; of rows with the same key the least text counts, rows without
    a key are left out. A text that the lexicon has nothing of is hashed over all its own
    terms, and so is alike to texts of its kind only. A text without any term has an all-zero
    fingerprint, a likeness of 1 to the same text and of 0 to any other. Other columns are not
    read.
    """
    spark = docs.sparkSession
    rows = single(docs, key, text)
    lexicon = band(rows, settings)
    links = stored(spark, receivers(rows), "receivers")
    both = edits(rows, links)
    # Terms of both texts in one list; the empty one is first in each, so every row stays.
    words = both.select(
        "id",
        F.char_length("text").cast("long").alias("n"),
        F.sha2("edited", 256).alias("sha"),
        terms(F.col("text")).alias("own"),
        terms(F.col("edited")).alias("edited"),
    ).select("id", "n", "sha", F.size("own").alias("first"), F.posexplode(F.concat("own", "edited")))
    edit = (F.col("pos") >= F.col("first")).alias("edit")
    known = words.select("id", "n", "sha", edit, F.xxhash64("col").alias("term"))
    known = known.join(lexicon, "term")
    pair = F.struct("term", "subsets")
    found = known.groupBy("id").agg(
        F.any_value("n").alias("n_chars"),
        F.any_value("sha").alias("edited_sha256"),
        F.sort_array(F.collect_list(F.when(~F.col("edit"), pair))).alias("own"),
        F.sort_array(F.collect_list(F.when(F.col("edit"), pair))).alias("edited"),
    )
    prints = found.select(
        "id", "n_chars", "edited_sha256",
        hashes(F.col("own"), settings).alias("own"), hashes(F.col("edited"), settings).alias("edited"),
    )
    prints = stored(spark, prints, "prints")
    more = stored(spark, without_lexicon(prints, rows, links, settings), "more")
    prints = prints.join(more, "id", "left").select(
        "id", "n_chars", "edited_sha256", "same",
        F.when(bare(F.col("own")), F.col("all_own")).otherwise(F.col("own")).alias("own"),
        F.when(bare(F.col("edited")), F.col("all_edited")).otherwise(F.col("edited")).alias("edited"),
        F.col("whole"),
    )
    # The document before `id` takes from it: there, `own` is the next one's.
    behind = prints.select("id", F.col("own").alias("next"), F.col("whole").alias("whole_next"))
    behind = behind.join(links.select("id", "receiver"), "id")
    result = prints.join(
        behind.select(F.col("receiver").alias("id"), "next", "whole_next"), "id"
    )
    one = F.lit(1.0)
    return result.select(
        F.col("id").alias(key),
        "n_chars",
        "edited_sha256",
        shown(F.col("own")).alias("fingerprint"),
        shown(F.col("edited")).alias("edited_fingerprint"),
        F.when(F.col("same"), one).otherwise(likeness(F.col("own"), F.col("edited"))).alias("near_edited"),
        F.when(F.col("whole") == F.col("whole_next"), one)
        .otherwise(likeness(F.col("own"), F.col("next"))).alias("near_next"),
    )


@query("op4_document_fingerprints")
def op4_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return compare_edits(table(spark, folder, "documents"))
