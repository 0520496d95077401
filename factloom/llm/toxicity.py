"""Toxicity (8): disguised words are restored through a noisy channel, then texts are scored.

Every stretch that can be read in more than one way (digits or signs next to letters, letters
set apart, letters doubled) becomes a lattice of what each sign may stand for. Viterbi picks the reading that
a trigram model of the corpus' characters finds likeliest. Words of the text as written
and as restored are then scored by features learned from labels.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import Memo, by_batch, fold, per_worker, query, stored, table, texts_of
from factloom.llm.letters import CODES, Words, counted, mixed

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7

# What signs stand for in disguised words, and the cost of reading them so.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "l", "+": "t", "€": "e", "£": "l",
}
SEPARATORS = " .-_*'"
READ, DROP, MASK, SHRINK = 0.5, 0.5, 1.0, 0.7

# Signs and separators; a run of them is looked at with what stands on either side.
MARKS = re.compile("[" + re.escape("".join(LEET) + ".-_*'") + "]+")
MONEY = "@$€£"
CLOSERS = ".,;:?\"')]}-_*…"
PART, BETWEEN = r"(?:[^\W_]|[@$!|+€£])", f"[{re.escape(SEPARATORS)}]"
APART = re.compile(rf"(?<![^\W_]){PART}(?:{BETWEEN}+{PART}(?![^\W_])){{2,}}")
CLOSE = re.compile(rf"(?<![^\W_]){PART}(?:{BETWEEN}{{1,2}}{PART}(?![^\W_])){{2,}}")
GAPS = re.compile(f"{BETWEEN}+")
TWICE = re.compile(r"(.)\1")
RUNS = re.compile(r"(.)\1*", re.DOTALL)
# Letters that stand there once, as many as follow each other, or one sign with its repeats.
PARTS = re.compile(r"((?:([^\W\d_])(?!\2))+)|((.)\4*)", re.DOTALL)
WORDS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """`sample`: labelled rows that the classifier is fitted on, at most. `least`: share of toxic texts among those with a feature
    from which it is kept. `doubt`: rows of the average kind that each share is shrunk by.
    `credit`: what a toxic text still counts for after each feature that explains it. `gain`:
    least credit that a further feature must earn."""

    sample: int = 20_000
    least: float = 0.7
    doubt: float = 2.0
    credit: float = 0.5
    gain: float = 3.0


class CharModel:
    """Interpolated trigram model over hashed counts: trigrams, bigrams, single characters."""

    SINGLES = 1 << 12

    def __init__(self, counts: np.ndarray):
        self.three, self.two = counts[:CODES], counts[CODES : 2 * CODES]
        self.one = counts[2 * CODES :]
        self.all = max(int(self.one.sum()), 1)
        self.memo = Memo(lambda key: self.fresh(*key), 200_000)
        self.meant = functools.cache(readings)

    @staticmethod
    def codes(words: Words) -> Iterator[np.ndarray]:
        yield words.trigram
        yield CODES + mixed(words.before, words.here).astype(np.int64)
        yield 2 * CODES + mixed(words.here, size=CharModel.SINGLES).astype(np.int64)

    def fresh(self, further: str, before: str, here: str) -> float:
        a, b, c = (np.array([ord(x) if x else 0], np.uint32) for x in (further, before, here))
        single = self.one[mixed(c, size=self.SINGLES)[0]]
        low = (single + 1) / (self.all + self.SINGLES)
        mid = (self.two[mixed(b, c)[0]] + 4 * low) / (self.one[mixed(b, size=self.SINGLES)[0]] + 4)
        top = self.three[mixed(a, b, c)[0]]
        return float(np.log((top + 4 * mid) / (self.two[mixed(a, b)[0]] + 4)))

    def __call__(self, further: str, before: str, here: str) -> float:
        return self.memo[further, before, here]


def train_characters(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts for `CharModel` over every text of the table."""
    size = 2 * CODES + CharModel.SINGLES
    rows = docs.select(F.col(text).alias("text")).filter("text IS NOT NULL")
    found = counted(rows, None, CharModel.codes, size).toArrow().to_pandas()
    counts = np.zeros(size, np.int64)
    counts[found["code"]] = found["n"]
    return counts


def readings(sign: str, times: int) -> list[tuple[str, float]]:
    """What a sign that stands there `times` times may mean, with the cost of each reading."""
    if sign in LEET:
        found = [(c, READ) for c in LEET[sign]]
        return found + [(c + c, READ) for c in LEET[sign]] if times > 1 else found
    if sign == "*":
        return [("", DROP), *((c, MASK) for c in "aeiou")]
    if sign in SEPARATORS:
        return [("", DROP)]
    if not sign.isalpha():
        return [(" ", 0.0)]
    if times == 1:
        return [(sign, 0.0)]
    # A doubled letter may be meant; a tripled one is not.
    return [(sign, SHRINK if times == 2 else 0.0), (sign + sign, 0.0)]


def restore(stretch: str, model: CharModel) -> str:
    """Likeliest reading of a lower-case stretch. States are the last two characters.

    While there is a single state, what is certain adds the same to every reading that
    follows, so only where readings differ is the model asked.
    """
    states: dict = {("", ""): (0.0, None)}
    for part in PARTS.finditer(stretch):
        plain, at = part[1] or "", 0
        if plain and not plain.isalpha():
            # Numerals among them are no letters.
            for sign in plain:
                states = followed(states, model.meant(sign, 1), model)
            continue
        while len(states) > 1 and at < len(plain):
            states = followed(states, [(plain[at], 0.0)], model)
            at += 1
        if at < len(plain):
            (((_, b), (value, path)),) = states.items()
            state = (b, plain[at]) if at + 1 == len(plain) else (plain[-2], plain[-1])
            states = {state: (value, (plain[at:], path))}
        elif not plain:
            found = model.meant(part[4], min(len(part[3]), 3))
            if len(found) > 1 or len(states) > 1:
                states = followed(states, found, model)
                continue
            (((a, b), (value, path)),) = states.items()
            for c in found[0][0]:
                (a, b), path = ("", "") if c == " " else (b, c), (c, path)
            states = {(a, b): (value, path)}
    if len(states) > 1:
        ends = [(v + (model(a, b, "") if b else 0.0), path) for (a, b), (v, path) in states.items()]
        path = max(ends, key=lambda x: x[0])[1]
    else:
        ((_, path),) = states.values()
    letters = []
    while path:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


def followed(states: dict, found: list[tuple[str, float]], model: CharModel) -> dict:
    """The states after a sign with these readings; of equal ones the likelier stays."""
    after: dict = {}
    for sounds, cost in found:
        for (a, b), (value, path) in states.items():
            value -= cost
            for c in sounds:
                if c == " ":
                    value += model(a, b, "") if b else 0.0
                    a, b = "", ""
                else:
                    value += model(a, b, c)
                    a, b = b, c
                path = (c, path)
            if (a, b) not in after or value > after[a, b][0]:
                after[a, b] = (value, path)
    return after


def hides(before: str, marks: str, after: str) -> bool:
    """Whether marks between two characters (or an end) may be read as letters or left out.

    Any other character ends a word, so only what stands next to the marks matters.
    """
    if before.isalpha() and after.isalpha():
        return True
    if before.isalpha() or after.isalpha():
        return any(m in LEET for m in marks)
    # Signs alone: two different ones that are no digits, which a number or a price has not.
    return len({m for m in marks if m in MONEY}) > 1


def apart(text: str) -> set[str]:
    """Letters set apart by any number of separators, and the words among them that wider gaps part."""
    found = set()
    for m in APART.finditer(text):
        found.add(m[0])
        gaps = {len(g) for g in GAPS.findall(m[0])}
        if len(gaps) > 1:
            found.update(re.split(f"{BETWEEN}{{{min(gaps) + 1},}}", m[0]))
            found.update(x[0] for x in CLOSE.finditer(m[0]))
    return found


def hidden(text: str) -> set[str]:
    """Tokens of a lower-case text with marks that may hide words."""
    found = set()
    end = -1
    for m in MARKS.finditer(text):
        at = m.start()
        if at < end or not hides(text[at - 1 : at], m[0], text[m.end() : m.end() + 1]):
            continue
        start = at
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        end = at
        while end < len(text) and not text[end].isspace():
            end += 1
        found.add(text[start:end])
        # Exclamation marks at the end may be letters or not.
        if text[start:end].rstrip(CLOSERS).endswith("!"):
            found.add(text[start:end].rstrip(CLOSERS + "!"))
    return found


def suspects(text: str) -> set[str]:
    """Stretches of a lower-case text that may be read in more than one way."""
    return apart(text) | hidden(text) | {w for w in WORDS.findall(text) if TWICE.search(w)}


# Letters set apart across tokens: what a token has of them at its beginning and its end.
JOINTS = SEPARATORS.replace(" ", "")
JOINT = f"[{re.escape(JOINTS)}]"
HEAD = re.compile(rf"{JOINT}*({PART}(?![^\W_])(?:{JOINT}+{PART}(?![^\W_]))*)")
TAIL = re.compile(rf"(?<![^\W_])({PART}(?:{JOINT}+{PART}(?![^\W_]))*){JOINT}*\Z")
WHOLE = re.compile(rf"{JOINT}*(?:{PART}(?![^\W_])(?:{JOINT}+{PART}(?![^\W_]))*)?{JOINT}*\Z")
# Three letters or more in tokens that follow each other; kinds as `kind` gives them.
ACROSS = re.compile("[MCFI]Z*[SMDEFGHI]|[SBEH]Z*[MGHI]|[SMBCEFHI]Z*[SM]Z*[SMDEFGHI]")


def kind(token: str) -> str:
    """Z, S, M: nothing but separators, with one or more single letters. Else by how many
    single letters (0, 1, more) the token begins and ends with: A-C none, one, more at the end;
    D-F the same with one at the beginning; G-I with more."""
    if len(token) > 2 and token[:-1].isalpha():
        # A word, perhaps with a sign behind it.
        return "A"
    whole = WHOLE.match(token)
    if whole:
        return "ZSM"[min(2, len(re.findall(PART, token)))]
    head, tail = HEAD.match(token), TAIL.search(token)
    counts = [min(2, len(re.findall(PART, m[1]))) if m else 0 for m in (head, tail)]
    return "ABCDEFGHI"[3 * counts[0] + counts[1]]


# What may stand behind a word without giving it another reading.
BEHIND = ".,;:?)\"'"


class Reader:
    """Text -> its distinct words, as written and as restored.

    What a token between white space may mean depends on nothing but itself, so each worker
    reads a token once and keeps what `tell` makes of it: (kind, what its words tell, what those
    tell that it has only where no letters are set apart across it and its neighbours), or None
    for a token of kind A without anything to tell. Only letters set apart across tokens are
    looked for in the text, where the tokens' kinds leave room for them.
    """

    def __init__(self, counts: np.ndarray, tell: Callable[[Iterable[str]], set] = set):
        model = CharModel(counts)
        self.restored = Memo(lambda stretch: WORDS.findall(restore(stretch, model)), 100_000)
        self.tell, self.tokens = tell, Memo(self.token)

    def token(self, token: str) -> tuple | None:
        core = token.rstrip(BEHIND)
        if core.isalpha() and len(core) > 1:
            if core is not token and core != token:
                return self.tokens[core]
            found = self.tell((token, *self.restored[token]) if TWICE.search(token) else (token,))
            name = kind(token)
            return (name, found, ()) if found or name != "A" else None
        words = set(WORDS.findall(token))
        for stretch in [w for w in words if TWICE.search(w)] + list(hidden(token)):
            words.update(self.restored[stretch])
        inside = {w for stretch in apart(token) for w in self.restored[stretch]}
        name, found, more = kind(token), self.tell(words), self.tell(inside)
        return (name, found, more) if found or more or name != "A" else None

    def __call__(self, text: str) -> set:
        lowered = text.lower()
        read = list(map(self.tokens.__getitem__, lowered.split()))
        kinds = "".join([entry[0] if entry else "A" for entry in read])
        told: set = set()
        across = ACROSS.search(kinds) is not None
        for _, found, inside in filter(None, read):
            told.update(found)
            if not across:
                told.update(inside)
        for stretch in apart(lowered) if across else ():
            told.update(self.tell(self.restored[stretch]))
        return told


SHORTEST, LONGEST = 4, 8


def features(word: str) -> list[str]:
    """The whole word and its beginnings of 4 to 8 letters."""
    return [f"={word}", *(word[:n] for n in range(SHORTEST, LONGEST + 1) if len(word) >= n)]


@dataclass
class Model:
    """`chances`: share of toxic texts among those that have a feature; `rest`: among those with none."""

    counts: np.ndarray
    chances: dict[str, float]
    rest: float = 0.0


class Scorer:
    """Text -> score: the chance that at least one of its tell-tale features is meant so.

    A word speaks through its strongest feature, and a feature speaks once.
    """

    def __init__(self, model: Model):
        self.model, self.read = model, Reader(model.counts, self.strongest)
        # How a word that has any feature begins.
        self.begins = {f[1 : SHORTEST + 1] if f[0] == "=" else f[:SHORTEST] for f in model.chances}

    def strongest(self, words: Iterable[str]) -> set[tuple[float, str]]:
        """Of each word the strongest feature that the model knows."""
        chances = self.model.chances
        known = (w for w in words if w[:SHORTEST] in self.begins)
        best = (max(((chances[f], f) for f in features(w) if f in chances), default=None) for w in known)
        return {x for x in best if x}

    def found(self, text: str) -> list[tuple[float, str]]:
        return sorted(self.read(text))

    def __call__(self, text: str) -> float:
        clean = 1 - self.model.rest
        for chance, _ in self.found(text):
            clean *= 1 - chance
        return 1 - clean


def sampled(docs: DataFrame, labels: DataFrame, settings: Settings, key: str, text: str) -> DataFrame:
    """Distinct labelled texts: text, toxic; at most `settings.sample` rows, picked by hash of the id."""
    marks = labels.filter(F.col("toxic").isNotNull() & F.col(key).isNotNull())
    marks = marks.groupBy(F.col(key).alias("_key")).agg(F.max("toxic").alias("toxic"))
    picked = marks.orderBy(F.xxhash64("_key"), "_key").limit(settings.sample)
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Proven bound: `settings.sample` rows of two numbers.
    found = rows.join(F.broadcast(picked), "_key")
    return found.groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def explaining(
    rows: list[tuple[int, list[str]]], chances: dict[str, float], settings: Settings
) -> set[str]:
    """The features that explain the toxic rows, chosen one by one.

    A feature earns the credit left of every toxic row in which it matches a word that no
    chosen feature matches yet, and loses one for every clean row. So beginnings of a word
    that is chosen already, and words that merely stand in the same texts, drop out.
    """
    matches: dict[str, list[tuple[int, str]]] = {}
    for row, (_, words) in enumerate(rows):
        for word in words:
            for f in features(word):
                if f in chances:
                    matches.setdefault(f, []).append((row, word))
    credit = [float(toxic) for toxic, _ in rows]
    taken: set[str] = set()
    explained: set[str] = set()

    def earns(f: str) -> float:
        hit = {row for row, word in matches[f] if word not in explained}
        return sum(credit[r] if rows[r][0] else -1.0 for r in hit)

    # Earnings only fall as words are explained, so an old figure bounds the new one.
    bounds = sorted(((-earns(f), -len(f), f) for f in matches))
    heapq.heapify(bounds)
    while bounds:
        _, size, f = heapq.heappop(bounds)
        now = earns(f)
        if now < settings.gain:
            continue
        if bounds and -now > bounds[0][0]:
            heapq.heappush(bounds, (-now, size, f))
            continue
        taken.add(f)
        fresh = {(row, word) for row, word in matches[f] if word not in explained}
        explained.update(word for _, word in fresh)
        for row in {row for row, _ in fresh}:
            credit[row] *= settings.credit
    return taken


def train(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    key: str = "doc_id",
    text: str = "text",
) -> Model:
    """Character counts from every text; features from a bounded sample of labels.

    Without labels of both kinds no feature counts and every score is near 0.
    """
    counts = train_characters(docs, text)
    rows = stored(docs.sparkSession, sampled(docs, labels, settings, key, text), "labelled")
    totals = dict(rows.groupBy("toxic").count().collect())
    if not totals.get(0) or not totals.get(1):
        return Model(counts, {})

    reader = per_worker(docs.sparkSession, counts, Reader)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, seen = reader(), (Counter(), Counter())
        for batch in batches:
            for value, toxic in zip(texts_of(batch), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({f for w in read(value) for f in features(w)})
        names = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_pydict(
            {
                "feature": pa.array(names, pa.string()),
                "clean": pa.array([seen[0][n] for n in names], pa.int64()),
                "toxic": pa.array([seen[1][n] for n in names], pa.int64()),
            }
        )

    found = rows.mapInArrow(count, "feature string, clean long, toxic long")
    found = found.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    base = totals[1] / (totals[0] + totals[1])
    # Shrunk towards the share of toxic texts among all, so that few sightings count little.
    chance = (F.col("toxic") + settings.doubt * base) / (
        F.col("toxic") + F.col("clean") + settings.doubt
    )
    chosen = (
        found.filter("toxic > 1").select("feature", "toxic", chance.alias("chance"))
        .filter(F.col("chance") >= settings.least)
    )
    # Features of `settings.sample` rows at most.
    chances = {r.feature: r.chance for r in chosen.collect()}

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = reader()
        for batch in batches:
            words = [
                sorted(w for w in read(t) if any(f in chances for f in features(w)))
                for t in texts_of(batch)
            ]
            yield pa.RecordBatch.from_pydict(
                {"y": batch.column("toxic"), "words": pa.array(words, pa.list_(pa.string()))}
            )

    # At most `settings.sample` rows, of their words that have a feature.
    pairs = rows.mapInArrow(told, "y int, words array<string>").filter("size(words) > 0")
    kept = explaining(sorted((r.y, r.words) for r in pairs.collect()), chances, settings)
    model = Model(counts, {f: chances[f] for f in sorted(kept)})

    made = per_worker(docs.sparkSession, model, Scorer)

    def missed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = made()
        for batch in batches:
            none = [not scorer.found(t) for t in texts_of(batch)]
            yield batch.select(["toxic"]).filter(pa.array(none))

    left = dict(rows.mapInArrow(missed, "toxic int").groupBy("toxic").count().collect())
    model.rest = (left.get(1, 0) + base) / (left.get(1, 0) + left.get(0, 0) + 1)
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, score (0 to 1), predicted (1 from the threshold on).

    A null text is an empty one and scores as a text without evidence. Nulls and repeats in
    the key pass through; other columns are not read. No shuffle.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = per_worker(docs.sparkSession, model, Scorer)

    def task(batches):
        scorer = made()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [scorer(t) for t in texts_of(batch)]
            columns = {
                key: batch.column("key"),
                "score": pa.array(scores, pa.float64()),
                "predicted": pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()),
            }
            return pa.RecordBatch.from_pydict(columns)

        return by_batch(work)(batches)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(task, f"`{key}` {kind}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows whose score stays below the threshold; all columns."""
    inner = [f"c{k}" for k in range(len(docs.columns))]
    column = inner[docs.columns.index(text)]
    made = per_worker(docs.sparkSession, model, Scorer)

    def task(batches):
        scorer = made()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([scorer(t) < THRESHOLD for t in texts_of(batch, column)]))

        return by_batch(work)(batches)

    rows = docs.toDF(*inner)
    return rows.mapInArrow(task, rows.schema).toDF(*docs.columns)


def training_labels(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    return labels.filter(fold(key, FOLDS) != HELD_OUT)


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, training_labels(table(spark, folder, "labels")))
    held_out = (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return score(docs, model).select("doc_id", held_out, "score", "predicted")
