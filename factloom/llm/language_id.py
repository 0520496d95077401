"""Language ID (9): scripts narrow the candidates, words are scored, Viterbi labels spans."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import by_batch, fold, per_worker, query, table, texts_of
from factloom.llm.letters import CODES, SCRIPTS, Tables, Words, chunks, counted

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2


@dataclass(frozen=True)
class Settings:
    """`switch`: what changing the language between two words costs, in nats. `shared`: weight
    of the trigrams of all languages in each one's. `rare_script`: share of a language's words
    below which a script is none of its own."""

    switch: float = 8.0
    shared: float = 0.05
    rare_script: float = 0.001


@dataclass
class Model:
    names: list[str]
    scores: np.ndarray  # trigram code x language, log probabilities
    barred: np.ndarray  # script x language, 0 or a large negative number
    settings: Settings


def train(docs: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang") -> Model:
    """Trigram probabilities of each language over all rows that have a text and a language.

    The result is bounded by languages times hash codes.
    """

    def count(words: Words) -> Iterator[np.ndarray]:
        yield words.trigram
        yield CODES + words.script.astype(np.int64)

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("_lang"))
    rows = rows.filter("text IS NOT NULL AND _lang IS NOT NULL")
    size = CODES + len(SCRIPTS)
    found = counted(rows, "_lang", count, size).toArrow().to_pandas()
    names = sorted(found["group"].unique())
    counts = np.zeros((size, len(names)))
    counts[found["code"], np.searchsorted(names, found["group"])] = found["n"]
    own = counts[:CODES] / np.maximum(counts[:CODES].sum(0), 1)
    pooled = counts[:CODES].sum(1)
    pooled = (pooled + 0.5) / (pooled.sum() + 0.5 * CODES)
    mixture = (1 - settings.shared) * own + settings.shared * pooled[:, None]
    scripts = counts[CODES:] / np.maximum(counts[CODES:].sum(0), 1)
    # A script that no language uses bars none of them.
    barred = np.where((scripts < settings.rare_script) & (scripts.max(1, initial=0) > 0)[:, None], -1e4, 0)
    return Model(names, np.log(mixture).astype(np.float32), barred.astype(np.float32), settings)


def labels(scores: np.ndarray, edge: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word: Viterbi through every text, the texts side by side.

    Word t of all texts is treated in one step, the texts ordered by length, so that those
    still running are the first ones.
    """
    n, lengths = scores.shape[0], np.diff(edge)
    order = np.argsort(-lengths, kind="stable")
    lengths, first = lengths[order], edge[:-1][order]
    running = np.searchsorted(-lengths, -np.arange(1, lengths.max(initial=0) + 1), side="right")
    came, moved = np.zeros(n, np.int16), np.zeros(scores.shape, bool)
    best = np.zeros((len(order), scores.shape[1]), np.float64)
    for t, k in enumerate(running):
        at, value = first[:k] + t, best[:k]
        top = value.argmax(1)
        change = value[np.arange(k), top] - switch
        moved[at] = value < change[:, None]
        came[at] = top
        best[:k] = np.maximum(value, change[:, None]) + scores[at]
    found = np.zeros(n, np.int16)
    state = best.argmax(1).astype(np.int16)
    for t in range(len(running) - 1, -1, -1):
        k = running[t]
        at, now = first[:k] + t, state[:k]
        found[at] = now
        state[:k] = np.where(moved[at, now], came[at], now)
    return found


def label_batch(
    texts: list[str], model: Model, tables: Tables
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's words begin, their letters, and their labels.

    Characters are scored a run of texts at a time; only the sums by word are kept for all.
    """
    edge, letters, sums = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)], []
    for run in chunks(texts):
        words = Words(run, tables)
        score = words.summed(model.scores[words.trigram]).reshape(-1, len(model.names))
        sums.append(score + model.barred[words.script])
        edge.append(words.edge[1:] + edge[-1][-1])
        letters.append(words.letters)
    edge, letters = np.concatenate(edge), np.concatenate(letters)
    return edge, letters, labels(np.concatenate(sums), edge, model.settings.switch)


def predict(texts: list[str], model: Model, tables: Tables) -> tuple[list[str], list[float]]:
    """Language with the most letters in its spans, and their share of all letters."""
    kinds = len(model.names)
    if not kinds:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    edge, counts, found = label_batch(texts, model, tables)
    owner = np.repeat(np.arange(len(texts)), np.diff(edge))
    letters = np.bincount(
        owner * kinds + found, weights=counts, minlength=len(texts) * kinds
    ).reshape(-1, kinds)
    total, top = letters.sum(1), letters.argmax(1)
    share = letters.max(1) / np.maximum(total, 1)
    names = [model.names[k] if t else UNKNOWN for k, t in zip(top, total, strict=True)]
    return names, [float(s) for s in share]


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: key, lang_pred, score (share of the letters in its spans).

    A null text, or one without letters, is `und` with score 0; so is every text when nothing
    was learned. Ties go to the language first by name. Nulls and repeats in the key pass
    through; other columns are not read. No shuffle.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = per_worker(docs.sparkSession, model, lambda value: (value, Tables()))

    def task(batches):
        model, tables = made()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, scores = predict(texts_of(batch), model, tables)
            columns = {
                key: batch.column("key"),
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(scores, pa.float64()),
            }
            return pa.RecordBatch.from_pydict(columns)

        return by_batch(work)(batches)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(task, f"`{key}` {kind}, lang_pred string, score double")


def spans(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of one language: key, span (from 0), lang, first_word, words, letters.

    Words are counted from 0 in their text; a text without letters has no spans.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = per_worker(docs.sparkSession, model, lambda value: (value, Tables()))

    def task(batches):
        model, tables = made()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            edge, counts, found = label_batch(texts_of(batch), model, tables)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(edge))
            new = np.ones(len(found), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
            at = np.flatnonzero(new)
            of = owner[at]
            columns = {
                key: batch.column("key").take(pa.array(of)),
                "span": pa.array(np.arange(len(at)) - np.searchsorted(of, of), pa.int32()),
                "lang": pa.array([model.names[k] for k in found[at]], pa.string()),
                "first_word": pa.array(at - edge[of], pa.int32()),
                "words": pa.array(np.diff(np.append(at, len(found))), pa.int32()),
                "letters": pa.array(
                    np.add.reduceat(counts, at) if len(at) else at, pa.int64()
                ),
            }
            return pa.RecordBatch.from_pydict(columns)

        return by_batch(work)(batches)

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        task,
        f"`{key}` {kind}, span int, lang string, first_word int, words int, letters long",
    )


def keep_identified(
    docs: DataFrame, model: Model, least: float = 0.4, text: str = "text"
) -> DataFrame:
    """Rows whose text has a language that holds at least `least` of its letters; all columns."""
    inner = [f"c{k}" for k in range(len(docs.columns))]
    column = inner[docs.columns.index(text)]
    made = per_worker(docs.sparkSession, model, lambda value: (value, Tables()))

    def task(batches):
        model, tables = made()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, scores = predict(texts_of(batch, column), model, tables)
            pairs = zip(names, scores, strict=True)
            return batch.filter(pa.array([n != UNKNOWN and s >= least for n, s in pairs]))

        return by_batch(work)(batches)

    rows = docs.toDF(*inner)
    return rows.mapInArrow(task, rows.schema).toDF(*docs.columns)


def training_rows(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.filter(fold(key, FOLDS) != HELD_OUT)


@query("op9_language_id")
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out")
    return identify(docs, train(training_rows(docs))).select(
        "doc_id", held_out, "lang_pred", "score"
    )
