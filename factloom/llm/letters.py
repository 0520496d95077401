"""Character tables and trigram counts of whole texts, vectorised over a batch."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.common import per_worker

# The end of Unicode.
LIMIT = 0x110000
# Trigrams are counted by hash: the table's size does not depend on the corpus.
CODES = 1 << 18

# Unicode script ranges, by name.
SCRIPT_RANGES = (
    ("latin", 0x41, 0x24F), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F),
    ("armenian", 0x530, 0x58F), ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F),
    ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("gurmukhi", 0xA00, 0xA7F),
    ("gujarati", 0xA80, 0xAFF), ("tamil", 0xB80, 0xBFF), ("telugu", 0xC00, 0xC7F),
    ("kannada", 0xC80, 0xCFF), ("malayalam", 0xD00, 0xD7F), ("thai", 0xE00, 0xE7F),
    ("tibetan", 0xF00, 0xFFF), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("han", 0xF900, 0xFAFF), ("han", 0x20000, 0x3FFFD),
)
SCRIPTS = ("other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES))


class Tables:
    """Which code points are letters, which belong to words, and their script."""

    def __init__(self):
        kinds = [unicodedata.category(chr(c))[0] for c in range(LIMIT)]
        self.letter = np.array([k == "L" for k in kinds] + [False])
        self.word = np.array([k in "LM" for k in kinds] + [False])
        self.script = np.zeros(LIMIT + 1, np.uint8)
        for name, first, last in SCRIPT_RANGES:
            self.script[first : last + 1] = SCRIPTS.index(name)


def chunks(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about `limit` characters; a longer text is a run of its own.

    What is computed for each character then takes memory for so many of them.
    """
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > limit:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def mixed(*parts: np.ndarray, size: int = CODES) -> np.ndarray:
    """Hash of code points, below `size` (a power of two)."""
    found = np.zeros(len(parts[0]), np.uint32)
    for part, factor in zip(parts, (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D), strict=False):
        found ^= part.astype(np.uint32) * np.uint32(factor)
        found ^= found >> np.uint32(13)
    found *= np.uint32(0x27D4EB2F)
    return (found >> np.uint32(12)) & np.uint32(size - 1)


class Words:
    """The words of several texts: runs of letters and marks, lower case.

    `trigram` holds for every word its characters and its end, each hashed with the two
    characters before it in the word; `start` is where each word begins in it.
    """

    def __init__(self, texts: list[str], tables: Tables):
        lowered = [t.lower() for t in texts]
        points = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
        points = np.minimum(points, LIMIT)
        inside = tables.word[points]
        here = np.where(inside, points, 0).astype(np.uint32)
        before = np.concatenate(([0], here[:-1])).astype(np.uint32)
        further = np.concatenate(([0], before[:-1])).astype(np.uint32)
        further[before == 0] = 0
        kept = np.flatnonzero(inside | (before != 0))
        self.here, self.before, self.further = here[kept], before[kept], further[kept]
        self.start = np.flatnonzero(self.before == 0)
        begins = kept[self.start]
        edges = np.cumsum([0] + [len(t) + 1 for t in lowered])
        # Words of text k are numbers edge[k] to edge[k + 1].
        self.edge = np.searchsorted(begins, edges)
        self.script = tables.script[points[begins]]
        self.letters = self.summed(tables.letter[points][kept].astype(np.int64))
        self.trigram = mixed(self.further, self.before, self.here)

    def summed(self, values: np.ndarray) -> np.ndarray:
        """Sums by word."""
        if not len(self.start):
            return values[:0]
        return np.add.reduceat(values, self.start, axis=0)


def counted(
    rows: DataFrame, group: str | None, count: Callable[[Words], Iterator[np.ndarray]], size: int
) -> DataFrame:
    """(group, code, n): occurrences of the codes that `count` yields, over all rows.

    Each task adds up its own rows in a table of `size` numbers per group, so what is
    shuffled depends on the tasks and the codes seen and not on the length of the texts.
    """

    made = per_worker(rows.sparkSession, None, lambda _: Tables())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, sums = made(), {}
        for batch in batches:
            names = batch.column("group").to_pylist()
            texts = batch.column("text").to_pylist()
            for name in set(names):
                total = sums.setdefault(name, np.zeros(size, np.int64))
                for run in chunks([t or "" for t, g in zip(texts, names, strict=True) if g == name]):
                    for codes in count(Words(run, tables)):
                        total += np.bincount(codes, minlength=size)
        for name, total in sums.items():
            codes = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "group": pa.array([name] * len(codes), pa.string()),
                    "code": pa.array(codes, pa.int32()),
                    "n": pa.array(total[codes], pa.int64()),
                }
            )

    named = F.col(group).cast("string") if group else F.lit("")
    found = rows.select(named.alias("group"), "text").mapInArrow(
        task, "group string, code int, n long"
    )
    return found.groupBy("group", "code").agg(F.sum("n").alias("n"))
