import collections
import random
import re

import duckdb
import numpy as np
import pytest

from factloom.llm import phrases
from factloom.llm.registry import oracles, queries


def brute(rows, threshold=30, longest=4, share=80):
    """The contract, read straight from the texts."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    found = []
    for lang, counts in f.items():
        frequent = {g: c for g, c in counts.items() if len(g) > 1 and c >= threshold}
        for g, a in frequent.items():
            cuts = [(2000000 * a // (counts[g[:k]] + counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            inside = any(
                100 * c >= share * a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1))
                for h, c in frequent.items() if len(h) > len(g)
            )
            if not inside:
                found.append((lang, " ".join(g), len(g), a, counts[g[:k]], counts[g[k:]], n[lang], score))
    return sorted(found)


def made(seed, texts=400):
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ab", "aB", "É", "é", "x y", "\x1c", "\x00", "日"]
    set_phrases = ["new york city", "of the people by", "heavy  metal", "a\tb"]
    for _ in range(texts):
        body = [chance.choice(set_phrases) if chance.random() < 0.3 else vocabulary[min(int(chance.expovariate(0.2)), 47)]
                for _ in range(chance.randrange(0, 60))]
        text = "".join(w + chance.choice([" ", " ", " ", ", ", ".", "\n", "\t"]) for w in body)
        yield chance.choice(["en", "de", None, "und", "a\nb", ""]), chance.choice([text, text, text, None, ""])


@pytest.mark.parametrize("chunk", [50, 1_000_000])
def test_equals_brute_force(spark, chunk, monkeypatch):
    rows = list(made(3))
    docs = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "lang AS n", "text AS phrase", "1 AS f")
    monkeypatch.setattr(phrases, "PARTITION_WORDS", 500)
    found = phrases.collocations(docs.repartition(5), threshold=8, chunk_words=chunk)
    assert sorted(map(tuple, found.collect())) == brute(rows, 8)


def test_summaries_keep_every_frequent_key():
    chance = np.random.default_rng(4)
    for threshold in (5, 30, 200):
        parts = []
        for _ in range(60):
            drawn = np.concatenate([chance.zipf(1.3, 300) % 500, chance.integers(1000, 1 << 31, 700)])
            keys, counts = np.unique(drawn.astype(np.uint64), return_counts=True)
            parts.append((keys, np.minimum(counts, threshold)))
        total = collections.Counter()
        for keys, counts in parts:
            total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        alive = phrases.survivors(iter(parts), sum(total.values()), threshold)
        wanted = {k for k, c in total.items() if c >= threshold}
        assert wanted <= set(alive.tolist()) and (np.diff(alive.astype(np.int64)) > 0).all()
        # What survives beside them has lost a part of the threshold at most.
        assert all(total[k] >= threshold * (1 - 1 / phrases.SPARE) for k in alive.tolist())


def test_a_summary_loses_no_more_than_its_bound():
    chance = np.random.default_rng(9)
    held, lost, mass, truth = np.empty(0, np.uint64), 0, 0, collections.Counter()
    for _ in range(40):
        keys, counts = np.unique(chance.zipf(1.5, 500).astype(np.uint64) % 3000, return_counts=True)
        truth.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        held, less = phrases.merged([held, phrases.summary(keys, counts)], 50)
        lost, mass = lost + less, mass + int(counts.sum())
        assert len(held) <= 50
    assert lost <= mass / 51
    kept = {int(x) >> 32: int(x) & 0xFFFFFFFF for x in held}
    assert all(truth[k] - lost <= kept.get(k, 0) <= truth[k] for k in truth)


def test_keys_that_fall_together_are_told_apart_by_their_words(spark, monkeypatch):
    rows = list(made(11, 150))
    monkeypatch.setattr(phrases, "LOW", np.uint64(0xF))
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    path = [r.asDict() for r in phrases.chunked(docs, "text", "lang", "und").collect()]
    for row in path:
        grams = phrases.Grams(row, 1, 4)
        keys, _ = grams.distinct()
        counted = {p: int(c) for _, found, counts in grams.counted(keys) for p, c in zip(found, counts, strict=True)}
        whole = collections.Counter()
        for lang, text in rows:
            if ("und" if lang is None else lang) == row["lang"]:
                for k in range(1, 5):
                    for piece in " ".join(phrases.words_of(text or "")).split("."):
                        w = piece.split(" ")
                        w = [x for x in w if x]
                        whole.update(" ".join(w[i : i + k]) for i in range(len(w) - k + 1))
        assert counted == dict(whole)


def test_long_texts_are_cut_at_separators(monkeypatch):
    monkeypatch.setattr(phrases, "STRETCH", 12)
    text = "one two three. four five six seven eight nine ten eleven, twelve; thirteen fourteen"
    parts = list(phrases.stretches(text))
    assert "".join(parts) == text and all(p[-1] in ".,;" for p in parts[:-1]) and len(parts) > 2
    assert list(phrases.stretches("x" * 100)) == ["x" * 100] and list(phrases.stretches("")) == [""]


def test_odd_documents(spark, odd_documents, no_documents):
    rows = [(r["lang"], r["text"]) for r in odd_documents.collect()]
    found = phrases.collocations(odd_documents, threshold=2)
    assert sorted(map(tuple, found.collect())) == brute(rows, 2)
    assert phrases.collocations(no_documents).count() == 0


def test_ranks_break_ties_by_bytes(spark):
    rows = [("x", p, 2, 5, 9, 9, 99, 7) for p in ("b b", "a b", "é b", "z b")] + [("x", "q", 2, 6, 9, 9, 99, 7), ("y", "c", 2, 1, 1, 1, 9, 1)]
    scored = spark.createDataFrame(rows, "lang string, phrase string, words int, a long, l long, r long, n long, score long")
    best = phrases.best_of_each(scored, 4).orderBy("lang", "rank")
    assert [(r["lang"], r["rank"], r["phrase"]) for r in best.collect()] == [
        ("x", 1, "q"), ("x", 2, "a b"), ("x", 3, "b b"), ("x", 4, "z b"), ("y", 1, "c")]


def test_query_equals_sql(spark, medium):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{medium}/documents.parquet')")
    wanted = duck.execute(oracles["op13_phrase_collocations"])
    names = [d[0] for d in wanted.description]
    df = queries["op13_phrase_collocations"](spark, medium)
    assert df.columns == names
    rows = sorted(map(tuple, df.collect()))
    assert rows and rows == sorted(wanted.fetchall())
