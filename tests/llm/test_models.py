import zlib

import numpy as np
import pytest

from factloom.llm import language_id, toxicity
from factloom.llm.registry import queries as QUERIES


def fold(key, modulus):
    return zlib.crc32(str(key).encode()) % modulus


@pytest.fixture(scope="module")
def languages(documents):
    return language_id.train(language_id.training_rows(documents))


def test_held_out_languages(spark, medium, documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    rows = QUERIES["op9_language_id"](spark, medium).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    assert all(r["held_out"] == (fold(r["doc_id"], 4) == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(odd_documents, no_documents, languages):
    rows = language_id.identify(odd_documents, languages).collect()
    assert len(rows) == odd_documents.count()
    found = {(r["doc_id"]): (r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (3, 4, 5)}
    assert found == {3: ("und", 0.0), 4: ("und", 0.0), 5: ("und", 0.0)}
    kept = language_id.keep_identified(odd_documents, languages)
    assert kept.columns == odd_documents.columns
    assert kept.count() == sum(r["lang_pred"] != "und" for r in rows)
    assert language_id.identify(no_documents, languages).count() == 0
    nothing = language_id.train(no_documents)
    assert {r["lang_pred"] for r in language_id.identify(odd_documents, nothing).collect()} == {"und"}


def test_spans_of_mixed_text(spark, documents, languages):
    by_lang = {}
    some = documents.filter("length(text) BETWEEN 300 AND 3000")
    pure = {r["doc_id"] for r in language_id.identify(some, languages).collect() if r["score"] == 1}
    for r in some.select("doc_id", "lang", "text").collect():
        if fold(r["doc_id"], 4) == 2 and r["doc_id"] in pure:
            by_lang.setdefault(r["lang"], r["text"])
    parts = [by_lang[k] for k in ("en", "de", "fr")]
    mixed = spark.createDataFrame([(1, "\n".join(parts))], "doc_id long, text string")
    rows = language_id.spans(mixed, languages).orderBy("span").collect()
    assert [r["lang"] for r in rows] == ["en", "de", "fr"]
    assert rows[0]["first_word"] == 0 and rows[1]["first_word"] == rows[0]["words"]


def brute_viterbi(scores, switch):
    """The best of all ways to label the words."""
    from itertools import product

    best = max(
        product(range(scores.shape[1]), repeat=len(scores)),
        key=lambda path: sum(scores[t, k] for t, k in enumerate(path))
        - switch * sum(a != b for a, b in zip(path, path[1:], strict=False)),
    )
    return sum(scores[t, k] for t, k in enumerate(best)) - switch * sum(
        a != b for a, b in zip(best, best[1:], strict=False))


def test_viterbi_finds_the_best_path_of_every_text():
    draw = np.random.default_rng(5)
    for _ in range(40):
        lengths = draw.integers(0, 7, 4)
        edge = np.concatenate([[0], np.cumsum(lengths)])
        scores = draw.normal(size=(edge[-1], 3)) * 2
        found = language_id.labels(scores, edge, 1.5)
        for a, b in zip(edge, edge[1:], strict=False):
            if b > a:
                path = found[a:b]
                value = sum(scores[a + t, k] for t, k in enumerate(path)) - 1.5 * np.sum(path[1:] != path[:-1])
                assert abs(value - brute_viterbi(scores[a:b], 1.5)) < 1e-9


def test_scripts_narrow_the_candidates(spark):
    rows = [(f"alpha beta {i}", "xx") for i in range(20)] + [(f"привет мир {i}", "yy") for i in range(20)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"))
    texts = spark.createDataFrame([(1, "незнакомо"), (2, "unknown"), (3, "日本")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in language_id.identify(texts, model).collect()}
    assert found[1] == "yy" and found[2] == "xx" and found[3] in ("xx", "yy")


SHOWN = {
    "1d10t": "idiot", "i d i o t": "idiot", "i.d.i.o.t": "idiot", "idiooooot": "idiot", "m0r0n": "moron",
    "tr@sh": "trash", "$cum": "scum", "s-c-u-m": "scum", "p4th3t1c": "pathetic", "st*pid": "stupid",
    "di5gu5t1ng": "disgusting", "c l o w n": "clown",
}


@pytest.fixture(scope="module")
def model(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity.train(docs, toxicity.training_labels(labels))


def test_disguised_words_are_restored(model):
    chars = toxicity.CharModel(model.counts)
    for disguised, word in SHOWN.items():
        found = toxicity.suspects(f"so {disguised} he said")
        assert word in {toxicity.restore(s, chars) for s in found}, disguised
    scorer = toxicity.Scorer(model)
    assert all(scorer(f"so {d} he said") >= toxicity.THRESHOLD for d in SHOWN)
    assert scorer("on 2023-05-01 version b2b 3d is on the is as and") < toxicity.THRESHOLD


def test_disguises_at_word_ends_doubled_and_far_apart(model):
    chars = toxicity.CharModel(model.counts)
    hidden = {
        "idio7,": "idiot", "idio7.": "idiot", "idio7!": "idiot", "(idio7)": "idiot", "idi'ot": "idiot",
        "stuupid": "stupid", "iiddiioott": "idiot", "i   d   i   o   t": "idiot", "m.....o.....r.....o.....n": "moron",
    }
    scorer = toxicity.Scorer(model)
    for disguised, word in hidden.items():
        stretches = toxicity.suspects(f"so {disguised} he said")
        found = {w for s in stretches for w in toxicity.WORDS.findall(toxicity.restore(s, chars))}
        assert word in found, (disguised, found)
        assert scorer(f"so {disguised} he said") >= toxicity.THRESHOLD, disguised
    assert {"a$$", "a55", "@$$"} <= toxicity.suspects("an a$$ an a55 an @$$")
    assert "s   t   u" in toxicity.suspects("s   t   u") and "i d i o t" in toxicity.suspects("s t u p i d   i d i o t")
    assert not toxicity.suspects("on 2023-05-01 for $45, 1,000 of 13.5 or so.")
    clean = "All letters will follow in summer! It's the 13th of 20, page 7a. Well-known offers cost $45, or 1,000."
    assert scorer(clean) < toxicity.THRESHOLD


def test_lattice_search_equals_all_readings(model):
    from itertools import product

    chars = toxicity.CharModel(model.counts)
    for stretch in ("1d10t", "m00r0n", "t-r@ssh", "sstuuupid", "lo0ser1"):
        options = [toxicity.readings(m[1], len(m[0])) for m in toxicity.RUNS.finditer(stretch)]
        ways = {}
        for way in product(*options):
            text, value, a, b = "".join(s for s, _ in way), -sum(c for _, c in way), "", ""
            for c in text:
                value += chars(a, b, c)
                a, b = b, c
            ways[text] = max(ways.get(text, -1e9), value + (chars(a, b, "") if b else 0))
        assert toxicity.restore(stretch, chars) == max(ways, key=ways.get)


def test_held_out_toxicity(spark, model):
    folder = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = toxicity.score(spark.read.parquet(f"{folder}/documents.parquet"), model).collect()
    held = [r for r in rows if r["doc_id"] in labels and fold(r["doc_id"], 3) == 1]
    caught = [r["predicted"] for r in held if labels[r["doc_id"]] == 1]
    wrong = [r["predicted"] for r in held if labels[r["doc_id"]] == 0]
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.02
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_query_and_odd_rows(spark, medium, model, odd_documents, no_documents):
    rows = QUERIES["op8_toxicity"](spark, medium).collect()
    assert len(rows) == 1000 and all(r["held_out"] == (fold(r["doc_id"], 3) == 1) for r in rows)
    scored = toxicity.score(odd_documents, model).collect()
    assert len(scored) == odd_documents.count() and all(r["predicted"] == 0 for r in scored)
    kept = toxicity.drop_toxic(odd_documents, model)
    assert kept.columns == odd_documents.columns and kept.count() == odd_documents.count()
    assert toxicity.score(no_documents, model).count() == 0
    nothing = toxicity.train(no_documents, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["predicted"] for r in toxicity.score(odd_documents, nothing).collect()} == {0}


def test_tokens_are_read_as_the_whole_text_is():
    """What the token table and the kinds give equals looking through the text as a whole."""
    import random

    import numpy as np

    counts = np.random.default_rng(0).integers(0, 50, 2 * toxicity.CODES + toxicity.CharModel.SINGLES)
    model, reader = toxicity.CharModel(counts), toxicity.Reader(counts)
    chance = random.Random(3)
    texts = ["".join(chance.choices("abio!@$1|.-_*' \n\t,(é5²日", k=chance.randrange(60))) for _ in range(4000)]
    texts += ["i d i o t", "(i. d, i-d i o", "a-b c", "so i - d - i - o", "x" * 60 + "!! stuupid", "", "a b\tc d", "word. word, woord."]
    for text in texts:
        lowered = text.lower()
        words = set(toxicity.WORDS.findall(lowered))
        for stretch in toxicity.suspects(lowered):
            words.update(toxicity.WORDS.findall(toxicity.restore(stretch, model)))
        assert reader(text) == words, text
