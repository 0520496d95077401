import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from factloom.llm import imatch, url_filter
from factloom.llm.registry import queries as QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_edited_texts_and_likeness(spark, medium, documents):
    rows = QUERIES["op4_document_fingerprints"](spark, medium).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    order = sorted(texts, reverse=True)
    following = {a: b for a, b in zip(order, order[1:] + order[:1], strict=True)}
    found = {r["doc_id"]: r for r in rows}
    assert sorted(found) == sorted(texts)
    by_text = defaultdict(set)
    for key, r in found.items():
        text, half = texts[key], len(texts[key]) // 2
        edited = text[: len(text) - half] + texts[following[key]][:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text[text].add(r["fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())
    mean = lambda c: sum(r[c] for r in rows) / len(rows)
    assert mean("near_edited") > 5 * mean("near_next")


def brute_terms(text):
    import regex

    return set(regex.split(r"[^\p{L}\p{N}]+", text.lower())) - {""}


def test_fingerprints_use_exactly_the_band(spark, documents):
    """Texts get equal fingerprints where their terms in the band are the same."""
    docs = documents.limit(300).cache()
    settings = imatch.Settings(rarest=0.01, commonest=0.2, rates=(1, 2), per_rate=3)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    counts = Counter(t for x in texts.values() for t in brute_terms(x))
    band = {t for t, n in counts.items() if max(2, 3) <= n <= 60}
    found = {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprint(docs, settings).collect()}
    groups, prints = defaultdict(set), defaultdict(set)
    for key, text in texts.items():
        kept = frozenset(brute_terms(text) & band)
        groups[kept].add(found[key])
        prints[found[key]].add(kept)
        assert (not kept) == (set(found[key]) == {"0"})
    assert all(len(g) == 1 for g in groups.values()) and all(len(p) == 1 for p in prints.values())


def test_fingerprints_of_odd_rows(spark, odd_documents, no_documents):
    rows = imatch.compare_edits(odd_documents).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(1, 12))
    texts = {1: "the cat sat on the mat today", 11: "one two three", 10: "a" * 3000}
    by_key = {r["doc_id"]: r for r in rows}
    assert by_key[11]["n_chars"] == len(texts[11]) and by_key[3]["n_chars"] == 0
    edited = texts[1][: 28 - 14] + texts[11][:14]  # the first document follows the last
    assert by_key[1]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert imatch.compare_edits(no_documents).count() == 0 and imatch.fingerprint(no_documents).count() == 0
    alone = spark.createDataFrame([(7, "abcd")], "doc_id long, text string")
    (row,) = imatch.compare_edits(alone).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_a_lexicon_too_large_to_broadcast_gives_the_same(documents):
    docs = documents.limit(100).cache()
    a = imatch.compare_edits(docs, imatch.Settings(rarest=0.02, commonest=0.5))
    b = imatch.compare_edits(docs, imatch.Settings(rarest=0.02, commonest=0.5, broadcast=0))
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_copies_and_small_tables_keep_their_fingerprints(spark):
    """A third of the rows is one text; others share words, a few have words of their own or none."""
    hot = "solar panels feed batteries that carry towns through winter nights " * 2
    rows = [(k, hot) for k in range(200)]
    rows += [(200 + k, " ".join(f"w{(k * 7 + j * j) % 150}" for j in range(20))) for k in range(396)]
    rows += [(600, "ein ganz seltener satz"), (601, "ein ganz seltener satz"), (602, ""), (603, None), (604, "?!"), (605, "!?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in imatch.compare_edits(docs).collect()}
    zero = "0" * len(found[0]["fingerprint"])
    same = {found[k]["fingerprint"] for k in range(200)}
    assert len(same) == 1 and same != {zero}
    assert all(found[k]["near_next"] == found[k]["near_edited"] == 1.0 for k in range(1, 200))
    assert found[601]["near_next"] == 1.0 and found[601]["fingerprint"] == found[600]["fingerprint"] != zero
    assert found[603]["near_next"] == 1.0 and found[603]["fingerprint"] == zero  # null after empty
    assert found[605]["near_next"] == 0.0  # other signs, both without a term
    assert {r["doc_id"]: r["fingerprint"] for r in imatch.fingerprint(docs).collect()} == {
        k: r["fingerprint"] for k, r in found.items()}
    few = spark.createDataFrame([(k, "one two three" if k < 3 else f"text {k}") for k in range(6)], docs.schema)
    prints = {r["doc_id"]: r["fingerprint"] for r in imatch.compare_edits(few).collect()}
    assert zero not in prints.values() and prints[0] == prints[1] == prints[2] != prints[3]


@pytest.mark.parametrize("name", ["op4_document_fingerprints", "op6_line_dedup", "op10_url_filter"])
def test_native_operators_run_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op10_url_filter"])
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, name, folder):
    from factloom.llm.registry import oracles as ORACLES

    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, result.fetchall()))


def near_copies(rows, seed=5):
    """Texts of 80 words out of 4,000 that differ from the first in one word each."""
    import random

    chance = random.Random(seed)
    base = [f"w{chance.randrange(4000)}" for _ in range(80)]
    for _ in range(rows):
        text = list(base)
        text[chance.randrange(80)] = f"odd{chance.randrange(10**9)}"
        yield " ".join(text)


def test_a_hot_group_of_near_copies_is_as_alike_as_a_small_one(spark):
    """A third of all rows are near copies of one text; 40 groups of eight are near copies too."""
    import random

    chance = random.Random(1)
    groups = [list(near_copies(300, 2)), *[list(near_copies(8, 100 + g)) for g in range(40)]]
    alone = [" ".join(f"w{chance.randrange(4000)}" for _ in range(80)) for _ in range(280)]
    rows, inside = [], {"hot": [], "small": [], "alone": []}
    for name, texts in [("hot", groups[0]), *[("small", g) for g in groups[1:]], ("alone", alone)]:
        inside[name] += range(len(rows) + 1, len(rows) + len(texts))
        rows += [(len(rows) + k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    near = {r["doc_id"]: r["near_next"] for r in imatch.compare_edits(docs).collect()}
    mean = {name: sum(near[k] for k in keys) / len(keys) for name, keys in inside.items()}
    assert mean["small"] > 0.7 and mean["hot"] > 0.9 * mean["small"] and mean["alone"] < 0.05, mean
    assert sum(near[k] == 0 for k in inside["hot"]) < 0.02 * len(inside["hot"])


def test_near_copies_agree_in_a_sketch(spark):
    rows = [(0, t) for t in near_copies(100)] + [(k, " ".join(f"w{k}x{j}" for j in range(30)) + " the of and to in") for k in range(1, 200)]
    df = spark.createDataFrame(rows, "g int, text string")
    hashed = F.transform(F.filter(imatch.terms(F.col("text")), lambda w: w != ""), lambda w: F.xxhash64(w))
    drawn = df.select("g", F.array(*imatch.sketches(hashed)).alias("s")).collect()
    common = [Counter(r["s"][k] for r in drawn if r["g"] == 0).most_common(1)[0][0] for k in range(imatch.SKETCHES)]
    assert sum(any(a == b for a, b in zip(r["s"], common, strict=True)) for r in drawn if r["g"] == 0) >= 99
    others = [r["s"] for r in drawn if r["g"]]
    assert all(Counter(s[k] for s in others).most_common(1)[0][1] <= 4 for k in range(imatch.SKETCHES))


URLS = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("HTTPS://WWW.Example.NET/en/page?q=/de/", "www.example.net", "/en/page", "example.net/en/", "allow"),
    ("http://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    ("https://example.com/de/#x", "example.com", "/de/", "example.com/de/", "block"),
    ("ftp://news.org/fr/1", "news.org", "/fr/1", "org/fr/", "allow"),
    ("http://badexample.com/de/", "badexample.com", "/de/", None, None),
    ("http://example.net", "example.net", "", None, None),
    ("http://x.org?a=://b", "x.org", "", None, None),
    ("no scheme", "", "", None, None), ("", "", "", None, None), (None, "", "", None, None),
    ("://", "", "", None, None), ("a://b://c/d", "b:", "//c/d", None, None),
]


def test_hosts_paths_and_rules(spark):
    rows = [(k, url, "x") for k, (url, *_) in enumerate(URLS)] + [(0, URLS[0][0], "x"), (None, URLS[0][0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = url_filter.judge(pages).collect()
    assert len(found) == len(rows)
    by_key = {r["page_id"]: r for r in found}
    for k, (_, host, path, rule, verdict) in enumerate(URLS):
        r = by_key[k]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert by_key[9]["verdict"] == by_key[10]["verdict"]  # null counts as empty
    assert url_filter.judge(pages.limit(0)).count() == 0
    undecided = url_filter.judge(pages, rules=())
    assert {(r["rule"], r["verdict"], r["score"]) for r in undecided.collect()} == {(None, "allow", 0.0)}


def brute_ratio(urls, order=3, alphabet=256):
    """Log ratios of (url, verdict) by Witten-Bell, recursively from the definition."""
    seen = {c: Counter() for c in ("allow", "block")}
    follow = {c: defaultdict(Counter) for c in ("allow", "block")}
    for url, verdict in urls:
        padded = "\x02" * order + url + "\x03"
        for k in range(order, len(padded)):
            if verdict:
                for n in range(order + 1):
                    follow[verdict][padded[k - n : k]][padded[k]] += 1
                    seen[verdict][padded[k - n : k]] += 1

    def chance(c, context, char):
        lower = chance(c, context[1:], char) if context else 1 / alphabet
        total, kinds = seen[c][context], len(follow[c][context])
        return lower if not total else (follow[c][context][char] + kinds * lower) / (total + kinds)

    scores = {}
    for url, _ in urls:
        padded = "\x02" * order + url + "\x03"
        places = range(order, len(padded))
        scores[url] = sum(
            math.log(chance("allow", padded[k - order : k], padded[k]))
            - math.log(chance("block", padded[k - order : k], padded[k])) for k in places) / len(places)
    return scores


def test_scores_equal_the_definition(spark, small):
    urls = [r["url"] for r in spark.read.parquet(f"{small}/pages.parquet").select("url").distinct().collect()]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")
    found = url_filter.judge(pages, settings=url_filter.Settings(order=3)).collect()
    rules = {r["page_id"]: r["verdict"] if r["rule"] else None for r in found}
    expected = brute_ratio([(u, rules[k]) for k, u in enumerate(urls)])
    for r in found:
        assert abs(r["score"] - expected[urls[r["page_id"]]]) < 1e-9


def test_hot_values_take_the_other_join(spark, small):
    from factloom.llm.common import join_values

    rows = spark.range(1000).selectExpr("if(id < 600, 'hot', cast(id AS string)) AS key", "id")
    values = rows.groupBy("key").count().selectExpr("key", "count AS uses", "upper(key) AS value")
    for parts in (1, 10, 100_000):
        joined = join_values(rows, values, "key", "uses", 1000, parts)
        assert joined.filter("value = upper(key)").count() == 1000 and joined.columns == ["key", "id", "value"]
