import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm import exact_dedup, line_dedup, ngram_join
from factloom.llm.components import components


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def expected_copies(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[normal(text)].append(key)
    found = []
    for text, keys in groups.items():
        known = sorted(k for k in keys if k is not None)
        keep = known[0] if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = 0
        for key in sorted(keys, key=lambda k: (k is None, k or 0)):
            found.append((key, keep, len(keys), kept == 0, sha))
            kept += 1
    return found


def test_copies_of_odd_rows(spark, odd_documents, no_documents):
    rows = [tuple(r) for r in exact_dedup.find_copies(odd_documents.repartition(5)).collect()]
    expected = expected_copies(odd_documents.select("doc_id", "text").collect())
    assert sorted(map(str, rows)) == sorted(map(str, expected))
    kept = exact_dedup.drop_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    assert kept.count() == sum(r[3] for r in rows)
    assert exact_dedup.find_copies(no_documents).count() == 0 and exact_dedup.drop_copies(no_documents).count() == 0


def test_copies_across_tasks_and_full_memory(documents, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HELD_BYTES", 2000)
    rows = documents.select("doc_id", "text").collect()
    found = exact_dedup.find_copies(documents.repartition(7)).collect()
    assert sorted(map(tuple, found)) == sorted(expected_copies(rows))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=40))
def test_trie_holds_each_string_once(texts):
    trie, ends = exact_dedup.RadixTrie(), {}
    for number, text in enumerate(texts):
        end = trie.terminal(text)
        end.add(exact_dedup.rank(number, number), 1, number, number)
        assert ends.setdefault(text, end) is end
    assert len({id(e) for e in ends.values()}) == len(set(texts))
    for text, end in ends.items():
        assert end.rows == texts.count(text) and end.best[1] == texts.index(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=12), max_size=60), st.integers(0, 200))
def test_spilled_subtrees_and_what_is_left_are_all_ends(texts, limit):
    trie, ends = exact_dedup.RadixTrie(), {}
    for text in texts:
        ends[text] = trie.terminal(text)
    before = trie.held
    assert before == trie.root.size()
    out = list(trie.spill(limit))
    left = list(trie.root.ends())
    assert len(out) + len(left) == len(ends) and {id(e) for e in [*out, *left]} == {id(e) for e in ends.values()}
    assert trie.held == trie.root.size() <= before
    # What stays is within the limit, or a single path.
    assert trie.held <= limit or not out and len(left) <= 1 or len(left) <= 1
    for text, end in ends.items():
        if end in left:
            assert trie.terminal(text) is end


def test_held_rows_do_not_keep_their_batches():
    """A file of copies with a few texts of its own in each batch: a task holds little more than those."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    start, most = pa.total_allocated_bytes(), 0

    def batches():
        nonlocal most
        for n in range(40):
            texts = ["copy " * 2000] * 99 + [f"own {n}"]
            rows = {"c0": texts, "_norm": texts, "_key": list(range(n * 100, n * 100 + 100)),
                    "_uid": list(range(n * 100, n * 100 + 100)), "_sha": ["x"] * 100}
            yield pa.RecordBatch.from_pydict(rows)
            most = max(most, pa.total_allocated_bytes() - start)

    rows = owners = 0
    for batch in exact_dedup.collapse(["c0", "_key", "_uid", "_sha"], batches()):
        kinds = batch.column("kind").to_pylist()
        rows, owners = rows + kinds.count("member"), owners + kinds.count("owner")
    assert (rows, owners) == (4000, 41)
    # A batch has 2 MB; 40 of them would have 80.
    assert most < 12 << 20


def shingles(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split("[\x20\x09-\x0d]+", lowered) if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def expected_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    lists = defaultdict(list)
    for x, found in enumerate(sets):
        both = Counter(y for s in found for y in lists[s])
        for y, n in both.items():
            if 100 * n >= 75 * (len(found) + len(sets[y]) - n):
                label[root(x)] = root(y)
        for s in found:
            lists[s].append(x)
    least = defaultdict(list)
    for x, (key, _) in enumerate(rows):
        least[root(x)].append(key)
    smallest = {r: min((k for k in keys if k is not None), default=None) for r, keys in least.items()}
    return sorted(str((key, len(sets[x]), smallest[root(x)])) for x, (key, _) in enumerate(rows))


def near_rows(seed, groups=6):
    """Groups of edited copies round the threshold, and texts that share a passage only."""
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghijklmnop") * draw.randint(1, 3) + str(draw.randint(0, 400))
    passage = [word() for _ in range(60)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(draw.randint(3, 120))]
        for _ in range(draw.randint(1, 12)):
            text = [word() if draw.random() < draw.choice((0, 0.01, 0.03, 0.06)) else w for w in base]
            if draw.random() < 0.4:
                text += passage
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("change", [
    {}, {"block": 3}, {"volume": 200}, {"frequent": 0}, {"window": 50}, {"broadcast": 0}, {"bits": 12}, {"per_range": 1}])
def test_components_equal_brute_force(spark, change):
    rows = near_rows(len(change) + 1)
    found = ngram_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                                   ngram_join.Settings(**change))
    got = sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in found.collect())
    assert got == expected_components(rows)


def test_components_of_real_and_odd_rows(documents, odd_documents, no_documents):
    for docs in (documents, odd_documents):
        rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        found = ngram_join.near_copies(docs).collect()
        got = sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in found)
        assert got == expected_components(rows)
    assert ngram_join.near_copies(no_documents).count() == 0


def test_one_row_of_each_group_stays(odd_documents, no_documents):
    kept = ngram_join.drop_near_copies(odd_documents)
    assert kept.columns == odd_documents.columns
    texts = Counter(r["text"] for r in kept.collect())
    # Of the copies one stays, rows without words all stay, the two long texts are one group.
    assert texts["the cat sat on the mat today"] + texts["the  cat\tsat on the mat today"] == 1
    assert texts[None] == 2 and texts[""] == texts[" "] == 1 and texts["a" * 3000] == 1
    assert sum(n for t, n in texts.items() if t and t.startswith("w0x0")) == 1
    assert ngram_join.drop_near_copies(no_documents).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), max_size=9), st.integers(1, 6))
def test_merge_skip_counts_as_a_plain_count_does(lists, least):
    from array import array

    got = dict(ngram_join.merge_skip([array("i", sorted(s)) for s in lists], least))
    plain = Counter(x for s in lists for x in s)
    assert got == {x: n for x, n in plain.items() if n >= least}


def test_shared_shingles_are_marked(spark):
    import numpy as np

    draw = np.random.default_rng(2)
    values = draw.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2)
    kept = np.sort(values) >> np.uint64(64 - ngram_join.KEPT_BITS)
    for ranges in (64, 1024):
        width = (1 << ngram_join.KEPT_BITS) // ranges
        back = [k * width + ngram_join.restored(low, high) for k, low, high in ngram_join.thinned(np.sort(values), ranges)]
        assert (np.concatenate(back) == kept.astype(np.int64)).all()


def test_components_of_a_graph(spark):
    draw = random.Random(3)
    edges = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(220)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert found == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def line_words(line):
    return frozenset(w for w in re.split("[\x20\x09-\x0d]+", line.lower()) if w)


def expected_removed(rows, percent=80):
    lists, sets, gone = defaultdict(list), [], set()
    for key, text in rows:
        for place, line in enumerate((text or "").split("\n")):
            words = line_words(line)
            if words:
                both = Counter(y for w in words for y in lists[w])
                if any(100 * n >= percent * (len(words) + len(sets[y]) - n) for y, n in both.items()):
                    gone.add((key, place))
                for w in words:
                    lists[w].append(len(sets))
                sets.append(words)
    return gone


def line_rows(seed):
    draw = random.Random(seed)
    word = lambda: f"{draw.choice('abcdefgh')}{draw.randint(0, 60)}"
    bases = [[word() for _ in range(draw.randint(1, 25))] for _ in range(12)]
    rows = []
    for key in range(30):
        lines = []
        for _ in range(draw.randint(0, 8)):
            line = list(draw.choice(bases))
            for _ in range(draw.choice((0, 0, 1, 2, 4))):
                line[draw.randrange(len(line))] = word()
            lines.append(" ".join(line) if draw.random() < 0.9 else draw.choice(("", " ", "\t")))
        rows.append((key, "\n".join(lines) if draw.random() < 0.95 else None))
    return rows


@pytest.mark.parametrize("change", [{}, {"near": 1}, {"near": 50}, {"broadcast": 0}, {"percent": 60, "shared": 2}])
def test_lines_equal_brute_force(spark, change):
    rows = line_rows(len(change))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.later_matches(docs, line_dedup.Settings(**change)).collect()
    gone = expected_removed(rows, change.get("percent", 80))
    assert {(r["id"], r["place"]) for r in found} == gone and len(found) == len(gone)
    clean = {r["doc_id"]: r["text"] for r in line_dedup.drop_lines(docs, line_dedup.Settings(**change)).collect()}
    for key, text in rows:
        kept = None if text is None else "\n".join(
            line for k, line in enumerate(text.split("\n")) if (key, k) not in gone)
        assert clean[key] == kept


def test_lines_of_odd_rows(odd_documents, no_documents):
    clean = line_dedup.drop_lines(odd_documents)
    assert clean.columns == odd_documents.columns and clean.count() == odd_documents.count()
    assert line_dedup.later_matches(no_documents).count() == 0 and line_dedup.drop_lines(no_documents).count() == 0


def test_lines_of_null_and_repeated_ids(spark):
    """Every row against brute force over all rows, in the order of lines."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [
        (None, f"{base}\nonly here in the first\nshared line of many"), (None, "quite another text\nshared line of many"),
        (None, f"third text\nkept as it is\n{base} lambda"), (1, f"{base} my\nplain one"), (1, "plain one\nplain two\nplain three"),
        (1, f"other start\nplain two\n{base} omega"), (2, "plain three\nfresh words"), (2, None), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    told = docs.select("doc_id", "text", line_dedup.row_of("text").alias("row")).collect()
    told.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["row"]))
    seen, expected, clean = [], [], []
    for r in told:
        gone = []
        for place, line in enumerate((r["text"] or "").split("\n")):
            words = set(line.lower().split())
            if words and any(100 * len(words & w) >= 80 * len(words | w) for w in seen):
                gone.append(place)
            if words:
                seen.append(words)
        expected.append((r["doc_id"], len((r["text"] or "").split("\n")), len(gone), gone))
        kept = [line for k, line in enumerate((r["text"] or "").split("\n")) if k not in gone]
        clean.append((r["doc_id"], None if r["text"] is None else "\n".join(kept)))
    found = [tuple(r) for r in line_dedup.removed_places(docs).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected)) and sum(r[2] for r in found) > 5
    assert sorted(map(str, map(tuple, line_dedup.drop_lines(docs).collect()))) == sorted(map(str, clean))


def test_words_of_one_short_hash_are_not_equal_lines(spark):
    """Lines whose words differ, but not in the 31 bits that the index keeps."""
    words = spark.range(400_000).selectExpr("concat('w', id) AS word", "xxhash64(concat('w', id)) & 2147483647 AS h")
    pairs = words.groupBy("h").agg({"word": "collect_list"}).toDF("h", "words").filter("size(words) > 1")
    rows = [tuple(r["words"][:2]) for r in pairs.collect()]
    assert len(rows) > 10
    lines = [line for a, b in rows for line in (a, b, f"Page {a}", f"Page {b}", f"Page {a}")]
    docs = spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")
    found = line_dedup.later_matches(docs).collect()
    assert sorted(r["place"] for r in found) == [5 * k + 4 for k in range(len(rows))]


def test_a_line_of_very_many_words(spark):
    """Longer than 16 bits count, a near copy of it, and a word that every line has."""
    long = [f"w{k}" for k in range(40_000)]
    rows = [(1, "the " + " ".join(long) + "\nthe one"), (2, "the " + " ".join(long[1000:] + [f"x{k}" for k in range(500)])),
            (3, "the " + " ".join(long[20_000:])), (4, "\n".join(f"the a{k} b{k} c{k}" for k in range(300)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = line_dedup.later_matches(docs).collect()
    assert {(r["id"], r["place"]) for r in found} == {(2, 0)}


def test_line_query(spark, medium):
    rows = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    from factloom.llm.registry import queries as QUERIES

    found = QUERIES["op6_line_dedup"](spark, medium).collect()
    gone = {(r["doc_id"], k) for r in found for k in r["removed"]}
    assert gone == expected_removed([tuple(r) for r in rows]) and len(found) == len(rows)
    assert all(r["n_removed"] == len(r["removed"]) for r in found)


def test_line_dedup_keeps_only_what_its_result_reads(spark, tmp_path):
    from factloom.session import shared_root

    before = set(os.listdir(shared_root(spark)))
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(k, f"{text}\nline {k} of its own words") for k in range(6)], "doc_id long, text string")
    assert line_dedup.removed_places(docs).filter("n_removed > 0").count() == 5
    left = {name.partition("-")[0] for name in set(os.listdir(shared_root(spark))) - before}
    assert left == {"places", "judged"}


def test_lines_of_the_same_few_words_do_not_meet(spark, monkeypatch):
    """Short and long lines that share many words and are not alike: few pairs, no words kept."""
    draw, kept = random.Random(6), {}
    write = line_dedup.stored

    def watched(session, df, name):
        found = write(session, df, name)
        kept.setdefault(name, []).append((found.count(), found.columns))
        return found

    monkeypatch.setattr(line_dedup, "stored", watched)
    few, many = [f"a{k}" for k in range(60)], [f"b{k}" for k in range(400)]
    lines = [draw.sample(few, 20) for _ in range(300)] + [draw.sample(many, 160) for _ in range(150)]
    lines += [[*line[1:], "other"] for line in lines[::30]]
    rows = [(k, " ".join(line)) for k, line in enumerate(lines)]
    found = line_dedup.later_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["id"], r["place"]) for r in found} == expected_removed(rows) and len(found) >= 15
    assert sum(n for name in ("near", "rest") for n, _ in kept[name]) < len(lines) / 4
    assert all("words" not in columns for name in ("lines", "sets", "numbered") for _, columns in kept[name])
