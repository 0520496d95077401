import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from factloom.llm import hard_negatives as hn
from factloom.llm.registry import oracles, queries

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=5, k=5, m=5):
    """Read straight from the contract; rows are (key, vector, label), keys need not be unique."""
    part = [
        (key, [math.floor(256 * x) for x in v], label) for key, v, label in rows
        if key is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for key, q, label in part:
        if key % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v, strict=True)), other, theirs)
            for other, v, theirs in part if other != key and len(v) == len(q)
        )
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            hard = [(s, other) for s, other, theirs in scored if theirs != label and 80 * -p <= 100 * -s <= 100 * -p]
            found += [(key, positive, n, other, -p, -s) for n, (s, other) in enumerate(hard[:m], 1)]
    return sorted(found)


def mined(spark, rows, schema=SCHEMA, every=5):
    df = spark.createDataFrame(rows, schema).withColumns({"key": F.lit("x"), "size": F.lit(1), "rank": F.lit(0)})
    return sorted(map(tuple, hn.mine(df.repartition(3), F.col("key") % every == 0).collect()))


def clustered(seed, n, dims):
    chance = np.random.default_rng(seed)
    centres = chance.normal(size=(6, dims))
    for i in range(n):
        c = int(chance.integers(6))
        v = centres[c] + 0.2 * chance.normal(size=dims)
        yield i, [round(float(x), 2) for x in v], int(chance.integers(3)) if chance.random() < 0.3 else c % 3


@pytest.mark.parametrize("dims", [1, 2, 8, 33])
def test_equals_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(hn, "TILE", 60)
    monkeypatch.setattr(hn, "LEAF", 4)
    monkeypatch.setattr(hn, "BLOCK", 17)
    rows = list(clustered(dims, 400, dims))
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.5 + i / 100], i % 2) for i in range(1, 12)]
    rows += [(20, None, 1), (21, [], 1), (22, [nan, 1.0], 1), (23, [inf, 1.0], 0), (24, [None, 1.0], 0), (None, [1.0, 1.0], 0),
             (25, [1.0, 1.0], None), (30, [1.0], 0), (35, [1.0], 0), (36, [0.9], 1), (5, [1.0, 0.9], 0), (5, [1.0, 0.55], 1),
             (40, [-1.0, -1.0], 0), (45, [0.0, 0.0], 0), (46, [0.0, 0.0], 0), (47, [0.0, 0.0], 1), (50, [1.0, 0.7], 0), (50, [1.0, 0.7], 0)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, [], SCHEMA) == []


def test_a_third_of_the_rows_are_one_vector(spark, monkeypatch):
    monkeypatch.setattr(hn, "TILE", 50)
    chance = random.Random(2)
    rows = [(i, [1.0, 1.0, 1.0] if i % 3 == 0 else [round(chance.uniform(0, 2), 1) for _ in range(3)], i % 4) for i in range(300)]
    assert mined(spark, rows, every=20) == brute(rows, every=20)


def test_products_beyond_doubles_are_exact(spark):
    big = 1 << 22
    rows = [(5, [float(big), 1.0], 0)] + [(i, [float(big) + i / 256 * (i % 3), i / 256], i % 2) for i in range(6, 30)]
    assert mined(spark, rows) == brute(rows)
    assert brute(rows)[0][4] > 1 << 53


def test_boxes_bound_every_product():
    chance = np.random.default_rng(1)
    rows = [{"size": 5, "key": i, "label": "x", "vector": hn.packed(np.floor(chance.normal(size=5) * 100))} for i in range(700)]
    tree = hn.Tree(hn.pack(rows))
    assert sorted(tree.keys.tolist()) == list(range(700)) and len(tree.levels[-1][0]) == 1
    anchors = np.floor(chance.normal(size=(9, 5)) * 100)
    for level, (low, high) in enumerate(hn.bounds(tree, anchors)):
        width = hn.FAN ** level
        for node in range(low.shape[1]):
            leaves = range(node * width, min((node + 1) * width, len(tree.ends)))
            inside = np.concatenate([tree.vectors[tree.starts[i] : tree.ends[i]] for i in leaves]) @ anchors.T
            assert (low[:, node] <= inside.min(axis=0)).all() and (inside.max(axis=0) <= high[:, node]).all()


def test_the_queue_leaves_boxes_closed(monkeypatch):
    """Clustered rows: most leaves are never opened, and the result is the same."""
    rows = [{"size": 8, "key": i, "label": str(l), "vector": hn.packed(np.floor(np.array(v) * 256))} for i, v, l in clustered(3, 6000, 8)]
    monkeypatch.setattr(hn, "LEAF", 32)
    tree = hn.Tree(hn.pack(rows))
    opened = []

    class Noted(hn.Best):
        def add(self, scores, keys):
            opened.append(len(scores))
            super().add(scores, keys)

    anchors = tree.vectors[::500]
    limits = hn.bounds(tree, anchors)
    everyone = np.ones(len(tree.keys), bool)
    for n, anchor in enumerate(anchors):
        best = Noted(5)
        hn.search(tree, anchor, [(low[n], high[n]) for low, high in limits], everyone, [best])
        scores = tree.vectors @ anchor
        assert best.rows == sorted((-int(s), int(k)) for s, k in zip(scores, tree.keys, strict=True))[:5]
        window = Noted(5, 0, 100)
        hn.search(tree, anchor, [(low[n], high[n]) for low, high in limits], everyone, [window])
        inside = [(-int(s), int(k)) for s, k in zip(scores, tree.keys, strict=True) if 0 <= s <= 100]
        assert window.rows == sorted(inside)[:5]
    assert sum(opened) < 0.5 * 2 * len(anchors) * len(tree.keys)


def test_query_equals_sql(spark, medium):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{medium}/embeddings.parquet')")
    wanted = duck.execute(oracles["op11_hard_negatives"])
    df = queries["op11_hard_negatives"](spark, medium)
    assert df.columns == [d[0] for d in wanted.description]
    rows = sorted(map(tuple, df.collect()))
    assert rows and rows == sorted(wanted.fetchall())
