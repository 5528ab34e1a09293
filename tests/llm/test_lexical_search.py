"""The quadtree against its points, and ranked search against all pairs."""

import random

import numpy as np
import pytest

from strandline.llm import lexical_search as S


@pytest.mark.parametrize("seed", range(5))
def test_the_grid_gives_back_its_points(seed):
    r = np.random.default_rng(seed)
    points = np.unique(r.integers(0, 90, (400, 2)), axis=0)
    impact = r.integers(1, 10**6, len(points))
    bits, less = S.grid(points[:, 0], points[:, 1], impact, 7)
    tree = S.Treap(bits, less, 7)
    assert tree.top[0] == impact.max()
    for row in {*points[:, 0].tolist()}:
        mine = points[:, 0] == row
        got = tree.best(np.array([row]), np.array([3]), 200, [], list(range(128)))
        assert got == sorted((-3 * v, c, c) for v, c in zip(impact[mine].tolist(), points[mine, 1].tolist(), strict=True))


def test_one_cell():
    tree = S.Treap(*S.grid(np.array([0]), np.array([0]), np.array([5]), 0), 0)
    assert tree.best(np.array([0]), np.array([2]), 3, [], [7]) == [(-10, 7, 0)]


def corpus():
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(60)] + ["É", "漢", "Ab"]
    docs = [(i, " ".join(r.choices(vocab, weights=[1 / (k + 1) for k in range(len(vocab))], k=r.randint(0, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(40)] + [(2000, None), (2001, ""), (2002, " .,\n"), (None, docs[3][1])]
    items = [(k, " ".join(r.choices(vocab, k=r.randint(1, 25)))) for k in range(25)] + [(90, None), (91, "unheard"), (92, "W0 w0 ab"), (93, docs[3][1])]
    return docs, items


@pytest.mark.parametrize(("tokens", "block"), [(1 << 21, 1 << 10), (700, 4)])
def test_search_is_exact(spark, tmp_path, monkeypatch, tokens, block):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "BROADCAST_TERMS", block * 10)
    docs, items = corpus()
    rows = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, shard int, score int").repartition(3)
    n, length = S.collection(rows).first()
    own = S.shards
    if tokens < 1 << 21:  # small shards: the size is read where they are made

        def small(d, *a):
            from pyspark.sql import functions as F

            return own(d.repartition(12, F.col("doc_id")), *a)

        monkeypatch.setattr(S, "shards", small)
    S.build(rows, f"{tmp_path}/index")
    assert spark.read.parquet(f"{tmp_path}/index/collection").first()["L"] == length
    out = S.search(spark, f"{tmp_path}/index", spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(i, k + 1, d, s) for i, own in S.brute_force(docs, items).items() for k, (d, s) in enumerate(own)}
    assert {tuple(r) for r in out} == want and len(out) == len(want)


def test_repeated_and_empty(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "b")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "a"), (5, "a"), (None, "b")], "item_id long, text string")
    S.build(docs, f"{tmp_path}/i")
    out = [tuple(r)[:3] for r in S.search(spark, f"{tmp_path}/i", items).collect()]
    assert sorted(out, key=str) == sorted([(5, 1, 1), (5, 2, 1)] * 2 + [(None, 1, 2), (None, 2, 1), (None, 3, 1)], key=str)
    S.build(docs.limit(0), f"{tmp_path}/e")
    assert S.search(spark, f"{tmp_path}/e", items).count() == 0
