"""Operators that once grew with the square of something, or went pair by pair, against plain versions."""

import itertools
import random
import time

import numpy as np
from pyspark.sql import functions as F

from strandline.functions.numeric import poisson_tail
from strandline.operators import chains, fuzzy, graph, matching, models, overlap


def joined_rows(df):
    """The most rows that a join of df made, df being collected."""
    df.collect()
    found, todo = [0], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif "Join" in name:
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return max(found)


def test_many_alignments_at_once():
    r = random.Random(4)
    texts = ["".join(r.choice("ACGT") for _ in range(r.choice([0, 1, 3, 22, 22, 40]))) for _ in range(400)]
    pairs = [(r.choice(texts), r.choice(texts)) for _ in range(1500)] + [("é", "é"), ("", "")]
    for costs in ((1, -1, -6, -1), (2, -1, -2, -1), (1, -3, -1, -2)):
        assert models.align_scores(*zip(*pairs, strict=True), *costs).tolist() == [models.align_score(a, b, *costs) for a, b in pairs]
    assert models.align_scores([], []).tolist() == []
    begin = time.process_time()
    models.align_scores([x[:22] for x in texts] * 100, [x[:12] for x in texts] * 100)
    assert time.process_time() - begin < 8  # one at a time they take some 40 seconds


def test_pairs_within_meet_once(spark):
    r = random.Random(9)
    dense = ["".join(x) for x in itertools.product("AC", repeat=8)]
    mixed = ["".join(r.choice("AC") for _ in range(r.choice([1, 2, 3, 4, 13, 24]))) for _ in range(150)]
    plain = lambda keys, d: {(a, b, n) for a, b in itertools.combinations(sorted(set(keys)), 2) if len(a) == len(b) > d and (n := sum(x != y for x, y in zip(a, b, strict=True))) <= d}
    for keys, d in ((dense, 2), (dense, 1), (mixed, 2), (mixed, 3), (mixed, 0)):
        out = fuzzy.pairs_within(spark.createDataFrame([(k,) for k in [*keys, keys[0], None]], "k string"), "k", d)
        assert sorted(map(tuple, out.collect())) == sorted(plain(keys, d))
    keys = {"".join(r.choice("ACGT") for _ in range(10)) for _ in range(2000)}
    out = fuzzy.pairs_within(spark.createDataFrame([(k,) for k in keys], "k string"), "k", 2)
    assert 0 < joined_rows(out) < 4 * out.count()  # 60,000 met by thirds of their letters


def test_confirmed_keys_by_places(spark):
    r = random.Random(2)
    allowed = {"".join(r.choice("ACG") for _ in range(4)): float(r.randint(1, 60)) for _ in range(60)} | {"ACNT": 3.0, "A": 1.0}
    reads = [(i, r.choice([*allowed, "TTTT"]), "".join(chr(33 + r.choice([2, 10, 20, 30, 38])) for _ in range(r.choice([4, 4, 4, 3])))) for i in range(600)]
    error = lambda q, i: 10 ** (-max(3, min((ord(q[i]) if i < len(q) else 0) - 34, 33)) / 10)

    def plain(key, qual):
        if all(ord(c) - 33 > 24 for c in qual):
            return key
        w = {key: allowed[key]}
        for other, prior in allowed.items():
            places = [i for i in range(len(key)) if key[i] != other[i]] if len(other) == len(key) else []
            if len(places) == 2 and all(other[i] in "ACGT" for i in places):
                w[other] = prior * error(qual, places[0]) * error(qual, places[1])
        best = max(w, key=lambda t: (w[t], t))
        return best if w[best] > 0.9 * sum(w.values()) else None

    out = fuzzy.confirmed(spark.createDataFrame(reads, "id long, key string, qual string"), spark.createDataFrame(list(allowed.items()), "key string, prior double"), ["id"], 0.9)
    got = {x.id: x.corrected for x in out.collect()}
    assert got == {i: plain(k, q) for i, k, q in reads if k in allowed}
    assert np.any([v is None for v in got.values()])


def test_coalesced_keys_without_all_pairs(spark, monkeypatch):
    r = random.Random(6)
    # families that share most bins, of which two lean on each other by a few members, and keys of no family
    rows = [(k, f"{k % 4}:{b}") for k in range(80) for b in range(40) if r.random() < 0.8]
    rows += [(k, f"{f}:{b}") for k, f in ((0, 1), (4, 1), (3, 2)) for b in range(30)] + [(k, f"s{r.randrange(60)}") for k in range(80, 120) for _ in range(6)] + [(200, None), (None, "0:1")]
    df = spark.createDataFrame(rows, "k long, b string")

    def plain(most):
        own = df.distinct()
        size = {x.k: x.n for x in own.groupBy("k").agg(F.count("*").alias("n")).collect()}
        c = [x.n for x in own.groupBy("b").agg(F.count("*").alias("n")).collect()]
        pairs = [(x.a, x.b, x.n, size[x.a] * size[x.b] / (sum(c) ** 2 / sum(v * v for v in c))) for x in matching.pair_counts(own.withColumnRenamed("b", "bin"), "bin", "k", 2, most).collect()]
        some = spark.createDataFrame([(a, b, float(n), e) for a, b, n, e in pairs if n >= e + 6 * e**0.5] or [(0, 0, 0.0, 1.0)], "a long, b long, n double, e double")
        return sorted(map(tuple, graph.components(some.filter(poisson_tail(F.col("n") + 1, F.col("e")) < 1e-3)).collect()))

    for most in (None, 17):
        assert sorted(map(tuple, overlap.coalesced(df, "k", "b", 1e-3, 1, most).collect())) == plain(most)
    alike = spark.createDataFrame([(k, b) for k in range(300) for b in range(20 * (k % 6), 20 * (k % 6) + 20)], "k long, b long")
    seen = []
    monkeypatch.setattr(overlap, "components", lambda edges: (seen.append(edges.count()), graph.components(edges))[1])
    assert len({x.cluster for x in overlap.coalesced(alike, "k", "b", 1e-3, 1).collect()}) == 6
    assert max(seen) < 1500  # 7,350 pairs are alike


def test_chains_hold_a_row_a_tile(spark, monkeypatch):
    held = []
    monkeypatch.setattr(chains, "cut_lineage", lambda df: (held.append(df.count()), df)[1])
    df = spark.range(600).select((F.col("id") % 3).alias("g"), "id", (F.xxhash64("id") % 2).alias("x"))
    score = lambda pdf: (np.where(pdf["x"].to_numpy()[:, None] == np.arange(2), 0.0, -1.0), np.where(np.eye(2, dtype=bool), 0.0, -3.0))
    assert chains.decoded(df, ["g"], ["id"], 100, 2, score, np.zeros(2)).count() == 600
    assert held and max(held) == 18  # six tiles of three groups
