"""Chains in tiles against one pass over each whole group."""

import random

import numpy as np
import pytest

from strandline.operators import chains as C
from strandline.operators import models as M

K = 3


def plain(emission, moves, prior):
    """States by one pass, of scores within 1e-9 the smallest state; and posteriors."""
    n, k = emission.shape
    pick = lambda x: int(np.argmax(x >= x.max() - 1e-9))
    now, back = prior + emission[0], []
    for i in range(1, n):
        go = now[:, None] + moves[i]
        back.append([pick(go[:, b]) for b in range(k)])
        now = go.max(axis=0) + emission[i]
    path = [pick(now)]
    for b in reversed(back):
        path.append(b[path[-1]])
    ahead = [np.exp(prior + emission[0])]
    for i in range(1, n):
        ahead.append(ahead[-1] @ np.exp(moves[i]) * np.exp(emission[i]))
    after = [np.ones(k)]
    for i in range(n - 1, 0, -1):
        after.append(np.exp(moves[i]) @ (np.exp(emission[i]) * after[-1]))
    p = np.array(ahead) * np.array(after[::-1])
    return path[::-1], p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize(("tile", "whole"), [(1, True), (3, True), (7, False), (1000, False)])
def test_tiles_do_not_matter(spark, tile, whole):
    r = random.Random(tile)
    draw = (lambda: float(-r.randint(0, 3))) if whole else (lambda: -3 * r.random())  # whole scores tie often
    rows = [(g, i, [draw() for _ in range(K)], [draw() for _ in range(K * K)], f"x{i}") for g, n in (("a", 40), ("b", 1), (None, 17), ("c", 23)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, e array<double>, m array<double>, note string").repartition(3)
    prior = np.array([0.0, -1.0, -1.0])

    def score(pdf):
        return np.stack(pdf["e"].to_list()), np.stack(pdf["m"].to_list()).reshape(-1, K, K)

    out = C.decoded(df, ["g"], ["i"], tile, K, score, prior, smooth=True).collect()
    assert len(out) == len(rows)
    for g in ("a", "b", None, "c"):
        own = [x for x in rows if x[0] == g]
        path, posterior = plain(np.array([x[2] for x in own]), np.array([x[3] for x in own]).reshape(-1, K, K), prior)
        got = sorted([x for x in out if x.g == g], key=lambda x: x.i)
        assert [x.state for x in got] == path and [x.before for x in got] == [None, *path[:-1]]
        assert np.allclose([x.posterior for x in got], posterior)


def test_models_do_not_depend_on_tiles(spark):
    r = random.Random(8)
    bins = spark.createDataFrame([(g, i, r.choice([0, 2, 4, 9]), r.randint(0, 5), r.random() * 9) for g in range(4) for i in range(90)], "g int, i int, n int, o int, v double")
    key = lambda df: sorted(map(str, df.collect()))
    for f in (lambda t: M.copy_numbers(bins, ["g"], ["i"], "n", 2.0, tile=t).drop("confidence"), lambda t: M.deletions(bins, ["g"], ["i"], "n", "o", tile=t), lambda t: M.phase_switches(bins.withColumn("p", bins.o % 2), ["g"], ["i"], "p", 2.0, tile=t), lambda t: M.copy_numbers_as_read(bins, ["g"], ["i"], "v", tile=t)[0]):
        assert key(f(4)) == key(f(1000))


def test_ploidy_is_estimated_until_it_settles(spark):
    r = random.Random(2)
    rows = [(0, i, {True: 30.0, False: 20.0}[300 <= i < 400] + r.choice([-2.4, 0, 1.4])) for i in range(1000)]
    out, fit = M.copy_numbers_as_read(spark.createDataFrame(rows, "g int, i int, v double"), ["g"], ["i"], "v", change=1e-6)
    fit = fit.first()
    assert fit.settled and fit.ploidy == pytest.approx(2.1, abs=0.02)
    assert {(x.i // 100, x.state) for x in out.collect()} == {(k, 3 if k == 3 else 2) for k in range(10)}


def test_empty(spark):
    none = spark.createDataFrame([], "g int, i int, n int")
    assert M.copy_numbers(none, ["g"], ["i"], "n", 2.0).count() == 0
