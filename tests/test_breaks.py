"""Breaks by expectation and maximisation against dense arrays."""

import math
import random

import numpy as np
import pytest

from strandline.operators import breaks as B

SURVIVAL = [math.log(max(1e-6, 1 - k / 60)) for k in range(80)]
LEAST, CHIMERAS, REACH = -50.0, 1e-4, 70


def planted(seed):
    """Two loci: a deletion on one haplotype, and none; and one with a single pair."""
    r = random.Random(seed)
    pairs, phases = [], []
    for locus in (1, 2):
        for key in range(14):
            hap = key % 2
            if key % 5 != 4:
                phases.append((locus, key, *([0.95, 0.05, 0.9, 0.1] if hap == 0 else [0.05, 0.95, 0.1, 0.9]), locus == 1))
            for _ in range(r.randint(1, 4)):
                a = r.randint(950, 995)
                if hap == 0 and locus == 1:
                    end = 1300 + (a + r.randint(20, 50) - 1000)
                    pairs.append((locus, key, a, a + 3, end - 3, max(end, 1304), 0.01, False, False))
                else:
                    pairs.append((locus, key, a, a + 5, a + 30, a + 40 + r.randint(0, 9), 0.02, True, False))
    pairs.append((3, 0, 10, 15, 40, 45, 0.0, False, True))
    cells = [(locus, b1, b2) for locus in (1, 2) for b1 in (1000, 1010, 1040) for b2 in (1280, 1300)] + [(3, 20, 30)]
    return pairs, cells, phases


def dense(pairs, cells, phases, locus, rounds=5):
    add = np.logaddexp
    own = [p for p in pairs if p[0] == locus]
    keys, grid = sorted({p[1] for p in own}), sorted(c[1:] for c in cells if c[0] == locus)
    chance = lambda n: SURVIVAL[min(max(n, 0), len(SURVIVAL) - 1)]
    ln = lambda p: math.log(p) if p > 0 else -math.inf
    mix = lambda p: add(math.log1p(-CHIMERAS) + p, math.log(CHIMERAS) + LEAST)
    none, sv = np.zeros(len(keys)), np.zeros((len(keys), len(grid)))
    for _, key, o1, i1, i2, o2, w, normal, split in own:
        i = keys.index(key)
        zero = mix(add(math.log1p(-w) + chance(o2 - o1), ln(w) + LEAST))
        none[i] += zero
        for j, (b1, b2) in enumerate(grid):
            if (i1 > b1 and o1 < b2) or (o2 > b1 and i2 < b2):
                sv[i, j] += LEAST
            elif not normal and i1 <= b1 < i1 + REACH and i2 - REACH < b2 <= i2:
                sv[i, j] += mix(add(math.log1p(-w) + (0 if split else chance(b1 - o1 + o2 - b2)), ln(w) + LEAST))
            else:
                sv[i, j] += zero
    same = any(p[-1] for p in phases if p[0] == locus)
    prior = np.array([next((p[2:6] for p in phases if p[:2] == (locus, k)), (0.5,) * 4) for k in keys], float)
    stays = np.maximum(1 - prior[:, 0] - prior[:, 1], 1 - prior[:, 2] - prior[:, 3]) > 0.1
    now, settled = prior.copy(), False

    def best(now):
        out = []
        for j in range(len(grid)):
            for x in (0, 1):
                for y in (0, 1):
                    if not same or x == y:
                        hp = np.minimum(now[:, x], now[:, 2 + y])
                        with np.errstate(divide="ignore"):
                            out.append((round(float(add(np.log(hp) + sv[:, j], np.log(1 - hp) + none).sum()), 9), -j, -x, -y))
        return max(out)

    for _ in range(rounds):
        _, j, x, y = best(now)
        j, x, y = -j, -x, -y
        hp = np.minimum(now[:, x], now[:, 2 + y])
        with np.errstate(divide="ignore"):
            p = np.exp(sv[:, j] + np.log(hp) - add(sv[:, j] + np.log(hp), none + np.log(1 - hp)))
        new = now.copy()
        new[:, x], new[:, 1 - x], new[:, 2 + y], new[:, 3 - y] = p, 1 - p, p, 1 - p
        new[stays] = now[stays]
        settled = np.abs(new - now).max() <= 1e-4
        now = new
        if settled:
            break
    het, j, x, y = best(now)
    hom, h = max((round(float(sv[:, j].sum()), 9), -j) for j in range(len(grid)))
    chosen = -h if hom >= het else -j
    return float(none.sum()), hom, het, "hom" if hom >= het else "het", *grid[chosen], *((None, None) if hom >= het else (-x, -y)), bool(settled), int((sv[:, chosen] > none).sum())


@pytest.mark.parametrize("seed", range(3))
def test_against_dense_arrays(spark, seed):
    pairs, cells, phases = planted(seed)
    df = spark.createDataFrame(pairs, "locus int, key int, outer1 int, inner1 int, inner2 int, outer2 int, wrong double, normal boolean, split boolean")
    chances = B.pair_chances(df, spark.createDataFrame(cells, "locus int, b1 int, b2 int"), SURVIVAL, REACH, CHIMERAS, LEAST)
    out = {x.locus: x for x in B.break_models(chances, spark.createDataFrame(phases, "locus int, key int, a0 double, a1 double, z0 double, z1 double, same boolean")).collect()}
    for locus in (1, 2, 3):
        want = dense(pairs, cells, phases, locus)
        got = out[locus]
        assert [got.none, got.hom, got.het] == pytest.approx(want[:3], abs=1e-6)
        assert (got.zygosity, got.b1, got.b2, got.hap1, got.hap2, got.settled, got.support) == want[3:]
    assert (out[1].zygosity, out[1].hap1, out[1].hap2) == ("het", 0, 0) and out[1].b1 in (1000, 1010) and out[1].het > out[1].none
