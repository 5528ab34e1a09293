"""Whole-chromosome phases against all assignments, planted haplotypes, and tiles."""

import itertools
import random

import numpy as np
import pytest

from strandline.operators import chromosomes as C

SCHEMA = "contig string, variant long, key long, odds double"
value = lambda s: np.logaddexp(s / 2, -s / 2).sum(axis=-1)


def reads(seed, variants, keys, span, noise, contig="a"):
    """Evidence of keys that see a few neighbouring variants of one haplotype each."""
    r = random.Random(seed)
    truth = {v * 10: r.choice([1, -1]) for v in range(variants)}
    rows = []
    for key in range(keys):
        side, start = r.choice([1, -1]), r.randrange(variants)
        for v in range(start, min(variants, start + span)):
            if r.random() < 0.8:
                rows.append((contig, v * 10, key, (1 if r.random() > noise else -1) * side * truth[v * 10] * r.choice([1.0, 2.5, 4.0])))
    return rows, truth


@pytest.mark.parametrize("seed", range(5))
def test_twelve_variants_against_all_assignments(spark, seed):
    rows, _ = reads(seed, 12, 30, 5, 0.08)
    out = {x.variant: x for x in C.phased(spark.createDataFrame(rows, SCHEMA), ["contig"], least=0.0).collect()}
    variants = sorted({v for _, v, _, _ in rows})
    e = np.zeros((len(variants), 30))
    for _, v, k, o in rows:
        e[variants.index(v), k] += o
    every = np.array([(1, *x) for x in itertools.product((1, -1), repeat=len(variants) - 1)])
    best = value(every @ e).max()
    x = np.array([1 - 2 * out[v].haplotype for v in variants])
    assert value(x @ e) == pytest.approx(best, abs=1e-6)
    for i, v in enumerate(variants[1:], 1):
        y = np.where(np.arange(len(variants)) >= i, -x, x)
        assert out[v].sure == pytest.approx(value(x @ e) - value(y @ e), abs=1e-6)


def test_planted_haplotypes_whatever_the_tiles(spark):
    rows, truth = reads(9, 150, 260, 7, 0.03)
    more, other = reads(10, 40, 90, 6, 0.0, None)
    gap = [("c", v, k, 3.0 * (-1) ** (v // 10)) for k in range(4) for v in ((0, 10) if k % 2 else (500, 510))]
    df = spark.createDataFrame([*rows, *more, *gap, ("c", None, 1, 1.0), ("c", 3, None, 1.0)], SCHEMA).repartition(4)
    results = []
    for tile in (8, 1000):
        out = C.phased(df, ["contig"], tile=tile).collect()
        results.append(sorted(map(str, out)))
        for contig, known in (("a", truth), (None, other)):
            own = [x for x in out if x.contig == contig]
            blocks = {}
            for x in own:
                blocks.setdefault(x.block, []).append((x.haplotype, known[x.variant]))
            wrong = sum(min(sum((h == 0) == (t == 1) for h, t in b), sum((h == 0) == (t == -1) for h, t in b)) for b in blocks.values())
            assert wrong <= 0.02 * len(own) and len(blocks) <= 12
        own = {x.variant: (x.block, x.haplotype) for x in out if x.contig == "c"}
        assert own == {0: (1, 0), 10: (1, 1), 500: (2, 0), 510: (2, 1)}
    assert results[0] == results[1]
