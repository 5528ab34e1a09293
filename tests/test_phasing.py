import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from strandline.operators import fuzzy, phasing


def test_beam_finds_the_best_phase():
    r = np.random.default_rng(3)
    for _ in range(20):
        e = r.normal(0, 2, (7, 9)) * (r.random((7, 9)) < 0.6)
        best = max(float(phasing._value(np.array((1, *x)) @ e)) for x in itertools.product((1, -1), repeat=6))
        x = phasing.phased(e, 128)
        assert x[0] == 1 and abs(float(phasing._value(x @ e)) - best) < 1e-9
        c = phasing.confidence(e, x)
        assert np.isinf(c[0]) and (c[1:] >= -1e-9).all()


def test_chunks_of_known_haplotypes(spark):
    r = random.Random(1)
    truth = {v: r.choice([0, 1]) for v in range(40)}
    rows = []
    for key in range(60):
        side, start = r.choice([0, 1]), r.randrange(40)
        for v in range(start, min(40, start + 8)):
            right = (truth[v] == side) if r.random() > 0.03 else (truth[v] != side)
            rows.append((v // 20, v, key, 3.0 if right else -3.0))
    rows = [x for x in rows if x[1] // 20 == x[0]]
    out = phasing.phase(spark.createDataFrame(rows, "chunk long, variant long, key long, odds double"), ["chunk"]).collect()
    for chunk in (0, 1):
        own = {x.variant: x.haplotype for x in out if x.chunk == chunk}
        wrong = sum(own[v] != truth[v] ^ truth[min(own)] for v in own)
        assert min(wrong, len(own) - wrong) <= 1


def test_stitching_turns_chunks(spark):
    truth = {v: v * 7 % 3 % 2 for v in range(50)}
    rows = [("a", c, v, truth[v] ^ turn) for c, (s, e, turn) in enumerate([(0, 20, 0), (12, 32, 1), (24, 44, 1)]) for v in range(s, e)] + [("a", 3, v, 0) for v in range(60, 65)]
    out = phasing.stitched(spark.createDataFrame(rows, "k string, chunk long, variant long, hap int"), ["k"], "chunk", "variant", "hap").collect()
    assert {x.chunk: (x.block, x.flipped) for x in out} == {0: (1, False), 1: (1, True), 2: (1, True), 3: (2, False)}
    assert all((x.hap ^ int(x.flipped)) == truth[x.variant] for x in out if x.block == 1)


def test_repeats_and_alleles(spark):
    one = lambda e: spark.range(1).select(e.alias("x")).first().x
    assert one(phasing.repeat_runs(F.lit("AAAAC"))) == [4, 4, 3]
    assert one(phasing.repeat_runs(F.lit("ACACACT"))) == [1, 6, 3] and one(phasing.repeat_runs(F.lit(""))) == [0, 0, 0]
    counts = lambda *x: F.array(*[F.lit(v).cast("long") for v in x])
    assert one(phasing.homozygous(counts(1, 9))) == 1 and one(phasing.homozygous(counts(5, 5))) is None and one(phasing.homozygous(counts(0, 0))) is None


def test_second_neighbours(spark):
    got = [x.text for x in spark.range(1).select(fuzzy.second_neighbours(F.lit("ACG")).alias("x")).first().x]
    assert len(got) == len(set(got)) == 27 and all(sum(a != b for a, b in zip(t, "ACG", strict=True)) == 2 for t in got)
