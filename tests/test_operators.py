"""Operators against brute force on small data, and the cases that the reference's own tests name: empty, book-ended, nested, identical, zero length."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.functions import numeric, sequence, tags
from strandline.operators import aggregates, fuzzy, graph, intervals, matching, models, sessions, variants
from strandline.sources import records
from strandline.streaming import windows


def spans(seed, n=120, top=400, longest=60):
    r = random.Random(seed)
    rows = [(r.choice("ab"), s, s + r.choice([0, 1, r.randint(1, longest)]), i) for i in range(n) for s in [r.randint(0, top)]]
    return rows + [("a", 10, 20, 900), ("a", 20, 30, 901), ("a", 10, 20, 902), ("a", 0, 5000, 903), ("c", 1, 2, 904), (None, 1, 9, 905)]


LEFT, RIGHT = "contig string, start long, end long, id long", "contig string, start_r long, end_r long, id_r long"


@pytest.mark.parametrize("base", [1, 16, 1 << 14])
def test_overlaps_at_any_cell_size(spark, base):
    a, b = spans(1), spans(2)
    got = sorted((r.id, r.id_r) for r in intervals.overlap_join(spark.createDataFrame(a, LEFT), spark.createDataFrame(b, RIGHT), "contig", base).collect())
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] is not None and x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert got == want


def test_interval_algebra(spark):
    a, b = [x for x in spans(3) if x[0]], [x for x in spans(4) if x[0]]
    left, right = spark.createDataFrame(a, LEFT), spark.createDataFrame(b, RIGHT)
    cells = lambda rows: {(c, p) for c, s, e in rows for p in range(s, e)}
    of = lambda rows: cells([x[:3] for x in rows])
    frame = lambda df: [(r.contig, r.start, r.end) for r in df.collect()]
    merged = frame(intervals.merge(left, "contig", tile=64))
    assert cells(merged) == of(a) and frame(intervals.merge(left, "contig", tile=1 << 20)).sort() == merged.sort()
    assert cells(frame(intervals.intersect(left, right, "contig", 8))) == of(a) & of(b)
    assert cells(frame(intervals.subtract(left, right, "contig", ["id"], 8))) == of(a) - of(b)
    depth = {(r.contig, p): r.depth for r in intervals.depth(left, "contig", tile=50).collect() for p in range(r.start, r.end)}
    want = {}
    for c, s, e, _ in a:
        for p in range(s, e):
            want[c, p] = want.get((c, p), 0) + 1
    assert depth == want
    empty = spark.createDataFrame([], LEFT)
    assert intervals.merge(empty, "contig").count() == intervals.depth(empty, "contig").count() == intervals.overlap_join(empty, right, "contig").count() == 0
    book = spark.createDataFrame([("a", 1, 5, 1), ("a", 5, 9, 2)], LEFT)
    assert intervals.merge(book, "contig").count() == 2 and intervals.merge(book, "contig", touching=True).count() == 1


def test_nearest(spark):
    regions = [(10, 20), (30, 40), (50, 60)]
    points = [0, 9, 10, 19, 20, 24, 25, 26, 29, 30, 45, 44, 46, 60, 99]

    def plain(p):
        inside = [x for x in regions if x[0] <= p < x[1]]
        if inside:
            return inside[0]
        left = [x for x in regions if x[0] <= p]
        right = [x for x in regions if x[0] > p]
        if not left or not right:
            return (right or left[-1:])[0]
        return left[-1] if p - left[-1][1] < right[0][0] - p else right[0]

    out = intervals.nearest(spark.createDataFrame([("a", p) for p in points], "contig string, pos long"), spark.createDataFrame([("a", *x) for x in regions], "contig string, start_r long, end_r long"), "contig").collect()
    assert {r.pos: (r.start_r, r.end_r) for r in out} == {p: plain(p) for p in points}


def test_sessions_and_clusters(spark):
    r = random.Random(5)
    rows = sorted((r.randint(0, 300), r.randint(1, 25)) for _ in range(80))
    df = spark.createDataFrame([("k", s, s + n) for s, n in rows], "contig string, start long, end long")
    number, first, reach, k = [], None, None, 0
    for s, n in rows:
        if first is None or s - reach > 3 or max(reach, s + n) - first > 40:
            k, first, reach = k + 1, s, s + n
        number.append(k)
        reach = max(reach, s + n)
    got = [x.cluster for x in sessions.clusters(df, ["contig"], 3, 40).orderBy("start", "end").collect()]
    assert got == number
    picked, reach = 0, None
    for s, n in sorted(set(rows), key=lambda x: (x[0], x[0] + x[1])):
        if reach is None or s >= reach:
            picked, reach = picked + 1, s + n
    assert sessions.apart(df.distinct(), ["contig"]).count() == picked
    weeks = spark.createDataFrame([("k", 10 * i, 10 * i + 10, n) for i, n in enumerate([1, 2, 9, 1, 1, 1, 8])], "contig string, start long, end long, n long")
    assert [(x.start, x.end, x.n) for x in sessions.coalesced_windows(weeks, ["contig"], 4, 30).orderBy("start").collect()] == [(0, 30, 12), (30, 60, 3), (60, 70, 8)]
    hits = spark.range(60).select("id", sessions.sliding(F.col("id"), 20, 10).alias("w")).collect()
    assert all(list(x.w) == [s for s in range(0, 60, 10) if s <= x.id < s + 20] for x in hits)


def test_fuzzy_keys(spark):
    allowed = spark.createDataFrame([("AAAA", 5.0), ("CCCC", 1.0), ("AACC", 1.0)], "key string, prior double")
    reads = spark.createDataFrame([(1, "AAAA", "IIII"), (2, "AAAC", "III#"), (3, "ACCC", "#III"), (4, "GGGG", "IIII"), (5, None, "IIII"), (6, "AAAC", "IIII")], "id int, key string, qual string")
    got = {r.id: r.corrected for r in fuzzy.corrected(reads, allowed, ["id"], 0.9).collect()}
    assert got[1] == "AAAA" and got[2] == "AAAA" and got[3] == "CCCC" and got[4] is None and got[5] is None
    seq = spark.createDataFrame([("ACGTTGCAACGGTTACGT",)], "s string").select(fuzzy.super_kmers(F.col("s"), 7, 3).alias("x"), F.col("s")).first()
    covered = set()
    for x in seq.x:
        part = seq.s[x.start : x.start + x.length]
        assert x.minimizer in part and x.length >= 7
        covered |= {x.start + i for i in range(x.length - 6)}
    assert covered == set(range(len(seq.s) - 6))
    sets = spark.createDataFrame([(1, list(range(50))), (2, list(range(50))), (3, list(range(100, 150))), (4, [])], "k int, v array<int>")
    assert [(r.a, r.b, r.estimate) for r in fuzzy.minhash_candidates(sets, "k", "v", 24, 3).collect()] == [(1, 2, 1.0)]


def test_graphs(spark):
    edges = [(1, 2), (2, 3), (3, 4), (5, 3), (10, 11), (11, 12), (12, 10), (20, 20), (30, 31), (30, 32)]
    got = {r.node: (r.path, r.place) for r in graph.compressed_paths(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got[1] == (1, 0) and got[2] == (1, 1) and got[3] == (3, 0) and got[4] == (3, 1) and got[5] == (5, 0)
    assert got[10] == (10, 0) and got[12] == (10, 2) and got[31] == (31, 0) and got[20] == (20, 0)


def all_paths(e, t, p, first=True):
    n, k = e.shape
    best = None
    for code in range(k**n):
        path = [code // k**i % k for i in range(n)]
        score = p[path[0]] + (e[0, path[0]] if first else 0) + sum(t[path[i - 1], path[i]] + e[i, path[i]] for i in range(1, n))
        if best is None or score > best[0] + 1e-12:
            best = score, path
    return best[0]


def test_markov_models():
    r = np.random.default_rng(1)
    for _ in range(10):
        e, t, p = r.normal(size=(6, 3)), np.log(r.dirichlet(np.ones(3), 3)), np.log(r.dirichlet(np.ones(3)))
        path = models.viterbi(e, t, p)
        assert abs(p[path[0]] + e[0, path[0]] + sum(t[path[i - 1], path[i]] + e[i, path[i]] for i in range(1, 6)) - all_paths(e, t, p)) < 1e-9
        post = np.zeros((6, 3))
        for code in range(3**6):
            own = [code // 3**i % 3 for i in range(6)]
            w = math.exp(p[own[0]] + e[0, own[0]] + sum(t[own[i - 1], own[i]] + e[i, own[i]] for i in range(1, 6)))
            post[np.arange(6), own] += w
        assert np.allclose(models.smoothed(e, t, p), post / post.sum(axis=1, keepdims=True))


def plain_alignment(a, b, match=1, mismatch=-1, opening=-6, extending=-1):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    best = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            ways = [0, h[i - 1][j - 1] + (match if a[i - 1] == b[j - 1] else mismatch)]
            ways += [h[i - k][j] + opening + (k - 1) * extending for k in range(1, i + 1)] + [h[i][j - k] + opening + (k - 1) * extending for k in range(1, j + 1)]
            h[i][j] = max(ways)
            best = max(best, h[i][j])
    return best


def test_alignment_and_switches(spark):
    r = random.Random(2)
    for _ in range(40):
        a, b = ("".join(r.choices("ACGT", k=r.randint(0, 25))) for _ in "ab")
        assert models.align_score(a, b, 2, -1, -2, -1) == plain_alignment(a, b, 2, -1, -2, -1)
    rows = [(1, i, p) for i, p in enumerate([0, 0, 0, 1, 0, 0, 0, 0, 1, 1, 1, 1, 1, 1, 1, 1])]
    out = models.phase_switches(spark.createDataFrame(rows, "b int, i int, p int"), ["b"], ["i"], "p").orderBy("i").collect()
    assert [x.i for x in out if x.short_switch] == [3] and [x.i for x in out if x.long_switch] == [8]


def test_trio(spark):
    rows = [(1, i, ["A", "C"], ["G", "T"], ["A", "G"], 1, 1, 1) for i in range(4)] + [(1, 4, ["A", "A"], ["G", "G"], ["T", "G"], 1, 1, 1)]
    out = models.trio_states(spark.createDataFrame(rows, "c int, i int, p1 array<string>, p2 array<string>, ch array<string>, p1_set int, p2_set int, ch_set int"), ["c"], ["i"]).orderBy("i").collect()
    assert {x.state for x in out} == {0} and [x.violation for x in out] == [False] * 4 + [True]


def test_tags_and_scalars(spark):
    one = lambda e: spark.range(1).select(e.alias("x")).first().x
    info = F.lit("B=2;A=1;C;B=3")
    assert one(tags.parsed(info)) == {"A": "1", "B": "3", "C": ""} and one(tags.parsed(F.lit("."))) == {} == one(tags.parsed(F.lit(None).cast("string")))
    assert one(tags.updated(tags.parsed(info), {"A": F.lit(None), "D": F.lit(7)})) == "B=3;C=.;D=7" and one(tags.updated(tags.parsed(F.lit("A=1")), {"A": F.lit(None)})) == "."
    assert one(tags.with_filter(F.lit("Z;A"), "M", F.lit(5.0), 10)) == "A;M;Z" and one(tags.with_filter(F.lit("M"), "M", F.lit(50.0), 10)) == "."
    assert one(sequence.locus(F.lit("chr1:5-9")))[:] == ("chr1", 5, 9) and one(sequence.locus(F.lit("None"))) is None
    assert one(sequence.mask(F.lit("ACGTAC"), 1, 3)) == "NCGNNN" and one(sequence.trim_length(F.lit("III#II"), 20, 3)) == 3
    assert [x.contig for x in one(sequence.split_alignments(F.lit("chr2,5,+,10M,60,1;chr3,9,-,5S5M,3,0;")))] == ["chr2", "chr3"]
    names = spark.createDataFrame([("chr10",), ("chr2",), ("chrX",), ("1",)], "n string").orderBy(sequence.contig_order(F.col("n"))).collect()
    assert [x.n for x in names] == ["1", "chr2", "chr10", "chrX"]
    tails = spark.createDataFrame([(3.0, 1.5), (0.0, 2.0), (40.0, 20.0)], "n double, r double").select(numeric.poisson_tail("n", "r").alias("t"), numeric.chi_square_tail("r").alias("c")).collect()
    want = [1 - sum(math.exp(-r) * r**k / math.factorial(k) for k in range(int(n))) for n, r in ((3, 1.5), (0, 2), (40, 20))]
    assert np.allclose([x.t for x in tails], want) and abs(tails[0].c - math.erfc(math.sqrt(0.75))) < 1e-12
    logs = spark.createDataFrame([(3.0, 10.0, 0.2)], "k double, n double, p double").select(numeric.log10_binomial_tail("k", "n", "p").alias("x")).first().x
    assert abs(logs - math.log10(sum(math.comb(10, k) * 0.2**k * 0.8 ** (10 - k) for k in range(4, 11)))) < 1e-9


def test_variants_and_statistics(spark):
    rows = [("chr1", 10, "ACGT", ["AT"], 1.0), ("chr1", 20, "A", ["AC", "G"], 1.0), ("chr1", 30, "GCC", ["GC"], 1.0)]
    out = records.by_allele(spark.createDataFrame(rows, "contig string, pos long, ref string, alts array<string>, qual double")).collect()
    assert sorted((x.pos, x.ref, x.alt) for x in out) == [(10, "ACG", "A"), (20, "A", "AC"), (20, "A", "G"), (30, "GC", "G")]
    calls = spark.createDataFrame([("x", 1, 0, 100, 5.0), ("y", 1, 10, 105, 9.0), ("z", 1, 300, 400, 1.0)], "name string, contig int, start long, end long, qual double")
    grouped = variants.overlap_groups(calls, 0.8, 16)
    assert {r.name for r in variants.selected(grouped, "quality").collect()} == {"y", "z"} and {r.name for r in variants.selected(grouped, "widest").collect()} == {"x", "z"}
    lengths = spark.createDataFrame([(x,) for x in (2, 2, 2, 3, 3, 4, 8, 8)], "v long")
    assert aggregates.nx(lengths, "v").first().nx == 8
    spots = [(1, i, (float(i % 3), 0.0)) for i in range(9)]
    near = variants.near_duplicates(spark.createDataFrame(spots, "k int, id int, place struct<x:double,y:double>"), ["k"], "place", 0.5, 100).collect()
    assert near[0].optical == 9
    a = spark.createDataFrame([("k", 5, 1), ("k", 9, 2), ("j", 1, 3)], "k string, t long, id int")
    b = spark.createDataFrame([("k", 5, 50), ("k", 7, 70)], "k string, t long, v int")
    back = lambda **x: {r.id: r.v for r in matching.as_of(a, b, ["k"], "t", **x).collect()}
    assert back() == {1: 50, 2: 70, 3: None} and back(strict=True) == {1: None, 2: 70, 3: None} and back(forward=True) == {1: 50, 2: None, 3: None}


def test_streams_agree_with_batch(spark, tmp_path):
    rows = [(i % 7, i * 600 + (i % 5) * 40) for i in range(400)]
    own = spark.createDataFrame(rows, "user_id long, at long").withColumn("ts", F.timestamp_seconds("at"))
    own.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = windows.events(spark, str(tmp_path / "in"), "user_id long, at long, ts timestamp", files=10)
    got = windows.collected(windows.sessions(stream, "ts", ["user_id"], "2 hours"), str(tmp_path / "s"), str(tmp_path / "c")).collect()
    last = max(a for _, a in rows)
    want = sessions.gap_sessions(own, ["user_id"], "at", 7200 - 1).groupBy("user_id", "session").agg(F.count("*").alias("n"), F.max("at").alias("last")).collect()
    closed = sorted((x.user_id, x.n) for x in want if x["last"] + 7200 <= last - 3600)
    assert sorted((x.user_id, x.n) for x in got) == closed
    flushed = windows.flushed(stream.withColumn("place", F.col("at")), "ts", "user_id", "place", 300, 5)
    out = windows.collected(flushed, str(tmp_path / "f"), str(tmp_path / "g")).collect()
    assert sum(x.late for x in out) == 0 and len(out) <= len(rows)


def test_indexed_files(spark, tmp_path):
    df = spark.createDataFrame(spans(8)[:100], LEFT)
    records.write_indexed(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100
    assert [r.value.split("\t")[0] for r in records.bed_lines(df).collect()] == sorted(r.contig for r in df.collect())
