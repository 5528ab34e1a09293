"""Ids that several rows have, rows that an order ties, and values at the edge of a rank."""

import random

from pyspark.sql import functions as F

from strandline.operators import aggregates, events, intervals, matching, sessions, targets
from strandline.operators.ordered import numbered


def test_rows_of_one_id_are_judged_apart(spark):
    left = spark.createDataFrame([(1, "c", 0, 5), (1, "c", 20, 25), (1, "d", 0, 5), (2, "c", 3, 4)], "id long, contig string, start long, end long")
    right = spark.createDataFrame([("c", 3, 6)], "contig string, start_r long, end_r long")
    rows = lambda df: sorted((x.id, x.contig, x.start) for x in df.collect())
    assert rows(intervals.overlapping(left, right, "contig", ["id"], 8)) == [(1, "c", 0), (2, "c", 3)]
    assert rows(intervals.overlapping(left, right, "contig", ["id"], 8, anti=True)) == [(1, "c", 20), (1, "d", 0)]
    records = left.select("id", "contig", F.col("start").alias("pos"), (F.col("end") - F.col("start")).alias("length"))
    on = lambda whole: sorted((x.id, x.contig, x.pos) for x in targets.on_targets(records, right, "contig", ["id"], whole, 8).collect())
    assert on(False) == [(1, "c", 0), (2, "c", 3)] and on(True) == [(2, "c", 3)]


def test_filters_of_repeated_ids(spark):
    own = spark.createDataFrame([(1, "c", 0, 5), (1, "c", 0, 5), (1, "c", 20, 25)], "id long, contig string, start long, end long")
    track = spark.createDataFrame([("c", 3, 6)], "contig string, start_r long, end_r long")
    out = events.passing(own, {"LATE": F.col("start") > 9}, {"BLACK": track}, ["id"], 8)
    assert sorted((x.id, x.start, tuple(x.filters)) for x in out.collect()) == [(1, 0, ("BLACK",)), (1, 0, ("BLACK",)), (1, 20, ("LATE",))]


def test_break_pairs_without_a_distinct(spark):
    r = random.Random(3)
    schema = "name long, chrom1 int, start1 long, stop1 long, chrom2 int, start2 long, stop2 long"

    def some(n, names):
        return [(r.choice(names), r.randrange(2), a := r.randrange(60), a + r.choice([0, 2, 9]), r.randrange(2), b := r.randrange(60), b + 2) for _ in range(n)]

    def plain(calls, truth, slack):
        sides = lambda x, w: sorted([(x[1], max(x[2] - w, 0), x[3] + w), (x[4], max(x[5] - w, 0), x[6] + w)])
        near = lambda a, b: a[0] == b[0] and a[1] < b[2] and b[1] < a[2]
        return {(x[0], y[0]) for x in calls for y in truth if all(map(near, sides(x, slack), sides(y, 0)))}

    for names in (range(10**6), range(40)):
        calls, truth = some(120, names), some(120, names)
        a, b = spark.createDataFrame(calls, schema), spark.createDataFrame(truth, schema)
        assert sorted(map(tuple, matching.breakpoint_matches(a, b, 2, 8).collect())) == sorted(plain(calls, truth, 2))
        assert sorted(x.truth for x in matching.breakpoints_met(a, b, 2, 8).collect()) == sorted({y for _, y in plain(calls, truth, 2)})
    once = {x[0]: x for x in calls}.values()
    out = matching.breakpoint_matches(spark.createDataFrame(once, schema), spark.createDataFrame({x[0]: x for x in truth}.values(), schema), 2, 8)
    assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()  # pairs aren't shuffled again


def test_ties_stay_in_the_fragment_that_they_begin(spark):
    rows = [("c", s, s + 4) for s in range(0, 3000, 10) for _ in range(5)]
    df = spark.createDataFrame(rows, "contig string, start long, end long").repartition(7)
    plain = sorted((s, s + 4, 5) for s in range(0, 3000, 10))
    for compat in (False, True):
        for tile in (17, 1 << 20):
            assert sorted((x.start, x.end, x.n) for x in sessions.end_gap_fragments(df, ["contig"], 2, compat, tile).collect()) == plain
    # whatever order a sort gives to alike rows: the first of them is the one with the least reach
    flags = spark.createDataFrame([("c", 10, 14, 14), ("c", 10, 14, 4), ("c", 0, 4, None)], "contig string, start long, end long, reach long")
    out = numbered(flags, ["contig"], ["start", "end", "reach"], F.col("start") > F.col("reach") + 2, "k", 100)
    assert sorted((x.start, x.k) for x in out.collect()) == [(0, 1), (10, 2), (10, 2)]


def test_quantiles_are_exact(spark):
    r = random.Random(8)
    # at a share of 0.5 the rank is the last 1, which a sketch of 1 in 100 misses
    rows = [("a", 1.0)] * 500 + [("a", 2.0)] * 500 + [("b", float(r.randrange(10**6))) for _ in range(1001)] + [(None, 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = [0.0, 0.1, 0.5, 0.501, 0.9, 1.0]
    got = {(x.g, x.q): x.value for x in aggregates.quantiles(df, ["g"], "v", shares, 10).collect()}
    for g in ("a", "b", None):
        own = sorted(v for k, v in rows if k == g and v is not None)
        rank = lambda q: max(1, len(own) - int(len(own) - q * len(own)))
        assert [got[g, q] for q in shares] == [own[rank(q) - 1] for q in shares]
    assert len(got) == 18 and [x.value for x in aggregates.quantiles(df.filter("g = 'a'"), [], "v", [0.5]).collect()] == [1.0]
