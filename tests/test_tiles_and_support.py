"""Windows in tiles against windows over whole groups, and operators without SQL against brute force."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators import matching, ordered, sessions, support, variants
from strandline.sources import layout


def rows(n=400, seed=3):
    r = random.Random(seed)
    return [(r.choice(["a", "b", None]), r.randint(-50, 900), k, r.choice([None, r.randint(0, 9)])) for k in range(n)]


@pytest.mark.parametrize("tile", [1, 40, 1 << 20])
def test_across_tiles(spark, tile):
    df = spark.createDataFrame(rows(), "g string, pos long, id long, v long")
    w = W.partitionBy("g").orderBy("pos", "id")
    up_to, before, after = w.rowsBetween(W.unboundedPreceding, 0), w.rowsBetween(W.unboundedPreceding, -1), w.rowsBetween(1, W.unboundedFollowing)
    want = df.select("id", F.sum("v").over(up_to).alias("s"), F.max("v").over(before).alias("m"), F.lag("v").over(w).alias("a"), F.lead("v").over(w).alias("z"), F.last("v", True).over(up_to).alias("l"), F.first("v", True).over(after).alias("n"))
    v = F.col("v")
    got = ordered.across(df, ["g"], ["pos", "id"], {"s": ("sum", F.coalesce(v, F.lit(0))), "m": ("reach", v), "a": ("lag", v), "z": ("lead", v), "l": ("last", v), "n": ("next", v)}, tile)
    key = lambda x: x.id
    for a, b in zip(sorted(got.collect(), key=key), sorted(want.collect(), key=key), strict=True):
        assert (a.id, a.m, a.a, a.z, a.l, a.n) == (b.id, b.m, b.a, b.z, b.l, b.n) and (a.s or 0) == (b.s or 0)


def test_tiles_change_nothing(spark):
    r = random.Random(5)
    df = spark.createDataFrame([("c", s, s + r.randint(1, 30)) for s in (r.randint(0, 3000) for _ in range(200))], "contig string, start long, end long")
    key = lambda x: tuple(map(str, x))
    for f in (lambda t: sessions.end_gap_fragments(df, ["contig"], 3, tile=t), lambda t: sessions.end_gap_fragments(df, ["contig"], 3, True, t), lambda t: sessions.clusters(df, ["contig"], 2, 60, t), lambda t: sessions.islands(df, ["contig"], "start", t), lambda t: sessions.coalesced_windows(df.withColumn("n", F.lit(2)), ["contig"], 5, 90, t)):
        assert sorted(map(key, f(17).collect())) == sorted(map(key, f(1 << 20).collect()))
    left = spark.createDataFrame([("c", k, k) for k in range(0, 300, 7)], "g string, t long, id long")
    right = spark.createDataFrame([("c", k, str(k)) for k in range(3, 300, 21)], "g string, t long, name string")
    for forward in (False, True):
        for strict in (False, True):
            got = {x.id: x.name for x in matching.as_of(left, right, ["g"], "t", forward, strict, 10).collect()}
            for k in range(0, 300, 7):
                seen = [t for t in range(3, 300, 21) if ((t > k or t == k and not strict) if forward else (t < k or t == k and not strict))]
                assert got[k] == (str((min if forward else max)(seen)) if seen else None)


def test_key_clusters(spark):
    r = random.Random(8)
    calls = [(k % 5, k, float(r.randint(0, 9)), sorted(r.sample(range(8), r.randint(1, 5)))) for k in range(120)]
    got = {(x.g, x.name) for x in variants.key_clusters(spark.createDataFrame(calls, "g long, name long, qual double, keys array<long>"), ["g"], 0.5).collect()}
    want = set()
    for g in range(5):
        held = []
        for _, name, qual, keys in [c for c in calls if c[0] == g]:
            for h in held:
                if len(h[2] & set(keys)) / len(h[2] | set(keys)) >= 0.5:
                    if qual > h[1]:
                        h[:] = [name, qual, set(keys)]
                    break
            else:
                held.append([name, qual, set(keys)])
        want |= {(g, h[0]) for h in held}
    assert got == want and len(want) < 120


def test_error_tables(spark):
    allowed = spark.createDataFrame([("AAAA",), ("AATT",), ("GGGG",)], "key string")
    one = {x.wrong: x.key for x in support.error_table(allowed).collect()}
    two = {x.wrong: x.key for x in support.error_table(allowed, two_errors=True).collect()}
    shift = {x.wrong: x.key for x in support.error_table(allowed, indel=True).collect()}
    assert one["AAAC"] == "AAAA" and "AAAT" not in one and "AAAA" not in one
    assert two["GGCC"] == "GGGG" and "GGCC" not in one
    assert shift["ATTC"] == "AATT"


def test_lockstep_fails_out_of_step(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")
    assert variants.in_lockstep(a, a.select("k", F.lit(1).alias("b")), ["k"]).count() == 2
    with pytest.raises(Exception, match="out of step at 2"):
        variants.in_lockstep(a, a.filter("k = 1").select("k", F.lit(1).alias("b")), ["k"]).collect()


def test_read_files_are_found_by_name(spark, tmp_path):
    for name in ("s1_S1_L001_R1_001.fastq.gz", "s1_S1_L001_R2_001.fastq.gz", "s1_S1_L001_I1_001.fastq.gz", "notes.txt", "deep/s2_S3_L002_R1_004.fastq"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("@r\n")
    got = {(x.sample, x.lane, x.read, x.group) for x in layout.fastq_files(spark, str(tmp_path)).collect()}
    assert got == {("s1", 1, "R1", 1), ("s1", 1, "R2", 1), ("s2", 2, "R1", 4)}
