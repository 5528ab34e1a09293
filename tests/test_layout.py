import random

from pyspark.sql import functions as F

from strandline.operators import events, overlap
from strandline.sources import layout, records


def test_ranges_include_the_left_edge_and_repeat_rows(spark):
    df = spark.createDataFrame([("a", 1, 5, 1), ("a", 5, 9, 2), ("a", 20, 30, 3), ("b", 1, 99, 4)], "contig string, start long, end long, id int")
    asked = spark.createDataFrame([("a", 5, 20), ("a", 5, 21)], "contig string, start_r long, end_r long")
    got = sorted((r.id, r.end_r) for r in layout.ranges(df, asked).collect())
    assert got == [(1, 20), (1, 21), (2, 20), (2, 21), (3, 21)]


def test_identifiers_and_shards(spark):
    r = random.Random(1)
    keys = ["".join(r.choices("ACGT", k=6)) for _ in range(300)] + [None]
    df = spark.createDataFrame([(k, f"n{i}") for i, k in enumerate(keys)], "k string, name string")
    got = {x.k: x.id for x in layout.key_ids(df.repartition(6), "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(set(filter(None, keys))))}
    shards = layout.sharded(df.unionAll(df), "k", "name", 7).groupBy("k").agg(F.count_distinct("shard").alias("n")).filter("k is not null").collect()
    assert all(x.n == 1 for x in shards)


def test_profiles_round_trip(spark):
    df = spark.createDataFrame([("a", 0, 30, 2), ("a", 30, 50, 5), ("a", 80, 90, 5)], "contig string, start long, end long, v int")
    out = sorted((r.start, r.end, r.v) for r in layout.bin_ranges(layout.dense(df, 10, "v"), 10, "v").collect())
    assert out == [(0, 30, 2), (30, 50, 5), (80, 90, 5)]


def test_vcf_lines(spark):
    calls = spark.createDataFrame([("chr1\t10\t20\tchr1\t500\t510\tx\t7\t+\t-\t.\tTYPE=DEL",), ("chr1\t5\t6\tchr2\t9\t10\ty",)], "value string")
    text = [r.value for r in layout.vcf_lines(records.bedpe_to_vcf(records.bedpe(calls))).collect()]
    assert text[0].startswith("##fileformat") and text[1].startswith("#CHROM") and len(text) == 5
    assert any("<DEL>" in t and "END=510" in t for t in text) and sum("MATEID" in t for t in text) == 2
    back = records.vcf(spark.createDataFrame([(t,) for t in text], "value string")).collect()
    assert sorted((x.contig, x.pos) for x in back) == [("chr1", 5), ("chr1", 10), ("chr2", 9)]


def test_mates_and_background(spark):
    rows = [("x", 1, 0, 2, 1, 100, 102), ("y", 1, 1, 3, 1, 300, 302), ("z", 1, 900, 902, 1, 101, 103)]
    calls = spark.createDataFrame(rows, "name string, chrom1 int, start1 long, stop1 long, chrom2 int, start2 long, stop2 long")
    assert {r.name: r.nmates for r in events.mates(calls, 1).collect()} == {"x": 2, "y": 1, "z": 1}
    bins = spark.createDataFrame([("a", i, n, 10) for i, n in enumerate([10, 10, 99, 10])], "g string, bin int, n long, size long")
    assert [r.expected for r in events.background(bins, ["g"], "bin", "n", 10, 1).orderBy("bin").collect()] == [10.0, 54.5, 10.0, 99.0]


def test_harmonic_bins(spark):
    edges = overlap.harmonic_edges(50)
    assert edges == sorted(set(edges)) and edges[0] == 0 and edges[-1] >= 50
    out = spark.range(60).select("id", overlap.discretised(F.col("id"), 50).alias("v")).collect()
    assert [r.v for r in out] == sorted(r.v for r in out) and out[0].v == 0 and out[50].v == out[59].v
