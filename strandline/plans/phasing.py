"""Queries on haplotypes: phasing chunks, stitching them, repeats and allele shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import chromosomes as C
from strandline.operators import fuzzy as Z
from strandline.operators import phasing as P
from strandline.plans.base import code, code_sql, items, query, table
from strandline.plans.matching import READS, _reads


@query()
def phased_chunks(spark, sf):
    """Days are variants, suppliers of one group keys that hold one of two sides, with some noise."""
    side = F.when((F.col("contig") + F.col("start")) % 2 == 0, 1.0).otherwise(-1.0) * F.when(F.col("flag") == "R", -0.5).otherwise(1.0)
    own = items(spark, sf).select((F.col("contig") % 4).alias("contig"), F.floor(F.col("start") / 20).alias("chunk"), F.col("start").alias("variant"), F.col("contig").alias("key"), side.alias("odds"))
    return P.phase(own, ["contig", "chunk"], beam=16)


@query()
def phased_variants(spark, sf):
    """Stretches of four days are variants of four chromosomes, a supplier's items of two months a key, with some noise."""
    variant, key = F.floor(F.col("start") / 4), F.col("contig") * 100 + F.floor(F.col("start") / 60)
    side = F.when((key + (variant % 3 == 0).cast("int")) % 2 == 0, 2.0).otherwise(-2.0) * F.when(F.col("id") % 9 == 0, -0.5).otherwise(1.0)
    own = items(spark, sf).select((F.col("contig") % 4).alias("chromosome"), variant.alias("variant"), key.alias("key"), side.alias("odds"))
    return C.phased(own, ["chromosome"], tile=366)


@query("""WITH v AS (SELECT DISTINCT l_suppkey AS k, l_partkey AS variant, l_partkey // 50 AS c FROM lineitem), d AS (SELECT k, variant, c AS chunk, (variant + c * (k % 2)) % 2 AS hap FROM v UNION ALL SELECT k, variant, c - 1, CASE WHEN k % 5 = 0 AND variant % 3 = 0 THEN 1 - (variant + (c - 1) * (k % 2)) % 2 ELSE (variant + (c - 1) * (k % 2)) % 2 END FROM v WHERE variant % 50 < 20 AND c > 0),
j AS (SELECT a.k, a.chunk + 1 AS chunk, avg(CASE WHEN a.hap = b.hap THEN 1.0 ELSE 0.0 END) AS same FROM d a JOIN d b ON a.k = b.k AND a.variant = b.variant AND b.chunk = a.chunk + 1 GROUP BY ALL),
c AS (SELECT k, chunk, same, coalesce(same >= 0.95 OR same <= 1 - 0.95, false) AS sure FROM (SELECT DISTINCT k, chunk FROM d) LEFT JOIN j USING (k, chunk)),
g AS (SELECT *, sum(CASE WHEN sure THEN 0 ELSE 1 END) OVER (PARTITION BY k ORDER BY chunk ROWS UNBOUNDED PRECEDING) AS block FROM c), f AS (SELECT *, sum(CASE WHEN sure AND same <= 1 - 0.95 THEN 1 ELSE 0 END) OVER (PARTITION BY k, block ORDER BY chunk ROWS UNBOUNDED PRECEDING) % 2 = 1 AS flipped FROM g)
SELECT d.k, d.chunk, d.variant, d.hap, f.block::BIGINT AS block, f.flipped FROM d JOIN f USING (k, chunk)""")
def stitched_chunks(spark, sf):
    v = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_partkey").alias("variant"), F.floor(F.col("l_partkey") / 50).alias("c")).distinct()
    hap = lambda c: (F.col("variant") + c * (F.col("k") % 2)) % 2
    before = F.col("c") - 1
    turned = F.when((F.col("k") % 5 == 0) & (F.col("variant") % 3 == 0), 1 - hap(before)).otherwise(hap(before))
    one = v.select("k", "variant", F.col("c").alias("chunk"), hap(F.col("c")).alias("hap"))
    two = v.filter("variant % 50 < 20 and c > 0").select("k", "variant", before.alias("chunk"), turned.alias("hap"))
    return P.stitched(one.unionAll(two), ["k"], "chunk", "variant", "hap")


RUN = "list_max(list_filter(range(1, length(after) // {k} + 1), lambda m: substr(after, 1, {k} * m) = repeat(substr(after, 1, {k}), m)))::INT * {k}"


@query(f"SELECT p_partkey, after, {RUN.format(k=1)} AS mono, {RUN.format(k=2)} AS di, {RUN.format(k=3)} AS tri FROM (SELECT p_partkey, repeat({code_sql('p_partkey', 1)}, (p_size % 5)::INT) || {code_sql('p_partkey', 12)} AS after FROM part)")
def repeat_annotation(spark, sf):
    own = table(spark, sf, "part").select("p_partkey", F.concat(F.repeat(code(F.col("p_partkey"), 1), (F.col("p_size") % 5).cast("int")), code(F.col("p_partkey"), 12)).alias("after"))
    return own.select("p_partkey", "after", P.repeat_runs(F.col("after")).alias("r")).select("p_partkey", "after", F.get("r", 0).alias("mono"), F.get("r", 1).alias("di"), F.get("r", 2).alias("tri"))


@query("""WITH c AS (SELECT l_partkey, count(*) FILTER (l_returnflag = 'A') AS a, count(*) FILTER (l_returnflag = 'N') AS b, count(*) FILTER (l_returnflag = 'R') AS c FROM lineitem GROUP BY 1)
SELECT l_partkey, CASE WHEN greatest(a, b, c) / (a + b + c) >= 0.7 THEN CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END ELSE -1 END AS allele FROM c""")
def homozygous_candidates(spark, sf):
    n = lambda f: F.count(F.when(F.col("l_returnflag") == f, 1))
    own = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.array(n("A"), n("N"), n("R")).alias("counts"))
    return own.select("l_partkey", F.coalesce(P.homozygous(F.col("counts")), F.lit(-1)).alias("allele"))


@query(f"""WITH {READS}, k AS (SELECT DISTINCT r.key, r.qual, a.prior, len(list_filter(range(1, 9), lambda i: ascii(substr(r.qual, i, 1)) - 33 <= 24)) > 0 AS low FROM reads r JOIN allowed a USING (key)),
n AS (SELECT k.key, k.qual, a.key AS t, a.prior * list_product(list_transform(list_filter(range(1, 9), lambda i: substr(k.key, i, 1) <> substr(a.key, i, 1)), lambda i: pow(10.0, -greatest(3.0, least(ascii(substr(k.qual, i, 1)) - 34, 33.0)) / 10))) AS w FROM k JOIN allowed a ON hamming(k.key, a.key) = 2 WHERE low
UNION ALL SELECT key, qual, key, prior FROM k WHERE low), m AS (SELECT key, qual, sum(w) AS s, max(w) AS m, arg_max(t, (w, t)) AS t FROM n GROUP BY ALL)
SELECT k.key, k.qual, CASE WHEN NOT low THEN k.key WHEN m.m > 0.9 * m.s THEN m.t END AS corrected FROM k LEFT JOIN m USING (key, qual)""")
def confirmed_keys(spark, sf):
    reads, allowed = _reads(spark, sf)
    distinct = reads.select("key", "qual").distinct().withColumn("rid", F.concat("key", F.lit("|"), "qual"))
    out = Z.confirmed(distinct, allowed, ["rid"], 0.9)
    return out.select(F.substring_index("rid", "|", 1).alias("key"), F.expr("substring(rid, instr(rid, '|') + 1)").alias("qual"), "corrected")
