"""Queries on alignment rows. A line item stands for a read: the supplier is its key, the order its name."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import reads as R
from strandline.plans.base import code, code_sql, query, table


def _reads(spark, sf):
    day = F.datediff(F.col("l_shipdate"), F.lit("1992-01-01")).cast("long") * 100
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("qname"), F.col("l_suppkey").alias("bx"), (F.col("l_linenumber") % 3).cast("long").alias("contig"), (day + F.col("l_partkey") % 100).alias("pos"), (day + F.col("l_partkey") % 100 + F.col("l_quantity").cast("long")).alias("aend"),
        F.col("l_quantity").cast("int").alias("mapq"), (F.col("l_returnflag") == "A").alias("secondary"), (F.col("l_discount") >= 0.095).alias("unmapped"), (F.col("l_linestatus") == "F").alias("duplicate"), ((F.col("l_orderkey") * 1000000 + F.col("l_partkey")) * 10 + F.col("l_linenumber")).alias("id"),
    )


READS = """r AS (SELECT l_orderkey AS qname, l_suppkey AS bx, (l_linenumber % 3)::BIGINT AS contig, date_diff('day', DATE '1992-01-01', l_shipdate::DATE)::BIGINT * 100 + l_partkey % 100 AS pos,
date_diff('day', DATE '1992-01-01', l_shipdate::DATE)::BIGINT * 100 + l_partkey % 100 + l_quantity::BIGINT AS aend, l_quantity::INT AS mapq, l_returnflag = 'A' AS secondary, l_discount >= 0.095 AS unmapped, l_linestatus = 'F' AS duplicate, (l_orderkey * 1000000 + l_partkey) * 10 + l_linenumber AS id FROM lineitem)"""


@query(f"WITH {READS} SELECT id, pos, mapq FROM r WHERE mapq >= 30 AND NOT secondary AND NOT unmapped AND NOT duplicate")
def filtered_reads(spark, sf):
    return R.aligned(_reads(spark, sf), 30, keep=~F.col("duplicate")).select("id", "pos", "mapq")


@query(f"WITH {READS} SELECT qname, count(*) AS n FROM r WHERE ('0x' || substr(md5('7:' || qname::VARCHAR), 1, 8))::BIGINT % 100 < 25 GROUP BY qname")
def pair_subsample(spark, sf):
    return R.pair_subsample(_reads(spark, sf), "qname", 25, 7).groupBy("qname").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('3:' || o_orderkey::VARCHAR), o_orderkey LIMIT 500")
def fixed_sample(spark, sf):
    return R.fixed_sample(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 500, 3)


@query(f"WITH {READS} SELECT DISTINCT bx FROM r WHERE contig = 1 AND pos < 151000 AND aend > 150000")
def keys_at_locus(spark, sf):
    return R.at_locus(_reads(spark, sf), 1, 150000, 151000, "bx")


FRAGS = f"""{READS}, s AS (SELECT *, sum(CASE WHEN pos - prev <= 3000 THEN 0 ELSE 1 END) OVER (PARTITION BY bx, contig ORDER BY pos, qname ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT *, lag(pos) OVER (PARTITION BY bx, contig ORDER BY pos, qname) AS prev FROM r WHERE NOT duplicate AND NOT unmapped)),
f AS (SELECT bx, contig, session::BIGINT AS session, min(pos) AS start, max(aend) AS e, count(DISTINCT qname) AS n, count(*) AS se FROM s GROUP BY bx, contig, session HAVING max(mapq) >= 30),
fr AS (SELECT *, CASE WHEN n > 1 THEN e - start ELSE 1000 END AS obs, CASE WHEN n > 1 THEN (e - start) * (n + 1) / greatest(n - 1, 1) ELSE 1000.0 END AS est FROM f)"""


def _fragments(spark, sf):
    return R.fragments(_reads(spark, sf).filter(~F.col("duplicate") & ~F.col("unmapped")), 3000, 30)


@query(f'WITH {FRAGS} SELECT bx, contig, session, start, e AS "end", n AS num_reads, se AS num_reads_se, obs AS obs_len, round(est, 4) AS est_len FROM fr')
def fragment_table(spark, sf):
    return _fragments(spark, sf).withColumn("est_len", F.round("est_len", 4))


@query(f"WITH {FRAGS} SELECT bx, count(*) AS fragments, sum(n)::BIGINT AS reads, round(avg(n), 6) AS reads_per_fragment, round(sum(CASE WHEN n > 1 THEN n ELSE 0 END) / sum(n), 6) AS linked_reads, round(count(*) FILTER (n > 1) / count(*), 6) AS linked_fragments, round(sum(est), 3) AS length FROM fr GROUP BY bx")
def barcode_table(spark, sf):
    out = R.barcodes(_fragments(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("reads_per_fragment", "linked_reads", "linked_fragments")}).withColumn("length", F.round("length", 3))


@query(f"WITH {FRAGS} SELECT arg_max(b, (m, -b)) + 500.0 AS mode FROM (SELECT floor(est / 1000) * 1000 AS b, sum(est) AS m FROM fr WHERE n > 1 GROUP BY 1)")
def fragment_length_mode(spark, sf):
    return R.length_mode(_fragments(spark, sf), 1000).select(F.col("mode").cast("double").alias("mode"))


@query(f"""WITH c AS (SELECT {code_sql('l_partkey')} AS key, count(*) AS n FROM lineitem GROUP BY 1), a AS (SELECT DISTINCT {code_sql('p_partkey')} AS key FROM part WHERE p_partkey % 3 > 0), g AS (SELECT * FROM c SEMI JOIN a USING (key)), m AS (SELECT quantile_cont(n, 0.5) AS m FROM g)
SELECT round(least(1, (SELECT count(*) FROM g) / (SELECT count(*) FROM a)), 6) AS observed, round((SELECT sum(n) FROM g) / (SELECT sum(n) FROM c), 6) AS correct, round(sum(n) * sum(n) / sum(n * n), 4) AS diversity, round(avg(CASE WHEN n >= m / 2 AND n <= m * 2 THEN 1.0 ELSE 0.0 END), 6) AS within_twice_median, round(stddev_pop(n) / avg(n), 6) AS cv FROM g, m""")
def barcode_metrics(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy(code(F.col("l_partkey")).alias("key")).agg(F.count("*").alias("n"))
    allowed = table(spark, sf, "part").filter("p_partkey % 3 > 0").select(code(F.col("p_partkey")).alias("key"))
    out = R.barcode_metrics(counts, allowed)
    return out.select(*[F.round(c, 4 if c == "diversity" else 6).alias(c) for c in out.columns])


@query(f"""WITH {READS}, p AS (SELECT a.contig AS c1, b.contig AS c2, a.pos AS p1, b.pos AS p2, a.id % 2 = 0 AS v1, b.id % 3 = 0 AS v2, a.mapq AS m1, b.mapq AS m2, a.bx % 4 AS lane FROM r a JOIN r b ON a.qname = b.qname AND a.id < b.id),
q AS (SELECT *, m1 >= 20 AND m2 >= 20 AS sure, c1 = c2 AS same, abs(p1 - p2) AS d FROM p), t AS (SELECT *, same AND d <= 50000 AND v1 <> v2 AND CASE WHEN p1 <= p2 THEN v1 ELSE v2 END AS outw, same AND d <= 50000 AND v1 = v2 AS way FROM q)
SELECT lane, count(*) AS n, count(*) FILTER (sure) AS confident, count(*) FILTER (sure AND NOT same) AS inter_contig, count(*) FILTER (sure AND same AND d > 50000) AS far, count(*) FILTER (sure AND way) AS same_direction, count(*) FILTER (sure AND outw) AS outward, coalesce(quantile_cont(least(d, 10000), 0.5) FILTER (sure AND same AND d <= 50000 AND NOT outw AND NOT way), 0)::DOUBLE AS insert_median FROM t GROUP BY lane""")
def read_pair_metrics(spark, sf):
    own = _reads(spark, sf)
    side = lambda k, m: own.select("qname", F.col("id").alias(f"id{k}"), F.col("contig").alias(f"contig{k}"), F.col("pos").alias(f"pos{k}"), (F.col("id") % m == 0).alias(f"reverse{k}"), F.col("mapq").alias(f"mapq{k}"), F.col("bx").alias(f"bx{k}"))
    pairs = side(1, 2).join(side(2, 3), "qname").filter("id1 < id2").withColumns({"lane": F.col("bx1") % 4, "insert": F.abs(F.col("pos1") - F.col("pos2"))})
    return R.pair_counts(pairs, ["lane"], far=50_000, least=20)


@query(f"""WITH {READS}, b AS (SELECT s_suppkey AS name, k AS side, (s_suppkey + k) % 3 AS contig, s_suppkey * 2000 + k * 5000 AS s FROM supplier, range(1, 3) t(k)), h AS (SELECT name, side, avg(CASE WHEN (mapq - bx % 2 <> mapq) AND mapq >= 30 THEN 1.0 ELSE 0.0 END) AS f FROM b JOIN r ON r.contig = b.contig AND pos >= s AND pos < s + 900 WHERE NOT duplicate GROUP BY ALL)
SELECT s_suppkey AS name, round(CASE WHEN n = 2 THEN f ELSE 0 END, 8) AS share FROM supplier LEFT JOIN (SELECT name, count(*) AS n, max(f) AS f FROM h GROUP BY name) ON name = s_suppkey""")
def mapq_changed(spark, sf):
    sides = F.explode(F.array(F.lit(1), F.lit(2))).alias("side")
    breaks = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("name"), sides).select("name", "side", ((F.col("name") + F.col("side")) % 3).cast("long").alias("contig"), (F.col("name") * 2000 + F.col("side") * 5000).alias("start_r"), (F.col("name") * 2000 + F.col("side") * 5000 + 900).alias("end_r"))
    reads = _reads(spark, sf).withColumn("old_mapq", (F.col("mapq") - F.col("bx") % 2).cast("int"))
    return R.changed_share(breaks, reads, 30, 1024).withColumn("share", F.round(F.coalesce("share", F.lit(0.0)), 8))


@query(f"""WITH {READS}, g AS (SELECT s_suppkey AS name, s_suppkey % 3 AS contig, s_suppkey * 2000 AS s FROM supplier), c AS (SELECT name, pos, count(*) AS n FROM g JOIN r ON r.contig = g.contig AND (pos // 20) * 20 >= s AND (pos // 20) * 20 < s + 300 GROUP BY ALL), k AS (SELECT name, (pos // 20) * 20 AS pos, sum(n) AS n FROM c GROUP BY ALL),
z AS (SELECT name, p, coalesce(n, 0) AS n FROM (SELECT name, s + o AS p FROM g, range(0, 300) t(o)) LEFT JOIN k USING (name) WHERE k.pos = p OR k.pos IS NULL UNION ALL SELECT name, -1, 0 FROM g WHERE false)
SELECT g.name, coalesce(x.hits / 300.0 > 0.01, false) AS too_many FROM g LEFT JOIN (SELECT name, count(*) FILTER (n > 2) AS hits FROM k GROUP BY name) x USING (name)""")
def clipped_regions(spark, sf):
    regions = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("name"), (F.col("s_suppkey") % 3).cast("long").alias("contig"), (F.col("s_suppkey") * 2000).alias("start_r"), (F.col("s_suppkey") * 2000 + 300).alias("end_r"))
    clips = _reads(spark, sf).select("contig", (F.expr("pos div 20") * 20).alias("pos"))
    return R.clipped_regions(regions, clips, 2, 0.01, 256).select("name", "too_many")


@query("""WITH v AS (SELECT ['S','I','D','C'][l_linenumber % 4 + 1] AS kind, l_quantity::INT AS length, l_suppkey % 3 > 0 AS in_truth, l_partkey % 4 > 0 AS in_calls, l_discount < 0.08 AS passes, l_orderkey % 3 = 0 AS ti, l_orderkey % 3 = 1 AS tv, l_linestatus = 'O' AS ph, l_tax > 0.04 AS hi FROM lineitem),
x AS (SELECT v.*, k.variant, g.region, f.filter FROM v, (VALUES ('any'), ('snp'), ('insertion'), ('deletion'), ('complex'), ('insertion_lt5bp'), ('insertion_5_to_50bp'), ('deletion_lt5bp'), ('deletion_5_to_50bp')) k(variant), (VALUES ('all'), ('taxed')) g(region), (VALUES ('unfiltered'), ('filtered')) f(filter)
WHERE (region = 'all' OR hi) AND (variant = 'any' OR (variant = 'snp' AND kind = 'S') OR (variant = 'complex' AND kind = 'C') OR (starts_with(variant, 'insertion') AND kind = 'I' OR starts_with(variant, 'deletion') AND kind = 'D') AND (variant NOT LIKE '%lt5bp' OR length < 5) AND (variant NOT LIKE '%50bp' OR length BETWEEN 5 AND 50))),
c AS (SELECT *, in_calls AND (passes OR filter = 'unfiltered') AS call FROM x)
SELECT filter, variant, region, count(*) FILTER (call AND in_truth) AS tp, count(*) FILTER (call AND NOT in_truth) AS fp, count(*) FILTER (NOT call AND in_truth) AS fn, round(count(*) FILTER (call AND in_truth) / count(*) FILTER (in_truth), 8) AS sensitivity, round(count(*) FILTER (call AND in_truth) / count(*) FILTER (call), 8) AS ppv, round(count(*) FILTER (call AND ti) / count(*) FILTER (call AND tv), 8) AS titv, round(count(*) FILTER (call AND ph) / count(*) FILTER (call), 8) AS phased FROM c GROUP BY ALL""")
def variant_statistics(spark, sf):
    kind = F.element_at(F.array(*map(F.lit, "SIDC")), (F.col("l_linenumber") % 4 + 1).cast("int"))
    rows = table(spark, sf, "lineitem").select(kind.alias("kind"), F.col("l_quantity").cast("int").alias("length"), (F.col("l_suppkey") % 3 > 0).alias("in_truth"), (F.col("l_partkey") % 4 > 0).alias("in_calls"), (F.col("l_discount") < 0.08).alias("passes"), (F.col("l_orderkey") % 3 == 0).alias("ti"), (F.col("l_orderkey") % 3 == 1).alias("tv"), (F.col("l_linestatus") == "O").alias("is_phased"), (F.col("l_tax") > 0.04).alias("hi"))
    out = R.variant_statistics(rows, {"taxed": F.col("hi")})
    return out.withColumns({c: F.round(c, 8) for c in ("sensitivity", "ppv", "titv", "phased")})


@query(f"""WITH {READS}, g AS (SELECT s_suppkey AS gene, s_suppkey % 3 AS contig, s_suppkey * 2000 AS s FROM supplier), h AS (SELECT gene, qname % 5 AS ps, mapq > 10 AS ph, bx % 3 AS parity FROM g JOIN r ON r.contig = g.contig AND pos >= s AND pos < s + 1500 WHERE qname % 5 <> 4),
b AS (SELECT gene, ps, count(*) AS n, count(*) FILTER (ph) AS p, count(*) FILTER (parity = 0) AS c0, count(*) FILTER (parity = 1) AS c1 FROM h GROUP BY ALL)
SELECT gene, sum(n)::BIGINT AS variants, count(*) AS blocks, count(*) = 1 AS phased, round(sum(p * (p - 1) / 2) / (sum(n) * (sum(n) - 1) / 2), 8) AS pair_phased, coalesce(round(sum(c0 * (c0 - 1) / 2 + c1 * (c1 - 1) / 2) / nullif(sum((c0 + c1) * (c0 + c1 - 1) / 2), 0), 8), -1) AS pair_correct FROM b GROUP BY gene HAVING sum(n) > 1""")
def gene_phasing(spark, sf):
    genes = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("gene"), (F.col("s_suppkey") % 3).cast("long").alias("contig"), (F.col("s_suppkey") * 2000).alias("start_r"), (F.col("s_suppkey") * 2000 + 1500).alias("end_r"))
    rows = _reads(spark, sf).select("contig", "pos", F.when(F.col("qname") % 5 != 4, F.col("qname") % 5).alias("ps"), (F.col("mapq") > 10).alias("is_phased"), (F.col("bx") % 3).alias("parity"))
    out = R.gene_phasing(rows, genes, 1024)
    return out.withColumns({"pair_phased": F.round("pair_phased", 8), "pair_correct": F.coalesce(F.round("pair_correct", 8), F.lit(-1.0))})


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 20 ORDER BY n DESC, l_partkey LIMIT 1500")
def common_parts(spark, sf):
    return R.common_keys(table(spark, sf, "lineitem"), "l_partkey", 20)
