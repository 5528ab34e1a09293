"""Queries on records against regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.functions.sequence import gc_share
from strandline.operators import intervals as I
from strandline.operators import targets as T
from strandline.plans.base import ITEMS, code, code_sql, items, query, table
from strandline.plans.intervals import B, DEPTH, SIDES, _sides


def _regions(spark, sf):
    merged = I.merge(_sides(spark, sf)[1].select("contig", F.col("start_r").alias("start"), F.col("end_r").alias("end")), "contig", tile=512)
    return merged.select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"))


@query(f"""WITH {SIDES}, {B}, c AS (SELECT a.id, a.start AS x, a."end" AS y, min(s) FILTER (s < a."end" AND e > a.start) AS o, max(e) FILTER (e <= a.start) AS l, min(s) FILTER (s >= a."end") AS r FROM a JOIN b_m ON a.contig = b_m.contig GROUP BY ALL)
SELECT id, coalesce(o, -1) AS overlaps, CASE WHEN o IS NOT NULL THEN 0 ELSE coalesce(least(x - l, r - y), -1) END AS nearest, CASE WHEN o IS NOT NULL THEN 0 ELSE coalesce(x - l, -1) END AS to_left, CASE WHEN o IS NOT NULL THEN 0 ELSE coalesce(r - y, -1) END AS to_right FROM c""")
def nearest_intervals(spark, sf):
    out = T.nearest_intervals(_sides(spark, sf)[0], _regions(spark, sf), ["contig"], 512).filter("nearest is not null")
    return out.select("id", F.coalesce("overlaps.start", F.lit(-1)).alias("overlaps"), *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("nearest", "to_left", "to_right")])


def _records(spark, sf):
    return items(spark, sf).filter("flag = 'R'").select("contig", "id", F.col("start").alias("pos"), (F.col("end") - F.col("start")).alias("length"))


@query(f'WITH {SIDES}, {B} SELECT id FROM a WHERE EXISTS (SELECT 1 FROM b_m WHERE a.contig = b_m.contig AND (a.start >= s AND a.start < e OR a."end" >= s AND a."end" < e))')
def records_touching_targets(spark, sf):
    return T.on_targets(_records(spark, sf), _regions(spark, sf), "contig", ["id"], False, 64).select("id")


@query(f'WITH {SIDES}, {B} SELECT id FROM a WHERE EXISTS (SELECT 1 FROM b_m WHERE a.contig = b_m.contig AND a.start >= s AND a.start < e AND a."end" < e)')
def records_within_targets(spark, sf):
    return T.on_targets(_records(spark, sf), _regions(spark, sf), "contig", ["id"], True, 64).select("id")


@query(f"""WITH {ITEMS}, v AS (SELECT contig, id, start, "end", CASE WHEN id % 3 > 0 THEN id % 3 END AS ps FROM items WHERE flag = 'R'), f AS (SELECT contig, start AS s, "end" AS e, id % 4 AS ps, price FROM items WHERE flag = 'A')
SELECT v.id, count(*) AS n, round(sum(f.price), 2) AS mass FROM v JOIN f ON v.contig = f.contig AND v.start < f.e AND f.s < v."end" + 1 AND (v.ps IS NULL OR v.ps = f.ps) GROUP BY v.id""")
def variant_fragments(spark, sf):
    own = items(spark, sf)
    variants = own.filter("flag = 'R'").select("contig", "id", "start", "end", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("ps"))
    fragments = own.filter("flag = 'A'").select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"), (F.col("id") % 4).alias("ps_r"), "price")
    return T.fragments_at(variants, fragments, "contig", 8).groupBy("id").agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("mass"))


@query(f"""WITH {ITEMS}, b AS (SELECT s_suppkey AS name, s_suppkey AS c1, 300 AS s1, 310 AS e1, (s_suppkey * 7) % 50 + 1 AS c2, 900 AS s2, 905 AS e2 FROM supplier), r AS (SELECT contig, start, "end" AS e, id // 10 % 1000000 AS key FROM items),
k AS (SELECT key, count(*) / (SELECT count(*) FROM r) AS share FROM r GROUP BY key), h AS (SELECT name, 1 AS side, key FROM b JOIN r ON contig = c1 AND start < e1 + 40 AND s1 - 60 < e UNION ALL SELECT name, 2, key FROM b JOIN r ON contig = c2 AND start < e2 + 40 AND s2 - 60 < e),
e AS (SELECT name, key, count(*) FILTER (side = 1) AS r1, count(*) FILTER (side = 2) AS r2 FROM h GROUP BY ALL), s AS (SELECT name, count(*) FILTER (r1 > 0) AS n1, count(*) FILTER (r2 > 0) AS n2, count(*) FILTER (r1 > 0 AND r2 > 0) AS shared, sum(r1)::BIGINT AS reads1, sum(r2)::BIGINT AS reads2 FROM e GROUP BY name),
c AS (SELECT name, sum(log10(1 - pow(1 - share, greatest(n1, n2)))) AS p FROM e JOIN k USING (key) JOIN s USING (name) WHERE r1 > 0 AND r2 > 0 GROUP BY name)
SELECT name, coalesce(n1, 0) AS n1, coalesce(n2, 0) AS n2, coalesce(shared, 0) AS shared, coalesce(reads1, 0) AS reads1, coalesce(reads2, 0) AS reads2, round(coalesce(c.p, 0), 5) AS log10_empirical,
round(CASE WHEN coalesce(shared, 0) > 0 AND shared < n1 THEN log10(list_sum(list_transform(range(shared + 1, n1 + 1), lambda i: exp(lgamma(n1 + 1) - lgamma(i + 1) - lgamma(n1 - i + 1) + i * ln(n2 / 1000000.0) + (n1 - i) * ln(1 - n2 / 1000000.0))))) ELSE 0 END, 5) AS log10_binomial
FROM b LEFT JOIN s USING (name) LEFT JOIN c USING (name)""")
def keys_around_breaks(spark, sf):
    breaks = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("name"), F.col("s_suppkey").alias("chrom1"), F.lit(300).alias("start1"), F.lit(310).alias("stop1"), (F.col("s_suppkey") * 7 % 50 + 1).alias("chrom2"), F.lit(900).alias("start2"), F.lit(905).alias("stop2"))
    reads = items(spark, sf).select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"), (F.floor(F.col("id") / 10) % 1000000).alias("key"))
    keys = reads.groupBy("key").agg(F.count("*").alias("n")).join(F.broadcast(reads.agg(F.count("*").alias("all")))).select("key", (F.col("n") / F.col("all")).alias("share"))  # one row
    out = T.keys_around_breaks(breaks, reads, keys, 60, 40, 1_000_000, 64)
    bounded = F.when(F.col("log10_binomial") > float("-inf"), F.col("log10_binomial"))
    return out.withColumns({"log10_empirical": F.round(F.coalesce("log10_empirical", F.lit(0.0)), 5), "log10_binomial": F.round(F.coalesce(bounded, F.lit(0.0)), 5)})


@query(f"""WITH {ITEMS}, f AS (SELECT id, contig, start AS s1, "end" AS e1, start + 500 AS s2, "end" + 500 AS e2 FROM items), t AS (SELECT DISTINCT s_suppkey AS contig, x * 90 AS s FROM supplier, range(0, 40) r(x))
SELECT a.s AS left_target, b.s AS right_target, count(*) AS n FROM f JOIN t a ON f.contig = a.contig AND s1 < a.s + 90 AND a.s < e1 JOIN t b ON f.contig = b.contig AND s2 < b.s + 90 AND b.s < e2 GROUP BY ALL""")
def target_pairs(spark, sf):
    own = items(spark, sf)
    linked = own.select(F.struct("id", "contig", "start", "end", "price").alias("id"), F.col("contig").alias("contig1"), F.col("start").alias("start1"), F.col("end").alias("end1"), F.col("contig").alias("contig2"), (F.col("start") + 500).alias("start2"), (F.col("end") + 500).alias("end2"))
    tiles = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(39 * 90).cast("long"), F.lit(90).cast("long"))).alias("target"))
    return T.target_pairs(linked, tiles.withColumns({"start_r": F.col("target"), "end_r": F.col("target") + 90}), ["id"], 64)


@query(f"""WITH {ITEMS}, x AS (SELECT s_suppkey AS contig, k AS exon, k * 200 AS s, k * 200 + 60 AS e FROM supplier, range(0, 12) r(k)), c AS (SELECT x.contig, exon, count(*) AS total, count(*) FILTER (flag <> 'N') AS phased FROM x JOIN items i ON i.contig = x.contig AND i.start >= s AND i.start < e GROUP BY ALL)
SELECT x.contig, x.exon::INT AS exon, coalesce(total, 0) AS total, coalesce(phased, 0) AS phased, round(coalesce(phased / total, -1), 6) AS share FROM x LEFT JOIN c USING (contig, exon)""")
def exon_phasing(spark, sf):
    k = F.col("exon")
    exons = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("exon")).withColumns({"start_r": k * 200, "end_r": k * 200 + 60})
    variants = items(spark, sf).select("contig", F.col("start").alias("pos"), (F.col("flag") != "N").alias("phased"))
    return T.exon_phasing(variants, exons, "contig", ["contig", "exon"], 64).select("contig", "exon", "total", "phased", F.round(F.coalesce("share", F.lit(-1.0)), 6).alias("share"))


DEPTHS = DEPTH + ", dr AS (SELECT * FROM dp WHERE depth <> 0)"


@query(f"""WITH {DEPTHS}, bt AS (SELECT s_suppkey AS contig, s_suppkey * 3 AS s, s_suppkey * 3 + 120 AS e, {code_sql('s_suppkey', 30, 'g')} AS seq FROM supplier), m AS (SELECT bt.contig, sum((least(bt.e, d."end") - greatest(bt.s, d.start)) * depth) / 120.0 AS mean FROM bt JOIN dr d ON d.contig = bt.contig AND d.start < bt.e AND bt.s < d."end" GROUP BY ALL)
SELECT bt.contig, round(coalesce(mean, 0), 6) AS mean, round((length(seq) - length(translate(seq, 'GC', ''))) / 30, 6) AS gc FROM bt LEFT JOIN m USING (contig)""")
def bait_coverage(spark, sf):
    k = F.col("s_suppkey")
    baits = table(spark, sf, "supplier").select(k.alias("contig"), (k * 3).alias("start"), (k * 3 + 120).alias("end"), code(k, 30, "g").alias("seq"))
    out = T.mean_depths(baits, {"mean": I.depth(items(spark, sf), "contig", tile=256)}, "contig", ["contig"], 64)
    return out.select("contig", F.round("mean", 6).alias("mean"), F.round(gc_share(F.col("seq")), 6).alias("gc"))


@query(f"""WITH {ITEMS}, r AS (SELECT contig, start, "end" AS e, CASE flag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 0 END AS hp, c AS cutoff FROM items, (VALUES (0), (30)) v(c) WHERE "end" - start >= c),
st AS (SELECT contig, cutoff, hp, pos, sum(d) AS d FROM (SELECT contig, cutoff, hp, start AS pos, 1 AS d FROM r WHERE start < e UNION ALL SELECT contig, cutoff, hp, e, -1 FROM r WHERE start < e) GROUP BY ALL HAVING sum(d) <> 0),
dp AS (SELECT contig, cutoff, hp, pos AS start, lead(pos) OVER w AS "end", (sum(d) OVER (PARTITION BY contig, cutoff, hp ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT AS depth FROM st WINDOW w AS (PARTITION BY contig, cutoff, hp ORDER BY pos))
SELECT contig, cutoff, hp, start, "end", depth FROM dp WHERE depth <> 0""")
def haplotype_depth(spark, sf):
    hp = F.when(F.col("flag") == "R", 1).when(F.col("flag") == "A", 2).otherwise(0)
    reads = items(spark, sf).select("contig", "start", "end", hp.alias("hp"), (F.col("end") - F.col("start")).alias("mapq"))
    return T.haplotype_depth(reads, ["contig"], [0, 30], 256)


@query(f"""WITH {DEPTH}, h AS (SELECT contig, start, "end" AS e FROM dp WHERE depth > 8), g AS (SELECT *, sum(CASE WHEN start <= p THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY start ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, lag(e) OVER (PARTITION BY contig ORDER BY start) AS p FROM h))
SELECT contig, min(start) AS start, max(e) AS "end" FROM g GROUP BY contig, k""")
def high_depth_regions(spark, sf):
    return T.excluded(I.depth(items(spark, sf), "contig", tile=256), ["contig"], 8, 512)


@query(f"""WITH {DEPTHS}, c AS (SELECT s_suppkey AS contig, 400 + s_suppkey % 90 AS s, 460 + s_suppkey % 130 AS e FROM supplier), w AS (SELECT contig, greatest(s - 20, 0) AS a, e + 20 AS z, (e - s) // 2 AS h FROM c),
pos AS (SELECT contig, p, 'in' AS side FROM w, unnest(range(a, z)) t(p) UNION ALL SELECT contig, p, 'out' FROM w, unnest(range(greatest(a - h, 0), a)) t(p) UNION ALL SELECT contig, p, 'out' FROM w, unnest(range(z, z + h)) t(p)),
cv AS (SELECT pos.contig, p, side, coalesce(max(depth), 0) AS depth FROM pos LEFT JOIN dr ON dr.contig = pos.contig AND dr.start <= p AND p < dr."end" GROUP BY ALL),
md AS (SELECT contig, median(depth) FILTER (side = 'in') AS i, median(depth) FILTER (side = 'out') AS o FROM cv GROUP BY contig),
bn AS (SELECT contig, p // 10 AS bin, avg(depth) AS mean FROM cv WHERE side = 'in' GROUP BY ALL), ar AS (SELECT contig, list(mean ORDER BY bin) AS b, median(mean) AS middle FROM bn GROUP BY contig)
SELECT contig, NOT (i < 0.6 * o OR i > 1.4 * o) AND len(b) > 4 AND greatest(b[1], b[2], b[-1], b[-2]) > 1.2 * middle AS pileup FROM ar JOIN md USING (contig)""")
def pileup_filter(spark, sf):
    k = F.col("s_suppkey")
    calls = table(spark, sf, "supplier").select(k.alias("contig"), (k % 90 + 400).alias("start"), (k % 130 + 460).alias("end"))
    return T.pileups(calls, I.depth(items(spark, sf), "contig", tile=256), "contig", ["contig"], 20, 10, 1.2, 0.6, 1.4, 64).select("contig", "pileup")


@query("""WITH c AS (SELECT c_custkey AS contig, 1000 + c_custkey % 500 AS length FROM customer), l AS (SELECT contig, sum(length - 99) OVER (ORDER BY contig ROWS UNBOUNDED PRECEDING)::BIGINT AS stop, length - 99 AS n FROM c),
d AS (SELECT k, ('0x' || substr(md5('5:' || k::VARCHAR), 1, 15))::BIGINT % (SELECT max(stop) FROM l) AS place FROM range(0, 3000) r(k)) SELECT k, contig, place - (stop - n) AS start, place - (stop - n) + 100 AS "end" FROM d JOIN l ON place >= stop - n AND place < stop""")
def random_windows(spark, sf):
    contigs = table(spark, sf, "customer").select(F.col("c_custkey").alias("contig"), (F.col("c_custkey") % 500 + 1000).alias("length"))
    return T.random_windows(contigs, 3000, 100, 5)
