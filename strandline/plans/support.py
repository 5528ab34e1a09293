"""Queries on evidence for calls and states."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import support as S
from strandline.plans.base import ITEMS, code, code_sql, items, query, table


@query(f"""WITH {ITEMS}, b AS (SELECT s_suppkey AS name, s_suppkey AS c1, 400 AS p1, (s_suppkey * 3) % 50 + 1 AS c2, 800 AS p2 FROM supplier), r AS (SELECT contig, start, "end" AS e, id // 10 % 40 AS key FROM items),
h AS (SELECT name, 1 AS side, key, start, e FROM b JOIN r ON contig = c1 AND start < p1 + 90 AND p1 - 90 < e UNION ALL SELECT name, 2, key, start, e FROM b JOIN r ON contig = c2 AND start < p2 + 90 AND p2 - 90 < e),
s AS (SELECT *, sum(CASE WHEN start - p <= 30 THEN 0 ELSE 1 END) OVER (PARTITION BY name, side, key ORDER BY start, e ROWS UNBOUNDED PRECEDING) AS molecule FROM (SELECT *, lag(start) OVER (PARTITION BY name, side, key ORDER BY start, e) AS p FROM h))
SELECT name, side, key, molecule::BIGINT AS molecule, min(start) AS start, max(e) AS "end", count(*) AS n FROM s GROUP BY ALL HAVING count(*) >= 2""")
def molecules_at_breaks(spark, sf):
    k = F.col("s_suppkey")
    breaks = table(spark, sf, "supplier").select(k.alias("name"), k.alias("contig1"), F.lit(400).alias("pos1"), (k * 3 % 50 + 1).alias("contig2"), F.lit(800).alias("pos2"))
    reads = items(spark, sf).select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"), (F.floor(F.col("id") / 10) % 40).alias("key"))
    return S.molecules_at_breaks(breaks, reads, 90, 30, 2, 64, 256)


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey AS contig, CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 40 END AS variant, l_quantity AS score FROM lineitem), c AS (SELECT contig, variant, count(*) AS n FROM r WHERE variant IS NOT NULL GROUP BY ALL)
SELECT l_orderkey, l_linenumber, score, greatest(score, coalesce(CASE WHEN n >= 3 THEN least(score + 2.0 * (n - 1), 60.0) END, score)) AS rescued FROM r LEFT JOIN c USING (contig, variant)""")
def rescued_scores(spark, sf):
    reads = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("contig"), F.when(F.col("l_partkey") % 3 > 0, F.col("l_partkey") % 40).alias("variant"), F.col("l_quantity").alias("score"))
    return S.rescued(reads, 3, 2.0, 60.0).select("l_orderkey", "l_linenumber", "score", "rescued")


@query(f"""WITH a AS (SELECT DISTINCT {code_sql('p_partkey', 7, 'e')} AS key FROM part), n AS (SELECT DISTINCT key, substr(key, 1, i - 1) || c || substr(key, i + 1) AS wrong FROM a, range(1, 8) r(i), (VALUES ('A'), ('C'), ('G'), ('T')) v(c)
UNION SELECT key, substr(key, 1, i - 1) || substr(key, i + 1) || c FROM a, range(1, 8) r(i), (VALUES ('A'), ('C'), ('G'), ('T')) v(c) UNION SELECT key, substr(key, 1, i - 1) || c || substr(key, i, 7 - i) FROM a, range(1, 8) r(i), (VALUES ('A'), ('C'), ('G'), ('T')) v(c))
SELECT wrong, min(key) AS key FROM n WHERE wrong NOT IN (SELECT key FROM a) GROUP BY wrong HAVING min(key) = max(key)""")
def error_tables(spark, sf):
    return S.error_table(table(spark, sf, "part").select(code(F.col("p_partkey"), 7, "e").alias("key")), indel=True).select("wrong", "key")


@query(f"""WITH {ITEMS}, x AS (SELECT contig, start, "end" AS e, id % 7 + 1 AS n, unnest(range(start // 25, ("end" - 1) // 25 + 1)) AS bin FROM items) SELECT contig, bin, round(sum(n * (least(e, (bin + 1) * 25) - greatest(start, bin * 25)) / (e - start)), 6) AS n FROM x GROUP BY ALL""")
def fractional_bins(spark, sf):
    own = items(spark, sf).select("contig", "start", "end", (F.col("id") % 7 + 1).alias("n"))
    return S.bin_shares(own, ["contig"], 25, "n").withColumn("n", F.round("n", 6))


RATES = [1.5, 3.0, 4.5, 6.0]


@query(f"""WITH {ITEMS}, b AS (SELECT contig, start // 30 * 30 AS s, count(*) AS n FROM items GROUP BY ALL), v AS (SELECT s_suppkey AS contig, k * 400 AS s, k * 400 + 300 AS e, k FROM supplier, range(0, 6) r(k)),
l AS (SELECT v.contig, v.k, i - 1 AS state, sum(-({RATES})[i] + n * ln(({RATES})[i]) - lgamma(n + 1)) AS ll FROM v JOIN b ON v.contig = b.contig AND v.s < b.s + 30 AND b.s < v.e, range(1, 5) r(i) GROUP BY ALL)
SELECT contig, k::INT AS k, arg_max(state, (ll, -state))::INT AS state, round(2 * (list(ll ORDER BY ll DESC)[1] - list(ll ORDER BY ll DESC)[2]), 4) AS twice FROM l GROUP BY ALL""")
def interval_significance(spark, sf):
    bins = items(spark, sf).groupBy("contig", (F.floor(F.col("start") / 30) * 30).alias("start_r")).agg(F.count("*").alias("n")).withColumn("end_r", F.col("start_r") + 30)
    k = F.col("k")
    own = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k")).withColumns({"start": k * 400, "end": k * 400 + 300})
    return S.interval_significance(bins, own, "contig", ["contig", "k"], RATES, 64).select("contig", "k", "state", F.round("twice", 4).alias("twice"))


@query("""WITH s AS (SELECT DISTINCT l_partkey // 10 AS edge, l_suppkey AS key FROM lineitem) SELECT edge, count(*) FILTER (coalesce(hp, 0) = 0) AS unphased, count(*) FILTER (hp = 1) AS one, count(*) FILTER (hp = 2) AS two FROM s LEFT JOIN (SELECT s_suppkey AS key, s_suppkey % 3 AS hp FROM supplier WHERE s_suppkey % 5 > 0) USING (key) GROUP BY edge""")
def haplotypes_of_edges(spark, sf):
    own = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("kmer"), F.col("l_suppkey").alias("key")).distinct()
    edges = own.select("kmer").distinct().select(F.floor(F.col("kmer") / 10).alias("edge"), "kmer")
    haplotypes = table(spark, sf, "supplier").filter("s_suppkey % 5 > 0").select(F.col("s_suppkey").alias("key"), (F.col("s_suppkey") % 3).alias("hp"))
    return S.haplotypes_of_edges(edges, own, haplotypes)


@query("""WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey % 8 AS lane, 1000 + (l_linenumber % 3 + 1) * 100 + l_partkey % 16 + 1 AS tile, l_partkey AS x, l_quantity AS y FROM lineitem), e AS (SELECT lane, min(x) AS x0, max(x) - min(x) + 1 AS w, min(y) AS y0, max(y) - min(y) + 1 AS h FROM r GROUP BY lane)
SELECT l_orderkey, l_linenumber, tile, x, (tile // 100 % 10 - 1) * w + x - x0 AS lane_x, (tile % 100 - 1) * h + y - y0 AS lane_y FROM r JOIN e USING (lane)""")
def lane_places(spark, sf):
    reads = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 8).alias("lane"), (F.lit(1001) + (F.col("l_linenumber") % 3 + 1) * 100 + F.col("l_partkey") % 16).alias("tile"), F.col("l_partkey").alias("x"), F.col("l_quantity").alias("y"))
    return S.lane_places(reads, ["lane"]).select("l_orderkey", "l_linenumber", "tile", "x", "lane_x", "lane_y")


@query("""WITH t AS (SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k, sum(o_totalprice) OVER (PARTITION BY o_custkey) AS s FROM orders) SELECT o_custkey, max(o_totalprice) AS first, count(*) AS n, round(sum(o_totalprice) / max(s), 6) AS share FROM t WHERE k <= 3 GROUP BY o_custkey""")
def top_contributions(spark, sf):
    out = S.top_contributions(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", 3, ["o_orderkey"])
    return out.select("o_custkey", F.get("top", 0).alias("first"), F.size("top").cast("long").alias("n"), F.round("share", 6).alias("share"))
