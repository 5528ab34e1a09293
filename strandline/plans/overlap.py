"""Queries on shared keys, windows and discretised coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import intervals as I
from strandline.operators import overlap as O
from strandline.operators import sessions as S
from strandline.plans.base import ITEMS, items, query, table
from strandline.plans.intervals import DEPTH


@query("SELECT s AS contig, s % 10 AS cluster FROM (SELECT DISTINCT l_suppkey AS s FROM lineitem) QUALIFY count(*) OVER (PARTITION BY s % 10) > 1")
def coalesced_suppliers(spark, sf):
    own = items(spark, sf).select("contig", F.concat((F.col("contig") % 10).cast("string"), F.lit(":"), F.floor(F.col("start") / 7).cast("string")).alias("bin"))
    return O.coalesced(own, "contig", "bin", 1e-3, 1)


@query("""WITH w AS (SELECT DISTINCT date_diff('day', DATE '1992-01-01', o_orderdate::DATE)::BIGINT // 30 AS w, o_custkey AS k FROM orders), s AS (SELECT w, count(*) AS n FROM w GROUP BY 1), p AS (SELECT a.w AS a, b.w AS b, count(*) AS n FROM w a JOIN w b ON a.k = b.k AND a.w < b.w GROUP BY ALL HAVING count(*) >= 15)
SELECT a, b, n, round(log10(t), 5) AS log10_p FROM (SELECT a, b, p.n, list_sum(list_transform(range(p.n, least(x.n, y.n) + 1), lambda i: exp(lgamma(least(x.n, y.n) + 1) - lgamma(i + 1) - lgamma(least(x.n, y.n) - i + 1) + i * ln(greatest(x.n, y.n) / 20000.0) + (least(x.n, y.n) - i) * ln(1 - greatest(x.n, y.n) / 20000.0)))) AS t
FROM p JOIN s x ON x.w = a JOIN s y ON y.w = b WHERE b - a >= 2) WHERE log10(t) <= -8""")
def window_overlaps(spark, sf):
    day = F.datediff(F.col("o_orderdate"), F.lit("1992-01-01")).cast("long")
    own = table(spark, sf, "orders").select(F.floor(day / 30).alias("w"), F.col("o_custkey").alias("k"))
    return O.window_overlaps(own, "w", "k", 20_000, -8, 15, 2).withColumn("log10_p", F.round("log10_p", 5))


@query("WITH c AS (SELECT l_quantity AS v, count(*) AS n FROM lineitem GROUP BY 1) SELECT v, n, round(CASE WHEN c < t THEN ln(1 - c / t) ELSE 1 END, 8) AS log_survival FROM (SELECT *, sum(n) OVER (ORDER BY v) AS c, sum(n) OVER () AS t FROM c)")
def quantity_survival(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy(F.col("l_quantity").alias("v")).agg(F.count("*").alias("n"))
    return O.survival(counts, "v").withColumn("log_survival", F.round(F.coalesce("log_survival", F.lit(1.0)), 8))


@query("WITH l AS (SELECT l_quantity::BIGINT AS length, count(*) AS n FROM lineitem GROUP BY 1) SELECT d AS distance, round(sum(greatest(length - d, 0) * n) / sum(length * n), 8) AS share FROM l, range(0, 50, 5) t(d) GROUP BY d")
def expected_reach(spark, sf):
    lengths = table(spark, sf, "lineitem").groupBy(F.col("l_quantity").cast("long").alias("length")).agg(F.count("*").alias("n"))
    return O.expected_share(lengths, F.sequence(F.lit(0).cast("long"), F.lit(45).cast("long"), F.lit(5).cast("long"))).withColumn("share", F.round("share", 8))


EDGES = O.harmonic_edges(1000, 2.0)
MIDDLES = [0] + [round((a + b) / 2) for a, b in zip(EDGES, EDGES[1:], strict=False)]


@query(f"""WITH {DEPTH}, v AS (SELECT contig, start, ({MIDDLES})[len(list_filter({EDGES}, lambda e: e < least(depth, 1000))) + 1] AS v FROM dp WHERE depth <> 0),
r AS (SELECT *, sum(CASE WHEN v IS NOT DISTINCT FROM p AND k > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY start) AS run FROM (SELECT *, lag(v) OVER w AS p, row_number() OVER w AS k FROM v WINDOW w AS (PARTITION BY contig ORDER BY start)))
SELECT contig, run::BIGINT AS run, any_value(v)::BIGINT AS v, count(*) AS n, min(start) AS first, max(start) AS last FROM r GROUP BY contig, run""")
def zoomable_coverage(spark, sf):
    runs = I.depth(items(spark, sf), "contig", tile=256).select("contig", "start", O.discretised(F.col("depth"), 1000, 2.0).cast("long").alias("v"))
    return S.run_lengths(runs, ["contig"], ["start"], "v", 256)


@query(f"""WITH {ITEMS}, b AS (SELECT contig, start // 30 AS bin, count(*) AS n, avg(id % 97) AS score FROM items GROUP BY ALL), m AS (SELECT contig, start // 30 // 4 AS bin, count(DISTINCT id % 1000) AS molecules FROM items GROUP BY ALL)
SELECT contig, bin, molecules, sum(n)::BIGINT AS n, round(avg(score), 6) AS score FROM (SELECT contig, bin // 4 AS bin, n, score FROM b) JOIN m USING (contig, bin) GROUP BY ALL""")
def merged_bins(spark, sf):
    bins = items(spark, sf).groupBy("contig", F.floor(F.col("start") / 30).alias("bin")).agg(F.collect_set(F.col("id") % 1000).alias("molecules"), F.count("*").alias("n"), F.avg(F.col("id") % 97).alias("score"))
    return O.merged_bins(bins, ["contig"], 4).withColumns({"score": F.round("score", 6), "molecules": F.col("molecules").cast("long")})
