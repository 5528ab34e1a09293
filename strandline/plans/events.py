"""Queries on copy-number and break events."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import events as E
from strandline.plans.base import ITEMS, items, query
from strandline.plans.matching import _ordered, _svs, _svs_sql


@query(f"""WITH {ITEMS}, b AS (SELECT contig, start // 30 AS bin, count(*) AS n, sum("end" - start)::BIGINT AS size FROM items GROUP BY ALL)
SELECT contig, bin, round(coalesce((coalesce(sum(n) OVER p, 0) + coalesce(sum(n) OVER f, 0)) / nullif(coalesce(sum(size) OVER p, 0) + coalesce(sum(size) OVER f, 0), 0) * size, -1), 6) AS expected FROM b
WINDOW p AS (PARTITION BY contig ORDER BY bin ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), f AS (PARTITION BY contig ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)""")
def flanking_background(spark, sf):
    bins = items(spark, sf).groupBy("contig", F.floor(F.col("start") / 30).alias("bin")).agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("size"))
    return E.background(bins, ["contig"], "bin", "n", 30, 3).select("contig", "bin", F.round(F.coalesce("expected", F.lit(-1.0)), 6).alias("expected"))


@query(f"""WITH {ITEMS}, b AS (SELECT contig, start // 90 AS bin, count(*) FILTER (flag = 'R') AS r, count(*) FILTER (flag = 'A') AS a FROM items GROUP BY ALL)
SELECT contig, bin, round(1e-9 + CASE WHEN r + a = 0 THEN 1 ELSE least(1, 2 * list_sum(list_transform(range(0, least(r, a) + 1), lambda k: exp(lgamma(r + a + 1) - lgamma(k + 1) - lgamma(r + a - k + 1) - (r + a) * ln(2))))) END, 6) AS p FROM b""")
def haplotype_parity(spark, sf):
    n = lambda f: F.count(F.when(F.col("flag") == f, 1)).alias(f.lower())
    bins = items(spark, sf).groupBy("contig", F.floor(F.col("start") / 90).alias("bin")).agg(n("R"), n("A"))
    return bins.select("contig", "bin", F.round(E.parity(F.col("r"), F.col("a")) + 1e-9, 6).alias("p"))


EV = f'{ITEMS}, c AS (SELECT * FROM items WHERE flag = \'R\'), t AS (SELECT * FROM items WHERE flag = \'A\')'


@query(f"""WITH {EV}, s AS (SELECT (SELECT count(*) FROM c) AS nc, (SELECT count(*) FROM t) AS nt, (SELECT count(*) FROM c WHERE EXISTS (SELECT 1 FROM t WHERE t.contig = c.contig AND t.start < c."end" AND c.start < t."end")) AS tp, (SELECT count(*) FROM t WHERE NOT EXISTS (SELECT 1 FROM c WHERE t.contig = c.contig AND t.start < c."end" AND c.start < t."end")) AS fn)
SELECT tp, nc - tp AS fp, fn, round((nt - fn) / nt, 8) AS sensitivity, round(tp / nc, 8) AS ppv FROM s""")
def event_truth(spark, sf):
    own = items(spark, sf)
    out = E.truth_status(own.filter("flag = 'R'"), own.filter("flag = 'A'"), ["id"], 8)
    return out.withColumns({c: F.round(c, 8) for c in ("sensitivity", "ppv")})


@query(f"""WITH {EV} SELECT id, array_to_string(list_filter([CASE WHEN price < 20000 THEN 'CHEAP' END, CASE WHEN "end" - start > 40 THEN 'LONG' END, CASE WHEN EXISTS (SELECT 1 FROM t WHERE t.contig = c.contig AND t.start < c."end" AND c.start < t."end") THEN 'BLACK' END], lambda x: x IS NOT NULL), ';') AS filters FROM c""")
def event_filters(spark, sf):
    own = items(spark, sf)
    track = own.filter("flag = 'A'").select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    rules = {"CHEAP": F.col("price") < 20000, "LONG": F.col("end") - F.col("start") > 40}
    return E.passing(own.filter("flag = 'R'"), rules, {"BLACK": track}, ["id"], 8).select("id", F.array_join("filters", ";").alias("filters"))


MATCH = "(SELECT DISTINCT y.name AS truth FROM {c} x JOIN {t} y ON x.c1 = y.c1 AND x.c2 = y.c2 AND x.s1 < y.e1 AND y.s1 < x.e1 AND x.s2 < y.e2 AND y.s2 < x.e2)"


@query(f"WITH {ITEMS}, {_svs_sql('one', 'R')}, {_svs_sql('two', 'N')}, {_svs_sql('truth', 'A')} SELECT t.name AS truth, a.truth IS NOT NULL AS in_one, b.truth IS NOT NULL AS in_two FROM truth t LEFT JOIN {MATCH.format(c=_ordered('one', 2), t=_ordered('truth', 0))} a ON a.truth = t.name LEFT JOIN {MATCH.format(c=_ordered('two', 2), t=_ordered('truth', 0))} b ON b.truth = t.name")
def compared_samples(spark, sf):
    return E.compared({"one": _svs(spark, sf, "R"), "two": _svs(spark, sf, "N")}, _svs(spark, sf, "A"), 2, 8)


@query(f"WITH {EV} SELECT c.id, sum(least(c.\"end\", t.\"end\") - greatest(c.start, t.start))::BIGINT AS shared FROM c JOIN t ON t.contig = c.contig AND t.start < c.\"end\" AND c.start < t.\"end\" GROUP BY c.id")
def shared_bases(spark, sf):
    own = items(spark, sf)
    right = own.filter("flag = 'A'").select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    return E.shared_bases(own.filter("flag = 'R'"), right, "contig", ["id"], 8)


@query(f"""WITH {ITEMS}, {_svs_sql('calls', 'R')}, t AS (SELECT name, chrom1 AS contig, start1 AS s, stop1 AS e FROM calls UNION ALL SELECT name, chrom2, start2, stop2 FROM calls), d AS (SELECT DISTINCT contig, s, e FROM t),
g AS (SELECT *, sum(CASE WHEN s > reach + 1 OR reach IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, max(e) OVER (PARTITION BY contig ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM d)),
m AS (SELECT DISTINCT name, contig, k FROM t JOIN g USING (contig, s, e)), z AS (SELECT contig, k, count(*) AS n FROM m GROUP BY ALL), s AS (SELECT name, sum(n - 1)::BIGINT AS nmates FROM m JOIN z USING (contig, k) GROUP BY name)
SELECT calls.name, nmates FROM calls JOIN s USING (name)""")
def breakpoint_mates(spark, sf):
    return E.mates(_svs(spark, sf, "R"), 1).select("name", "nmates")
