"""Queries on intervals: joins, set algebra, depth, coverage, nearest regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import intervals as I
from strandline.plans.base import ITEMS, items, query, table


def _sides(spark, sf):
    own = items(spark, sf)
    right = own.filter("flag = 'A'").select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"), F.col("id").alias("id_r"))
    return own.filter("flag = 'R'").select("contig", "start", "end", "id"), right


SIDES = f"{ITEMS}, a AS (SELECT * FROM items WHERE flag = 'R'), b AS (SELECT contig, start AS start_r, \"end\" AS end_r, id AS id_r FROM items WHERE flag = 'A')"
MERGED = """{n}_m AS (SELECT contig, min(s) AS s, max(e) AS e, count(*) AS n FROM (
  SELECT *, sum(CASE WHEN s < reach THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM (
    SELECT *, max(e) OVER (PARTITION BY contig ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM (SELECT contig, {s} AS s, {e} AS e FROM {n}))) GROUP BY contig, k)"""
A, B = MERGED.format(n="a", s="start", e='"end"'), MERGED.format(n="b", s="start_r", e="end_r")


@query(f'WITH {SIDES} SELECT a.id, b.id_r, least(a."end", end_r) - greatest(a.start, start_r) AS overlap FROM a JOIN b ON a.contig = b.contig AND a.start < end_r AND start_r < a."end"')
def interval_overlaps(spark, sf):
    a, b = _sides(spark, sf)
    return I.overlap_join(a, b, "contig", 8).select("id", "id_r", (F.least("end", "end_r") - F.greatest("start", "start_r")).alias("overlap"))


@query("""WITH o AS (SELECT o_custkey AS c, o_orderkey AS id, date_diff('day', DATE '1992-01-01', o_orderdate::DATE)::BIGINT AS pos, o_orderstatus AS st FROM orders), r AS (
SELECT c, min(pos) AS s, max(pos) AS e FROM o WHERE st = 'F' GROUP BY c) SELECT o.id, r.s AS start_r, r.e AS end_r FROM o JOIN r ON o.c = r.c AND pos >= s AND pos < e""")
def points_in_spans(spark, sf):
    day = F.datediff(F.col("o_orderdate"), F.lit("1992-01-01")).cast("long")
    own = table(spark, sf, "orders").select(F.col("o_custkey").alias("contig"), F.col("o_orderkey").alias("id"), day.alias("pos"), "o_orderstatus")
    spans = own.filter("o_orderstatus = 'F'").groupBy("contig").agg(F.min("pos").alias("start_r"), F.max("pos").alias("end_r"))
    return I.point_join(own, spans, "contig", 256).select("id", "start_r", "end_r")


@query(f'WITH {SIDES} SELECT id, contig FROM a WHERE EXISTS (SELECT 1 FROM b WHERE a.contig = b.contig AND a.start < end_r AND start_r < a."end")')
def interval_semi(spark, sf):
    a, b = _sides(spark, sf)
    return I.overlapping(a, b, "contig", ["id"], 8).select("id", "contig")


@query(f'WITH {SIDES} SELECT id, contig FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.contig = b.contig AND a.start < end_r AND start_r < a."end")')
def interval_anti(spark, sf):
    a, b = _sides(spark, sf)
    return I.overlapping(a, b, "contig", ["id"], 8, anti=True).select("id", "contig")


@query(f'WITH {SIDES}, {A} SELECT contig, s AS start, e AS "end", n FROM a_m')
def interval_merge(spark, sf):
    return I.merge(_sides(spark, sf)[0], "contig", tile=512)


@query(f'WITH {SIDES}, x AS (SELECT contig, greatest(start - 3, 0) AS start, "end" + 3 AS "end" FROM a), {MERGED.format(n="x", s="start", e=chr(34) + "end" + chr(34))} SELECT contig, s AS start, e AS "end", n FROM x_m')
def interval_merge_extended(spark, sf):
    return I.merge(_sides(spark, sf)[0], "contig", extend=3, tile=512)


@query(f'WITH {SIDES}, {A}, {B} SELECT a_m.contig, greatest(a_m.s, b_m.s) AS start, least(a_m.e, b_m.e) AS "end" FROM a_m JOIN b_m ON a_m.contig = b_m.contig AND a_m.s < b_m.e AND b_m.s < a_m.e')
def interval_intersect(spark, sf):
    a, b = _sides(spark, sf)
    return I.intersect(a, b, "contig", 8)


@query(f"""WITH {SIDES}, {B}, h AS (SELECT a.id, a.contig, a.start, a."end" AS e, b_m.s, b_m.e AS f FROM a LEFT JOIN b_m ON a.contig = b_m.contig AND a.start < b_m.e AND b_m.s < a."end"), g AS (
SELECT id, contig, start AS x, min(coalesce(s, e)) AS y FROM h GROUP BY ALL UNION ALL SELECT id, contig, f, coalesce(lead(s) OVER (PARTITION BY id ORDER BY s), e) FROM h WHERE s IS NOT NULL)
SELECT id, contig, x AS start, y AS "end" FROM g WHERE x < y""")
def interval_subtract(spark, sf):
    a, b = _sides(spark, sf)
    return I.subtract(a, b, "contig", ["id"], 8)


@query(f'WITH {SIDES}, {A} SELECT contig, e AS start, z AS "end" FROM (SELECT *, lead(s) OVER (PARTITION BY contig ORDER BY s) AS z FROM a_m) WHERE e < z')
def interval_gaps(spark, sf):
    return I.gaps(_sides(spark, sf)[0], "contig", 512)


DEPTH = f"""{ITEMS}, st AS (SELECT contig, pos, sum(d) AS d FROM (SELECT contig, start AS pos, 1 AS d FROM items WHERE start < "end" UNION ALL SELECT contig, "end", -1 FROM items WHERE start < "end") GROUP BY contig, pos HAVING sum(d) <> 0),
dp AS (SELECT contig, pos AS start, lead(pos) OVER w AS "end", (sum(d) OVER (PARTITION BY contig ORDER BY pos ROWS UNBOUNDED PRECEDING))::BIGINT AS depth FROM st WINDOW w AS (PARTITION BY contig ORDER BY pos))"""


@query(f'WITH {DEPTH} SELECT contig, start, "end", depth FROM dp WHERE depth <> 0')
def depth_of_coverage(spark, sf):
    return I.depth(items(spark, sf), "contig", tile=256)


@query(f'WITH {SIDES}, {B}, w AS (SELECT DISTINCT contig, (start // 90) * 90 AS s FROM items) SELECT w.contig, w.s AS start, coalesce(sum(least(w.s + 90, b_m.e) - greatest(w.s, b_m.s)), 0)::BIGINT AS covered FROM w LEFT JOIN b_m ON w.contig = b_m.contig AND w.s < b_m.e AND b_m.s < w.s + 90 GROUP BY w.contig, w.s')
def window_coverage(spark, sf):
    _, b = _sides(spark, sf)
    own = items(spark, sf).select("contig", (F.floor(F.col("start") / 90) * 90).alias("start")).distinct().withColumn("end", F.col("start") + 90)
    return I.coverage(own, b, "contig", ["contig", "start"], 64).select("contig", "start", "covered")


@query(f"""WITH {SIDES}, {B}, c AS (SELECT a.id, a.start AS pos, b_m.s, b_m.e, CASE WHEN a.start >= b_m.s THEN greatest(a.start - b_m.e, 0) ELSE b_m.s - a.start END AS d, CASE WHEN a.start >= b_m.s AND a.start < b_m.e THEN 0 WHEN a.start < b_m.s THEN 1 ELSE 2 END AS o FROM a JOIN b_m ON a.contig = b_m.contig)
SELECT id, pos, s AS start_r, e AS end_r, d AS distance FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN o = 0 THEN -1 ELSE d END, o, s DESC) = 1""")
def nearest_region(spark, sf):
    a, b = _sides(spark, sf)
    regions = I.merge(b.select("contig", F.col("start_r").alias("start"), F.col("end_r").alias("end")), "contig").select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    out = I.nearest(a.select("contig", F.col("start").alias("pos"), "id"), regions, "contig", 512)
    return out.filter("start_r is not null").select("id", "pos", "start_r", "end_r", "distance")


def _ladder() -> str:
    return "CASE " + " ".join(f"WHEN (s >> {k}) = ((e - 1) >> {k}) THEN {o} + (s >> {k})" for k, o in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1))) + " ELSE 0 END"


@query(f'WITH {ITEMS} SELECT id, {_ladder()} AS bin FROM (SELECT id, start * 997 AS s, "end" * 1009 + 1 AS e FROM items)')
def interval_bins(spark, sf):
    return items(spark, sf).select("id", I.bin_of(F.col("start") * 997, F.col("end") * 1009 + 1).alias("bin"))


@query('SELECT c_custkey, s AS start, least(s + 1300, len) AS "end" FROM (SELECT c_custkey, len, unnest(range(0, len, 1000)) AS s FROM (SELECT c_custkey, (c_acctbal::DECIMAL(15, 2) * 100)::BIGINT // 100 AS len FROM customer WHERE c_acctbal >= 1))')
def tiling_windows(spark, sf):
    own = table(spark, sf, "customer").filter("c_acctbal >= 1").select("c_custkey", F.floor("c_acctbal").cast("long").alias("length"))
    return I.tiles(own, 1000, 300).select("c_custkey", "start", "end")
