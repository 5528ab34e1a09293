"""Queries on ranges, identifiers and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import intervals as I
from strandline.plans.base import ITEMS, code, code_sql, items, query, table
from strandline.plans.intervals import DEPTH
from strandline.sources import layout as L


@query(f'WITH {ITEMS}, q AS (SELECT s_suppkey AS contig, 900 + s_suppkey * 3 AS s, 930 + s_suppkey * 3 AS e FROM supplier UNION ALL SELECT s_suppkey, 920 + s_suppkey * 3, 925 + s_suppkey * 3 FROM supplier) SELECT id, q.s AS query FROM items i JOIN q ON i.contig = q.contig AND i."end" >= q.s AND i.start < q.e')
def range_queries(spark, sf):
    own = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("contig"), (F.col("s_suppkey") * 3).alias("k"))
    asked = own.select("contig", (F.col("k") + 900).alias("start_r"), (F.col("k") + 930).alias("end_r")).unionAll(own.select("contig", F.col("k") + 920, F.col("k") + 925))
    return L.ranges(items(spark, sf), asked, 16).select("id", F.col("start_r").alias("query"))


@query(f"SELECT k AS key, row_number() OVER (ORDER BY k) - 1 AS id FROM (SELECT DISTINCT {code_sql('p_partkey', 10)} AS k FROM part)")
def key_ids(spark, sf):
    return L.key_ids(table(spark, sf, "part").select(code(F.col("p_partkey"), 10).alias("key")), "key")


@query(f"""WITH {DEPTH}, b AS (SELECT contig, unnest(range(start // 5, ("end" - 1) // 5 + 1)) AS bin, depth FROM dp WHERE depth <> 0), m AS (SELECT contig, bin, max(depth) // 4 AS v FROM b GROUP BY ALL),
r AS (SELECT *, sum(CASE WHEN bin = pb + 1 AND v = pv THEN 0 ELSE 1 END) OVER (PARTITION BY contig ORDER BY bin) AS run FROM (SELECT *, lag(bin) OVER w AS pb, lag(v) OVER w AS pv FROM m WINDOW w AS (PARTITION BY contig ORDER BY bin)))
SELECT contig, min(bin) * 5 AS start, (max(bin) + 1) * 5 AS "end", any_value(v)::BIGINT AS v FROM r GROUP BY contig, run""")
def dense_profile(spark, sf):
    bins = L.dense(I.depth(items(spark, sf), "contig", tile=256), 5, "depth")
    return L.bin_ranges(bins.groupBy("contig", "bin").agg(F.expr("max(depth) div 4").alias("v")), 5, "v", 128)


@query("SELECT p_partkey, 'part' || p_partkey AS sample, (p_size % 8)::INT AS lane, 'R' || (p_partkey % 2 + 1) AS read FROM part WHERE p_partkey % 3 > 0")
def fastq_names(spark, sf):
    good = F.concat(F.lit("/data/part"), F.col("p_partkey").cast("string"), F.lit("_S1_L00"), (F.col("p_size") % 8).cast("string"), F.lit("_R"), (F.col("p_partkey") % 2 + 1).cast("string"), F.lit("_001.fastq.gz"))
    own = table(spark, sf, "part").select("p_partkey", L.fastq_name(F.when(F.col("p_partkey") % 3 > 0, good).otherwise("/data/notes.txt")).alias("n"))
    return own.filter("n is not null").select("p_partkey", "n.sample", "n.lane", "n.read")
