"""Queries on writers and small readers: the lines that a format gets, files written and read again, and checks of inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strandline.lineage import shared_folder
from strandline.operators import graph as G
from strandline.operators import intervals as I
from strandline.plans.base import ITEMS, code, code_sql, items, query, table
from strandline.plans.intervals import DEPTH
from strandline.plans.matching import READS, _reads, _svs, _svs_sql
from strandline.plans.records import PE, _bedpe
from strandline.sources import layout as L
from strandline.sources import records as R


def _place(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(f"""WITH {ITEMS} SELECT contig || chr(9) || start || chr(9) || "end" AS value FROM items""")
def bed_lines(spark, sf):
    return R.bed_lines(items(spark, sf).withColumn("contig", F.col("contig").cast("string")))


@query(f"""WITH {DEPTH} SELECT contig || chr(9) || start || chr(9) || "end" || chr(9) || depth AS value FROM dp WHERE depth <> 0""")
def bedgraph_lines(spark, sf):
    return R.bedgraph_lines(I.depth(items(spark, sf), "contig", tile=256).withColumn("contig", F.col("contig").cast("string")), "depth")


@query(f"""WITH {ITEMS}, {_svs_sql('pe', 'R')} SELECT concat_ws(chr(9), chrom1, start1, stop1, chrom2, start2, stop2, name, floor(qual)::INT, '+', '-', '.', 'TYPE=DEL') AS value FROM pe""")
def bedpe_lines(spark, sf):
    own = _svs(spark, sf, "R").withColumn("qual", F.floor("qual").cast("int"))
    return R.bedpe_lines(own.withColumns({"strand1": F.lit("+"), "strand2": F.lit("-"), "filters": F.lit("."), "info": F.lit("TYPE=DEL")}))


@query(f"""WITH {PE}, l AS (SELECT chrom1 AS contig, s1 + 1 AS pos, name AS id, '<' || kind || '>' AS alt, 'END=' || (s1 + 510) || ';SVTYPE=' || kind AS info FROM pe WHERE kind <> 'DISTAL' UNION ALL
SELECT chrom1, s1 + 1, name || '_1', 'N[' || chrom2 || ':' || (s2 + 1) || '[', 'SVTYPE=BND;MATEID=' || name || '_2' FROM pe WHERE kind = 'DISTAL' UNION ALL SELECT chrom2, s2 + 1, name || '_2', ']' || chrom1 || ':' || (s1 + 1) || ']N', 'SVTYPE=BND;MATEID=' || name || '_1' FROM pe WHERE kind = 'DISTAL')
SELECT '##fileformat=VCFv4.2' AS value UNION ALL SELECT replace('#CHROM POS ID REF ALT QUAL FILTER INFO', ' ', chr(9)) UNION ALL SELECT concat_ws(chr(9), contig, pos, id, 'N', alt, '.', 'PASS', info) FROM l""")
def vcf_lines(spark, sf):
    calls = R.bedpe_to_vcf(R.bedpe(_bedpe(spark, sf))).withColumn("qual", F.lit(None).cast("double"))
    return L.vcf_lines(calls)


@query(f"SELECT '@r' || p_partkey || chr(10) || {code_sql('p_partkey', 12)} || chr(10) || '+' || chr(10) || substr(md5(p_partkey::VARCHAR), 1, 12) AS value FROM part")
def fastq_lines(spark, sf):
    k = F.col("p_partkey")
    return R.fastq_lines(table(spark, sf, "part").select(F.concat(F.lit("@r"), k.cast("string")).substr(2, 100).alias("name"), code(k, 12).alias("seq"), F.substring(F.md5(k.cast("string")), 1, 12).alias("qual")))


@query("""SELECT '{"key":' || s_suppkey || ',"nation":' || s_nationkey || '}' AS value FROM supplier""")
def json_summaries(spark, sf):
    return table(spark, sf, "supplier").select(R.sanitised(F.struct(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"))).alias("value"))


@query(f'WITH {ITEMS} SELECT flag, count(*) AS n, sum("end" - start)::BIGINT AS mass FROM items GROUP BY flag')
def partitioned_files(spark, sf):
    """Rows fanned out to a folder for each key, and read back."""
    at = _place(spark, "fan")
    R.write_partitioned(items(spark, sf), at, ["flag"])
    return spark.read.parquet(at).groupBy("flag").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start")).alias("mass"))


@query(f'WITH {ITEMS} SELECT contig, id, start FROM items WHERE contig BETWEEN 3 AND 5 AND start BETWEEN 500 AND 900')
def indexed_files(spark, sf):
    """Rows written in order of their range, and a region of them read with filters that prune."""
    at = _place(spark, "indexed")
    R.write_indexed(items(spark, sf), at)
    return spark.read.parquet(at).filter(F.col("contig").between(3, 5) & F.col("start").between(500, 900)).select("contig", "id", "start")


@query("SELECT l_suppkey, count(*) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem WHERE l_suppkey % 4 > 0 GROUP BY 1")
def keyed_files(spark, sf):
    """Rows sorted by key into files, and the keys looked up in them; rows without a key are left where they are."""
    at = _place(spark, "keyed")
    own = table(spark, sf, "lineitem").select(F.when(F.col("l_suppkey") % 4 > 0, F.col("l_suppkey")).alias("l_suppkey"), "l_orderkey", "l_extendedprice")
    L.sorted_by_key(own, "l_suppkey", "l_orderkey").write.parquet(at)
    return spark.read.parquet(at).filter("l_suppkey is not null").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))


@query("""SELECT CASE WHEN p_size % 5 = 0 THEN 'fields' WHEN p_size % 5 = 1 THEN 'numbers' WHEN p_size % 5 = 2 THEN 'order' ELSE 'contig' END AS problem, count(*) AS n FROM part WHERE p_size % 5 < 3 OR p_size % 5 = 3 AND p_partkey % 2 = 0 GROUP BY 1""")
def bed_problems(spark, sf):
    k, kind = F.col("p_partkey").cast("string"), F.col("p_size") % 5
    contig = F.when((kind == 3) & (F.col("p_partkey") % 2 == 0), "chrUn").otherwise("chr1")
    line = F.when(kind == 0, F.concat_ws("\t", F.lit("chr1"), k)).when(kind == 1, F.concat_ws("\t", F.lit("chr1"), F.lit("x"), k)).when(kind == 2, F.concat_ws("\t", F.lit("chr1"), k, F.lit("0"))).otherwise(F.concat_ws("\t", contig, k, (F.col("p_partkey") + 5).cast("string")))
    known = spark.createDataFrame([("chr1",), ("chr2",)], "contig string")
    return R.bed_problems(table(spark, sf, "part").select(line.alias("value")), known).groupBy("problem").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN k % 7 = 0 THEN 'chrX' WHEN k % 7 = 1 THEN 'GL' || k ELSE 'chr' || k END AS contig, k * 1000 AS length, k % 7 <> 1 AS \"primary\", k % 7 = 0 AS sex, k % 7 > 1 AS autosome FROM (SELECT s_suppkey AS k FROM supplier)")
def contig_table(spark, sf):
    k = F.col("s_suppkey")
    name = F.when(k % 7 == 0, "chrX").when(k % 7 == 1, F.concat(F.lit("GL"), k.cast("string"))).otherwise(F.concat(F.lit("chr"), k.cast("string")))
    return R.contigs(table(spark, sf, "supplier").select(F.concat_ws("\t", name, (k * 1000).cast("string"), F.lit("0")).alias("value")))


@query("SELECT 'FC' || s_suppkey AS flow_cell, (s_suppkey % 8 + 1)::INT AS lanes, n::INT AS number, (s_suppkey % 100 + n)::INT AS cycles, n = 2 AS \"index\" FROM supplier, range(1, 4) r(n)")
def run_descriptions(spark, sf):
    k = F.col("s_suppkey")
    read = lambda n: F.concat(F.lit(f'<Read Number="{n}" NumCycles="'), (k % 100 + n).cast("string"), F.lit(f'" IsIndexedRead="{"Y" if n == 2 else "N"}"/>'))
    xml = F.concat(F.lit("<RunInfo><Run><Flowcell>FC"), k.cast("string"), F.lit("</Flowcell><Reads>"), read(1), read(2), read(3), F.lit('</Reads><FlowcellLayout LaneCount="'), (k % 8 + 1).cast("string"), F.lit('"/></Run></RunInfo>'))
    own = R.run_info(table(spark, sf, "supplier").select(xml.alias("value")))
    return own.select("flow_cell", "lanes", F.explode("reads").alias("r")).select("flow_cell", "lanes", "r.*")


@query("SELECT 'sv' || s_suppkey AS name, side::INT AS side, (s_suppkey * 10 + side)::BIGINT AS ps, hp::INT AS hp, (s_nationkey + side * hp)::BIGINT AS n FROM supplier, range(1, 3) a(side), range(1, 3) b(hp)")
def break_details(spark, sf):
    part = lambda side: [(F.col("s_suppkey") * 10 + side).cast("string"), *[(F.col("s_nationkey") + side * hp).cast("string") for hp in (1, 2)]]
    lines = table(spark, sf, "supplier").select(F.concat_ws(",", F.concat(F.lit("sv"), F.col("s_suppkey").cast("string")), *part(1), *part(2)).alias("value"))
    return R.break_details(lines)


@query("""WITH e AS (SELECT user_id, event_id, row_number() OVER w - 1 AS place, first_value(event_id) OVER w AS path, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)), p AS (SELECT path, count(*) AS n FROM e WHERE n > 1 GROUP BY path)
SELECT 'S' || chr(9) || path || chr(9) || n AS value FROM p UNION ALL SELECT 'L' || chr(9) || path || chr(9) || '+' || chr(9) || (path + 1) || chr(9) || '+' || chr(9) || '0M' FROM p WHERE path + 1 IN (SELECT path FROM p)""")
def graph_lines(spark, sf):
    """Paths of each user's events as segments, the sequence standing for its length, linked to the path that begins with the next event."""
    from strandline.operators.ordered import across

    own = table(spark, sf, "events").select("user_id", "event_id")
    steps = across(own, ["user_id"], ["event_id"], {"b": ("lead", F.col("event_id"))}, 1 << 12).filter("b is not null").select(F.col("event_id").alias("a"), "b")
    paths = G.compressed_paths(steps).groupBy(F.col("path").alias("node")).agg(F.count("*").cast("string").alias("seq"))
    links = paths.select(F.col("node").alias("a"), (F.col("node") + 1).alias("b")).join(paths.select(F.col("node").alias("b")), "b", "left_semi").select("a", "b")
    return R.graph_lines(paths, links)


@query(f"WITH {READS}, c AS (SELECT key, count(*) AS n FROM reads GROUP BY key) SELECT c.key, n, a.key IS NOT NULL AS valid, round(n / (SELECT sum(n) FROM c), 10) AS share FROM c LEFT JOIN allowed a USING (key)")
def index_summary(spark, sf):
    reads, allowed = _reads(spark, sf)
    return R.index_summary(reads.groupBy("key").agg(F.count("*").alias("n")), allowed).withColumn("share", F.round("share", 10))
