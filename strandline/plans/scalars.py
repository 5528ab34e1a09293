"""Queries on scalar functions of reads, names, alleles and probabilities, and on sets of variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.functions import numeric as N
from strandline.functions import sequence as Q
from strandline.functions import tags as T
from strandline.operators import aggregates as A
from strandline.operators import fuzzy as Z
from strandline.operators import matching as M
from strandline.operators import variants as V
from strandline.plans.base import ITEMS, code, code_sql, items, query, table
from strandline.plans.matching import _svs, _svs_sql
from strandline.sources import layout as L
from strandline.sources import records as R

ID = "(l_orderkey * 1000000 + l_partkey) * 10 + l_linenumber"


def _id():
    return (F.col("l_orderkey") * 1000000 + F.col("l_partkey")) * 10 + F.col("l_linenumber")


@query(f"""SELECT p_partkey, array_to_string(list_filter(range(0, 27), lambda i: substr(s, i + 1, 4) IN ('GAAC', 'GACC', 'GAGC', 'GATC', 'GTTC', 'GGTC', 'GCTC')), ',') AS sites FROM (SELECT p_partkey, {code_sql('p_partkey', 30)} AS s FROM part)""")
def restriction_sites(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(Q.site_positions(code(F.col("p_partkey"), 30), "GANC").cast("array<string>"), ",").alias("sites"))


@query(f"""SELECT {ID} AS id, CASE WHEN i < 4 THEN -1 WHEN i < 14 THEN i - 4 WHEN i < 14 + n THEN -1 ELSE i - 4 - n + 3 END AS place, i::INT AS base FROM (SELECT *, l_linenumber AS n FROM lineitem), range(0, 20) r(i) WHERE i < 19 + n""")
def reference_offsets(spark, sf):
    text = F.concat(F.lit("4S10M"), F.col("l_linenumber").cast("string"), F.lit("I3D5M"))
    own = table(spark, sf, "lineitem").select(_id().alias("id"), F.posexplode(Q.reference_offsets(Q.cigar(text))).alias("base", "place"))
    return own.filter("base < 20").select("id", F.coalesce("place", F.lit(-1)).alias("place"), "base")


@query(f"SELECT p_partkey, substr(s, 1, 6) AS key, substr(q, 1, 6) AS key_qual, substr(s, 9) AS seq, substr(q, 9) AS qual FROM (SELECT p_partkey, {code_sql('p_partkey', 24)} AS s, substr(md5(p_partkey::VARCHAR), 1, 24) AS q FROM part)")
def trimmed_reads(spark, sf):
    own = table(spark, sf, "part").select("p_partkey", Q.trimmed(code(F.col("p_partkey"), 24), F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 24), 6, 2).alias("t"))
    return own.select("p_partkey", "t.*")


@query(f"SELECT ref, alt, length(ref) = 1 OR length(alt) = 1 AS primitive, (length(alt) - length(ref))::INT AS size, count(*) AS n FROM (SELECT {code_sql('l_partkey', 3)} AS r3, {code_sql('l_suppkey', 2, 'a')} AS a2, l_linenumber AS k FROM lineitem), LATERAL (SELECT substr(r3, 1, k % 3 + 1) AS ref, substr(a2, 1, k % 2 + 1) AS alt) GROUP BY ALL")
def allele_shapes(spark, sf):
    own = table(spark, sf, "lineitem").select(F.substring(code(F.col("l_partkey"), 3), F.lit(1), F.col("l_linenumber") % 3 + 1).alias("ref"), F.substring(code(F.col("l_suppkey"), 2, "a"), F.lit(1), F.col("l_linenumber") % 2 + 1).alias("alt"))
    ref, alt = F.col("ref"), F.col("alt")
    return own.groupBy("ref", "alt", Q.primitive(ref, alt).alias("primitive"), Q.allele_length(ref, alt).alias("size")).agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, greatest(-10 * a, -3 * (a + r), -10 * r) AS best, (-10 * a - greatest(-10 * a, -3 * (a + r), -10 * r)) || ',' || (-3 * (a + r) - greatest(-10 * a, -3 * (a + r), -10 * r)) || ',' || (-10 * r - greatest(-10 * a, -3 * (a + r), -10 * r)) AS likelihoods
FROM (SELECT l_orderkey, l_linenumber, l_quantity::INT AS a, (l_partkey % 30)::INT AS r FROM lineitem)""")
def pseudo_likelihoods(spark, sf):
    own = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("a"), (F.col("l_partkey") % 30).cast("int").alias("r"))
    return own.select("l_orderkey", "l_linenumber", F.greatest(F.col("a") * -10, (F.col("a") + F.col("r")) * -3, F.col("r") * -10).alias("best"), N.pseudo_likelihoods(F.col("r"), F.col("a")).alias("likelihoods"))


@query("SELECT p_partkey, allele::INT AS allele, (CASE allele WHEN 0 THEN p_size % 3 ELSE 2 END)::INT AS n, CASE WHEN allele = 0 AND p_size % 3 = 0 THEN '' ELSE 'k' || p_partkey || '-1' END AS first FROM part, range(0, 2) r(allele)")
def allele_keys(spark, sf):
    key = lambda k: F.concat(F.lit("k"), F.col("p_partkey").cast("string"), F.lit(f"-{k}"))
    none, one, two = F.lit(""), key(1), F.concat(key(1), F.lit(";"), key(2))
    text = F.concat(F.when(F.col("p_size") % 3 == 0, none).when(F.col("p_size") % 3 == 1, one).otherwise(two), F.lit(","), two)
    own = table(spark, sf, "part").select("p_partkey", F.posexplode(Q.allele_keys(text)).alias("allele", "keys"))
    return own.select("p_partkey", "allele", F.size("keys").alias("n"), F.coalesce(F.get("keys", 0), F.lit("")).alias("first"))


@query(f"SELECT p_partkey, s AS seq, (p_size % 9)::INT AS \"group\", list_sum(list_transform(range(0, 16), lambda i: (instr('AGCT', substr(s, i + 1, 1)) - 1) * pow(4, i)::BIGINT))::BIGINT AS packed FROM (SELECT p_partkey, p_size, {code_sql('p_partkey', 16)} AS s FROM part WHERE p_size % 9 > 1)")
def key_codec(spark, sf):
    own = table(spark, sf, "part").filter("p_size % 9 > 1").select("p_partkey", Q.group_of(F.concat(code(F.col("p_partkey"), 16), F.lit("-"), (F.col("p_size") % 9).cast("string"))).alias("k"))
    own = own.withColumn("packed", Q.packed_key(F.col("k.seq")))
    return own.select("p_partkey", Q.unpacked_key(F.col("packed"), 16).alias("seq"), "k.group", "packed")


@query("SELECT l_linenumber, l_quantity::INT AS n, round(-(0.3 * l_linenumber + 0.05 * 40) + l_quantity * ln(0.3 * l_linenumber + 0.05 * 40) - lgamma(l_quantity + 1), 6) AS log_p FROM (SELECT DISTINCT l_linenumber, l_quantity FROM lineitem)")
def two_rate_reads(spark, sf):
    own = table(spark, sf, "lineitem").select("l_linenumber", F.col("l_quantity").cast("int").alias("n")).distinct()
    return own.select("l_linenumber", "n", F.round(N.two_rate_log_pmf(F.col("n"), F.lit(0.3), F.lit(0.05), F.col("l_linenumber"), F.lit(40)), 6).alias("log_p"))


@query("""WITH RECURSIVE b AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY size) AS k, sum(n) OVER (PARTITION BY s) AS t FROM (SELECT l_suppkey AS s, l_quantity::BIGINT AS size, count(*) AS n FROM lineitem GROUP BY 1, 2)),
r AS (SELECT s, k, size, n::BIGINT AS n, 1 AS g FROM b WHERE k = 1 UNION ALL SELECT b.s, b.k, b.size, (CASE WHEN abs(b.n - r.n) / b.t < 0.2 THEN r.n + b.n ELSE b.n END)::BIGINT, CASE WHEN abs(b.n - r.n) / b.t < 0.2 THEN r.g ELSE r.g + 1 END FROM r JOIN b ON b.s = r.s AND b.k = r.k + 1)
SELECT s AS l_suppkey, arg_max(size, k) AS size, arg_max(n, k) AS n FROM r GROUP BY s, g""")
def merged_frequencies(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_suppkey", F.col("l_quantity").cast("long").alias("size")).agg(F.count("*").alias("n"))
    bins = counts.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct("size", "n"))).alias("b"))  # a histogram: as many entries as sizes
    return bins.select("l_suppkey", F.explode(N.merged_bins(F.col("b"), 0.2)).alias("m")).select("l_suppkey", "m.*")


@query(f"""SELECT {ID} AS id, l_quantity >= 40 AND l_linestatus = 'F' AND (l_linenumber > 2 OR l_partkey % 50 >= 20) AND l_linenumber % 2 = 0 AND l_suppkey % 3 > 0 AS stringent, CASE WHEN l_suppkey % 3 > 0 THEN 'BC' || l_suppkey END AS key FROM lineitem""")
def stringent_reads(spark, sf):
    key = Q.blank_to_null(F.when(F.col("l_suppkey") % 3 > 0, F.concat(F.lit("BC"), F.col("l_suppkey").cast("string"))).otherwise(""))
    own = table(spark, sf, "lineitem").select("*", _id().alias("id"), key.alias("key"))
    ok = Q.stringent(F.col("l_quantity") + 20, F.col("l_linestatus") == "F", F.col("l_linenumber") <= 2, F.col("l_partkey") % 50, F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(2), F.col("key"))
    return own.select("id", ok.alias("stringent"), "key")


@query(f"SELECT {ID} AS id, k::INT AS k, 'chr' || (l_suppkey + k) AS contig, l_partkey - 1 + k AS pos, CASE k WHEN 0 THEN '+' ELSE '-' END AS strand, (l_quantity + k)::INT AS mapq, k = 1 AS clipped FROM lineitem, range(0, 2) r(k)")
def split_reads(spark, sf):
    part = lambda k, sign, cigar: F.concat_ws(",", F.concat(F.lit("chr"), (F.col("l_suppkey") + k).cast("string")), (F.col("l_partkey") + k).cast("string"), F.lit(sign), F.lit(cigar), (F.col("l_quantity") + k).cast("int").cast("string"), F.lit("0"))
    tag = F.concat(part(0, "+", "10M2I5M"), F.lit(";"), part(1, "-", "12M8S"), F.lit(";"))
    own = table(spark, sf, "lineitem").select(_id().alias("id"), F.posexplode(Q.split_alignments(tag)).alias("k", "a"))
    return own.select("id", "k", "a.contig", "a.pos", "a.strand", "a.mapq", Q.one_clip(Q.cigar(F.col("a.cigar"))).alias("clipped"))


@query(f"WITH {ITEMS}, {_svs_sql('pe', 'R')} SELECT name, CASE WHEN chrom1 > chrom2 THEN chrom2 ELSE chrom1 END AS chrom1, CASE WHEN chrom1 > chrom2 THEN start2 ELSE start1 END AS start1, CASE WHEN chrom1 > chrom2 THEN chrom1 ELSE chrom2 END AS chrom2, CASE WHEN chrom1 > chrom2 THEN stop1 ELSE stop2 END AS stop2 FROM pe")
def swapped_breaks(spark, sf):
    return T.swapped(_svs(spark, sf, "R"), F.col("chrom1") > F.col("chrom2")).select("name", "chrom1", "start1", "chrom2", "stop2")


@query("""WITH n AS (SELECT DISTINCT CASE WHEN p_size > 40 THEN 'chrX' || p_size ELSE 'chr' || p_size END AS name FROM part) SELECT name, row_number() OVER (ORDER BY try_cast(replace(name, 'chr', '') AS BIGINT) IS NULL, try_cast(replace(name, 'chr', '') AS BIGINT), replace(name, 'chr', '')) AS place FROM n""")
def contig_places(spark, sf):
    own = table(spark, sf, "part").select(F.concat(F.when(F.col("p_size") > 40, "chrX").otherwise("chr"), F.col("p_size").cast("string")).alias("name")).distinct()
    from pyspark.sql import Window as W

    return own.withColumn("place", F.row_number().over(W.orderBy(Q.contig_order(F.col("name")))))  # contigs: a handful


@query(f"SELECT {ID} AS id, 'sample:lib:' || l_suppkey AS read_group, (l_linenumber)::INT AS lane, (1100 + l_suppkey)::INT AS tile, (l_partkey)::INT AS x, (l_quantity)::INT AS y FROM lineitem")
def read_names(spark, sf):
    name = F.concat_ws(":", F.lit("M:1:F"), F.col("l_linenumber").cast("string"), (F.col("l_suppkey") + 1100).cast("string"), F.col("l_partkey").cast("string"), F.col("l_quantity").cast("int").cast("string"))
    own = table(spark, sf, "lineitem").select(_id().alias("id"), Q.pack_read_group(F.lit("sample"), F.lit("lib"), F.col("l_suppkey").cast("string")).alias("read_group"), Q.read_position(name).alias("p"))
    return own.select("id", "read_group", "p.*")


@query("""SELECT l_quantity::INT AS n, round(l_quantity / 1.3489795003921634, 8) AS deviation, least(l_quantity * 15, 500.0) AS quality, round(CASE WHEN l_quantity > 40 THEN -1 ELSE sqrt(1 / l_quantity - 1 / 40.0) END, 8) AS cv, round(least(-10 * log10(pow(10, -l_quantity / 5)), 60), 6) AS phred FROM (SELECT DISTINCT l_quantity FROM lineitem)""")
def deviations_and_qualities(spark, sf):
    n = F.col("n").cast("double")
    own = table(spark, sf, "lineitem").select(F.col("l_quantity").cast("int").alias("n")).distinct()
    return own.select("n", F.round(N.deviation_from_iqr(n), 8).alias("deviation"), N.p_value_quality(n * -1.5).alias("quality"), F.round(N.fraction_cv(n, F.lit(40.0)), 8).alias("cv"), F.round(N.quality(F.pow(F.lit(10.0), -n / 5)), 6).alias("phred"))


@query("SELECT p_partkey, 'part ' || p_partkey AS name, CASE WHEN p_size % 4 > 0 THEN p_size::VARCHAR END AS size FROM part")
def tsv_scan(spark, sf):
    lines = table(spark, sf, "part").select(F.concat_ws("\t", F.col("p_partkey").cast("string"), F.concat(F.lit("part "), F.col("p_partkey").cast("string")), F.when(F.col("p_size") % 4 > 0, F.col("p_size").cast("string")).otherwise(".")).alias("value"))
    head = spark.createDataFrame([("p_partkey\tname\tsize",)], "value string")
    return R.tsv(head.unionAll(lines), ["p_partkey", "name", "size"]).withColumn("p_partkey", F.col("p_partkey").cast("long"))


@query(f"""SELECT l_orderkey AS pos, n::INT AS allele, CASE n WHEN 1 THEN 'A' ELSE 'GT' END AS ref, CASE n WHEN 1 THEN 'T' ELSE 'G' END AS alt, CASE n WHEN 1 THEN l_orderkey + 1 ELSE l_orderkey + 2 END AS at, l_linenumber % 5 > 0 AS good FROM lineitem, range(1, 3) r(n)""")
def split_alleles(spark, sf):
    """CAGT with the alternatives CTGT (A to T) and CAG (GT to G)."""
    own = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pos"), F.col("l_linenumber").alias("k"), F.lit("CAGT").alias("ref"), F.array(F.lit("CTGT"), F.lit("CAG")).alias("alts"))
    checked = own.withColumn("good", F.col("k") % 5 > 0)
    out = R.by_allele(checked.withColumn("at", F.col("pos")).withColumnRenamed("pos", "first").withColumnRenamed("at", "pos"))
    return out.select(F.col("first").alias("pos"), F.col("allele").cast("int").alias("allele"), "ref", "alt", F.col("pos").alias("at"), "good")


@query("SELECT p_partkey, p_size % 5 > 0 AND p_size % 7 > 0 AS good FROM part")
def usable_alleles(spark, sf):
    own = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 5 > 0, "ACN").otherwise("AC*").alias("ref"), F.when(F.col("p_size") % 7 > 0, F.array(F.lit("A"), F.lit("GG"))).otherwise(F.array().cast("array<string>")).alias("alts"))
    return own.select("p_partkey", R.good_alleles(own).alias("good"))


@query(f"""WITH {ITEMS}, v AS (SELECT contig, start // 300 AS ps, start AS pos, flag <> 'N' AS het, id % 4 > 0 AS phased, CASE WHEN id % 3 < 2 THEN id % 3 END AS parity FROM items WHERE id % 11 > 0)
SELECT contig, ps, min(pos) AS start, max(pos) AS "end", count(*) AS n, count(*) FILTER (het) AS het, round(count(*) FILTER (phased) / count(*), 6) AS phased_share, round(coalesce((count(*) FILTER (parity = 0) * (count(*) FILTER (parity = 0) - 1) + count(*) FILTER (parity = 1) * (count(*) FILTER (parity = 1) - 1)) / nullif(count(parity) * (count(parity) - 1), 0), -1), 6) AS correct_pairs
FROM v GROUP BY ALL HAVING count(*) > 1""")
def phase_block_track(spark, sf):
    own = items(spark, sf).filter("id % 11 > 0").select("contig", F.floor(F.col("start") / 300).alias("ps"), F.col("start").alias("pos"), (F.col("flag") != "N").alias("het"), (F.col("id") % 4 > 0).alias("phased"), F.when(F.col("id") % 3 < 2, F.col("id") % 3).alias("parity"))
    out = V.phase_blocks(own).filter("n > 1")  # blocks of one variant aren't shown
    return out.withColumns({"phased_share": F.round("phased_share", 6), "correct_pairs": F.round(F.coalesce("correct_pairs", F.lit(-1.0)), 6)})


@query("""WITH r AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice, l_partkey) AS id, l_quantity AS x, l_partkey % 40 AS y FROM lineitem) SELECT a.l_orderkey, count(*) AS optical FROM r a JOIN r b ON a.l_orderkey = b.l_orderkey AND a.id < b.id WHERE pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 100 GROUP BY 1""")
def near_duplicates(spark, sf):
    reads = table(spark, sf, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_extendedprice", "l_partkey").alias("id"), F.struct(F.col("l_quantity").alias("x"), (F.col("l_partkey") % 40).alias("y")).alias("place"))
    return V.near_duplicates(reads, ["l_orderkey"], "place", 10.0)


@query(f"""WITH c AS (SELECT {code_sql('l_partkey')} AS key, count(*) AS n FROM lineitem GROUP BY 1), s AS (SELECT CASE WHEN key LIKE 'AC%' THEN 'one' WHEN key LIKE 'GT%' OR key LIKE 'CA%' THEN 'two' END AS lot, sum(n)::BIGINT AS n FROM c GROUP BY 1)
SELECT lot, n, round(n / sum(n) OVER (), 8) AS share, n / sum(n) OVER () >= 0.5 AND n >= 10 AS confident FROM s WHERE lot IS NOT NULL""")
def key_lots(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy(code(F.col("l_partkey")).alias("key")).agg(F.count("*").alias("n"))
    prefixes = spark.createDataFrame([("AC", "one"), ("GT", "two"), ("CA", "two")], "prefix string, lot string")
    return Z.lots(counts, prefixes, 0.5, 10).withColumn("share", F.round("share", 8))


@query(f"WITH {ITEMS} SELECT contig, id FROM items QUALIFY row_number() OVER (PARTITION BY contig ORDER BY abs(start - 1000), id) = 1")
def nearest_key_to_locus(spark, sf):
    return M.nearest_key(items(spark, sf), ["contig"], F.abs(F.col("start") - 1000), ["id"]).select("contig", "id")


@query(f"WITH {ITEMS} SELECT id, array_to_string(list_filter([CASE WHEN price < 5000 THEN 'LOWQ' END, CASE WHEN \"end\" - start < 5 THEN 'SHORT' END, CASE WHEN flag = 'N' THEN 'OPEN' END], lambda x: x IS NOT NULL), ';') AS failed FROM items")
def failed_rules(spark, sf):
    rules = {"LOWQ": F.col("price") < 5000, "SHORT": F.col("end") - F.col("start") < 5, "OPEN": F.col("flag") == "N", "UNKNOWN": F.lit(None).cast("boolean")}
    return items(spark, sf).select("id", F.array_join(V.call_filters(rules), ";").alias("failed"))


@query("SELECT l_orderkey AS pos, l_partkey % 100 AS alt, CASE WHEN a AND b THEN 'both' WHEN a THEN 'left' ELSE 'right' END AS side FROM (SELECT l_orderkey, l_partkey, bool_or(l_linenumber % 2 = 0) OVER w AS a, bool_or(l_linenumber % 3 = 0) OVER w AS b FROM lineitem WINDOW w AS (PARTITION BY l_orderkey, l_partkey % 100)) WHERE a OR b GROUP BY ALL")
def variant_sets(spark, sf):
    own = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("pos"), (F.col("l_partkey") % 100).alias("alt"), "l_linenumber")
    return V.compared_sets(own.filter("l_linenumber % 2 = 0"), own.filter("l_linenumber % 3 = 0"), ["pos", "alt"])


@query("SELECT l_suppkey AS key, count(*) FILTER (l_returnflag = 'R') AS left_n, count(*) FILTER (l_returnflag = 'A') AS right_n FROM lineitem GROUP BY 1 HAVING count(*) FILTER (l_returnflag = 'R') > 0 AND count(*) FILTER (l_returnflag = 'A') > 0")
def common_keys(spark, sf):
    side = lambda f, name: table(spark, sf, "lineitem").filter(F.col("l_returnflag") == f).groupBy(F.col("l_suppkey").alias("key")).agg(F.count("*").alias(name))
    return side("R", "left_n").join(side("A", "right_n"), "key")


@query("SELECT o_orderkey, n FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def lockstep_orders(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    orders = table(spark, sf, "orders").select("o_orderkey").join(counts.select("o_orderkey"), "o_orderkey", "left_semi")
    return V.in_lockstep(orders, counts, ["o_orderkey"])


@query("WITH n AS (SELECT p_partkey AS pos, p_size % 4 AS alt, min(p_name) AS name FROM part GROUP BY 1, 2) SELECT l_orderkey, l_linenumber, coalesce(name, '') AS name FROM lineitem LEFT JOIN n ON l_partkey = pos AND l_linenumber % 4 = alt")
def annotated_variants(spark, sf):
    known = table(spark, sf, "part").select(F.col("p_partkey").alias("pos"), (F.col("p_size") % 4).alias("alt"), F.col("p_name").alias("name"))
    own = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("pos"), (F.col("l_linenumber") % 4).alias("alt"))
    return V.annotated(own, known, ("pos", "alt")).select("l_orderkey", "l_linenumber", F.coalesce("name", F.lit("")).alias("name"))


@query("SELECT l_returnflag, unnest([0.1, 0.5, 0.9])::DOUBLE AS q, unnest(quantile_disc(l_quantity, [0.1, 0.5, 0.9])) AS value FROM lineitem GROUP BY l_returnflag")
def quantile_sketches(spark, sf):
    return A.quantiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", [0.1, 0.5, 0.9], 10_000)


@query("""WITH RECURSIVE i AS (SELECT l_suppkey AS contig, date_diff('day', DATE '1992-01-01', l_shipdate::DATE)::BIGINT AS start, date_diff('day', DATE '1992-01-01', l_shipdate::DATE)::BIGINT + l_quantity::BIGINT AS e, (l_orderkey * 1000000 + l_partkey) * 10 + l_linenumber AS name, l_extendedprice AS qual, l_linestatus AS kind FROM lineitem),
o AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY start, e, name, qual) AS k FROM i), r AS (
SELECT contig, k, start AS ls, e AS le, name AS best, qual AS bq, kind = 'F' AS f, kind = 'O' AS p, kind AS bk, 1 AS g FROM o WHERE k = 1 UNION ALL
SELECT contig, k, CASE WHEN j THEN ls ELSE start END, CASE WHEN NOT j OR qual > bq THEN e ELSE le END, CASE WHEN NOT j OR qual > bq THEN name ELSE best END, CASE WHEN NOT j OR qual > bq THEN qual ELSE bq END, CASE WHEN j THEN f OR kind = 'F' ELSE kind = 'F' END, CASE WHEN j THEN p OR kind = 'O' ELSE kind = 'O' END, CASE WHEN NOT j OR qual > bq THEN kind ELSE bk END, CASE WHEN j THEN g ELSE g + 1 END
FROM (SELECT o.*, r.ls, r.le, r.best, r.bq, r.f, r.p, r.bk, r.g, least((least(r.le, o.e) - o.start)::DOUBLE / (r.le - r.ls), (least(r.le, o.e) - o.start)::DOUBLE / (o.e - o.start)) >= 0.6 AS j FROM r JOIN o ON o.contig = r.contig AND o.k = r.k + 1))
SELECT contig, arg_max(best, k) AS name, CASE WHEN bool_or(f) AND bool_or(p) THEN 'UNK' ELSE arg_max(bk, k) END AS kind FROM r GROUP BY contig, g""")
def kept_best_calls(spark, sf):
    day = F.datediff(F.col("l_shipdate"), F.lit("1992-01-01")).cast("long")
    calls = table(spark, sf, "lineitem").select(_id().alias("name"), F.col("l_suppkey").alias("contig"), day.alias("start"), (day + F.col("l_quantity").cast("long")).alias("end"), F.col("l_extendedprice").alias("qual"), F.col("l_linestatus").alias("kind"))
    return V.kept_best(calls, 0.6, 366).select("contig", "name", "kind")


@query()
def key_set_clusters(spark, sf):
    sets = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("name")).agg(F.max("l_extendedprice").alias("qual"), F.array_sort(F.collect_set(F.col("l_suppkey") % 10)).alias("keys"))
    own = table(spark, sf, "orders").select(F.col("o_orderkey").alias("name"), F.col("o_custkey").alias("c")).join(sets, "name").select("c", "name", "qual", "keys")
    return V.key_clusters(own, ["c"], 0.5).select("c", "name", "qual")


@query("SELECT l_suppkey % 7 AS shard_key, count(*) AS n, count(DISTINCT l_suppkey) AS keys FROM lineitem WHERE l_suppkey % 5 > 0 GROUP BY 1")
def sharded_rows(spark, sf):
    """Rows dealt to shards by key, and all rows of a key found in one of them."""
    own = table(spark, sf, "lineitem").select("l_orderkey", F.when(F.col("l_suppkey") % 5 > 0, F.col("l_suppkey")).alias("key"))
    dealt = L.sharded(own, "key", "l_orderkey", 16)
    placed = dealt.filter("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("shard").alias("shards")).filter("shards = 1")
    return placed.groupBy((F.col("key") % 7).alias("shard_key")).agg(F.sum("n").alias("n"), F.count("*").alias("keys"))
