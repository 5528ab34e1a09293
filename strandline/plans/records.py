"""Queries on text record formats and scalar functions: Spark writes the lines of a format from a table, then reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.functions import numeric as N
from strandline.functions import sequence as Q
from strandline.functions import tags as T
from strandline.operators import fuzzy as Z
from strandline.plans.base import code, code_sql, query, table
from strandline.sources import records as R


def _line(df, *fields):
    return df.select(F.concat_ws("\t", *[f if isinstance(f, str) else f.cast("string") for f in fields]).alias("value"))


@query("SELECT 'chr' || p_size AS contig, p_partkey AS start, p_partkey + 100 AS \"end\", p_brand AS name FROM part WHERE p_size % 2 = 0")
def bed_scan(spark, sf):
    own = table(spark, sf, "part").withColumn("value", F.concat_ws("\t", F.concat(F.lit("chr"), F.col("p_size").cast("string")), F.col("p_partkey").cast("string"), (F.col("p_partkey") + 100).cast("string"), "p_brand"))
    text = own.filter("p_size % 2 = 0").select("value").unionAll(own.filter("p_size % 2 = 1").select(F.concat(F.lit("#"), F.col("value"))))
    return R.bed(text)


def _bedpe(spark, sf):
    kind = F.element_at(F.array(*map(F.lit, ("DEL", "INV", "DUP", "DISTAL"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    own = table(spark, sf, "lineitem").select("*", ((F.col("l_orderkey") * 1000000 + F.col("l_partkey")) * 10 + F.col("l_linenumber")).alias("id"), kind.alias("kind"))
    info = F.concat(F.lit("TYPE="), F.col("kind"), F.lit(";NPAIRS="), F.col("l_quantity").cast("int").cast("string"), F.lit(";HAPS=None;ZS=HET"))
    return _line(own, F.concat(F.lit("chr"), (F.col("l_suppkey") % 20).cast("string")), F.col("l_partkey"), F.col("l_partkey") + 10, F.concat(F.lit("chr"), (F.col("l_suppkey") % 20 + (F.col("kind") == "DISTAL").cast("int")).cast("string")), F.col("l_partkey") + 500, F.col("l_partkey") + 510, F.col("id"), F.col("l_quantity"), F.lit("+"), F.lit("-"), F.lit("."), info)


PE = "pe AS (SELECT ['DEL', 'INV', 'DUP', 'DISTAL'][l_linenumber % 4 + 1] AS kind, ((l_orderkey * 1000000 + l_partkey) * 10 + l_linenumber)::VARCHAR AS name, 'chr' || (l_suppkey % 20) AS chrom1, 'chr' || (l_suppkey % 20 + CASE WHEN l_linenumber % 4 = 3 THEN 1 ELSE 0 END) AS chrom2, l_partkey AS s1, l_partkey + 500 AS s2, l_quantity AS qual FROM lineitem)"


@query(f"WITH {PE} SELECT name, chrom1, s1 AS start1, s2 AS start2, kind, qual::INT AS pairs, false AS has_haps, CASE WHEN qual < 20 THEN 'LOWQ' ELSE '.' END AS filters, CASE WHEN kind = 'DISTAL' THEN -1 ELSE s2 - s1 - 10 END AS distance, 'NPAIRS=' || qual::INT || ';QUAL=' || qual::INT || ';TYPE=' || kind || ';ZS=HET' AS info FROM pe")
def bedpe_scan(spark, sf):
    own = R.bedpe(_bedpe(spark, sf)).withColumn("info", T.parsed(F.col("info")))
    info = F.col("info")
    return own.select(
        "name", "chrom1", "start1", "start2", T.value(info, "TYPE").alias("kind"), T.value(info, "NPAIRS", "int").alias("pairs"), T.value(info, "HAPS").isNotNull().alias("has_haps"), T.with_filter(F.col("filters"), "LOWQ", F.col("qual"), 20).alias("filters"),
        F.coalesce(T.break_distance(F.col("chrom1"), F.col("stop1"), F.col("chrom2"), F.col("start2")), F.lit(-1)).alias("distance"), T.updated(info, {"HAPS": F.lit(None), "QUAL": F.col("qual").cast("int")}).alias("info"),
    )


@query(f"""WITH {PE} SELECT chrom1 AS contig, s1 + 1 AS pos, name AS id, '<' || kind || '>' AS alt, 'END=' || (s1 + 510) || ';SVTYPE=' || kind AS info, qual FROM pe WHERE kind <> 'DISTAL' UNION ALL
SELECT chrom1, s1 + 1, name || '_1', 'N[' || chrom2 || ':' || (s2 + 1) || '[', 'SVTYPE=BND;MATEID=' || name || '_2', qual FROM pe WHERE kind = 'DISTAL' UNION ALL
SELECT chrom2, s2 + 1, name || '_2', ']' || chrom1 || ':' || (s1 + 1) || ']N', 'SVTYPE=BND;MATEID=' || name || '_1', qual FROM pe WHERE kind = 'DISTAL'""")
def bedpe_to_vcf(spark, sf):
    return R.bedpe_to_vcf(R.bedpe(_bedpe(spark, sf))).drop("filters")


@query(f"""WITH v AS (SELECT l_orderkey AS pos, {code_sql('l_partkey', 3)} AS ref, {code_sql('l_suppkey', 1, 'a')} AS a1, l_linenumber % 2 AS g, l_quantity AS q FROM lineitem)
SELECT pos - 1 AS pos, ref, a1 AS alt, q AS qual, g = 1 AS het, g = 0 AS phased, q >= 10 AS passes, CASE WHEN ref = a1 THEN 'C' WHEN starts_with(ref, a1) THEN 'D' ELSE 'C' END AS kind FROM v""")
def vcf_scan(spark, sf):
    own = table(spark, sf, "lineitem")
    gt = F.when(F.col("l_linenumber") % 2 == 1, "0/1:7").otherwise("1|1:7")
    text = _line(own, F.lit("chr1"), F.col("l_orderkey"), F.lit("."), code(F.col("l_partkey"), 3), code(F.col("l_suppkey"), 1, "a"), F.col("l_quantity"), F.when(F.col("l_quantity") >= 10, "PASS").otherwise("q10"), F.lit("DP=3;DB"), F.lit("GT:PS"), gt)
    variants = R.genotype(R.vcf(text))
    return variants.select("pos", "ref", F.get("alts", 0).alias("alt"), "qual", "het", "phased", "passes", Q.variant_type(F.col("ref"), F.get("alts", 0)).alias("kind"))


@query(f"SELECT 'r' || p_partkey AS name, {code_sql('p_partkey', 12)} AS seq, substr(md5(p_partkey::VARCHAR), 1, 12) AS qual FROM part")
def fastq_scan(spark, sf):
    own = table(spark, sf, "part")
    rows = F.posexplode(F.array(F.concat(F.lit("@r"), F.col("p_partkey").cast("string"), F.lit(" extra")), code(F.col("p_partkey"), 12), F.lit("+"), F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 12))).alias("k", "value")
    lines = own.select("p_partkey", rows).select("value", (F.col("p_partkey") * 4 + F.col("k")).alias("line"))
    return R.fastq(lines, "line").select("name", "seq", "qual")


@query("""SELECT 'q' || l_orderkey AS qname, 'chr' || (l_suppkey % 5) AS contig, l_partkey - 1 AS pos, l_partkey - 1 + 30 + l_linenumber AS aend, (l_linenumber % 2) = 1 AS reverse, l_quantity::INT AS mapq, 'BC' || l_suppkey AS bx, 30::INT AS matched, 5::INT AS clipped FROM lineitem WHERE l_quantity >= 10""")
def sam_scan(spark, sf):
    own = table(spark, sf, "lineitem")
    flag = F.when(F.col("l_linenumber") % 2 == 1, 16).otherwise(0)
    cigar = F.concat(F.lit("5S20M"), F.col("l_linenumber").cast("string"), F.lit("D10M"))
    text = _line(own, F.concat(F.lit("q"), F.col("l_orderkey").cast("string")), flag, F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")), F.col("l_partkey"), F.col("l_quantity").cast("int"), cigar, F.lit("="), F.col("l_partkey") + 200, F.lit(235), F.lit("A" * 35), F.lit("I" * 35), F.concat(F.lit("BX:Z:BC"), F.col("l_suppkey").cast("string")))
    reads = R.sam(text).filter((F.col("mapq") >= 10) & ~F.col("secondary") & ~F.col("unmapped"))
    return reads.select("qname", "contig", "pos", "aend", "reverse", "mapq", F.try_element_at("tags", F.lit("BX")).alias("bx"), Q.cigar_bases(F.col("cigar"), "MI").alias("matched"), Q.cigar_bases(F.col("cigar"), "S").alias("clipped"))


@query("SELECT 'chr' || (s_suppkey % 3) AS contig, s_suppkey - 1 AS start, s_suppkey + 50 AS \"end\", 'G' || s_suppkey AS gene FROM supplier WHERE s_suppkey % 2 = 0")
def gtf_scan(spark, sf):
    kind = F.when(F.col("s_suppkey") % 2 == 0, "protein_coding").otherwise("pseudogene")
    attributes = F.concat(F.lit('gene_id "x"; gene_name "G'), F.col("s_suppkey").cast("string"), F.lit('"; gene_type "'), kind, F.lit('";'))
    own = table(spark, sf, "supplier")
    return R.gtf_genes(_line(own, F.concat(F.lit("chr"), (F.col("s_suppkey") % 3).cast("string")), F.lit("src"), F.lit("gene"), F.col("s_suppkey"), F.col("s_suppkey") + 50, F.lit("."), F.lit("+"), F.lit("."), attributes))


@query("SELECT 'T' || s_suppkey AS transcript, 'G' || (s_suppkey // 2) AS gene, e::INT AS exon, s_suppkey * 100 + e * 10 AS start, s_suppkey * 100 + e * 10 + 5 AS \"end\" FROM supplier, range(0, 3) r(e)")
def exon_scan(spark, sf):
    base = F.col("s_suppkey") * 100
    joined = lambda more: F.concat(*[x for e in range(3) for x in ((base + e * 10 + more).cast("string"), F.lit(","))])
    own = table(spark, sf, "supplier")
    text = _line(own, F.concat(F.lit("T"), F.col("s_suppkey").cast("string")), F.lit("chr1"), F.lit("+"), base, base + 25, joined(0), joined(5), F.concat(F.lit("G"), F.floor(F.col("s_suppkey") / 2).cast("string")), F.lit("0,0,0"))
    return R.exons(text).select("transcript", "gene", "exon", "start", "end")


@query("SELECT lane::INT AS lane, c_name AS sample, c_mktsegment AS \"index\" FROM customer, range(1, 5) r(lane) WHERE c_custkey % 2 = 0 OR lane IN (1, 3)")
def sample_sheet_scan(spark, sf):
    head = spark.createDataFrame([("[Header]", -4), ("x,y,z", -3), ("[Data]", -2), ("Lane,Sample,Index", -1)], "value string, line long")
    own = table(spark, sf, "customer").select(F.concat_ws(",", F.when(F.col("c_custkey") % 2 == 0, "*").otherwise("1-3"), "c_name", "c_mktsegment").alias("value"), F.col("c_custkey").alias("line"))
    return R.sample_sheet(head.unionAll(own), "line", 4)


S = code_sql("p_partkey", 20)


@query(f"""SELECT p_partkey, reverse(translate(s, 'ACGT', 'TGCA')) AS rc, 'NNN' || substr(s, 4, 7) || repeat('N', 10) AS masked, round((length(s) - length(translate(s, 'GC', ''))) / 20, 8) AS gc, hamming(s, reverse(s))::INT AS distance, 'chr' || p_size || ':' || p_partkey || '..' || (p_partkey + 9) AS locus, p_partkey + 9 AS locus_end FROM (SELECT *, {S} AS s FROM part)""")
def sequence_functions(spark, sf):
    own = table(spark, sf, "part").select("p_partkey", "p_size", code(F.col("p_partkey"), 20).alias("s"))
    text = Q.locus_text(Q.contig_name(F.col("p_size").cast("string")), F.col("p_partkey"), F.col("p_partkey") + 9)
    return own.select("p_partkey", Z.reverse_complement(F.col("s")).alias("rc"), Q.mask(F.col("s"), 3, 10).alias("masked"), F.round(Q.gc_share(F.col("s")), 8).alias("gc"), Z.hamming(F.col("s"), F.reverse("s")).alias("distance"), text.alias("locus"), Q.locus(text)["end"].alias("locus_end"))


@query("""WITH q AS (SELECT p_partkey, list_transform(range(1, 17), lambda i: ascii(substr(md5(p_partkey::VARCHAR), i, 1)) - 33) AS q FROM part)
SELECT p_partkey, list_min(q)::INT AS low, round(list_avg(q), 6) AS mean, round(list_sum(list_transform(q, lambda x: pow(10.0, -x / 10.0))), 6) AS errors, len(list_filter(q, lambda x: x >= 20))::INT AS q20,
coalesce(list_max(list_filter(range(3, 17), lambda e: len(list_filter(q[e - 2:e], lambda x: x >= 20)) = 3)), 0)::INT AS trimmed FROM q""")
def quality_functions(spark, sf):
    qual = F.substring(F.md5(F.col("p_partkey").cast("string")), 1, 16)
    own = table(spark, sf, "part").select("p_partkey", qual.alias("q")).select("p_partkey", Q.quality_summary(F.col("q")).alias("s"), Q.trim_length(F.col("q"), 20, 3).alias("trimmed"))
    return own.select("p_partkey", "s.low", F.round("s.mean", 6).alias("mean"), F.round("s.expected_errors", 6).alias("errors"), "s.q20", "trimmed")


@query("""SELECT l_linenumber, l_quantity, round(-l_linenumber + l_quantity * ln(l_linenumber) - lgamma(l_quantity + 1), 6) AS log_pmf, round(lgamma(51) - lgamma(l_quantity + 1) - lgamma(51 - l_quantity), 6) AS log_choose,
round(log10(greatest(1 - pow(10, -l_quantity / 10), 1e-300)), 6) AS correct, round(sqrt(1 / l_quantity - 1 / 60.0), 6) AS cv FROM (SELECT DISTINCT l_linenumber, l_quantity FROM lineitem)""")
def log_probabilities(spark, sf):
    own = table(spark, sf, "lineitem").select("l_linenumber", "l_quantity").distinct()
    n, rate = F.col("l_quantity"), F.col("l_linenumber").cast("double")
    return own.select("l_linenumber", "l_quantity", F.round(N.poisson_log_pmf(n, rate), 6).alias("log_pmf"), F.round(N.log_binomial(F.lit(50.0), n), 6).alias("log_choose"), F.round(N.log_probability_correct(n) / F.ln(F.lit(10.0)), 6).alias("correct"), F.round(N.fraction_cv(n, F.lit(60.0)), 6).alias("cv"))


@query("""WITH n AS (SELECT DISTINCT l_linenumber::DOUBLE AS r, l_quantity::INT AS n FROM lineitem) SELECT r, n, round(1 - coalesce(list_sum(list_transform(range(0, n), lambda k: exp(-r + k * ln(r) - lgamma(k + 1)))), 0), 6) AS tail,
round(least(1, 2 * list_sum(list_transform(range(0, least(n, 50 - n) + 1), lambda k: exp(lgamma(51) - lgamma(k + 1) - lgamma(51 - k) - 50 * ln(2))))), 6) AS two_sided FROM n""")
def probability_tails(spark, sf):
    own = table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("double").alias("r"), F.col("l_quantity").cast("int").alias("n")).distinct()
    return own.select("r", "n", F.round(N.poisson_tail(F.col("n").cast("double"), F.col("r")), 6).alias("tail"), F.round(N.binomial_test(F.col("n").cast("double"), F.lit(50.0)), 6).alias("two_sided"))


@query("""SELECT l_linestatus, l_returnflag, CASE WHEN a AND NOT b AND c AND q < 25 THEN 'NORMAL' WHEN NOT a OR q > 45 THEN 'TRANS_' || CASE WHEN b THEN 'R' ELSE 'F' END || CASE WHEN c THEN 'R' ELSE 'F' END WHEN b = c THEN 'INV' WHEN b THEN 'TDUP' ELSE 'DEL' END AS kind, count(*) AS n
FROM (SELECT *, l_linestatus = 'O' AS a, l_linenumber % 2 = 0 AS b, l_suppkey % 2 = 0 AS c, l_quantity AS q FROM lineitem) GROUP BY ALL""")
def pair_types(spark, sf):
    kind = Q.pair_type(F.col("l_linestatus") == "O", F.col("l_linenumber") % 2 == 0, F.col("l_suppkey") % 2 == 0, F.col("l_quantity"), 25, 45)
    return table(spark, sf, "lineitem").groupBy("l_linestatus", "l_returnflag", kind.alias("kind")).agg(F.count("*").alias("n"))


@query("SELECT id, message, level FROM (SELECT 'late' AS id, 'late share ' || round(avg(CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END), 2) AS message, 'warn' AS level FROM lineitem) UNION ALL SELECT 'big', 'rows ' || count(*), 'error' FROM lineitem")
def raised_alarms(spark, sf):
    metrics = table(spark, sf, "lineitem").agg(F.avg(F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0)).alias("late"), F.count("*").alias("rows"), F.max(F.lit(None).cast("double")).alias("none"))
    rules = [
        {"id": "late", "when": "late > 0.1", "format": "concat('late share ', round(late, 2))", "level": "warn"},
        {"id": "big", "when": "rows > 10", "format": "concat('rows ', rows)", "level": "error"},
        {"id": "under", "when": "rows > 5", "format": "'hidden'", "level": "warn", "parent": "big"},
        {"id": "unknown", "when": "none > 1", "format": "'none'", "level": "warn"},
    ]
    return T.alarms(metrics, rules)
