"""Text record formats as DataFrames, and back. Readers take a table of lines (column value), so any reader of lines, gzip or not, will do; writers give lines.

Positions are from 0 and half open inside; formats that count from 1 are converted. Malformed numbers become null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.functions import sequence, tags


def lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path)


def _fields(df: DataFrame, separator: str = "\t", skip: str = r"^(#|track|browser|\s*$)") -> DataFrame:
    return df.filter(~F.col("value").rlike(skip)).withColumn("f", F.split("value", separator))


def _at(k: int, kind: str = "string") -> Column:
    return F.get("f", k) if kind == "string" else F.get("f", k).try_cast(kind)


def bed(df: DataFrame, feature: str | None = None) -> DataFrame:
    """(contig, start, end, name), of one feature name if given."""
    out = _fields(df).select(_at(0).alias("contig"), _at(1, "long").alias("start"), _at(2, "long").alias("end"), _at(3).alias("name"))
    return out if feature is None else out.filter(F.col("name") == feature)


def bed_lines(df: DataFrame) -> DataFrame:
    return df.orderBy("contig", "start", "end").select(F.concat_ws("\t", "contig", F.col("start").cast("string"), F.col("end").cast("string")).alias("value"))


def bedgraph_lines(df: DataFrame, value: str) -> DataFrame:
    return df.orderBy("contig", "start").select(F.concat_ws("\t", "contig", F.col("start").cast("string"), F.col("end").cast("string"), F.col(value).cast("string")).alias("value"))


BEDPE = ("chrom1", "start1", "stop1", "chrom2", "start2", "stop2", "name", "qual", "strand1", "strand2", "filters", "info")


def bedpe(df: DataFrame) -> DataFrame:
    """Twelve columns; missing trailing ones get the defaults 0, dots and dots."""
    kinds = {"start1": "long", "stop1": "long", "start2": "long", "stop2": "long", "qual": "double"}
    defaults = {"qual": F.lit(0.0), "strand1": F.lit("+"), "strand2": F.lit("+"), "filters": F.lit("."), "info": F.lit(".")}
    return _fields(df).select(*[F.coalesce(_at(k, kinds.get(c, "string")), defaults.get(c, F.lit(None))).alias(c) for k, c in enumerate(BEDPE)])


def bedpe_lines(df: DataFrame) -> DataFrame:
    """By quality, best first, then by place."""
    own = df.orderBy(F.desc("qual"), "chrom1", "start1", "stop1", "chrom2", "start2", "stop2", "name")
    return own.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in BEDPE]).alias("value"))


def bedpe_to_vcf(df: DataFrame) -> DataFrame:
    """Variant rows (contig, pos from 1, id, alt, info): one symbolic record for DEL, INV and DUP on one contig, else two breakends that name each other."""
    df = df.withColumn("__type", F.coalesce(tags.value(tags.parsed(F.col("info")), "TYPE"), F.lit("UNK")))
    kind = F.col("__type")
    symbolic = kind.isin("DEL", "INV", "DUP") & (F.col("chrom1") == F.col("chrom2"))
    one = F.struct(F.col("chrom1").alias("contig"), (F.col("start1") + 1).alias("pos"), F.col("name").alias("id"), F.concat(F.lit("<"), kind, F.lit(">")).alias("alt"), F.concat(F.lit("END="), (F.col("stop2")).cast("string"), F.lit(";SVTYPE="), kind).alias("info"))

    def end(k: int, other: int) -> Column:
        mate = F.concat(F.col(f"chrom{other}"), F.lit(":"), (F.col(f"start{other}") + 1).cast("string"))
        before = F.when(F.col(f"strand{other}") == "+", "]").otherwise("[")
        alt = F.when(F.col(f"strand{k}") == "+", F.concat(F.lit("N"), before, mate, before)).otherwise(F.concat(before, mate, before, F.lit("N")))
        return F.struct(F.col(f"chrom{k}").alias("contig"), (F.col(f"start{k}") + 1).alias("pos"), F.concat("name", F.lit(f"_{k}")).alias("id"), alt.alias("alt"), F.concat(F.lit("SVTYPE=BND;MATEID="), "name", F.lit(f"_{other}")).alias("info"))

    rows = F.when(symbolic, F.array(one)).otherwise(F.array(end(1, 2), end(2, 1)))
    return df.select(F.explode(rows).alias("r"), "qual", "filters").select("r.*", "qual", "filters")


def vcf(df: DataFrame) -> DataFrame:
    """(contig, pos from 0, id, ref, alts, qual, filters, info, format, sample): info and sample as maps of text."""
    own = _fields(df)
    own = own.withColumns({"__k": F.split(_at(8), ":"), "__v": F.split(_at(9), ":")})
    n = F.least(F.size("__k"), F.size("__v"))
    sample = F.when(F.col("__k").isNotNull() & F.col("__v").isNotNull(), F.map_from_arrays(F.slice("__k", F.lit(1), n), F.slice("__v", F.lit(1), n)))
    return own.select(
        _at(0).alias("contig"), (_at(1, "long") - 1).alias("pos"), F.nullif(_at(2), F.lit(".")).alias("id"), _at(3).alias("ref"), F.filter(F.split(_at(4), ","), lambda a: a != ".").alias("alts"),
        _at(5, "double").alias("qual"), tags.filters(_at(6)).alias("filters"), tags.parsed(_at(7)).alias("info"), sample.alias("sample"),
    )


def genotype(variants: DataFrame) -> DataFrame:
    """variants with gt (allele numbers), phased, ps, het and passes."""
    own = variants.withColumns({"__text": F.try_element_at("sample", F.lit("GT")), "ps": F.try_element_at("sample", F.lit("PS")).try_cast("long")})
    own = own.withColumn("gt", F.transform(F.split("__text", r"[/|]"), lambda x: x.try_cast("int")))
    return own.withColumns({
        "phased": F.coalesce(F.contains(F.col("__text"), F.lit("|")), F.lit(False)),
        "het": F.coalesce((F.size("gt") == 2) & (F.get("gt", 0) != F.get("gt", 1)), F.lit(False)), "passes": (F.size("filters") == 0) | F.array_contains("filters", "PASS"),
    }).drop("__text")


def good_alleles(variants: DataFrame) -> Column:
    """Only ACGTN, and no empty allele."""
    return F.coalesce(F.col("ref").rlike("^[ACGTN]+$") & (F.size("alts") > 0) & F.forall("alts", lambda a: a.rlike("^[ACGTN]+$")), F.lit(False))


def by_allele(variants: DataFrame) -> DataFrame:
    """One row for each alternative allele, with its number from 1, trimmed of what it shares with the reference: first the suffix, then the prefix."""
    rows = variants.select("*", F.posexplode("alts").alias("__n", "alt")).withColumn("allele", F.col("__n") + 1).drop("__n")
    common = lambda a, b: F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)) - 1, F.lit(1))), lambda k: (k < F.length(a)) & (k < F.length(b)) & (F.substring(a, F.lit(1), k) == F.substring(b, F.lit(1), k))))
    rows = rows.withColumn("__tail", common(F.reverse("ref"), F.reverse("alt")))
    rows = rows.withColumns({c: F.expr(f"substring({c}, 1, length({c}) - __tail)") for c in ("ref", "alt")}).drop("__tail")
    head = common(F.col("ref"), F.col("alt"))
    return rows.withColumn("__head", head).withColumns({"pos": F.col("pos") + F.col("__head"), "ref": F.expr("substring(ref, __head + 1)"), "alt": F.expr("substring(alt, __head + 1)")}).drop("__head")


def fastq(df: DataFrame, order: str, by: list[str] = (), lines_each: int = 4) -> DataFrame:
    """(by, name, seq, qual) from four-line records; ``order`` numbers the lines of each file from 0. With eight lines: also seq2 and qual2 of the mate."""
    part = (F.col(order) % lines_each).cast("int")
    own = df.groupBy(*by, F.floor(F.col(order) / lines_each).alias("__record")).agg(F.map_from_entries(F.collect_list(F.struct(part.alias("k"), "value"))).alias("m"))
    at = lambda k: F.try_element_at("m", F.lit(k))
    columns = [F.regexp_extract(at(0), r"^@(\S+)", 1).alias("name"), at(1).alias("seq"), at(3).alias("qual")]
    if lines_each == 8:
        columns += [at(5).alias("seq2"), at(7).alias("qual2")]
    return own.select(*by, *columns)


def fastq_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual").alias("value"))


def sam(df: DataFrame) -> DataFrame:
    """Alignment rows: flags as booleans, tags as a map of text; pos from 0."""
    own = _fields(df, skip=r"^(@|\s*$)")
    flag = _at(1, "int")
    bit = lambda n: (flag.bitwiseAND(n) != 0)
    ops = sequence.cigar(_at(5))
    tag = F.transform(F.slice("f", 12, F.greatest(F.size("f"), F.lit(1))), lambda x: F.struct(F.substring(x, 1, 2).alias("k"), F.substring(x, F.lit(6), F.length(x)).alias("v")))
    return own.select(
        _at(0).alias("qname"), bit(4).alias("unmapped"), bit(16).alias("reverse"), bit(64).alias("read1"), bit(256).alias("secondary"), bit(1024).alias("duplicate"), bit(2048).alias("supplementary"),
        F.nullif(_at(2), F.lit("*")).alias("contig"), (_at(3, "long") - 1).alias("pos"), _at(4, "int").alias("mapq"), ops.alias("cigar"), sequence.reference_end(_at(3, "long") - 1, ops).alias("aend"),
        F.when(_at(6) == "=", _at(2)).otherwise(F.nullif(_at(6), F.lit("*"))).alias("mate_contig"), (_at(7, "long") - 1).alias("mate_pos"), _at(8, "long").alias("tlen"), _at(9).alias("seq"), _at(10).alias("qual"), F.map_from_entries(tag).alias("tags"),
    )


def gtf_genes(df: DataFrame, protein_coding: bool = True) -> DataFrame:
    """(contig, start, end, gene)."""
    own = _fields(df).filter(_at(2) == "gene")
    attribute = lambda k: F.nullif(F.regexp_extract(_at(8), rf'{k} "([^"]*)"', 1), F.lit(""))
    out = own.select(_at(0).alias("contig"), (_at(3, "long") - 1).alias("start"), _at(4, "long").alias("end"), attribute("gene_name").alias("gene"), F.coalesce(attribute("gene_type"), attribute("gene_biotype")).alias("kind"))
    return (out.filter("kind = 'protein_coding'") if protein_coding else out).drop("kind")


def exons(df: DataFrame) -> DataFrame:
    """One row for each exon of gene rows (name, contig, strand, start, end, exon starts, exon ends, gene)."""
    numbers = lambda k: F.transform(F.filter(F.split(_at(k), ","), lambda x: x != ""), lambda x: x.cast("long"))
    own = _fields(df).select(_at(0).alias("transcript"), _at(1).alias("contig"), _at(2).alias("strand"), _at(7).alias("gene"), F.arrays_zip(numbers(5).alias("s"), numbers(6).alias("e")).alias("x"))
    return own.select("transcript", "contig", "strand", "gene", F.posexplode("x").alias("exon", "x")).select("transcript", "contig", "strand", "gene", "exon", F.col("x.s").alias("start"), F.col("x.e").alias("end"))


def tsv(df: DataFrame, columns: list[str], null: str = ".") -> DataFrame:
    """Named text columns of a table whose first field names the first column on the header line, which is left out; ``null`` reads as null."""
    own = _fields(df).filter(_at(0) != columns[0])
    return own.select(*[F.nullif(_at(k), F.lit(null)).alias(c) for k, c in enumerate(columns)])


def sample_sheet(df: DataFrame, order: str, lanes: int) -> DataFrame:
    """Rows (lane, sample, index) of the Data section of a sectioned sheet; a lane of * stands for all, several are joined by dashes."""
    section = F.last(F.nullif(F.regexp_extract("value", r"^\[(\w+)\]", 1), F.lit("")), ignorenulls=True).over(W.partitionBy().orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow))  # a sheet is one small file
    own = df.withColumn("section", section).filter("section = 'Data'").withColumn("f", F.split("value", ",")).filter((F.size("f") >= 3) & (_at(0) != "Lane"))
    lane = F.when(_at(0) == "*", F.transform(F.sequence(F.lit(1), F.lit(lanes)), lambda x: x.cast("string"))).otherwise(F.split(_at(0), "-"))
    return own.select(F.explode(lane).alias("lane"), _at(1).alias("sample"), _at(2).alias("index")).withColumn("lane", F.col("lane").cast("int"))


def sanitised(c: Column) -> Column:
    """JSON text of a struct, with numbers that JSON lacks as texts."""
    return F.to_json(c)


def write_partitioned(df: DataFrame, path: str, keys: list[str]) -> None:
    """One folder of files for each combination of keys; rows of a combination are spread by Spark's own partitioning, not gathered."""
    df.write.mode("overwrite").partitionBy(*keys).parquet(path)


def write_indexed(df: DataFrame, path: str, contig: str = "contig", start: str = "start") -> None:
    """Sorted by range, so that a reader's filters on contig and start prune row groups."""
    df.repartitionByRange(contig, start).sortWithinPartitions(contig, start).write.mode("overwrite").parquet(path)


def bed_problems(df: DataFrame, contigs: DataFrame) -> DataFrame:
    """(value, problem) of the lines of an interval file that can't be used: too few fields, bounds that aren't numbers or out of order, a contig that isn't one of ``contigs`` (contig)."""
    known = contigs.select(F.col("contig").alias("__contig")).distinct()
    own = _fields(df).join(known, F.get("f", 0) == F.col("__contig"), "left")
    start, end = _at(1, "long"), _at(2, "long")
    problem = F.when(F.size("f") < 3, "fields").when(start.isNull() | end.isNull(), "numbers").when((start < 0) | (end < start), "order").when(F.col("__contig").isNull(), "contig")
    return own.select("value", problem.alias("problem")).filter("problem is not null")


def contigs(df: DataFrame, sex: tuple[str, ...] = ("chrX", "chrY")) -> DataFrame:
    """(contig, length, primary, sex, autosome) of the lines of a sequence index. Primary contigs are named by a number or are sex contigs."""
    own = _fields(df).select(_at(0).alias("contig"), _at(1, "long").alias("length"))
    autosome, is_sex = F.col("contig").rlike(r"^chr\d+$"), F.col("contig").isin(*sex)
    return own.select("contig", "length", (autosome | is_sex).alias("primary"), is_sex.alias("sex"), autosome.alias("autosome"))


def run_info(df: DataFrame) -> DataFrame:
    """(flow_cell, lanes, reads) of run descriptions in XML, one document a row in value; reads is an array of (number, cycles, index)."""
    many = lambda what: F.xpath("value", F.lit(f"//Read/@{what}"))
    reads = F.transform(F.arrays_zip(many("Number").alias("n"), many("NumCycles").alias("c"), many("IsIndexedRead").alias("i")), lambda r: F.struct(r["n"].cast("int").alias("number"), r["c"].cast("int").alias("cycles"), (r["i"] == "Y").alias("index")))
    return df.select(F.xpath_string("value", F.lit("//Flowcell")).alias("flow_cell"), F.xpath_int("value", F.lit("//FlowcellLayout/@LaneCount")).alias("lanes"), reads.alias("reads"))


def break_details(df: DataFrame) -> DataFrame:
    """(name, side, hp, ps, n) of comma-separated details: a name, then for each side its phase set and the counts of both haplotypes."""
    own = _fields(df, ",").select(_at(0).alias("name"), F.array(*[F.struct(F.lit(k + 1).alias("side"), F.get("f", 1 + 3 * k).try_cast("long").alias("ps"), F.array(F.get("f", 2 + 3 * k).try_cast("long"), F.get("f", 3 + 3 * k).try_cast("long")).alias("n")) for k in (0, 1)]).alias("s"))
    sides = own.select("name", F.explode("s").alias("s")).select("name", "s.*")
    return sides.select("name", "side", "ps", F.posexplode("n").alias("hp", "n")).withColumn("hp", F.col("hp") + 1)


def graph_lines(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Lines of a graph exchange file from nodes (node, seq) and edges (a, b): segments, then links of forward strands."""
    segments = nodes.select(F.concat_ws("\t", F.lit("S"), F.col("node").cast("string"), "seq").alias("value"))
    links = edges.select(F.concat_ws("\t", F.lit("L"), F.col("a").cast("string"), F.lit("+"), F.col("b").cast("string"), F.lit("+"), F.lit("0M")).alias("value"))
    return segments.unionAll(links)


def index_summary(counts: DataFrame, known: DataFrame, key: str = "key") -> DataFrame:
    """(key, n, valid, share) of index counts (key, n): whether the index is a known one, and its share of all."""
    total = counts.agg(F.sum("n").alias("__all"))
    own = counts.join(known.select(key, F.lit(True).alias("valid")).distinct(), key, "left").join(F.broadcast(total))  # one row
    return own.select(key, "n", F.coalesce("valid", F.lit(False)).alias("valid"), (F.col("n") / F.col("__all")).alias("share"))
