"""Alignment rows: filters, subsamples, quality counts, fragments and barcodes, variant statistics by filter and region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators.aggregates import effective_diversity, pair_rate, ratio
from strandline.operators.intervals import overlapping, point_join
from strandline.operators.sessions import gap_sessions


def aligned(reads: DataFrame, least: int = 0, secondary: bool = False, unmapped: bool = False, keep: Column | None = None) -> DataFrame:
    """Primary, mapped reads of mapping quality ``least`` or more; ``keep`` is the caller's own condition."""
    ok = F.col("mapq") >= least
    ok = ok if secondary else ok & ~F.col("secondary")
    ok = ok if unmapped else ok & ~F.col("unmapped")
    return reads.filter(ok if keep is None else ok & keep)


def pair_subsample(df: DataFrame, key: str, percent: int, seed: int = 0) -> DataFrame:
    """Rows of ``percent`` of the keys, all rows of a key together, by a hash that other engines have too."""
    return df.filter(F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long") % 100 < percent)


def fixed_sample(df: DataFrame, key: list[str], n: int, seed: int = 0) -> DataFrame:
    """n rows, those of the smallest hashes: the same ones on every run."""
    return df.withColumn("__h", F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))).orderBy("__h", *key).limit(n).drop("__h")


def at_locus(reads: DataFrame, contig, start: int, end: int, key: str) -> DataFrame:
    """The distinct keys of reads that overlap a locus."""
    return reads.filter((F.col("contig") == contig) & (F.col("pos") < end) & (F.col("aend") > start) & F.col(key).isNotNull()).select(key).distinct()


def pair_counts(pairs: DataFrame, by: list[str], far: int = 5000, least: int = 29, insert_cap: int = 10_000) -> DataFrame:
    """Of read pairs (contig1, contig2, pos1, pos2, reverse1, reverse2, mapq1, mapq2, insert): all, confident, and chimeras by class; the median insert of confident proper pairs, capped."""
    sure = (F.col("mapq1") >= least) & (F.col("mapq2") >= least)
    same = F.col("contig1") == F.col("contig2")
    distance = F.abs(F.col("pos1") - F.col("pos2"))
    outward = same & (distance <= far) & (F.col("reverse1") != F.col("reverse2")) & (F.when(F.col("pos1") <= F.col("pos2"), F.col("reverse1")).otherwise(F.col("reverse2")))
    one_way = same & (distance <= far) & (F.col("reverse1") == F.col("reverse2"))
    proper = sure & same & (distance <= far) & ~outward & ~one_way
    n = lambda c: F.count(F.when(c, 1))
    return pairs.groupBy(*by).agg(
        F.count("*").alias("n"), n(sure).alias("confident"), n(sure & ~same).alias("inter_contig"), n(sure & same & (distance > far)).alias("far"), n(sure & one_way).alias("same_direction"), n(sure & outward).alias("outward"),
        F.coalesce(F.percentile(F.when(proper, F.least("insert", F.lit(insert_cap))), 0.5), F.lit(0.0)).alias("insert_median"),
    )


def fragments(reads: DataFrame, gap: int, least: int, targets: DataFrame | None = None, key: str = "bx") -> DataFrame:
    """(key, contig, session, start, end, num_reads, num_reads_se, obs_len, est_len) of reads (qname, pos, aend, mapq) by gap sessions: those with a confident read and, if targets (contig, start_r, end_r) are given, on one. One-read fragments count as 1000 long."""
    own = gap_sessions(reads, [key, "contig"], "pos", gap, ties=["qname"])
    out = own.groupBy(key, "contig", "session").agg(F.min("pos").alias("start"), F.max("aend").alias("end"), F.count_distinct("qname").alias("num_reads"), F.count("*").alias("num_reads_se"), F.max(F.col("mapq") >= least).alias("__sure"))
    span, n = F.col("end") - F.col("start"), F.col("num_reads")
    out = out.filter("__sure").drop("__sure").withColumns({"obs_len": F.when(n > 1, span).otherwise(1000), "est_len": F.when(n > 1, span * (n + 1) / F.greatest(n - 1, F.lit(1))).otherwise(1000.0)})
    return out if targets is None else overlapping(out, targets, "contig", [key, "session"])


def barcodes(frags: DataFrame, key: str = "bx") -> DataFrame:
    """One row for each key with fragments: their number, reads, mean reads, shares of fragments and of reads that are linked, and length."""
    linked = F.col("num_reads") > 1
    return frags.groupBy(key).agg(
        F.count("*").alias("fragments"), F.sum("num_reads").alias("reads"), F.avg("num_reads").alias("reads_per_fragment"),
        ratio(F.sum(F.when(linked, F.col("num_reads")).otherwise(0)), F.sum("num_reads")).alias("linked_reads"), ratio(F.count(F.when(linked, 1)), F.count("*")).alias("linked_fragments"), F.sum("est_len").alias("length"),
    )


def length_mode(frags: DataFrame, bin_size: int) -> DataFrame:
    """(mode): the middle of the bin of lengths that holds the most length, of fragments of several reads."""
    own = frags.filter("num_reads > 1").groupBy((F.floor(F.col("est_len") / bin_size) * bin_size).alias("__bin")).agg(F.sum("est_len").alias("__mass"))
    return own.agg((F.max_by("__bin", F.struct("__mass", -F.col("__bin"))) + bin_size / 2).alias("mode"))


def barcode_metrics(counts: DataFrame, allowed: DataFrame, key: str = "key") -> DataFrame:
    """One row from counts (key, n) and an allow-list: shares of the list seen and of rows on the list, effective diversity, share of keys within twice the median, coefficient of variation."""
    size = allowed.select(key).distinct().agg(F.count("*").alias("__size"))
    own = counts.join(allowed.select(key, F.lit(True).alias("__ok")).distinct(), key, "left")
    good = own.filter("__ok")
    median = good.agg(F.percentile("n", 0.5).alias("__median"))
    n = F.col("n")
    stats = good.join(F.broadcast(median)).agg(
        F.count("*").alias("__seen"), effective_diversity(n).alias("diversity"), F.avg(((n >= F.col("__median") / 2) & (n <= F.col("__median") * 2)).cast("double")).alias("within_twice_median"), ratio(F.stddev_pop("n"), F.avg("n")).alias("cv"),
    )
    rate = own.agg(ratio(F.sum(F.when(F.col("__ok"), n).otherwise(0)), F.sum(n)).alias("correct"))
    return stats.join(size).join(rate).select(F.least(ratio(F.col("__seen"), F.col("__size")), F.lit(1.0)).alias("observed"), "correct", "diversity", "within_twice_median", "cv")  # one row each


def changed_share(breaks: DataFrame, reads: DataFrame, least: int = 60, base: int = 1 << 14) -> DataFrame:
    """breaks (name, side, contig, start_r, end_r) to (name, share): the larger share of reads (contig, pos, mapq, old_mapq) on a side whose mapping quality was changed to ``least`` or more; 0 where a side has none."""
    hits = point_join(reads.filter(~F.col("duplicate")), breaks, "contig", base)
    changed = ((F.col("old_mapq") != F.col("mapq")) & (F.col("mapq") >= least)).cast("double")
    sides = hits.groupBy("name", "side").agg(F.avg(changed).alias("share")).groupBy("name").agg(F.count("*").alias("n"), F.max("share").alias("share"))
    return breaks.select("name").distinct().join(sides, "name", "left").select("name", F.when(F.col("n") == 2, F.col("share")).otherwise(0.0).alias("share"))


def clipped_regions(regions: DataFrame, clips: DataFrame, most_clips: int = 10, most_share: float = 0.1, base: int = 1 << 14) -> DataFrame:
    """regions (name, contig, start_r, end_r) with too_many: whether over ``most_share`` of their positions hold more clipped ends (clips: contig, pos) than both ``most_clips`` and the median position, zeros counted."""
    at = point_join(clips, regions, "contig", base).groupBy("name", "pos").agg(F.count("*").alias("n"))
    w = W.partitionBy("name").orderBy("n").rowsBetween(W.unboundedPreceding, W.currentRow)
    length = F.col("end_r") - F.col("start_r")
    counts = at.groupBy("name", "n").agg(F.count("*").alias("k")).join(regions.select("name", length.alias("length")), "name")
    counts = counts.withColumn("up_to", F.col("length") - F.sum("k").over(W.partitionBy("name")) + F.sum("k").over(w))
    # the median of the sorted positions, of two middle ones their mean
    low, high = F.floor((F.col("length") - 1) / 2), F.floor(F.col("length") / 2)
    middle = counts.groupBy("name").agg(*[F.coalesce(F.min(F.when((F.col("up_to") > m) & (F.col("length") - F.col("up_to") + F.col("k") < F.col("length")), F.col("n"))), F.lit(0)).alias(x) for m, x in ((low, "a"), (high, "b"))], F.max(F.col("length")).alias("length"), F.sum("k").alias("filled"))
    zeros = F.col("length") - F.col("filled")
    value = lambda x, m: F.when(zeros > m, 0).otherwise(F.col(x))
    middle = middle.select("name", ((value("a", F.floor((F.col("length") - 1) / 2)) + value("b", F.floor(F.col("length") / 2))) / 2).alias("median"))
    over = counts.join(middle, "name").groupBy("name").agg((F.coalesce(F.sum(F.when(F.col("n") > F.greatest(F.col("median"), F.lit(most_clips)), F.col("k"))), F.lit(0)) / F.max("length") > most_share).alias("too_many"))
    return regions.join(over, "name", "left").withColumn("too_many", F.coalesce("too_many", F.lit(False)))


def variant_statistics(rows: DataFrame, regions: dict[str, Column]) -> DataFrame:
    """(filter, kind, region, tp, fp, fn, sensitivity, ppv, titv, phased) from variant rows (kind, length, in_truth, in_calls, passes, ti, tv, is_phased): every combination of filter, kind with length class, and region, in one pass."""
    size = F.abs(F.col("length"))
    kinds = {"any": F.lit(True), "snp": F.col("kind") == "S", "insertion": F.col("kind") == "I", "deletion": F.col("kind") == "D", "complex": F.col("kind") == "C"}
    for name, letter in (("insertion", "I"), ("deletion", "D")):
        kinds[f"{name}_lt5bp"] = (F.col("kind") == letter) & (size < 5)
        kinds[f"{name}_5_to_50bp"] = (F.col("kind") == letter) & (size >= 5) & (size < 51)
    met = lambda named: F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in named.items()]))
    own = rows.withColumns({"__kinds": met(kinds), "__regions": met({"all": F.lit(True)} | regions)})
    own = own.withColumn("variant", F.explode("__kinds")).withColumn("region", F.explode("__regions")).withColumn("filter", F.explode(F.array(F.lit("unfiltered"), F.lit("filtered"))))
    call = F.col("in_calls") & (F.col("passes") | (F.col("filter") == "unfiltered"))
    n = lambda c: F.count(F.when(c, 1))
    tp, fp, fn = n(call & F.col("in_truth")), n(call & ~F.col("in_truth")), n(~call & F.col("in_truth"))
    return own.groupBy("filter", "variant", "region").agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), ratio(tp, tp + fn).alias("sensitivity"), ratio(tp, tp + fp).alias("ppv"), ratio(n(call & F.col("ti")), n(call & F.col("tv"))).alias("titv"), ratio(n(call & F.col("is_phased")), tp + fp).alias("phased"))


def gene_phasing(variants: DataFrame, genes: DataFrame, base: int = 1 << 14) -> DataFrame:
    """(gene, variants, blocks, phased, pair_phased, pair_correct) of genes (gene, contig, start_r, end_r) with several variants (contig, pos, ps, is_phased, parity), those without a phase set left out."""
    hits = point_join(variants.filter("ps is not null"), genes, "contig", base)
    blocks = hits.groupBy("gene", "ps").agg(F.count("*").alias("n"), F.count(F.when(F.col("is_phased"), 1)).alias("p"), *[F.count(F.when(F.col("parity") == k, 1)).alias(f"c{k}") for k in (0, 1)])
    two = lambda x: x * (x - 1) / 2
    n, tested = F.sum("n"), F.col("c0") + F.col("c1")
    own = blocks.groupBy("gene").agg(n.alias("variants"), F.count("*").alias("blocks"), (F.count("*") == 1).alias("phased"), ratio(F.sum(two(F.col("p"))), two(n)).alias("pair_phased"), ratio(F.sum(two(F.col("c0")) + two(F.col("c1"))), F.sum(two(tested))).alias("pair_correct"))
    return own.filter("variants > 1")


def common_keys(df: DataFrame, key: str, least: int, most: int = 1500) -> DataFrame:
    """(key, n): the most frequent keys above a noise level; a top-k report."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), key).limit(most)


def correct_pairs(parity: str) -> Column:
    return pair_rate([F.count(F.when(F.col(parity) == k, 1)) for k in (0, 1)])
