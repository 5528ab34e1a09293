"""Records against regions: nearest regions by direction, records on targets, keys around breaks, coverage of baits and calls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.functions.numeric import log10_binomial_tail
from strandline.lineage import cut_lineage
from strandline.operators.aggregates import ratio
from strandline.operators.intervals import depth, merge, overlap_join, point_join
from strandline.operators.matching import as_of
from strandline.operators.ordered import TILE, across


def nearest_intervals(left: DataFrame, right: DataFrame, by: list[str], tile: int = TILE) -> DataFrame:
    """left (start, end, ...) with the regions of right (start_r, end_r; disjoint) around it: ``overlaps``, the first one that it overlaps, ``left`` and ``right``, the last before and the first after it, and the distances ``nearest``, ``to_left`` and ``to_right``: 0 to all three where it overlaps, null where there is none."""
    extra = [c for c in left.columns if c not in [*by, "start"]]
    region = F.struct(F.col("start_r").cast("long").alias("start"), F.col("end_r").cast("long").alias("end"))
    a = left.select(*by, "start", F.lit(1).alias("__kind"), F.lit(None).cast("struct<start:bigint,end:bigint>").alias("__region"), F.struct(*extra).alias("__row"))
    b = right.select(*by, F.col("start_r").alias("start"), F.lit(0).alias("__kind"), region.alias("__region"), F.lit(None).cast(a.schema["__row"].dataType).alias("__row"))
    both = across(a.unionByName(b), by, ["start", "__kind"], {"__l": ("last", F.col("__region")), "__r": ("next", F.col("__region"))}, tile)
    own = both.filter("__kind = 1").select(*by, "start", "__row.*", "__l", "__r")
    at_left, at_right = F.col("__l.end") > F.col("start"), F.col("__r.start") < F.col("end")
    own = own.withColumn("overlaps", F.when(at_left, F.col("__l")).when(at_right, F.col("__r")))
    hit = F.col("overlaps").isNotNull()
    own = own.withColumns({"to_left": F.when(hit, 0).otherwise(F.col("start") - F.col("__l.end")), "to_right": F.when(hit, 0).otherwise(F.col("__r.start") - F.col("end"))})
    own = own.withColumns({"nearest": F.least("to_left", "to_right"), "left": F.when(~hit, F.col("__l")), "right": F.when(~hit, F.col("__r"))})
    return own.drop("__l", "__r")


def on_targets(records: DataFrame, targets: DataFrame, by: str, ids: list[str], whole: bool, base: int = 1 << 14) -> DataFrame:
    """records (pos, length, ...) that begin or end on a target (start_r, end_r), or, with ``whole``, that end before the target that holds their first position does. Records are told by their places, so ``ids`` may repeat."""
    keys = [by, "pos", "length"]
    places = records.select(*keys).distinct()
    if whole:
        hits = point_join(places, targets, by, base).filter(F.col("pos") + F.col("length") < F.col("end_r"))
    else:
        points = places.select(by, F.struct("pos", "length").alias("__own"), F.explode(F.array(F.col("pos"), F.col("pos") + F.col("length"))).alias("pos"))
        hits = point_join(points, targets, by, base).select(by, "__own.*")
    return records.join(hits.select(*keys).distinct(), keys, "left_semi").select(*records.columns)


def fragments_at(variants: DataFrame, fragments: DataFrame, by: str, base: int = 1 << 14) -> DataFrame:
    """Pairs of a variant (start, end, ps) and a fragment (start_r, end_r, ps_r, ...) that touches it, of the same phase set; variants without one take all."""
    touching = variants.withColumn("end", F.col("end") + 1)
    return overlap_join(touching, fragments, by, base).filter(F.col("ps").isNull() | (F.col("ps") == F.col("ps_r"))).withColumn("end", F.col("end") - 1)


def chance_of_all(n: Column, share: Column) -> Column:
    """log10 of the probability, summed over a group's keys, that each falls at least once into n draws of which it takes ``share``."""
    return F.sum(F.log10(F.lit(1.0) - F.pow(F.lit(1.0) - share, n)))


def keys_around_breaks(breaks: DataFrame, reads: DataFrame, keys: DataFrame, before: int, after: int, total: int, base: int = 1 << 14) -> DataFrame:
    """(name, n1, n2, shared, reads1, reads2, log10_binomial, log10_empirical) of breaks (name, chrom1, start1, stop1, chrom2, start2, stop2): distinct keys and reads (contig, start_r, end_r, read, key) of each side's window, the keys that both have, and how likely so many are by chance: with even keys, and with the shares of keys (key, share)."""
    side = lambda k: F.struct(F.lit(k).alias("side"), F.col(f"chrom{k}").alias("contig"), F.greatest(F.col(f"start{k}") - before, F.lit(0)).alias("start"), (F.col(f"stop{k}") + after).alias("end"))
    windows = breaks.select("name", F.explode(F.array(side(1), side(2))).alias("w")).select("name", "w.*")
    hits = overlap_join(windows, reads, "contig", base)
    n = lambda k: F.count(F.when(F.col("side") == k, 1))
    each = hits.groupBy("name", "key").agg(n(1).alias("r1"), n(2).alias("r2"))
    one = lambda c: F.count(F.when(c, 1))
    sums = each.groupBy("name").agg(one(F.col("r1") > 0).alias("n1"), one(F.col("r2") > 0).alias("n2"), one((F.col("r1") > 0) & (F.col("r2") > 0)).alias("shared"), F.sum("r1").alias("reads1"), F.sum("r2").alias("reads2"))
    both = each.filter("r1 > 0 and r2 > 0").select("name", "key").join(keys, "key").join(sums.select("name", F.greatest("n1", "n2").alias("__most")), "name")
    chance = both.groupBy("name").agg(chance_of_all(F.col("__most"), F.col("share")).alias("log10_empirical"))
    own = breaks.select("name").join(sums, "name", "left").join(chance, "name", "left").fillna(0, ["n1", "n2", "shared", "reads1", "reads2"])
    even = log10_binomial_tail(F.col("shared").cast("double"), F.col("n1").cast("double"), F.col("n2") / F.lit(float(total)))
    return own.withColumns({"log10_binomial": F.when(F.col("shared") > 0, even), "log10_empirical": F.col("log10_empirical")})


def target_pairs(fragments: DataFrame, targets: DataFrame, ids: list[str], base: int = 1 << 14) -> DataFrame:
    """(left_target, right_target, n): how many linked fragments (contig1, start1, end1, contig2, start2, end2) touch both targets (contig, start_r, end_r, target)."""
    side = lambda k: fragments.select(*ids, F.col(f"contig{k}").alias("contig"), F.col(f"start{k}").alias("start"), F.col(f"end{k}").alias("end"))
    hit = lambda k, name: overlap_join(side(k), targets, "contig", base).select(*ids, F.col("target").alias(name))
    return hit(1, "left_target").join(hit(2, "right_target"), ids).groupBy("left_target", "right_target").agg(F.count("*").alias("n"))


def exon_phasing(variants: DataFrame, exons: DataFrame, by: str, ids: list[str], base: int = 1 << 14) -> DataFrame:
    """exons (start_r, end_r) with total and phased variants (pos, phased) and their share, null for none."""
    counts = point_join(variants, exons.select(*ids, by, "start_r", "end_r"), by, base).groupBy(*ids).agg(F.count("*").alias("total"), F.count(F.when(F.col("phased"), 1)).alias("phased"))
    return exons.join(counts, ids, "left").fillna(0, ["total", "phased"]).withColumn("share", ratio(F.col("phased"), F.col("total")))


def mean_depths(baits: DataFrame, depths: dict[str, DataFrame], by: str, ids: list[str], base: int = 1 << 14) -> DataFrame:
    """baits (start, end) with the mean of each depth profile (start, end, depth: run lengths) over their positions."""
    size = F.col("end") - F.col("start")
    for name, runs in depths.items():
        right = runs.select(by, F.col("start").alias("start_r"), F.col("end").alias("end_r"), "depth")
        sums = overlap_join(baits.select(*ids, by, "start", "end"), right, by, base).groupBy(*ids).agg(F.sum((F.least("end", "end_r") - F.greatest("start", "start_r")) * F.col("depth")).alias("__sum"))
        baits = baits.join(sums, ids, "left").withColumn(name, F.coalesce(F.try_divide(F.col("__sum").cast("double"), size), F.lit(0.0))).drop("__sum")
    return baits


def haplotype_depth(reads: DataFrame, by: list[str], cutoffs: list[int], tile: int = TILE) -> DataFrame:
    """Depth runs (by, cutoff, hp, start, end, depth) of reads (start, end, mapq, hp): for each cutoff those of its mapping quality or more."""
    met = F.filter(F.array(*map(F.lit, cutoffs)), lambda c: F.col("mapq") >= c)
    return depth(reads.select(*by, "start", "end", "hp", F.explode(met).alias("cutoff")), [*by, "cutoff", "hp"], tile)


def excluded(runs: DataFrame, by: list[str], most: int, tile: int = TILE) -> DataFrame:
    """The regions whose depth is over ``most``."""
    return merge(runs.filter(F.col("depth") > most), by, touching=True, tile=tile).select(*by, "start", "end")


def pileups(calls: DataFrame, runs: DataFrame, by: str, ids: list[str], ext: int, bin_: int, times: float, low: float, high: float, base: int = 1 << 14) -> DataFrame:
    """calls (start, end) with pileup: whether one of the first or last two bins of depth around a call stands over ``times`` the median bin, unless the median depth of the call is below ``low`` or above ``high`` times that of the stretches beside it, half as long as the call."""
    runs = cut_lineage(runs)  # read five times
    begin, stop, half = F.greatest(F.col("start") - ext, F.lit(0)), F.col("end") + ext, F.floor((F.col("end") - F.col("start")) / 2)
    own = calls.select(*ids, by, begin.alias("a"), stop.alias("z"), half.alias("h"))
    right = runs.select(by, F.col("start").alias("start_r"), F.col("end").alias("end_r"), "depth")
    shared = F.least("end", "end_r") - F.greatest("start", "start_r")

    def medians(parts: DataFrame, name: str) -> DataFrame:
        """Of the depths of all positions of the parts (ids, start, end), those without a run counting as zero."""
        hits = overlap_join(parts, right, by, base).groupBy(*ids, "depth").agg(F.sum(shared).alias("n"))
        covered = hits.groupBy(*ids).agg(F.sum("n").alias("n"))
        sizes = parts.groupBy(*ids).agg(F.sum(F.col("end") - F.col("start")).alias("size"))
        zeros = sizes.join(covered, ids, "left").select(*ids, F.lit(0).cast("long").alias("depth"), (F.col("size") - F.coalesce("n", F.lit(0))).alias("n")).filter("n > 0")
        return hits.select(*ids, "depth", "n").unionByName(zeros).groupBy(*ids).agg(F.percentile("depth", 0.5, F.col("n")).alias(name))

    inside = own.select(*ids, by, F.col("a").alias("start"), F.col("z").alias("end"))
    beside = own.select(*ids, by, F.explode(F.array(F.struct(F.greatest(F.col("a") - F.col("h"), F.lit(0)).alias("start"), F.col("a").alias("end")), F.struct(F.col("z").alias("start"), (F.col("z") + F.col("h")).alias("end")))).alias("p")).select(*ids, by, "p.*").filter("start < end")
    bins = own.select(*ids, by, "a", "z", F.explode(F.sequence(F.floor(F.col("a") / bin_), F.floor((F.col("z") - 1) / bin_))).alias("bin"))
    bins = bins.select(*ids, by, "bin", F.greatest(F.col("bin") * bin_, F.col("a")).alias("start"), F.least((F.col("bin") + 1) * bin_, F.col("z")).alias("end"))
    means = mean_depths(bins, {"mean": runs}, by, [*ids, "bin"], base).groupBy(*ids).agg(F.array_sort(F.collect_list(F.struct("bin", "mean"))).alias("b"), F.percentile("mean", 0.5).alias("middle"))  # as many bins as a call is long
    edge = reduce(lambda x, y: x | y, [F.element_at("b", k)["mean"] > times * F.col("middle") for k in (1, 2, -1, -2)])
    out = own.join(means, ids).join(medians(inside, "__in"), ids, "left").join(medians(beside, "__out"), ids, "left")
    clear = (F.col("__in") < low * F.col("__out")) | (F.col("__in") > high * F.col("__out"))
    flag = out.select(*ids, (~F.coalesce(clear, F.lit(False)) & F.when(F.size("b") > 4, edge).otherwise(False)).alias("pileup"))
    return calls.join(flag, ids, "left")


def random_windows(contigs: DataFrame, n: int, size: int, seed: int = 0) -> DataFrame:
    """(k, contig, start, end): n windows of ``size``, placed by a hash of their number, contigs (contig, length) taking shares by their length; a window stays inside its contig. Contigs are a small table."""
    w = W.orderBy("contig").rowsBetween(W.unboundedPreceding, W.currentRow)
    laid = contigs.filter(F.col("length") >= size).withColumn("stop", F.sum(F.col("length") - size + 1).over(w)).withColumn("first", F.col("stop") - (F.col("length") - size + 1))
    total = laid.agg(F.max("stop").alias("total"))
    drawn = contigs.sparkSession.range(n).select(F.col("id").alias("k"), F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 15), 16, 10).cast("long").alias("h"))
    at = drawn.join(F.broadcast(total)).select("k", (F.col("h") % F.col("total")).alias("at"))  # one row
    placed = as_of(at, laid.select(F.col("first").alias("at"), "contig", "first"), [], "at", tile=1 << 32)
    return placed.select("k", "contig", (F.col("at") - F.col("first")).alias("start"), (F.col("at") - F.col("first") + size).alias("end"))
