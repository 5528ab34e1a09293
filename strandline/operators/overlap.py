"""Shared keys: barcodes that touch the same bins, windows that hold the same barcodes, and what chance would give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.functions.numeric import log10_binomial_tail, poisson_tail
from strandline.lineage import cut_lineage
from strandline.operators.graph import components
from strandline.operators.matching import pair_counts


#: Keys of a bin that the others are compared with first.
HUBS = 3


def coalesced(df: DataFrame, key: str, bin_: str, p_value: float, least: int, most_keys: int | None = None) -> DataFrame:
    """(key, cluster) of keys that share more bins than chance explains: over ``least``, six standard deviations and a Poisson tail below ``p_value``; clusters are connected components. The mean under chance is the product of the keys' bins over the effective number of bins.

    Keys first meet a few keys of each bin, those that are first by hash in most bins; what they share there is no more than what they share in all, so a link is one.
    Only bins that then hold keys of several components list their pairs, and only pairs of different ones.
    """
    own = cut_lineage(df.select(F.col(key).alias("k"), F.col(bin_).alias("bin")).distinct())
    sizes = own.groupBy("k").agg(F.count("*").alias("size"))
    per_bin = own.groupBy("bin").agg(F.count("*").alias("c"))
    bins = per_bin.agg((F.sum("c") * F.sum("c") / F.sum(F.col("c") * F.col("c"))).alias("bins"))
    met = own.filter("k is not null and bin is not null")
    if most_keys is not None:
        met = met.join(per_bin.filter(F.col("c") <= most_keys).select("bin"), "bin", "left_semi")

    def hits(pairs: DataFrame) -> DataFrame:
        both = pairs.filter(F.col("n") > least).join(sizes.select(F.col("k").alias("a"), F.col("size").alias("na")), "a").join(sizes.select(F.col("k").alias("b"), F.col("size").alias("nb")), "b").join(F.broadcast(bins))  # one row
        rate = (F.col("na") * F.col("nb") / F.col("bins")).alias("rate")
        near = both.select("a", "b", F.col("n").cast("double").alias("n"), rate).filter(F.col("n") >= F.col("rate") + 6 * F.sqrt("rate"))
        return near.filter(poisson_tail(F.col("n") + 1, F.col("rate")) < p_value).select("a", "b")

    firsts = met.groupBy("bin").agg(F.min_by("k", F.struct(F.xxhash64("k"), F.col("k"))).alias("h")).groupBy("h").agg(F.count("*").alias("leads"))
    ranked = met.join(firsts, F.col("k") == F.col("h")).withColumn("place", F.row_number().over(W.partitionBy("bin").orderBy(F.desc("leads"), "h")))
    hubs = ranked.filter(F.col("place") <= HUBS).select("bin", "h")
    starred = met.join(hubs, "bin").filter("k <> h").groupBy(F.col("k").alias("a"), F.col("h").alias("b")).agg(F.count("*").alias("n"))
    first = cut_lineage(hits(starred))
    rooted = cut_lineage(met.join(components(first).withColumnsRenamed({"node": "k"}), "k", "left").withColumn("root", F.coalesce("root", "k")))
    mixed = rooted.join(rooted.groupBy("bin").agg(F.min("root").alias("x"), F.max("root").alias("z")).filter("x <> z").select("bin"), "bin", "left_semi")
    side = lambda k, r: mixed.select("bin", F.col("k").alias(k), F.col("root").alias(r))
    rest = side("a", "ra").join(side("b", "rb"), "bin").filter("a < b and ra <> rb").groupBy("a", "b").agg(F.count("*").alias("n"))
    return components(first.unionAll(hits(rest))).withColumnsRenamed({"node": key, "root": "cluster"})


def window_overlaps(df: DataFrame, window: str, key: str, keys: int, most_log10: float, least: int, min_distance: int = 0, most_keys: int | None = None) -> DataFrame:
    """(a, b, n, log10_p) of windows at least ``min_distance`` apart that share ``least`` keys or more: the binomial tail of sharing n of the smaller one's keys when each key falls into the larger one with its share of all ``keys``."""
    own = df.select(window, key).distinct()
    sizes = own.groupBy(window).agg(F.count("*").alias("n"))
    pairs = pair_counts(own, key, window, least, most_keys).filter(F.col("b") - F.col("a") >= min_distance)
    both = pairs.join(sizes.select(F.col(window).alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col(window).alias("b"), F.col("n").alias("nb")), "b")
    tail = log10_binomial_tail((F.col("n") - 1).cast("double"), F.least("na", "nb").cast("double"), F.greatest("na", "nb") / F.lit(float(keys)))
    return both.select("a", "b", "n", tail.alias("log10_p")).filter(F.col("log10_p") <= most_log10)


def survival(counts: DataFrame, value: str) -> DataFrame:
    """counts (value, n) with log_survival: the log of the share of larger values, null at the largest."""
    w = W.orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    share = F.sum("n").over(w) / F.sum("n").over(W.partitionBy())
    return counts.withColumn("log_survival", F.when(share < 1, F.ln(1 - share)))


def expected_share(lengths: DataFrame, distances: Column) -> DataFrame:
    """(distance, share): the share of molecules (length, n) that reach over each distance, weighed by the places they can lie at: the sum of max(length - distance, 0) over the sum of lengths."""
    own = lengths.select("length", "n", F.explode(distances).alias("distance"))
    return own.groupBy("distance").agg(F.try_divide(F.sum(F.greatest(F.col("length") - F.col("distance"), F.lit(0)) * F.col("n")).cast("double"), F.sum(F.col("length") * F.col("n")).cast("double")).alias("share"))


def harmonic_edges(most: int, scale: float = 1.0) -> list[int]:
    """Upper ends of bins that widen as the square root of the count: few bins for any depth."""
    out, k = [0, 1], 1
    while out[-1] < most:
        edge = round(k**1.5 / 1.5 * scale)
        if edge > out[-1]:
            out.append(edge)
        k += 1
    return out


def discretised(value: Column, most: int, scale: float = 1.0) -> Column:
    """The middle of the bin that holds the value, capped at ``most``; bins are (lower end, upper end]."""
    edges = harmonic_edges(most, scale)
    bins = F.lit([0] + [round((a + b) / 2) for a, b in zip(edges, edges[1:], strict=False)])
    upper = F.lit(edges)
    below = F.size(F.filter(upper, lambda e: e < F.least(value, F.lit(most))))
    return F.get(bins, below)


def merged_bins(bins: DataFrame, by: list[str], size: int) -> DataFrame:
    """Runs of ``size`` neighbouring bins (bin, molecules: array, n, score) as one: the union of molecules, summed counts, mean score."""
    own = bins.withColumn("__bin", F.floor(F.col("bin") / size))
    return own.groupBy(*by, "__bin").agg(F.size(F.array_distinct(F.flatten(F.collect_list("molecules")))).alias("molecules"), F.sum("n").alias("n"), F.avg("score").alias("score")).withColumnRenamed("__bin", "bin")
