"""Copy-number and break events: flanking backgrounds, parity, truth status, mates, call sets of several samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.functions.numeric import binomial_test
from strandline.operators.aggregates import ratio
from strandline.operators.intervals import overlap_join, overlapping
from strandline.operators.matching import breakpoints_met
from strandline.operators.sessions import clusters


def background(bins: DataFrame, by: list[str], order: str, value: str, size: int, flank: int) -> DataFrame:
    """bins with expected: the flanking bins' value per base times the bin's own bases (column size); null without flanks."""
    w = W.partitionBy(*by).orderBy(order)
    total = lambda c: F.coalesce(F.sum(c).over(w.rowsBetween(-flank, -1)), F.lit(0)) + F.coalesce(F.sum(c).over(w.rowsBetween(1, flank)), F.lit(0))
    return bins.withColumn("expected", F.try_divide(total(value).cast("double"), total("size").cast("double")) * F.col("size"))


def parity(one: Column, other: Column) -> Column:
    """How unlikely the split between two haplotypes is at even odds: two-sided."""
    return binomial_test(F.least(one, other).cast("double"), (one + other).cast("double"))


def truth_status(calls: DataFrame, truth: DataFrame, ids: list[str], base: int = 1 << 14) -> DataFrame:
    """(kind, n) of calls (contig, start, end) and truths: TP and FP calls, FN truths, by any overlap; sensitivity and ppv beside."""
    right = lambda df: df.select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    tp = overlapping(calls, right(truth), "contig", ids, base).agg(F.count("*").alias("tp"))
    fn = overlapping(truth, right(calls), "contig", ids, base, anti=True).agg(F.count("*").alias("fn"))
    all_ = calls.agg(F.count("*").alias("calls")).join(truth.agg(F.count("*").alias("truths"))).join(tp).join(fn)  # one row each
    return all_.select("tp", (F.col("calls") - F.col("tp")).alias("fp"), "fn", ratio(F.col("truths") - F.col("fn"), F.col("truths")).alias("sensitivity"), ratio(F.col("tp"), F.col("calls")).alias("ppv"))


def passing(events: DataFrame, rules: dict[str, Column], tracks: dict[str, DataFrame], ids: list[str], base: int = 1 << 14) -> DataFrame:
    """events with filters: the names of the rules that hold and of the tracks (contig, start_r, end_r) that they overlap."""
    own = events.withColumn("filters", F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()])) if rules else F.array().cast("array<string>"))
    for name, track in tracks.items():
        hit = overlapping(events, track, "contig", ids, base).select("contig", "start", "end", F.lit(name).alias("__hit")).distinct()
        own = own.join(hit, ["contig", "start", "end"], "left").select(*own.columns, "__hit").withColumn("filters", F.when(F.col("__hit").isNotNull(), F.array_append("filters", F.col("__hit"))).otherwise(F.col("filters"))).drop("__hit")
    return own


def mates(calls: DataFrame, window: int) -> DataFrame:
    """calls with nmates: other calls with a breakpoint in the cluster of one of theirs; a call that many others touch is likely an artefact."""
    ends = lambda k: calls.select("name", F.col(f"chrom{k}").alias("contig"), F.col(f"start{k}").alias("start"), F.col(f"stop{k}").alias("end"))
    spots = ends(1).unionByName(ends(2)).select("contig", "start", "end").distinct()
    numbered = clusters(spots, ["contig"], window)
    member = ends(1).unionByName(ends(2)).join(numbered, ["contig", "start", "end"]).select("name", "contig", "cluster").distinct()
    sizes = member.groupBy("contig", "cluster").agg(F.count("*").alias("n"))
    # a name in two clusters counts each cluster's others; callers compare with a limit only
    return calls.join(member.join(sizes, ["contig", "cluster"]).groupBy("name").agg(F.sum(F.col("n") - 1).alias("nmates")), "name", "left").withColumn("nmates", F.coalesce("nmates", F.lit(0)))


def compared(samples: dict[str, DataFrame], truth: DataFrame, slack: int, base: int = 1 << 14) -> DataFrame:
    """(truth, in_<sample> ...): which call sets hold each truth."""
    found = [breakpoints_met(df, truth, slack, base).withColumn(f"in_{k}", F.lit(True)) for k, df in samples.items()]
    own = reduce(lambda a, b: a.join(b, "truth", "left"), found, truth.select(F.col("name").alias("truth")))
    return own.withColumns({f"in_{k}": F.coalesce(f"in_{k}", F.lit(False)) for k in samples})


def shared_bases(left: DataFrame, right: DataFrame, by: str, ids: list[str], base: int = 1 << 14) -> DataFrame:
    """(ids, shared): positions that each interval of left shares with intervals of right, counted once for each."""
    pairs = overlap_join(left, right, by, base)
    return pairs.groupBy(*ids).agg(F.sum(F.least("end", "end_r") - F.greatest("start", "start_r")).alias("shared"))
