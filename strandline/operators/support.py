"""Evidence for calls and states: molecules at breaks, rescued scores, error tables, shares of bins, significance of intervals, flow-cell places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.numeric import chi_square_tail, poisson_log_pmf
from strandline.operators.fuzzy import BASES, neighbours, second_neighbours
from strandline.operators.intervals import overlap_join
from strandline.operators.ordered import TILE
from strandline.operators.sessions import best_of, gap_sessions


def molecules_at_breaks(breaks: DataFrame, reads: DataFrame, reach: int, gap: int, least: int, base: int = 1 << 14, tile: int = TILE) -> DataFrame:
    """(name, side, key, molecule, start, end, n) of breaks (name, contig1, pos1, contig2, pos2): the reads (contig, start_r, end_r, key) within ``reach`` of either side, put together by key where they come within ``gap`` of each other; those of ``least`` reads or more."""
    side = lambda k: F.struct(F.lit(k).alias("side"), F.col(f"contig{k}").alias("contig"), F.greatest(F.col(f"pos{k}") - reach, F.lit(0)).alias("start"), (F.col(f"pos{k}") + reach).alias("end"))
    windows = breaks.select("name", F.explode(F.array(side(1), side(2))).alias("w")).select("name", "w.*")
    hits = overlap_join(windows, reads, "contig", base).select("name", "side", "key", F.col("start_r").alias("start"), F.col("end_r").alias("end"))
    own = gap_sessions(hits, ["name", "side", "key"], "start", gap, "molecule", ties=["end"], tile=tile)
    return own.groupBy("name", "side", "key", "molecule").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")).filter(F.col("n") >= least)


def rescued(reads: DataFrame, least: int, bonus: float, cap: float) -> DataFrame:
    """reads (contig, variant, score, ...) with rescued: the score and ``bonus`` for each other read that shows the same variant, ``cap`` at most, where ``least`` reads show it; else the score. Variants are counted before they meet the reads, so that one in a third of all reads is no hot spot of counting."""
    counts = reads.filter("variant is not null").groupBy("contig", "variant").agg(F.count("*").alias("__n"))
    more = F.when(F.col("__n") >= least, F.least(F.col("score") + bonus * (F.col("__n") - 1), F.lit(cap)))
    return reads.join(counts, ["contig", "variant"], "left").withColumn("rescued", F.greatest(F.col("score"), F.coalesce(more, F.col("score")))).drop("__n")


def shifted(key: Column, letters: str = BASES) -> Column:
    """Array of the texts of the same length that come of losing a letter (any other follows at the end) or gaining one (the last drops out)."""
    places, each = F.sequence(F.lit(1), F.length(key)), F.array(*map(F.lit, letters))
    n = F.length(key)
    lost = F.flatten(F.transform(places, lambda i: F.transform(each, lambda c: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(key, i + 1, n), c))))
    gained = F.flatten(F.transform(places, lambda i: F.transform(each, lambda c: F.concat(F.substring(key, F.lit(1), i - 1), c, F.substring(key, i, n - i)))))
    return F.array_distinct(F.concat(lost, gained))


def error_table(allowed: DataFrame, two_errors: bool = False, indel: bool = False, letters: str = BASES) -> DataFrame:
    """(wrong, key): what a key may have been read as, with one wrong letter, with two, or with one lost or gained; texts that are keys themselves, or could be of two keys, are left out. A table to join reads with."""
    key = F.col("key")
    texts = [F.transform(neighbours(key, letters), lambda x: x["text"])]
    if two_errors:
        texts.append(F.transform(second_neighbours(key, letters), lambda x: x["text"]))
    if indel:
        texts.append(shifted(key, letters))
    keys = allowed.select("key").distinct()
    rows = keys.select("key", F.explode(F.array_distinct(F.concat(*texts))).alias("wrong")).join(keys.select(F.col("key").alias("wrong")), "wrong", "left_anti")
    return rows.groupBy("wrong").agg(F.min("key").alias("key"), F.max("key").alias("__other")).filter("key = __other").drop("__other")


def bin_shares(fragments: DataFrame, by: list[str], size: int, value: str) -> DataFrame:
    """(by, bin, value): the value of fragments (start, end) dealt to bins in proportion to the positions that lie in each."""
    bins = F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))).alias("bin")
    own = fragments.filter("start < end").select(*by, "start", "end", value, bins)
    inside = F.least(F.col("end"), (F.col("bin") + 1) * size) - F.greatest(F.col("start"), F.col("bin") * size)
    return own.groupBy(*by, "bin").agg(F.sum(F.col(value) * inside / (F.col("end") - F.col("start"))).alias(value))


def interval_significance(bins: DataFrame, intervals: DataFrame, by: str, ids: list[str], rates: list[float], base: int = 1 << 14) -> DataFrame:
    """(ids, state, twice, p) of intervals (start, end) over bins (start_r, end_r, n): the state whose Poisson rate explains the counts best, twice the difference of its log likelihood from the second best, and the tail of that under chance."""
    scores = F.array(*[F.struct(F.lit(k).alias("state"), poisson_log_pmf(F.col("n").cast("double"), F.lit(r)).alias("ll")) for k, r in enumerate(rates)])
    scored = bins.select(by, "start_r", "end_r", F.explode(scores).alias("s")).select(by, "start_r", "end_r", "s.*")
    sums = overlap_join(intervals.select(*ids, by, "start", "end"), scored, by, base).groupBy(*ids, "state").agg(F.sum("ll").alias("ll"))
    ranked = sums.groupBy(*ids).agg(F.max_by("state", F.struct("ll", -F.col("state"))).alias("state"), F.sort_array(F.collect_list("ll"), False).alias("l"))  # as many as states
    twice = F.greatest(2 * (F.get("l", 0) - F.get("l", 1)), F.lit(1e-60))
    return ranked.select(*ids, "state", twice.alias("twice")).withColumn("p", chi_square_tail(F.col("twice")))


def haplotypes_of_edges(edges: DataFrame, kmer_keys: DataFrame, key_haplotypes: DataFrame) -> DataFrame:
    """(edge, unphased, one, two): distinct keys of an edge's k-mers (edge, kmer) on neither and on each haplotype (key, hp)."""
    seen = edges.join(kmer_keys, "kmer").select("edge", "key").distinct().join(key_haplotypes, "key", "left")
    n = lambda c: F.count(F.when(c, 1))
    return seen.groupBy("edge").agg(n(F.coalesce("hp", F.lit(0)) == 0).alias("unphased"), n(F.col("hp") == 1).alias("one"), n(F.col("hp") == 2).alias("two"))


def lane_places(reads: DataFrame, by: list[str]) -> DataFrame:
    """reads (tile: side, swath and two digits; x, y) with lane_x and lane_y: places on the whole lane, swaths side by side and tiles one above another, at the extents that the reads show."""
    extents = reads.groupBy(*by).agg(F.min("x").alias("__x0"), (F.max("x") - F.min("x") + 1).alias("__w"), F.min("y").alias("__y0"), (F.max("y") - F.min("y") + 1).alias("__h"))
    swath, row = F.floor(F.col("tile") / 100) % 10, F.col("tile") % 100
    own = reads.join(extents, by)
    return own.withColumns({"lane_x": (swath - 1) * F.col("__w") + F.col("x") - F.col("__x0"), "lane_y": (row - 1) * F.col("__h") + F.col("y") - F.col("__y0")}).drop("__x0", "__w", "__y0", "__h")


def top_contributions(df: DataFrame, by: list[str], value: str, n: int, ties: list) -> DataFrame:
    """(by, top, share): the n largest values of each group, in order, and their share of its sum."""
    sums = df.groupBy(*by).agg(F.sum(value).alias("__all"))
    best = best_of(df, by, [F.desc(value), *ties], n).groupBy(*by).agg(F.sort_array(F.collect_list(value), False).alias("top"))
    return best.join(sums, by).select(*by, "top", (F.aggregate("top", F.lit(0.0), lambda t, x: t + x) / F.col("__all")).alias("share"))
