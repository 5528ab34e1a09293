"""Phasing whole chromosomes from sparse evidence, with no chunks: rounds of the flips that help most, all over a chromosome at once.

Evidence says how much likelier a key has a variant's first allele than its second (log odds). A key lies on one haplotype, so the phases of variants, +1 or -1, are as good as the sum over keys
of log(exp(s / 2) + exp(-s / 2)), s being the sum of its signed odds. Two kinds of moves change phases: one variant turns around, or a junction does, with all
variants behind it. Their gains are sums over the keys that they touch. Each round makes every gainful move that is the best one of all its keys; such moves share no key, so their gains add up and the sum rises
every round, and the rounds end when no move gains. Where the first phases come from: each variant agrees with the one before it as the keys that hold both say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.operators.intervals import overlap_join
from strandline.operators.ordered import across

#: Gains below this are rounding.
LEAST_GAIN = 1e-9


def _value(s: Column) -> Column:
    return F.abs(s) / 2 + F.log1p(F.exp(-F.abs(s)))


def _signed(evidence: DataFrame, phases: DataFrame, by: list[str], tile: int) -> DataFrame:
    """evidence with x, the signed odds, their sum over the key, and up to the row."""
    signed = evidence.join(phases.select(*by, "place", "x"), [*by, "place"]).withColumn("signed", F.col("odds") * F.col("x"))
    whole = signed.groupBy(*by, "key").agg(F.sum("signed").alias("whole"))
    running = across(signed, [*by, "key"], ["place"], {"up_to": ("sum", F.col("signed")), "was": ("lag", F.col("place"))}, tile)
    return cut_lineage(running.join(whole, [*by, "key"]))


def _gains(signed: DataFrame, places: DataFrame, by: list[str], tile: int) -> DataFrame:
    """(by, place, one, tail): what turning a variant around gains, and turning it with all behind it."""
    gain = lambda s: _value(s) - _value(F.col("whole"))
    one = signed.groupBy(*by, "place").agg(F.sum(gain(F.col("whole") - 2 * F.col("signed"))).alias("one"))
    # a key's sum changes alike at all junctions between two of its rows: a step up behind the first and down behind the second
    head = F.col("up_to") - F.col("signed")
    g = gain(2 * head - F.col("whole"))
    steps = signed.filter("was is not null").select(*by, F.explode(F.array(F.struct((F.col("was") + 1).alias("place"), g.alias("g")), F.struct((F.col("place") + 1).alias("place"), (-g).alias("g")))).alias("s")).groupBy(*by, F.col("s.place").alias("place")).agg(F.sum("s.g").alias("g"))
    every = places.select(*by, "place").join(one, [*by, "place"], "left").join(steps, [*by, "place"], "left")
    out = across(every.withColumn("g", F.coalesce("g", F.lit(0.0))), by, ["place"], {"tail": ("sum", F.col("g"))}, tile)
    return cut_lineage(out.select(*by, "place", F.coalesce("one", F.lit(0.0)).alias("one"), "tail"))


def phased(evidence: DataFrame, by: list[str], least: float = 2.0, tile: int = 1 << 12) -> DataFrame:
    """(by, variant, block, haplotype, sure): phases of variants from rows (by, variant, key, odds).

    sure is what is lost by turning a variant and all behind it around: a block begins where that is below ``least`` (no key spans the place: nothing is lost). haplotype says which of its alleles a variant
    has on the haplotype on which the block's first variant has its first one. Rows of one key and variant add up; rows with a null are left out. tile: how
    many variants a task's windows take; the result doesn't depend on it.
    """
    some = F.col("odds").isNotNull() & F.col("key").isNotNull() & F.col("variant").isNotNull()
    rows = cut_lineage(evidence.filter(some).groupBy(*by, "variant", "key").agg(F.sum("odds").alias("odds")))
    width = 1 << 20  # of variant positions
    places = cut_lineage(across(rows.select(*by, "variant").distinct(), by, ["variant"], {"place": ("sum", F.lit(1).cast("long"))}, width))
    own = cut_lineage(rows.join(places, [*by, "variant"]).select(*by, "place", "key", "odds"))
    spans = own.groupBy(*by, "key").agg((F.min("place") + 1).alias("start_r"), (F.max("place") + 1).alias("end_r")).filter("start_r < end_r")
    spans = cut_lineage(spans)
    longest = spans.agg(F.max(F.col("end_r") - F.col("start_r"))).first()[0] or 1
    before = across(own, [*by, "key"], ["place"], {"was": ("lag", F.col("place")), "had": ("lag", F.col("odds"))}, tile)
    pull = _value(F.col("odds") + F.col("had")) - _value(F.col("odds") - F.col("had"))
    links = before.filter("was = place - 1").groupBy(*by, "place").agg(F.sum(pull).alias("pull"))
    turns = places.join(links, [*by, "place"], "left").withColumn("turn", F.when(F.col("pull") < 0, 1).otherwise(0))
    phases = cut_lineage(across(turns, by, ["place"], {"n": ("sum", F.col("turn"))}, tile).select(*by, "place", F.when(F.col("n") % 2 == 0, 1).otherwise(-1).alias("x")))
    while True:
        signed = _signed(own, phases, by, tile)
        gains = _gains(signed, places, by, tile)
        moves = gains.select(*by, "place", F.explode(F.array(F.struct(F.lit(0).alias("kind"), F.col("one").alias("gain")), F.struct(F.lit(1).alias("kind"), F.col("tail").alias("gain")))).alias("m")).select(*by, "place", "m.kind", F.round("m.gain", 9).alias("gain"))
        moves = moves.filter(F.col("gain") > LEAST_GAIN)
        if moves.isEmpty():
            break
        ones = moves.filter("kind = 0").join(own.select(*by, "place", "key"), [*by, "place"])
        tails = overlap_join(moves.filter("kind = 1").withColumns({"start": F.col("place"), "end": F.col("place") + 1}), spans, by, 64, longest=longest).select(*ones.columns)
        touched = ones.unionAll(tails)
        best = touched.groupBy(*by, "key").agg(F.max_by(F.struct("place", "kind"), F.struct("gain", -F.col("place"), -F.col("kind"))).alias("best"))
        held = touched.join(best, [*by, "key"]).groupBy(*by, "place", "kind").agg(F.min((F.col("best.place") == F.col("place")) & (F.col("best.kind") == F.col("kind"))).alias("all")).filter("all")
        flips = held.groupBy(*by, "place").agg(F.count(F.when(F.col("kind") == 0, 1)).alias("alone"), F.count(F.when(F.col("kind") == 1, 1)).alias("behind"))
        now = phases.join(flips, [*by, "place"], "left").fillna(0, ["alone", "behind"])
        turned = across(now, by, ["place"], {"n": ("sum", F.col("behind"))}, tile)
        phases = cut_lineage(turned.select(*by, "place", F.when((F.col("n") + F.col("alone")) % 2 == 1, -F.col("x")).otherwise(F.col("x")).alias("x")))
    ready = phases.join(gains, [*by, "place"]).withColumn("sure", F.round(F.abs(F.col("tail")), 9)).select(*by, "place", "x", "sure")
    new = (F.col("sure") < least) | (F.col("place") == 1)
    marked = across(ready.withColumn("__new", new), by, ["place"], {"block": ("sum", F.col("__new").cast("long")), "__first": ("last", F.when(F.col("__new"), F.col("x")))}, tile)
    return marked.join(places, [*by, "place"]).select(*by, "variant", "block", (F.col("x") != F.col("__first")).cast("int").alias("haplotype"), "sure")
