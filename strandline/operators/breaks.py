"""Breaks from read pairs: the likelihood of every pair of break positions of a locus, with the haplotypes of keys by expectation and maximisation."""

from __future__ import annotations

from math import log, log1p

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage


def _log_add(a: Column, b: Column) -> Column:
    top = F.greatest(a, b)
    return F.when(top == float("-inf"), top).otherwise(top + F.log1p(F.exp(-F.abs(a - b))))


def _log(p: Column) -> Column:
    return F.when(p > 0, F.ln(p)).otherwise(F.lit(float("-inf")))


def pair_chances(pairs: DataFrame, cells: DataFrame, survival: list[float], reach: int, chimeras: float = 1e-9, least: float = -1000.0) -> DataFrame:
    """(locus, b1, b2, key, none, sv): log-likelihoods of a key's pairs without a break and with a deletion between b1 and b2.

    pairs: locus, key, outer1, inner1, inner2, outer2 (the two reads' ends), wrong (the chance that a read lies elsewhere), normal, split. cells: locus, b1, b2. survival: the log of the chance of
    an insert of 0, 1, .. positions or more. A pair that isn't normal supports breaks between its reads, at most ``reach`` from each, by the insert they would leave it;
    a split read by itself. Reads inside the deletion are all but impossible (``least``). The join is dealt by cells, so a locus with
    many pairs is as many tasks as it has cells.
    """
    table = F.lit([float(x) for x in survival])
    chance = lambda size: F.get(table, F.least(F.greatest(size, F.lit(0)), F.lit(len(survival) - 1)).cast("int"))
    right, wrong = F.log1p(-F.col("wrong")), _log(F.col("wrong"))
    mixed = lambda p: _log_add(log1p(-chimeras) + p, F.lit(log(chimeras) + least))
    own = pairs.withColumn("__none", mixed(_log_add(right + chance(F.col("outer2") - F.col("outer1")), wrong + least)))
    # pairs are spread over the cells of their locus by a number, so that no locus is one task
    met = own.join(cells, "locus")
    inside = F.col("b1").between(F.col("inner1"), F.col("inner1") + reach - 1) & F.col("b2").between(F.col("inner2") - reach + 1, F.col("inner2"))
    insert = F.when(F.col("split"), F.lit(0.0)).otherwise(chance(F.col("b1") - F.col("outer1") + F.col("outer2") - F.col("b2")))
    broken = mixed(_log_add(right + insert, wrong + least))
    lost = ((F.col("inner1") > F.col("b1")) & (F.col("outer1") < F.col("b2"))) | ((F.col("outer2") > F.col("b1")) & (F.col("inner2") < F.col("b2")))
    sv = F.when(lost, F.lit(least)).when(~F.col("normal") & inside, broken).otherwise(F.col("__none"))
    return met.groupBy("locus", "b1", "b2", "key").agg(F.sum("__none").alias("none"), F.sum(sv).alias("sv"))


def break_models(chances: DataFrame, phases: DataFrame, rounds: int = 5, tolerance: float = 1e-4, mixed: float = 0.1) -> DataFrame:
    """(locus, none, hom, het, zygosity, b1, b2, hap1, hap2, support, settled): the best model of each locus from ``pair_chances``.

    phases: locus, key, a0, a1, z0, z1 (chances of either haplotype at the first and at the second break), same (both lie in one phase set); keys without a row
    are one half each. Each round takes the pair of haplotypes and the cell that explain all keys best, ties by the smaller cell and haplotypes, and weighs each key's
    haplotypes anew by it; keys that may be of both (more than ``mixed`` is on neither) stay. ``settled`` says whether weights moved by ``tolerance`` at most in the last round; loci that have settled
    stay put and the rounds end when all have. A homozygous model wins a tie. hap1 and hap2 are null for it; support counts keys that the break explains better.
    """
    chances = cut_lineage(chances)
    keys = chances.select("locus", "key").distinct()
    flags = chances.select("locus").distinct().join(phases.groupBy("locus").agg(F.max("same").alias("same")), "locus", "left").select("locus", F.coalesce("same", F.lit(False)).alias("same"))
    half = [F.coalesce(c, F.lit(0.5)).alias(c) for c in ("a0", "a1", "z0", "z1")]
    weights = keys.join(phases.drop("same"), ["locus", "key"], "left").join(flags, "locus").select("locus", "key", "same", *half)
    mixture = F.greatest(1 - F.col("a0") - F.col("a1"), 1 - F.col("z0") - F.col("z1")) > mixed
    weights = cut_lineage(weights.select("*", mixture.alias("stays"), F.lit(False).alias("settled")))
    pick = lambda side, h: F.when(h == 0, F.col(f"{side}0")).otherwise(F.col(f"{side}1"))
    haps = F.explode(F.array(*[F.struct(F.lit(x).alias("h1"), F.lit(y).alias("h2")) for x in (0, 1) for y in (0, 1)]))
    order = lambda score: F.struct(score, -F.col("b1"), -F.col("b2"), -F.col("h1"), -F.col("h2"))

    def totals(weights):
        rows = chances.join(weights, ["locus", "key"]).withColumn("__h", haps).filter("not same or __h.h1 = __h.h2").withColumns({"h1": F.col("__h.h1"), "h2": F.col("__h.h2")})
        hp = F.least(pick("a", F.col("h1")), pick("z", F.col("h2")))
        each = _log_add(_log(hp) + F.col("sv"), _log(1 - hp) + F.col("none"))
        return rows.groupBy("locus", "b1", "b2", "h1", "h2").agg(F.sum(each).alias("het"))

    def best(weights):
        return totals(weights).groupBy("locus").agg(F.max_by(F.struct("het", "b1", "b2", "h1", "h2"), order(F.round("het", 9))).alias("m")).select("locus", "m.*")

    last = None
    for _ in range(rounds):
        last = cut_lineage(best(weights))
        now = weights.join(last, "locus").join(chances, ["locus", "b1", "b2", "key"])
        hp = F.least(pick("a", F.col("h1")), pick("z", F.col("h2")))
        yes, no = F.col("sv") + _log(hp), F.col("none") + _log(1 - hp)
        p = F.when(F.col("stays") | F.col("settled"), F.lit(None)).otherwise(F.exp(yes - _log_add(yes, no)))
        now = now.withColumn("__p", p)
        new = {f"{side}{h}": F.when(F.col("__p").isNull(), F.col(f"{side}{h}")).otherwise(F.when(F.col(k) == h, F.col("__p")).otherwise(1 - F.col("__p"))) for side, k in (("a", "h1"), ("z", "h2")) for h in (0, 1)}
        moved = F.greatest(*[F.abs(F.col(f"__{c}") - F.col(c)) for c in new])
        now = now.withColumns({f"__{c}": v for c, v in new.items()}).withColumn("__moved", moved)
        now = cut_lineage(now.select("locus", "key", "same", "stays", "settled", "__moved", *[F.col(f"__{c}").alias(c) for c in new]))
        calm = now.groupBy("locus").agg((F.max("__moved") <= tolerance).alias("calm"))
        weights = cut_lineage(now.join(calm, "locus").select("locus", "key", "same", *new, "stays", (F.col("settled") | F.col("calm")).alias("settled")))
        if weights.filter("not settled").isEmpty():
            break
    het = cut_lineage(best(weights))
    sums = chances.groupBy("locus", "b1", "b2").agg(F.sum("sv").alias("hom"), F.sum("none").alias("none"))
    hom = sums.groupBy("locus").agg(F.max_by(F.struct("hom", "none", F.col("b1").alias("c1"), F.col("b2").alias("c2")), F.struct(F.round("hom", 9), -F.col("b1"), -F.col("b2"))).alias("m")).select("locus", "m.*")
    done = weights.groupBy("locus").agg(F.min("settled").alias("settled"))
    both = hom.join(het, "locus").join(done, "locus")
    is_hom = F.round("hom", 9) >= F.round("het", 9)
    chosen = cut_lineage(both.select("locus", "none", "hom", "het", F.when(is_hom, "hom").otherwise("het").alias("zygosity"), F.when(is_hom, F.col("c1")).otherwise(F.col("b1")).alias("b1"), F.when(is_hom, F.col("c2")).otherwise(F.col("b2")).alias("b2"), F.when(~is_hom, F.col("h1")).alias("hap1"), F.when(~is_hom, F.col("h2")).alias("hap2"), "settled"))
    support = chances.join(chosen.select("locus", "b1", "b2"), ["locus", "b1", "b2"]).groupBy("locus").agg(F.count(F.when(F.col("sv") > F.col("none"), 1)).alias("support"))
    return chosen.join(support, "locus")
