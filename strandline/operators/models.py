"""Models over ordered rows of a group: hidden Markov decoding and smoothing, phase switches, trios, haplotypes, alignment.

Chains are decoded in tiles of their order (``chains``), so a group of any length is many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from strandline.lineage import cut_lineage
from strandline.operators.chains import decoded
from strandline.operators.ordered import across


def viterbi(emission: np.ndarray, transition: np.ndarray, prior: np.ndarray, first: bool = True) -> np.ndarray:
    """The best path of log scores; of equal ones the smaller state. ``first=False`` leaves the first row's emission out."""
    n, k = emission.shape
    score, back = prior + (emission[0] if first else 0), np.zeros((n, k), np.int64)
    for i in range(1, n):
        ways = score[:, None] + transition
        back[i] = ways.argmax(axis=0)
        score = ways[back[i], np.arange(k)] + emission[i]
    path = np.empty(n, np.int64)
    path[-1] = score.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def smoothed(emission: np.ndarray, transition: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Posterior probabilities of the states, by the forward and backward passes in logs."""
    add = lambda x, axis: np.log(np.exp(x - x.max(axis=axis, keepdims=True)).sum(axis=axis)) + x.max(axis=axis)
    n, k = emission.shape
    ahead, behind = np.zeros((n, k)), np.zeros((n, k))
    ahead[0] = prior + emission[0]
    for i in range(1, n):
        ahead[i] = emission[i] + add(ahead[i - 1][:, None] + transition, 0)
    for i in range(n - 2, -1, -1):
        behind[i] = add(transition + (emission[i + 1] + behind[i + 1])[None, :], 1)
    both = ahead + behind
    both -= both.max(axis=1, keepdims=True)
    p = np.exp(both)
    return p / p.sum(axis=1, keepdims=True)


def switching(k: int, change: float) -> np.ndarray:
    """Log transitions that stay but for a share ``change``, spread evenly."""
    out = np.full((k, k), np.log(change / max(k - 1, 1)))
    np.fill_diagonal(out, np.log1p(-change))
    return out


#: Rows that a tile holds where rows stand one apart.
TILE = 1 << 12


def copy_scores(counts: np.ndarray, per_copy: float, states: int, alpha: float) -> np.ndarray:
    """Log-likelihoods of counts under negative binomials whose means are multiples of ``per_copy`` and whose variances are ``alpha`` times as large."""
    from strandline.functions.numeric import _lgamma

    x, mean = counts.astype(float), np.maximum(np.arange(states), 0.05) * per_copy
    size = mean / (alpha - 1)
    return _lgamma(x[:, None] + size) - _lgamma(size)[None, :] - _lgamma(x + 1)[:, None] - size * np.log(alpha) + x[:, None] * np.log((alpha - 1) / alpha)


def copy_numbers(df: DataFrame, by: list[str], order: list[str], count: str, per_copy: float, states: int = 6, change: float = 1e-3, alpha: float = 1.1, bad: str | None = None, tile: int = TILE) -> DataFrame:
    """df with state and confidence: the copy numbers that explain the counts of bins best, and the posterior probability of each. Bins marked ``bad`` say nothing."""

    def score(pdf):
        e = copy_scores(pdf[count].to_numpy(), per_copy, states, alpha)
        if bad is not None:
            e[pdf[bad].to_numpy(bool)] = 0
        return e, switching(states, change)

    out = decoded(df, by, order, tile, states, score, np.full(states, -np.log(states)), smooth=True)
    return out.select(*df.columns, "state", F.get("posterior", F.col("state")).alias("confidence"))


def copy_numbers_as_read(df: DataFrame, by: list[str], order: list[str], value: str, good: str | None = None, ploidy: float = 2.0, states: int = 6, change: float = 1e-3, alpha: float = 1.1, least: float = 1e-300, rounds: int = 10, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """(rows, fit): df with state, from fractional values of bins (``support.bin_shares``), and one row (ploidy, per_copy, rounds, settled).

    A copy's expected value is the mean over good bins divided by the ploidy, which is estimated anew from the decoded copy numbers of good bins
    below the highest state until it moves by less than 1e-6. Values are rounded, halves up; every state can begin; scores are at least the logarithm of ``least``.
    """
    df = cut_lineage(df)
    fine = F.lit(True) if good is None else F.col(good)
    sums = df.agg(F.sum(F.when(fine, F.col(value))).alias("v"), F.count(F.when(fine, 1)).alias("n")).first()
    moves = np.full((states, states), np.log(change))
    np.fill_diagonal(moves, np.log1p(-(states - 1) * change))
    settled, done, out, per_copy = False, 0, None, 0.0
    while done < rounds and not settled:
        done, per_copy = done + 1, (sums.v or 0.0) / max(sums.n, 1) / max(ploidy, 1e-9)

        def score(pdf, per_copy=per_copy):
            counts = np.floor(pdf[value].to_numpy(float) + 0.5)
            return np.maximum(copy_scores(counts, max(per_copy, 1e-9), states, alpha), np.log(least)), moves

        out = cut_lineage(decoded(df, by, order, tile, states, score, np.zeros(states)).drop("before"))
        new = out.filter(fine & (F.col("state") < states - 1)).agg(F.avg("state")).first()[0]
        settled = new is None or abs(new - ploidy) < 1e-6
        ploidy = ploidy if new is None else new
    fit = df.sparkSession.createDataFrame([(float(ploidy), float(per_copy), done, bool(settled))], "ploidy double, per_copy double, rounds int, settled boolean")
    return out, fit


def deletions(df: DataFrame, by: list[str], order: list[str], one: str, other: str, change: float = 1e-2, het: float = 0.9, normal: float = 0.65, tile: int = TILE) -> DataFrame:
    """df with deleted: whether the depth of one haplotype against the other tells of a deletion: two states, binomial."""

    def score(pdf):
        low, high = np.minimum(pdf[one], pdf[other]).to_numpy(float), np.maximum(pdf[one], pdf[other]).to_numpy(float)
        return np.stack([high * np.log(p) + low * np.log1p(-p) for p in (normal, het)], axis=1), switching(2, change)

    out = decoded(df, by, order, tile, 2, score, np.log([0.5, 0.5]))
    return out.select(*df.columns, (F.col("state") == 1).alias("deleted"))


def phase_switches(df: DataFrame, by: list[str], order: list[str], parity: str, long_cost: float = 5.0, tile: int = TILE) -> DataFrame:
    """df with short_switch (the row is off its stretch) and long_switch (the stretch changes): the cheapest account of the parities."""

    def score(pdf):
        p = pdf[parity].to_numpy(int)
        return np.where(p[:, None] == np.arange(2)[None, :], 0.0, -1.0), np.where(np.eye(2, dtype=bool), 0.0, -long_cost)

    out = decoded(df, by, order, tile, 2, score, np.zeros(2))
    return out.select(*df.columns, (F.col(parity) != F.col("state")).alias("short_switch"), F.coalesce(F.col("state") != F.col("before"), F.lit(False)).alias("long_switch"))


#: The eight states of a trio: haplotype from parent 1, from parent 2, the child's phasing.
TRIO = np.array([[s >> 2 & 1, s >> 1 & 1, s & 1] for s in range(8)])


def trio_states(df: DataFrame, by: list[str], order: list[str], switch: float = 25.0, tile: int = TILE, keep: list[str] | None = None) -> DataFrame:
    """df with state 0..7 (bits: haplotype from parent 1, from parent 2, child's phasing) and violation. Columns p1, p2, ch: two alleles each, and p1_set, p2_set, ch_set: phase sets, null where unphased. A mismatch costs 1; a switch costs ``switch`` within a phase set, nothing beyond.

    ``keep`` names the columns that come back beside ``by`` and ``order``: all, if not given.
    """
    sets = ("p1_set", "p2_set", "ch_set")
    kept = df.columns if keep is None else list(dict.fromkeys([*by, *order, *keep]))
    one, two = F.array_intersect("p1", "ch"), F.array_intersect("p2", "ch")
    both = (F.size(F.array_intersect(one, two)) == 1) & (F.array_sort(F.array_distinct(one)) == F.array_sort(F.array_distinct(two))) & (F.size(F.array_distinct("ch")) == 2)
    # alleles by number, in one number of six digits, so that numpy compares them and no text is shuffled
    alleles = F.concat("p1", "p2", "ch")
    digits = F.aggregate(F.transform(alleles, lambda x: F.array_position(alleles, x).cast("int")), F.lit(0), lambda n, x: n * 7 + x)
    own = df.withColumns({"violation": (F.size(one) == 0) | (F.size(two) == 0) | both, "__alleles": digits}).select(*kept, *[x for x in sets if x not in kept], "violation", "__alleles")
    seen = across(own, by, order, {f"__was_{x}": ("lag", F.col(x)) for x in sets}, tile)
    same = sum((F.coalesce(F.col(x) == F.col(f"__was_{x}"), F.lit(False)).cast("int") * (1 << i) for i, x in enumerate(sets)), F.lit(0))
    same = cut_lineage(seen.withColumn("__same", same).select(*kept, "violation", "__alleles", "__same"))  # three passes read it

    def score(pdf):
        a = (pdf["__alleles"].to_numpy()[:, None] // 7 ** np.arange(5, -1, -1) % 7).reshape(-1, 3, 2)
        e = -(a[:, 0, :][:, TRIO[:, 0]] != a[:, 2, :][:, TRIO[:, 2]]).astype(float) - (a[:, 1, :][:, TRIO[:, 1]] != a[:, 2, :][:, 1 - TRIO[:, 2]])
        far = np.abs(TRIO[:, None, :] - TRIO[None, :, :])
        held = pdf["__same"].to_numpy()[:, None] >> np.arange(3) & 1
        return e, -switch * (far[None] * held[:, None, None, :]).sum(axis=3, dtype=float)

    return decoded(same, by, order, tile, 8, score, np.zeros(8)).select(*kept, "state", "violation")


def haplotype_posterior(calls: DataFrame, by: list[str], mixed_prior: float = 0.01) -> DataFrame:
    """(by, h0, h1, hmix): posteriors of fragments from rows (hap0, hap1, mix): the log-probabilities of a variant's reads under each haplotype and under a mixture."""
    prior = {"h0": np.log((1 - mixed_prior) / 2), "h1": np.log((1 - mixed_prior) / 2), "hmix": np.log(mixed_prior)}
    sums = calls.groupBy(*by).agg(*[(F.sum(c) + float(prior[n])).alias(n) for c, n in (("hap0", "h0"), ("hap1", "h1"), ("mix", "hmix"))])
    top = F.greatest("h0", "h1", "hmix")
    total = F.exp(F.col("h0") - top) + F.exp(F.col("h1") - top) + F.exp(F.col("hmix") - top)
    return sums.select(*by, *[(F.exp(F.col(n) - top) / total).alias(n) for n in ("h0", "h1", "hmix")])


def support_score(h00: Column, h11: Column, h01: Column, h10: Column, p: float = 0.001) -> Column:
    """Log10 odds that keys of allele a lie on haplotype a or all on the other one, against chance: counts of keys by allele and haplotype."""
    agree, cross, total = h00 + h11, h01 + h10, h00 + h11 + h01 + h10
    log = lambda good, bad: good * float(np.log10(1 - p)) + bad * float(np.log10(p))
    return F.greatest(log(agree, cross), log(cross, agree)) - total * float(np.log10(0.5))


def align_score(a: str, b: str, match: int = 1, mismatch: int = -1, opening: int = -6, extending: int = -1) -> int:
    """Smith-Waterman with affine gaps: the best local score. A row at a time; gaps along the row by a running maximum."""
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    if not len(x) or not len(y):
        return 0
    last, down, best = np.zeros(len(y) + 1), np.full(len(y) + 1, -np.inf), 0.0
    step = np.arange(len(y) + 1)
    for c in x:
        down = np.maximum(down + extending, last + opening)
        diag = last[:-1] + np.where(y == c, match, mismatch)
        row = np.maximum(0, np.concatenate(([0.0], np.maximum(diag, down[1:]))))
        along = np.maximum.accumulate(row - step * extending)[:-1] + (step[1:] - 1) * extending + opening
        row[1:] = np.maximum(row[1:], along)
        best, last = max(best, row.max()), row
    return int(best)


#: Cells of a row of all pairs that are aligned side by side.
CELLS = 1 << 16


def _letters(texts: list[bytes], pad: int) -> np.ndarray:
    """The bytes of texts as columns, filled up with ``pad``."""
    sizes = np.array([len(t) for t in texts])
    out = np.full((int(sizes.max(initial=0)), len(texts)), pad, np.int16)
    ends = np.cumsum(sizes)
    out[np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes), np.repeat(np.arange(len(texts)), sizes)] = np.frombuffer(b"".join(texts), np.uint8)
    return out


def align_scores(a: list[str], b: list[str], match: int = 1, mismatch: int = -1, opening: int = -6, extending: int = -1) -> np.ndarray:
    """``align_score`` of many pairs, a row of many of them at once, in order of length; mismatches and gaps cost, so what fills a text up adds nothing."""
    x, y = [t.encode() for t in a], [t.encode() for t in b]
    out, at = np.zeros(len(x), np.int32), 0
    order = sorted(range(len(x)), key=lambda i: (len(y[i]), len(x[i])))
    while at < len(order):
        # the shortest come first, so a few fall short of the bound where lengths jump
        some = order[at : at + max(1, CELLS // (len(y[order[at]]) + 1))]
        some = some[: max(1, CELLS // (len(y[some[-1]]) + 1))]
        at += len(some)
        rows, other = _letters([x[i] for i in some], -1), _letters([y[i] for i in some], -2)
        step = np.arange(len(other) + 1, dtype=np.int32)[:, None]
        last, row = np.zeros((len(other) + 1, len(some)), np.int32), np.zeros((len(other) + 1, len(some)), np.int32)
        down, best = np.full(last.shape, -(1 << 30), np.int32), np.zeros(len(some), np.int32)
        for c in rows:
            down = np.maximum(down + extending, last + opening)
            row = np.zeros_like(last)
            row[1:] = np.maximum(np.maximum(last[:-1] + np.where(other == c, match, mismatch), down[1:]), 0)
            along = np.maximum.accumulate(row - step * extending, axis=0)[:-1] + (step[1:] - 1) * extending + opening
            row[1:] = np.maximum(row[1:], along)
            best, last = np.maximum(best, row.max(axis=0)), row
        out[some] = best
    return out


@F.pandas_udf(IntegerType())
def local_alignment(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(align_scores(a.fillna("").tolist(), b.fillna("").tolist()), dtype="int32")


def best_allele(reads: DataFrame, ids: list[str], seq: str, alleles: str) -> DataFrame:
    """(ids, allele, score, margin): the allele (array of sequences) that a read aligns to best, null on a tie, and by how much."""
    each = reads.repartition(*ids).select(*ids, seq, F.posexplode(alleles).alias("allele", "__text")).withColumn("score", local_alignment(F.col(seq), F.col("__text")))
    own = each.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct("score", "allele")), asc=False).alias("s"))
    first, second = F.get("s", 0), F.get("s", 1)
    margin = first["score"] - F.coalesce(second["score"], F.lit(0))
    return own.select(*ids, F.when(margin > 0, first["allele"]).alias("allele"), first["score"].alias("score"), margin.alias("margin"))


def expectation(df: DataFrame, by: list[str], a: str, b: str, rounds: int = 5, tolerance: float = 1e-4) -> DataFrame:
    """(by, share, settled): the share of rows that come from the first of two sources, from each row's log-probabilities under both, and whether it moved by ``tolerance`` at most in the last round. Every round is one aggregate; groups that have settled stay put, and the rounds end when all have."""
    df = cut_lineage(df.select(*by, a, b))
    share = df.select(*by).distinct().withColumns({"share": F.lit(0.5), "settled": F.lit(False)})
    for _ in range(rounds):
        p = F.lit(1.0) / (1 + F.exp(F.col(b) - F.col(a)) * (1 - F.col("share")) / F.col("share"))
        new = df.join(share, by).groupBy(*by).agg(F.avg(p).alias("__new"), F.first("share").alias("__old"))
        moved = F.abs(F.col("__new") - F.col("__old")) > tolerance
        share = cut_lineage(new.select(*by, F.when(moved, F.least(F.greatest("__new", F.lit(1e-9)), F.lit(1 - 1e-9))).otherwise(F.col("__old")).alias("share"), (~moved).alias("settled")))
        if share.filter("not settled").isEmpty():
            break
    return share
