"""Haplotypes from shared keys: phasing within chunks, stitching chunks, and what the phases say of variants."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _value(sums: np.ndarray) -> np.ndarray:
    """Of keys by the sums of their log-odds: the log-likelihood of either haplotype, less a constant."""
    return np.logaddexp(sums / 2, -sums / 2).sum(axis=-1)


def phased(evidence: np.ndarray, beam: int = 64, rounds: int = 4) -> np.ndarray:
    """+1 or -1 for each row of evidence (variants by keys: the log-odds that the key has the first allele): a beam over the rows in order, then flips of single rows and of all rows from one on, while they help."""
    n, keys = evidence.shape
    paths, sums = np.ones((1, 1), np.int8), evidence[:1].astype(float).copy()
    for i in range(1, n):
        grown = np.concatenate((sums + evidence[i], sums - evidence[i]))
        signs = np.concatenate((np.ones(len(paths), np.int8), -np.ones(len(paths), np.int8)))
        keep = np.argsort(-_value(grown), kind="stable")[:beam]
        paths = np.concatenate((np.concatenate((paths, paths))[keep], signs[keep, None]), axis=1)
        sums = grown[keep]
    x = paths[0].astype(float)
    best = float(_value(x @ evidence))
    for _ in range(rounds):
        before = best
        for tail in (False, True):
            for i in range(n):
                y = x.copy()
                y[i : n if tail else i + 1] *= -1
                if (score := float(_value(y @ evidence))) > best + 1e-9:
                    x, best = y, score
        if best == before:
            break
    return x * x[0]


def confidence(evidence: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each row the log-likelihood that is lost by flipping it and all after it: how sure the junction before it is; infinite for the first."""
    signed = evidence * x[:, None]
    total, head = signed.sum(axis=0), np.cumsum(signed, axis=0)
    best = _value(total)
    return np.array([np.inf, *[best - _value(2 * head[i - 1] - total) for i in range(1, len(x))]])


def phase(df: DataFrame, chunk: list[str], least: float = 2.0, beam: int = 64) -> DataFrame:
    """(chunk, variant, block, haplotype) from rows (chunk, variant, key, odds): the variants of a chunk phased by their keys; a new block begins where the junction is less sure than ``least``. A chunk is the caller's bounded stretch of variants."""

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.pivot_table(index="variant", columns="key", values="odds", aggfunc="sum", fill_value=0.0).sort_index()
        e = table.to_numpy(float)
        x = phased(e, beam)
        block = np.cumsum(confidence(e, x) < least)
        out = pd.DataFrame({"variant": table.index, "block": block, "haplotype": ((1 - x) / 2).astype(int)})
        for c in chunk:
            out[c] = pdf[c].iloc[0]
        return out[[*chunk, "variant", "block", "haplotype"]]

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*chunk, "variant").schema)
    return df.select(*chunk, "variant", "key", "odds").groupBy(*chunk).applyInPandas(each, f"{types}, block long, haplotype long")


def stitched(df: DataFrame, by: list[str], chunk: str, variant: str, haplotype: str, least: float = 0.95) -> DataFrame:
    """df with block and flipped: neighbouring chunks that share variants join where at least ``least`` of these agree, or disagree, in phase; else a new block begins. A chunk that disagrees with the last is turned around, so flips add up along a block."""
    a = df.select(*by, F.col(chunk).alias("__chunk"), variant, F.col(haplotype).alias("__a"))
    b = df.select(*by, (F.col(chunk) - 1).alias("__chunk"), variant, F.col(haplotype).alias("__b"))
    same = F.avg((F.col("__a") == F.col("__b")).cast("double"))
    joins = a.join(b, [*by, "__chunk", variant]).groupBy(*by, "__chunk").agg(same.alias("__same"))
    joins = joins.select(*by, (F.col("__chunk") + 1).alias(chunk), "__same")
    w = W.partitionBy(*by).orderBy(chunk)
    sure = F.coalesce((F.col("__same") >= least) | (F.col("__same") <= 1 - least), F.lit(False))
    chunks = df.select(*by, chunk).distinct().join(joins, [*by, chunk], "left").withColumn("block", F.sum(F.when(sure, 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    turn = F.when(sure & (F.col("__same") <= 1 - least), 1).otherwise(0)
    inside = W.partitionBy(*by, "block").orderBy(chunk).rowsBetween(W.unboundedPreceding, W.currentRow)
    chunks = chunks.withColumn("flipped", F.sum(turn).over(inside) % 2 == 1).select(*by, chunk, "block", "flipped")
    return df.join(chunks, [*by, chunk])


def homozygous(counts: Column, least: float = 0.7) -> Column:
    """The allele (by number) that holds at least that share of an array of allele counts, null for none."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda t, x: t + x)
    rows = F.transform(counts, lambda x, i: F.struct(x.alias("n"), (-i).alias("i")))
    top = F.array_max(rows)
    return F.when(F.try_divide(top["n"].cast("double"), total.cast("double")) >= least, -top["i"])


def repeat_runs(after: Column, longest: int = 3) -> Column:
    """For units of one to ``longest`` letters: how many letters at the start of the text the repeated unit covers; an array."""
    return F.array(*[F.when(F.length(F.regexp_extract(after, f"^(.{{{k}}})\\1+", 0)) > 0, F.length(F.regexp_extract(after, f"^(.{{{k}}})\\1*", 0))).otherwise(F.least(F.length(after), F.lit(k))) for k in range(1, longest + 1)])


def packed(df: DataFrame, order: list[str], size: str, most: int) -> DataFrame:
    """df with pack: rows in order fill packs of about ``most``; the running total before a row decides. For small tables of contigs."""
    before = F.sum(size).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col(size)
    return df.withColumn("pack", F.floor(before / most))
