"""Tracks for display: phase blocks from rows in order, and rows for overlapping intervals. Both depend on the order of all rows before, and run in parts."""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.operators.chains import Steps, _chunks, _dealt, _meeting, _names
from strandline.operators.ordered import TILE, across, numbered


def phase_block_rows(variants: DataFrame, by: list[str], least: int = 2, tile: int = TILE) -> DataFrame:
    """(by, block, start, end, ps, one, two): blocks of well phased heterozygous variants (pos, ps, first, second: whether an allele differs from the reference, phased).

    Rows are taken in order of pos, then ps, first and second. A row begins a block if it is the first of its group, or has a phase set (not 0 or null) other than the last one that a row had; rows without one
    join the block they meet. The block's name is the phase set of its first row, null for 0. one and two count variants on
    either haplotype; blocks with fewer than ``least`` of them are left out. Rows that aren't phased, or have two equal alleles, are ignored. The last phase set is carried over tiles, so no group is one task.
    """
    own = variants.filter("phased and first <> second").select(*by, "pos", F.nullif("ps", F.lit(0)).alias("ps"), "first", "second")
    order = ["pos", "ps", "first", "second"]
    seen = across(own, by, order, {"__set": ("last", F.col("ps")), "__n": ("sum", F.lit(1))}, tile)
    order = [*order, "__n"]  # rows that tie keep this order from here on
    before = across(seen, by, order, {"__was": ("lag", F.col("__set"))}, tile)
    new = (F.col("__n") == 1) | (F.col("ps").isNotNull() & ~F.col("ps").eqNullSafe(F.col("__was")))
    blocks = numbered(before, by, order, new, "block", tile)
    n = lambda c: F.count(F.when(F.col(c), 1))
    out = blocks.groupBy(*by, "block").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"), F.min_by(F.struct("ps"), F.struct("__n"))["ps"].alias("ps"), n("first").alias("one"), n("second").alias("two"))
    return out.filter(F.col("one") + F.col("two") >= least)


def _ranks(ends: np.ndarray) -> np.ndarray:
    """Which of the smallest values each is, equal ones alike."""
    order = np.argsort(ends, axis=-1, kind="stable")
    sorted_ = np.take_along_axis(ends, order, -1)
    step = np.concatenate((np.zeros_like(sorted_[..., :1]), np.cumsum(sorted_[..., 1:] != sorted_[..., :-1], axis=-1)), axis=-1)
    out = np.empty_like(step)
    np.put_along_axis(out, order, step, -1)
    return out


def track_rows(intervals: DataFrame, by: list[str], ties: list[str], rows: int = 3, tile: int = TILE) -> DataFrame:
    """intervals (start, end) with row: in order of start (then end, then ties) each takes the row that has been free for longest, the smaller of equal ones, even where none is free.

    Where an interval begins behind all before it, only the order of the rows' last ends matters from there on. So each stretch between such
    places is worked out by itself for every such order (13 for three rows), and the orders are followed from stretch to stretch. Intervals of no length
    and negative starts are taken as they are; null positions come first, in stretches of their own, and have no row.
    """
    states = [s for s in product(range(rows), repeat=rows) if set(s) == set(range(max(s) + 1))]
    number = np.full(rows**rows, -1, np.int32)
    for i, s in enumerate(states):
        number[sum(r * rows**j for j, r in enumerate(s))] = i
    order = ["start", "end", *ties]
    known = intervals.filter("start is not null and end is not null")
    reach = across(known, by, order, {"__reach": ("reach", F.greatest("start", "end")), "__n": ("sum", F.lit(1))}, tile)
    order = [*order, "__n"]  # rows that tie keep this order from here on
    cut = numbered(reach, by, order, F.col("__reach").isNull() | (F.col("start") > F.col("__reach")), "__stretch", tile).withColumnRenamed("__stretch", "__tile").drop("__reach")
    dealt = _dealt(cut, [*by, "__tile"], order)

    def each(batches):
        for pdf in _chunks(batches, "__run"):
            steps = Steps(pdf["__run"].to_numpy())
            start, end = pdf["start"].to_numpy(np.int64), pdf["end"].to_numpy(np.int64)
            last = start[steps.starts][:, None, None] - 2 * rows + np.array(states)[None]
            took = np.zeros((len(pdf), len(states)), np.int32)
            for n, at in steps.forward():
                best = (-last[:n]).argmax(axis=2)
                took[at] = best
                np.put_along_axis(last[:n], best[:, :, None], np.broadcast_to(end[at][:, None, None], (n, len(states), 1)), 2)
            code = (_ranks(last) * rows ** np.arange(rows)).sum(axis=2)
            after = np.full(len(pdf), None, dtype=object)
            for i, x in zip(steps.starts.tolist(), number[code], strict=True):
                after[i] = x
            yield pdf.drop(columns="__run").assign(__took=list(took), __after=after)

    found = cut_lineage(dealt.mapInPandas(each, f"{_names(dealt.drop('__run'))}, __took array<int>, __after array<int>"))
    stretches = found.filter("__after is not null").select(*by, "__tile", "__after")

    def followed(batches):
        for pdf in _chunks(batches, "__run"):
            steps = Steps(pdf["__run"].to_numpy())
            after, state, now = np.stack(pdf["__after"].to_list()), np.zeros(len(pdf), np.int32), np.zeros(len(steps.starts), np.int32)
            for n, at in steps.forward():
                state[at] = now[:n]
                now[:n] = after[at, now[:n]]
            yield pdf[[*by, "__tile"]].assign(__state=state)

    line = _dealt(stretches, by, ["__tile"])
    chosen = line.mapInPandas(followed, f"{_names(stretches.select(*by, '__tile'))}, __state int")
    placed = _meeting(found, chosen, by).select(*intervals.columns, F.get("__took", F.col("__state")).alias("row"))
    return placed.unionByName(intervals.filter("start is null or end is null").withColumn("row", F.lit(None).cast("int")))
