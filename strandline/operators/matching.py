"""Joins by key order and by truth: outer merges, as-of joins, pair counts, truth sets and metric grids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.operators.aggregates import ratio
from strandline.operators.intervals import overlap_join
from strandline.operators.ordered import TILE, across


def outer_merge(sides: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """The full outer join of any number of sides whose keys are unique: the keys, each side's other columns prefixed by its name, and in_<name>."""

    def named(name: str, df: DataFrame) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c not in keys], F.lit(True).alias(f"in_{name}"))

    joined = reduce(lambda a, b: a.join(b, keys, "full_outer"), [named(*x) for x in sides.items()])
    return joined.withColumns({f"in_{name}": F.coalesce(f"in_{name}", F.lit(False)) for name in sides})


def as_of(left: DataFrame, right: DataFrame, by: list[str], order: str, forward: bool = False, strict: bool = False, tile: int = TILE) -> DataFrame:
    """left with the columns of the last row of right at or before ``order`` (first at or after with ``forward``; never equal with ``strict``), null where there is none. Of right's ties the largest row counts. ``tile`` is a span of the order, seconds for times."""
    values = [c for c in right.columns if c not in [*by, order]]
    extra = [c for c in left.columns if c not in [*by, order]]
    one = right.groupBy(*by, order).agg(F.max(F.struct(*values)).alias("__right"))
    right_first = forward == strict  # of equal orders
    a = left.select(*by, order, F.lit(int(right_first)).alias("__kind"), F.struct(*[F.col(c) for c in extra] or [F.lit(1).alias("_")]).alias("__left"))
    b = one.select(*by, order, F.lit(int(not right_first)).alias("__kind"), "__right")
    both = across(a.unionByName(b, allowMissingColumns=True), by, [order, "__kind"], {"__pick": ("next" if forward else "last", F.col("__right"))}, tile)
    return both.filter(F.col("__left").isNotNull()).select(*by, order, *[F.col(f"__left.{c}") for c in extra], *[F.col(f"__pick.{c}").alias(c) for c in values])


def pair_counts(df: DataFrame, group: str, item: str, least: int = 1, most_items: int | None = None) -> DataFrame:
    """(a, b, n): how many groups each two items share, a < b. Groups of more than ``most_items`` items are left out if that is given, as callers do with windows that nearly every key touches."""
    own = df.select(group, item).distinct()
    if most_items is not None:
        own = own.join(own.groupBy(group).agg(F.count("*").alias("__n")).filter(F.col("__n") <= most_items).select(group), group, "left_semi")
    pairs = own.select(group, F.col(item).alias("a")).join(own.select(group, F.col(item).alias("b")), group).filter("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


#: Names that occur in several rows are broadcast if there are no more.
FEW = 100_000


def _break_pairs(calls: DataFrame, truth: DataFrame, slack: int, base: int, longest: int) -> DataFrame:
    """(name, truth) once for each two rows of which both breakpoints come within ``slack``."""

    def ordered(df: DataFrame, widen: int) -> DataFrame:
        side = lambda k: F.struct(F.col(f"chrom{k}").alias("c"), F.greatest(F.col(f"start{k}") - widen, F.lit(0)).alias("s"), (F.col(f"stop{k}") + widen).alias("e"))
        return df.select("name", F.least(side(1), side(2)).alias("x"), F.greatest(side(1), side(2)).alias("y"))

    def dealt(df: DataFrame, size: int) -> DataFrame:
        cells = F.sequence(F.floor(F.col("y.s") / size).cast("long"), F.floor(F.greatest(F.col("y.e") - 1, F.col("y.s")) / size).cast("long"))
        return df.withColumn("__end", F.explode(cells)).withColumn("__other", F.col("y.c"))

    size, place = base * 8, ["contig", "__other", "__end"]
    a, b = dealt(ordered(calls, slack), size), dealt(ordered(truth, 0), size)
    left = a.select("name", F.col("x.c").alias("contig"), F.col("x.s").alias("start"), F.col("x.e").alias("end"), "y", "__other", "__end")
    right = b.select(F.col("name").alias("truth"), F.col("x.c").alias("contig"), F.col("x.s").alias("start_r"), F.col("x.e").alias("end_r"), F.col("y").alias("z"), "__other", "__end")
    near = overlap_join(left, right, place, base, longest=longest)
    met = F.floor(F.greatest("y.s", "z.s") / size) == F.col("__end")  # once for each pair
    return near.filter(F.expr("y.s < z.e and z.s < y.e") & met).select("name", "truth")


def _longest_break(calls: DataFrame, truth: DataFrame, slack: int) -> int:
    size = F.max(F.greatest(F.col("stop1") - F.col("start1"), F.col("stop2") - F.col("start2")))
    found = [df.agg(size).first()[0] for df in (calls, truth)]
    return max((x for x in found if x is not None), default=1) + 2 * slack


def breakpoint_matches(calls: DataFrame, truth: DataFrame, slack: int, base: int = 1 << 14) -> DataFrame:
    """(name, truth): calls and truths of which both breakpoints come within ``slack``; ends are ordered by contig and start first. Both sides: name, chrom1, start1, stop1, chrom2, start2, stop2.

    Rows are dealt by the cells of both breakpoints, so that a pile of calls at one place meets only those that also end near each other. Two rows meet once,
    so only pairs of names that occur in several rows are made distinct.
    """

    def parted(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        again = cut_lineage(df.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("name").alias("__again")))
        n = again.limit(FEW + 1).count()
        if not n:
            return df, None
        few = (lambda x: F.broadcast(x)) if n <= FEW else (lambda x: x)
        same = F.col("name").eqNullSafe(F.col("__again"))
        return df.join(few(again), same, "left_anti"), few(df.join(few(again), same, "left_semi"))

    longest = _longest_break(calls, truth, slack)
    (once, again), (truth_once, truth_again) = parted(calls), parted(truth)
    out = _break_pairs(once, truth_once, slack, base, longest)
    rest = [_break_pairs(a, b, slack, base, longest) for a, b in ((again, truth), (once, truth_again)) if a is not None and b is not None]
    return out.unionAll(reduce(lambda a, b: a.unionAll(b), rest).distinct()) if rest else out


def breakpoints_met(calls: DataFrame, truth: DataFrame, slack: int, base: int = 1 << 14) -> DataFrame:
    """The distinct names of truth that ``breakpoint_matches`` pairs with a call. Places are matched once, however many rows they have."""
    place = ["chrom1", "start1", "stop1", "chrom2", "start2", "stop2"]
    one = lambda df: df.select(*place).distinct().withColumn("name", F.struct(*place))
    met = _break_pairs(one(calls), one(truth), slack, base, _longest_break(calls, truth, slack)).select("truth").distinct()
    return truth.join(met.select("truth.*"), place, "left_semi").select(F.col("name").alias("truth")).distinct()


def reciprocal_matches(calls: DataFrame, truth: DataFrame, share: float, base: int = 1 << 14) -> DataFrame:
    """(name, truth, overlap): intervals that overlap by more than ``share`` of both."""
    right = truth.select(F.col("name").alias("truth"), "contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    pairs = overlap_join(calls.select("name", "contig", "start", "end"), right, "contig", base)
    both = F.least("end", "end_r") - F.greatest("start", "start_r")
    return pairs.withColumn("overlap", both).filter((ratio(both, F.col("end") - F.col("start")) > share) & (ratio(both, F.col("end_r") - F.col("start_r")) > share)).select("name", "truth", "overlap")


def confusion(truth: Column, said: Column) -> list[Column]:
    """tp, fp, fn, sensitivity, ppv."""
    n = lambda c: F.count(F.when(c, 1))
    tp, fp, fn = n(truth & said), n(~truth & said), n(truth & ~said)
    return [tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), ratio(tp, tp + fn).alias("sensitivity"), ratio(tp, tp + fp).alias("ppv")]


def metric_grid(df: DataFrame, filters: dict[str, dict[str, Column]], metrics: list[Column]) -> DataFrame:
    """One row for each combination of one named condition from each dimension, from one pass: every row is sent to the combinations that it meets."""
    for name, conditions in filters.items():
        met = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in conditions.items()]))
        df = df.withColumn(f"__{name}", met)
    for name in filters:
        df = df.withColumn(name, F.explode(f"__{name}"))
    return df.groupBy(*filters).agg(*metrics)


def nearest_key(df: DataFrame, by: list[str], distance: Column, ties: list) -> DataFrame:
    """The row of each group at the smallest distance."""
    own = df.withColumn("__rank", F.row_number().over(W.partitionBy(*by).orderBy(distance, *ties)))
    return own.filter("__rank = 1").drop("__rank")
