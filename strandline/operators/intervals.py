"""Interval operators: half-open [start, end) of whole numbers within a group (a contig).

Joins deal intervals out to cells of several sizes. An interval's level is the smallest whose cells are
at least as long as the interval, so it touches two cells of its level at most; it is also lifted to the
higher levels, where it meets longer intervals. There are as many levels as the longest interval of the two
sides needs, which callers may name and is looked up otherwise. A pair meets at the higher of the two
levels only, and is kept in the cell of its later start only, so no pair is found twice and no interval, however
long, floods the join. Null or empty groups and bounds never overlap anything.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators.ordered import TILE, across

FACTOR = 8


def _size(base: int, level: int) -> int:
    return base * FACTOR**level


def _levels(longest: int, base: int) -> int:
    """As many levels as an interval of this length needs."""
    n = 1
    while _size(base, n - 1) < longest:
        n += 1
    return n


def _cells(df: DataFrame, start: Column, end: Column, base: int, levels: int, lifted_role: int) -> DataFrame:
    """df once for each cell: __role 1 pairs the left side's own level with all of the right side's, 2 the reverse (higher levels only)."""
    last = F.greatest(end - 1, start)
    level = reduce(lambda e, k: F.when(last - start + 1 <= _size(base, k), F.lit(k)).otherwise(e), range(levels - 1, -1, -1), F.lit(levels - 1))
    df = df.withColumn("__level", level)
    at = lambda k: F.transform(F.sequence(F.floor(start / _size(base, k)).cast("long"), F.floor(last / _size(base, k)).cast("long")), lambda c: F.struct(F.lit(k).alias("k"), c.alias("c")))
    none = F.array().cast("array<struct<k:int,c:bigint>>")
    own = F.flatten(F.array(*[F.when(F.col("__level") == k, at(k)).otherwise(none) for k in range(levels)]))
    up = F.flatten(F.array(*[F.when(F.col("__level") < k, at(k)).otherwise(none) for k in range(levels)]))
    role = lambda cells, n: F.transform(cells, lambda x: F.struct(F.lit(n).alias("role"), x["k"].alias("k"), x["c"].alias("c")))
    if levels == 1:
        both = role(at(0), 1)
    else:
        both = F.concat(role(own, 3 - lifted_role), role(up, lifted_role)) if lifted_role == 2 else F.concat(role(own, 1), F.when(F.col("__level") > 0, role(own, 2)).otherwise(role(none, 2)), role(up, 1))
    return df.withColumn("__cell", F.explode(both)).select("*", F.col("__cell.role").alias("__role"), F.col("__cell.k").alias("__k"), F.col("__cell.c").alias("__c")).drop("__cell", "__level")


def overlap_join(left: DataFrame, right: DataFrame, by: str | list[str], base: int = 16384, slack: int = 0, longest: int | None = None) -> DataFrame:
    """Pairs of intervals of the same group that overlap by a position, or come within ``slack`` of it.

    left has start and end, right start_r and end_r; other columns must differ, but for the group's. ``longest``
    names a length that few intervals exceed, which saves looking for the longest.
    """
    by = [by] if isinstance(by, str) else by
    s, e = F.col("start") - slack, F.col("end") + slack
    left, right = left.filter(F.col("start") <= F.col("end")), right.filter(F.col("start_r") <= F.col("end_r"))
    if longest is None:
        found = [x.agg(F.max(size)).first()[0] for x, size in ((left, e - s), (right, F.col("end_r") - F.col("start_r")))]
        longest = max((x for x in found if x is not None), default=1)
    levels = _levels(longest, base)
    a = _cells(left, s, e, base, levels, 2)
    b = _cells(right, F.col("start_r"), F.col("end_r"), base, levels, 1)
    sizes = F.element_at(F.array(*[F.lit(_size(base, k)).cast("long") for k in range(levels)]), F.col("__k") + 1)
    pairs = a.join(b, [*by, "__role", "__k", "__c"])
    later = F.floor(F.greatest(s, F.col("start_r")) / sizes).cast("long")
    return pairs.filter((s < F.col("end_r")) & (F.col("start_r") < e) & (later == F.col("__c"))).drop("__role", "__k", "__c")


def point_join(points: DataFrame, right: DataFrame, by: str | list[str], base: int = 16384) -> DataFrame:
    """Pairs of a point pos and an interval with start_r <= pos < end_r."""
    pairs = overlap_join(points.withColumns({"start": F.col("pos"), "end": F.col("pos") + 1}), right, by, base)
    return pairs.drop("start", "end")


def overlapping(left: DataFrame, right: DataFrame, by: str | list[str], ids: list[str], base: int = 16384, anti: bool = False) -> DataFrame:
    """Rows of left that overlap some interval of right, or none. Rows are told by their intervals, so ``ids`` may repeat."""
    keys = list(dict.fromkeys([*([by] if isinstance(by, str) else by), "start", "end"]))
    hits = overlap_join(left.select(*keys).distinct(), right.select(*keys[:-2], "start_r", "end_r").distinct(), keys[:-2], base).select(*keys).distinct()
    return left.join(hits, keys, "left_anti" if anti else "left_semi").select(*left.columns)


def _merge_once(df: DataFrame, by: list[str], touching: bool) -> DataFrame:
    w = W.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(W.unboundedPreceding, -1))
    apart = F.col("start") > reach if touching else F.col("start") >= reach
    run = F.sum(F.when(apart | reach.isNull(), 1).otherwise(0)).over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    return df.withColumn("__run", run).groupBy(*by, "__run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("__run")


def merge(df: DataFrame, by: str | list[str], extend: int = 0, touching: bool = False, tile: int = TILE) -> DataFrame:
    """The union of the intervals of each group, with n, the number merged. Book-ended intervals stay apart unless ``touching``; ``extend`` widens both ends first, the start down to 0 at most; a negative one narrows, and what it turns round is left out.

    Intervals merge within tiles of starts before they meet in their group, so a long group is no hot spot.
    """
    by = [by] if isinstance(by, str) else by
    wide = df.select(*by, F.greatest(F.col("start") - extend, F.lit(0)).alias("start") if extend else F.col("start"), (F.col("end") + extend).alias("end"), F.lit(1).cast("long").alias("n"))
    wide = wide.filter("start <= end") if extend < 0 else wide
    tiled = wide.withColumn("__tile", F.floor(F.col("start") / tile))
    return _merge_once(_merge_once(tiled, [*by, "__tile"], touching).drop("__tile"), by, touching)


def intersect(left: DataFrame, right: DataFrame, by: str | list[str], base: int = 16384) -> DataFrame:
    """The positions in both: pairwise clips of merged sides, merged."""
    by = [by] if isinstance(by, str) else by
    b = merge(right.select(*by, F.col("start_r").alias("start"), F.col("end_r").alias("end")), by).select(*by, F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    pairs = overlap_join(merge(left, by).drop("n"), b, by, base)
    return pairs.select(*by, F.greatest("start", "start_r").alias("start"), F.least("end", "end_r").alias("end"))


def subtract(left: DataFrame, right: DataFrame, by: str | list[str], ids: list[str], base: int = 16384) -> DataFrame:
    """What is left of each interval of left without the positions in right; ``ids`` tell rows of left apart."""
    by = [by] if isinstance(by, str) else by
    b = merge(right.select(*by, F.col("start_r").alias("start"), F.col("end_r").alias("end")), by).select(*by, F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    own = left.select(*dict.fromkeys([*ids, *by, "start", "end"]))
    hits = overlap_join(own, b, by, base)
    keys = list(dict.fromkeys([*ids, *by, "start", "end"]))
    w = W.partitionBy(*keys).orderBy("start_r")
    gaps = hits.withColumn("__next", F.coalesce(F.lead("start_r").over(w), F.col("end"))).withColumn("__first", F.row_number().over(w) == 1)
    piece = lambda a, z: F.struct(a.alias("s"), z.alias("e"))
    pieces = F.explode(F.array(F.when(F.col("__first"), piece(F.col("start"), F.col("start_r"))), piece(F.col("end_r"), F.col("__next")))).alias("p")
    cut = gaps.select(*[c for c in keys if c not in ("start", "end")], pieces).filter("p.s < p.e").select(*[c for c in keys if c not in ("start", "end")], F.col("p.s").alias("start"), F.col("p.e").alias("end"))
    whole = own.join(hits.select(*keys).distinct(), keys, "left_anti")
    return whole.select(*cut.columns).unionByName(cut)


def gaps(df: DataFrame, by: str | list[str], tile: int = TILE) -> DataFrame:
    """The positions between the merged intervals of each group."""
    by = [by] if isinstance(by, str) else by
    following = across(merge(df, by, tile=tile), by, ["start"], {"__next": ("lead", F.col("start"))}, tile)
    return following.select(*by, F.col("end").alias("start"), F.col("__next").alias("end")).filter("start < end")


def depth(df: DataFrame, by: str | list[str], tile: int = TILE, weight: Column | None = None) -> DataFrame:
    """Run-length depth of coverage: (start, end, depth) where depth isn't zero; neighbouring runs differ."""
    by = [by] if isinstance(by, str) else by
    one = F.lit(1).cast("long") if weight is None else weight
    ends = F.explode(F.array(F.struct(F.col("start").alias("pos"), one.alias("d")), F.struct(F.col("end").alias("pos"), (-one).alias("d")))).alias("x")
    steps = df.filter("start < end").select(*by, ends).groupBy(*by, F.col("x.pos").alias("pos")).agg(F.sum("x.d").alias("d")).filter("d <> 0")
    runs = across(steps, by, ["pos"], {"total": ("sum", F.col("d")), "end": ("lead", F.col("pos"))}, tile)
    return runs.filter("total <> 0").select(*by, F.col("pos").alias("start"), "end", F.col("total").alias("depth"))


def coverage(windows: DataFrame, right: DataFrame, by: str | list[str], ids: list[str], base: int = 16384) -> DataFrame:
    """windows with covered, the number of their positions that right covers."""
    by = [by] if isinstance(by, str) else by
    b = merge(right.select(*by, F.col("start_r").alias("start"), F.col("end_r").alias("end")), by).select(*by, F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    own = list(dict.fromkeys([*ids, *by, "start", "end"]))
    sums = overlap_join(windows.select(*own), b, by, base).groupBy(*ids).agg(F.sum(F.least("end", "end_r") - F.greatest("start", "start_r")).alias("covered"))
    return windows.join(sums, ids, "left").withColumn("covered", F.coalesce("covered", F.lit(0)))


def nearest(points: DataFrame, right: DataFrame, by: str | list[str], tile: int = TILE) -> DataFrame:
    """points with start_r, end_r and distance of the region that holds pos, else of the nearer one (a tie goes to the right); right is disjoint. Null where the group has none."""
    by = [by] if isinstance(by, str) else by
    extra = [c for c in points.columns if c not in [*by, "pos"]]
    region = F.struct("start_r", "end_r")
    a = points.select(*by, "pos", F.lit(1).alias("__kind"), F.lit(None).cast("struct<start_r:bigint,end_r:bigint>").alias("__region"), F.struct(*[F.col(c) for c in extra] or [F.lit(1).alias("_")]).alias("__row"))
    b = right.select(*by, F.col("start_r").alias("pos"), F.lit(0).alias("__kind"), region.cast("struct<start_r:bigint,end_r:bigint>").alias("__region"), F.lit(None).cast(a.schema["__row"].dataType).alias("__row"))
    both = across(a.unionByName(b), by, ["pos", "__kind"], {"__l": ("last", F.col("__region")), "__r": ("next", F.col("__region"))}, tile)
    left_gap = F.greatest(F.col("pos") - F.col("__l.end_r"), F.lit(0))
    right_gap = F.col("__r.start_r") - F.col("pos")
    use_left = F.col("__l").isNotNull() & (F.col("__r").isNull() | (left_gap < right_gap))
    out = both.filter("__kind = 1").withColumns({"__pick": F.when(use_left, F.col("__l")).otherwise(F.col("__r")), "distance": F.when(use_left, left_gap).otherwise(right_gap)})
    return out.select(*by, "pos", *[F.col(f"__row.{c}") for c in extra], "__pick.start_r", "__pick.end_r", "distance")


def bin_of(start: Column, end: Column) -> Column:
    """The number of the smallest of the nested bins (16 kb and eightfold up to 512 Mb) that holds [start, end)."""
    last = end - 1
    return reduce(
        lambda e, x: F.when(F.shiftright(start, x[0]) == F.shiftright(last, x[0]), F.lit(x[1]) + F.shiftright(start, x[0])).otherwise(e),
        [(26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)],
        F.lit(0).cast("long"),
    )


def tiles(df: DataFrame, size: int, overlap: int = 0) -> DataFrame:
    """Rows (length) in tiles [start, end) of ``size`` and ``overlap`` more."""
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(size).cast("long")))
    return df.filter("length > 0").withColumn("start", at).withColumn("end", F.least(F.col("start") + size + overlap, F.col("length")))
