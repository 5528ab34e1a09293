"""Windows over long groups, in tiles of their order.

A value that depends on all rows before or after a row is worked out within tiles of positions, and a
summary row of each tile carries it from tile to tile. So a group of any size is spread over as many
tasks as it has tiles, and only the summaries of a group meet in one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

TILE = 1 << 20


def tile_of(df: DataFrame, by: list[str], pos: str, tile: int) -> Column:
    """The tile of a row by a number or a time in seconds; rows of a null group key have tiles like others."""
    at = F.unix_seconds(F.col(pos).cast("timestamp")) if isinstance(df.schema[pos].dataType, TimestampType | TimestampNTZType) else F.col(pos)
    return F.floor(at / tile).cast("long")


def across(df: DataFrame, by: list[str], order: list[str], values: dict[str, tuple[str, Column]], tile: int = TILE) -> DataFrame:
    """df with columns of running values over each group in order; the first order column gives the tiles.

    values: name to (kind, column). Kinds: ``sum`` of all rows up to the row; ``reach``, the largest value before it;
    ``lag`` and ``lead``, the value of the row before and after; ``last``, the last value that isn't null up to the
    row; ``next``, the first such value after it. Order columns must order rows fully or tie only where rows are alike.
    """
    inner, tiles = W.partitionBy(*by, "__tile").orderBy(*order), W.partitionBy(*by).orderBy("__tile")
    up_to, before, after = (W.unboundedPreceding, W.currentRow), (W.unboundedPreceding, -1), (1, W.unboundedFollowing)
    place = F.struct(*order)
    own, summary, carry, out = {}, [], {}, {}
    for name, (kind, c) in values.items():
        a, s = f"__own_{name}", f"__tile_{name}"
        one = F.struct(c.alias("v"))
        known = F.when(c.isNotNull(), place)
        if kind == "sum":
            own[a], total = F.sum(c).over(inner.rowsBetween(*up_to)), F.sum(c)
            carry[s] = F.sum(s).over(tiles.rowsBetween(*before))
            out[name] = F.col(a) + F.coalesce(s, F.lit(0))
        elif kind == "reach":
            own[a], total = F.max(c).over(inner.rowsBetween(*before)), F.max(c)
            carry[s] = F.max(s).over(tiles.rowsBetween(*before))
            out[name] = F.greatest(a, s)
        elif kind in ("lag", "lead"):
            move = F.lag if kind == "lag" else F.lead
            own[a], total = move(one).over(inner), (F.max_by if kind == "lag" else F.min_by)(one, place)
            carry[s] = move(s).over(tiles)
            out[name] = F.coalesce(a, s)["v"]
        elif kind == "last":
            own[a], total = F.last(c, ignorenulls=True).over(inner.rowsBetween(*up_to)), F.max_by(c, known)
            carry[s] = F.last(s, ignorenulls=True).over(tiles.rowsBetween(*before))
            out[name] = F.coalesce(a, s)
        elif kind == "next":
            own[a], total = F.first(c, ignorenulls=True).over(inner.rowsBetween(*after)), F.min_by(c, known)
            carry[s] = F.first(s, ignorenulls=True).over(tiles.rowsBetween(*after))
            out[name] = F.coalesce(a, s)
        else:
            raise ValueError(kind)
        summary.append(total.alias(s))
    tiled = df.withColumn("__tile", tile_of(df, by, order[0], tile))
    carried = tiled.groupBy(*by, "__tile").agg(*summary).withColumns(carry)
    keys = [*by, "__tile"]
    carried = carried.select(*[F.col(c).alias(f"__key{k}") for k, c in enumerate(keys)], *carry)
    met = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__key{k}")) for k, c in enumerate(keys)])
    joined = tiled.withColumns(own).join(carried, met).drop(*[f"__key{k}" for k in range(len(keys))])
    return joined.withColumns(out).drop("__tile", *own, *carry).select(*df.columns, *[n for n in out if n not in df.columns])


def numbered(df: DataFrame, by: list[str], order: list[str], new: Column, name: str, tile: int = TILE) -> DataFrame:
    """df with name, the number of rows up to each for which ``new`` holds or is null."""
    return across(df.withColumn("__new", F.when(F.coalesce(new, F.lit(True)), 1).otherwise(0)), by, order, {name: ("sum", F.col("__new"))}, tile).drop("__new")
