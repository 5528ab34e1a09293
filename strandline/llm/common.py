"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"

#: Rows without an id come last; nothing else is assumed of them.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_id(doc_id: str = "doc_id") -> Column:
    """The id that orders documents: null ids come after all others."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID))


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def random_table(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


def slabs(rows: Iterator[tuple], size, most: int) -> Iterator[list[tuple]]:
    """Rows in lists whose sizes add up to ``most`` or so; a larger row is alone."""
    held, total = [], 0
    for row in rows:
        n = size(row)
        if held and total + n > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += n
    if held:
        yield held
