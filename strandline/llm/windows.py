"""Which fixed-length windows of symbol sequences also start earlier in the corpus.

The substring operators (words, bytes) share this search. A window is ``length`` consecutive
symbols of one document; "earlier" means a smaller (order id, text, start).

1. Every window is named by its smallest ``q``-gram identifier (leftmost on ties). Equal windows
   have equal names, so only windows under a shared name can repeat. Neighbouring windows with
   the same smallest q-gram form one *run*, and only runs are shuffled: about 2 / (length - q + 2)
   rows a symbol.
2. Runs of a name that agree in every symbol are copies: all windows of the later ones repeat.
   Each task keeps the earliest it has seen of such copies, so a passage that a third of all
   documents share costs a row a task.
3. Where a name has different runs, the earliest of each kind goes on, in blocks of ``block``
   windows named by the symbols that all windows of the block share; blocks that agree in every
   symbol are copies, as before.
4. Where such a name has different blocks, the earliest of each kind lists its windows one by one,
   and the earliest holder of each window is found the same way.

The comparisons are Spark's: rows are sorted by name, kind and place within the partition of their name, and
window functions count the kinds of a name and find the first of each kind; groups of any size spill.
A name that one task sees with many different runs is dealt out by the run instead of the name, with
markers at the name itself, so that a phrase in a third of all documents sends a few rows a task to its name.

Documents are told apart by id and, where an id (or its absence) stands for several texts, by 64 bits of a
hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.llm.common import mix, order_id, slabs

#: Symbols that one numpy pass holds; longer texts are passed in pieces that overlap by a window.
SLAB = 1 << 18
#: Symbols between two listed windows that are named along rather than left out.
GAP = 1 << 11
#: Runs that a task compares at once before it sends the earliest of each kind on.
GATHER = 1 << 19

#: What a row says of a run: found under its name, known to need a list, a marker of the latter, repeated.
PLAIN, LISTED, MARKER, REPEATED = range(4)

RUN = "key long, name long, kind_of long, oid long, mark long, place long, what int"
#: A place holds the start and, in its last bits, the number of windows.
COUNT_BITS = 7
#: Ids of several texts are broadcast up to this many rows, joined by a shuffle beyond.
BROADCAST_ROWS = 200_000


def text_mark(text: Column) -> Column:
    """Tells apart texts under the same id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def marked(docs: DataFrame, oid: str, mark: str) -> DataFrame:
    """docs with the id that orders them and the mark of their text, which is zero where the id stands for one text only."""
    named = docs.withColumns({oid: order_id(), mark: text_mark(F.col("text"))})
    several = cut_lineage(named.groupBy(oid).agg(F.min(mark).alias("__a"), F.max(mark).alias("__z")).filter("__a <> __z").select(oid, F.lit(True).alias("__several")))
    n = several.count()
    if not n:
        return named.withColumn(mark, F.col(oid).bitwiseAND(0))  # zero, but no literal, which each reader would fold into a plan of its own
    joined = named.join(F.broadcast(several) if n <= BROADCAST_ROWS else several, oid, "left")
    return joined.withColumn(mark, F.when(F.col("__several"), F.col(mark)).otherwise(F.lit(0).cast("long"))).drop("__several")


def keyed(docs: DataFrame) -> DataFrame:
    """One row for each row: oid, mark, text (null: empty), dealt out once for all steps that read the texts."""
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return marked(own, "oid", "mark").select("oid", "mark", "text").repartition("oid", "mark")


def smallest(names: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` consecutive names stands, the leftmost on ties."""
    low, at, have = names, np.arange(len(names), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        later = low[step:] < low[:-step]
        low = np.where(later, low[step:], low[:-step])
        at = np.where(later, at[step:], at[:-step])
        have += step
    return at


class Plan:
    """How to name windows: ``symbols(text bytes)`` gives an array; ``names(symbols)`` gives the identifiers of the q-grams, of ``half`` symbols and of the windows; ``second(symbols)`` names the windows once more, independently."""

    def __init__(self, length: int, q: int, half: int, block: int, symbols: Callable, names: Callable, second: Callable):
        self.length, self.q, self.half, self.block, self.symbols, self.names, self.second = length, q, half, block, symbols, names, second
        self.width = length - q + 1
        assert self.width <= min(length, (1 << COUNT_BITS) - 1)
        assert half <= length - block + 1 <= 2 * half

    def pieces(self, rows: Iterator[tuple]) -> Iterator[tuple[int, int, int, np.ndarray]]:
        for oid, mark, text in rows:
            data = self.symbols(text)
            for base in range(0, max(1, len(data) - self.length + 1), SLAB):
                part = data[base : base + SLAB + self.length - 1]
                if len(part) >= self.length:
                    yield oid, mark, base, part

    def runs(self, rows: Iterator[tuple]) -> Iterator[dict[str, np.ndarray]]:
        for slab in slabs(self.pieces(rows), lambda x: len(x[3]), SLAB):
            data = np.concatenate([x[3] for x in slab])
            sizes = np.array([len(x[3]) for x in slab])
            ends = np.cumsum(sizes)
            grams, _, windows = self.names(data)
            at = smallest(grams, self.width)[: len(windows)]
            of = np.repeat(np.arange(len(slab), dtype=np.int32), sizes)[: len(windows)]
            inside = np.arange(len(windows)) + self.length <= ends[of]
            first = inside.copy()
            first[1:] &= (at[1:] != at[:-1]) | (of[1:] != of[:-1])
            start = np.flatnonzero(first)
            last = np.append(start[1:], len(windows)) - 1
            last = np.minimum(last, ends[of[start]] - self.length)
            count = last - start + 1
            doc = of[start]
            name = grams[at[start]]
            kind = mix(windows[start] * np.uint64(0x9E3779B97F4A7C15) + windows[last]) + (count * 256 + at[start] - start).astype(np.uint64)
            base = np.array([x[2] for x in slab]) - np.append(0, ends[:-1])
            mark = np.array([x[1] for x in slab], dtype=np.int64)[doc]
            oid = np.array([x[0] for x in slab], dtype=np.int64)[doc]
            yield {"name": name, "kind": kind, "oid": oid, "mark": mark, "place": ((start + base[doc]) << COUNT_BITS) | count}

    def starts(self, places: np.ndarray) -> np.ndarray:
        """The starts of all windows of the runs at ``places``."""
        start, count = places >> COUNT_BITS, places & ((1 << COUNT_BITS) - 1)
        return np.unique(np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))

    def stretches(self, text: str, places: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """The starts of the windows at ``places`` in pieces of bounded length: starts less their base, the base, the symbols."""
        data, every = self.symbols(text), self.starts(places)
        cut = np.flatnonzero((np.diff(every) > GAP) | (np.diff(every // SLAB) > 0)) + 1
        for part in np.split(every, cut):
            yield part - part[0], int(part[0]), data[part[0] : part[-1] + self.length]

    def blocks(self, oid: int, mark: int, text: str, places: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
        for start, base, data in self.stretches(text, places):
            grams, halves, windows = self.names(data)
            at = smallest(grams, self.width)[start]
            step = (at - start) // self.block
            first = np.ones(len(start), bool)
            first[1:] = (np.diff(start) > 1) | (np.diff(at) != 0) | (np.diff(step) != 0)
            head = np.flatnonzero(first)
            tail = np.append(head[1:], len(start)) - 1
            begin, step = at[head] - step[head] * self.block, step[head]  # the symbols from here on are in all windows of the block, up to:
            stop = begin - self.block + 1 + self.length
            name = mix(halves[begin] * np.uint64(0x9E3779B97F4A7C15) + halves[stop - self.half]) + step.astype(np.uint64)
            count = start[tail] - start[head] + 1
            kind = mix(windows[start[head]] * np.uint64(0x9E3779B97F4A7C15) + windows[start[tail]]) + (count * 256 + at[head] - start[head]).astype(np.uint64)
            yield self.at(oid, mark, name, kind, start[head] + base, count)

    def singles(self, oid: int, mark: int, text: str, places: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
        for start, base, data in self.stretches(text, places):
            yield self.at(oid, mark, self.names(data)[2][start], self.second(data)[start], start + base, np.ones(len(start), np.int64))

    def at(self, oid: int, mark: int, name, kind, start, count) -> dict[str, np.ndarray]:
        return {"name": name, "kind": kind, "oid": np.full(len(name), oid, np.int64), "mark": np.full(len(name), mark, np.int64), "place": (start.astype(np.int64) << COUNT_BITS) | count}


def groups(*columns: np.ndarray) -> np.ndarray:
    """Where a new group of equal rows begins, of sorted rows."""
    new = np.ones(len(columns[0]), bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def same_start(new: np.ndarray, *columns: np.ndarray) -> np.ndarray:
    """Rows of the earliest place of their group: the first, and repetitions of it from repeated rows of the table."""
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    return np.logical_and.reduce([c == c[head] for c in columns])


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: (v if v.dtype == np.int32 else v.view(np.int64)) for k, v in columns.items()})


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        oid, mark, text = (b.column(k) for k in ("oid", "mark", "text"))
        for i in range(b.num_rows):
            yield oid[i].as_py(), mark[i].as_py(), text[i].as_py()


def gathered(parts: Iterator[dict[str, np.ndarray]], most: int) -> Iterator[dict[str, np.ndarray]]:
    for held in slabs(((p,) for p in parts), lambda x: len(x[0]["oid"]), most):
        yield {k: np.concatenate([p[0][k] for p in held]) for k in held[0][0]}


def earliest_runs(parts: Iterator[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Of each kind of run that a task sees, the earliest; the others are known to repeat."""
    for r in gathered(parts, GATHER):
        by = np.lexsort((r["place"], r["mark"], r["oid"], r["kind"], r["name"]))
        name, kind, oid, own_mark, place = (r[k][by] for k in ("name", "kind", "oid", "mark", "place"))
        if not len(name):
            continue
        new = groups(name, kind)
        keep, repeat = new, ~same_start(new, oid, own_mark, place)
        heads = np.flatnonzero(new)
        of_name = groups(name[heads])
        kinds = np.diff(np.append(np.flatnonzero(of_name), len(heads)))
        several = np.zeros(len(name), bool)
        several[heads] = np.repeat(kinds, kinds) > 2
        what = np.where(several, LISTED, PLAIN).astype(np.int32)
        mark = heads[of_name & several[heads]]
        key = np.where(several, mix(name * np.uint64(3) + kind), name)
        for pick, w, k in ((np.flatnonzero(keep), what, key), (mark, None, name), (np.flatnonzero(repeat), None, oid.view(np.uint64))):
            if len(pick):
                said = w[pick] if w is not None else np.full(len(pick), MARKER if pick is mark else REPEATED, np.int32)
                # what a row's key or verdict makes needless is left zero, which costs next to nothing in a shuffle
                own_name = np.where(said == LISTED, name[pick], np.uint64(0))
                own_kind = np.where(said == REPEATED, np.uint64(0), kind[pick])
                yield batch(key=k[pick], name=own_name, kind_of=own_kind, oid=oid[pick], mark=own_mark[pick], place=place[pick], what=said)


def judged(held: DataFrame) -> DataFrame:
    """From rows of form RUN: (oid, mark, place) of runs that repeat and, with its bits inverted, the place of those that must list their windows."""
    sure, name = F.col("what") == REPEATED, F.when(F.col("what") == LISTED, F.col("name")).otherwise(F.col("key"))
    of_kind = W.partitionBy("key", "__sure", "__name", "kind_of").orderBy("oid", "mark", "place")
    of_name = W.partitionBy("key", "__sure", "__name").orderBy("kind_of", "oid", "mark", "place").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)  # so that one sort serves both
    rows = held.repartition("key").withColumns({"__sure": sure, "__name": F.when(sure, F.lit(0).cast("long")).otherwise(name)})
    rows = rows.withColumn("__first", F.first(F.struct("oid", "mark", "place")).over(of_kind))
    rows = rows.withColumns({"__kinds": F.min("kind_of").over(of_name) != F.max("kind_of").over(of_name), "__most": F.max("what").over(of_name)})
    head = F.col("__first") == F.struct("oid", "mark", "place")
    lists = F.col("__kinds") | (F.col("__most") != PLAIN)
    place = F.when(F.col("__sure"), F.col("place")).when(F.col("what") == MARKER, None).when(~head, F.col("place")).when(lists, F.bitwise_not("place"))
    return rows.select("oid", "mark", place.alias("place")).filter("place is not null")


def repeated_windows(docs: DataFrame, plan: Plan) -> DataFrame:
    """Rows (oid, mark, spans) for documents of ``keyed()`` form: spans lists places, of which the start and the number of windows that repeat can be read."""

    def judge(of: DataFrame, parts: Callable) -> DataFrame:
        held = of.mapInArrow(lambda batches: earliest_runs(parts(batches)), RUN)
        return judged(held).groupBy("oid", "mark").agg(F.collect_list("place").alias("places"))

    def again(found: DataFrame, parts: Callable) -> DataFrame:
        def each(batches):
            for b in batches:
                for oid, mark, text, places in zip(*(b.column(k) for k in ("oid", "mark", "text", "places")), strict=True):
                    own = places.values.to_numpy()
                    yield from parts(oid.as_py(), mark.as_py(), text.as_py(), ~own[own < 0])

        return judge(docs.join(found.filter(F.array_min("places") < 0), ["oid", "mark"]), each)

    runs = judge(docs, lambda batches: plan.runs(rows_of(batches)))
    blocks = again(runs, plan.blocks)
    singles = again(blocks, plan.singles)
    found = runs  # every document of a later step is one of the step before
    for name, more in (("__blocks", blocks), ("__singles", singles)):
        found = found.join(more.withColumnRenamed("places", name), ["oid", "mark"], "left")
    none = F.array().cast("array<long>")
    every = F.concat("places", *[F.coalesce(c, none) for c in ("__blocks", "__singles")])
    return found.select("oid", "mark", F.filter(every, lambda p: p >= 0).alias("spans"))


def with_spans(docs: DataFrame, plan: Plan) -> DataFrame:
    """``keyed()`` documents with the spans of their repeated windows, null for none."""
    return docs.join(repeated_windows(docs, plan), ["oid", "mark"], "left")


def covered(spans: np.ndarray | None, length: int, n: int) -> np.ndarray:
    """Which of n symbols a repeated window covers."""
    step = np.zeros(n + 1, np.int32)
    if spans is not None and len(spans):
        spans = np.asarray(spans, dtype=np.int64)
        start, count = spans >> COUNT_BITS, spans & ((1 << COUNT_BITS) - 1)
        np.add.at(step, start, 1)
        np.add.at(step, start + count - 1 + length, -1)
    return np.cumsum(step[:n]) > 0


def intervals(mask: np.ndarray) -> np.ndarray:
    """Start and end of each maximal run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge.reshape(-1, 2)
