"""Hidden Markov chains over ordered rows, in tiles: decoding and smoothing of groups of any length.

A tile of rows is a matrix: the best score, or the log of the summed probability, from each state before its first row to each state at its last one.
Matrices of a group are multiplied in order (one small row a tile), so that every tile knows what comes before and behind it, and is then
decoded by itself. For each state at its end a tile gives the states of its rows and the state before it; the ends are followed from the
last tile back. Tiles of equal length step together through numpy arrays, whatever groups they are of.

Of scores within 1e-9 the smallest state counts, at every step back from the end, so the path does not depend on the tiles. Rows that order columns
tie take part in the order of the other columns. Null group keys form a group; null positions a tile of their own before all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from strandline.lineage import cut_lineage

#: Scores this near are equal, and rows that one numpy pass takes.
NEAR, TOGETHER = 1e-9, 1 << 15
Score = Callable[[pd.DataFrame], tuple[np.ndarray, np.ndarray]]


def _first_best(scores: np.ndarray, axis: int) -> np.ndarray:
    """The smallest index whose score is the largest, but for rounding."""
    top = scores.max(axis=axis, keepdims=True)
    return (scores >= np.where(np.isfinite(top), top - NEAR, top)).argmax(axis=axis)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis=axis)


class Steps:
    """Runs of rows side by side: step i is row i of all runs that have one; runs are in order of falling length."""

    def __init__(self, run: np.ndarray):
        starts = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))) if len(run) else np.empty(0, np.int64)
        sizes = np.diff(np.append(starts, len(run)))
        order = np.argsort(-sizes, kind="stable")
        self.starts, self.sizes, self.order = starts[order], sizes[order], order

    def forward(self) -> Iterator[tuple[int, np.ndarray]]:
        """(number of runs that have the row, their rows) step by step."""
        for i in range(int(self.sizes[0]) if len(self.sizes) else 0):
            m = int(np.searchsorted(-self.sizes, -i, "left"))
            yield m, self.starts[:m] + i

    def backward(self):
        return reversed(list(self.forward()))


def _of(moves: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return moves[rows] if moves.ndim == 3 else moves[None]


def matrices(steps: Steps, emission: np.ndarray, moves: np.ndarray, join) -> np.ndarray:
    """For each run (in their own order) the k by k matrix of its rows, the move into the first one included."""
    k = emission.shape[1]
    out = np.zeros((len(steps.starts), k, k))
    for i, (m, rows) in enumerate(steps.forward()):
        now = _of(moves, rows) + emission[rows][:, None, :]
        out[:m] = now if i == 0 else join(out[:m, :, :, None] + now[:, None, :, :], 2)
    back = np.empty_like(out)
    back[steps.order] = out
    return back


def _chunks(batches, run: str) -> Iterator[pd.DataFrame]:
    """Whole runs, about TOGETHER rows at once."""
    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n < TOGETHER:
            continue
        whole = pd.concat(held, ignore_index=True)
        last = whole[run].iloc[-1]
        cut = int((whole[run] != last).to_numpy().nonzero()[0].max(initial=-1)) + 1
        if cut:
            yield whole.iloc[:cut].reset_index(drop=True)
        held, n = [whole.iloc[cut:]], len(whole) - cut
    if n:
        yield pd.concat(held, ignore_index=True)


def _run(by: list[str]):
    return F.xxhash64(*[F.struct(c) for c in by])


def _dealt(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """df with ``__run``, which tells neighbouring groups apart, sorted within the partitions of the groups."""
    return df.withColumn("__run", _run(by)).repartition(*by).sortWithinPartitions(*by, *order)


def _names(df: DataFrame) -> str:
    return ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in df.schema)


def decoded(df: DataFrame, by: list[str], order: list[str], tile: int, states: int, score: Score, prior: np.ndarray, smooth: bool = False, first_emits: bool = True) -> DataFrame:
    """df with state, before (the state of the row before it in its group, null for the first) and, if asked, posterior (of all states).

    score gives of rows the log scores of the states (rows by states) and of moves from the row before (states by states, or that for each row). The first order
    column gives the tiles, ``tile`` of its units wide. ``first_emits=False`` leaves the first row's emission out of the scores.
    """
    kept = df.columns
    at = F.unix_seconds(F.col(order[0]).cast("timestamp")) if isinstance(df.schema[order[0]].dataType, TimestampType | TimestampNTZType) else F.col(order[0])
    df = df.withColumn("__tile", F.floor(at / tile).cast("long"))
    tiled = _dealt(df, [*by, "__tile"], order)
    k, prior = states, np.asarray(prior, float)
    flat = lambda x: list(x.reshape(len(x), -1))
    maximum = lambda x, axis: x.max(axis=axis)

    def scored(pdf):
        emission, moves = score(pdf)
        return Steps(pdf["__run"].to_numpy()), np.asarray(emission, float), np.asarray(moves, float)

    def summaries(batches):
        for pdf in _chunks(batches, "__run"):
            steps, emission, moves = scored(pdf)
            first = np.sort(steps.starts)
            head = pdf.iloc[first][[*by, "__tile"]].reset_index(drop=True)
            silent = emission.copy()
            silent[first] = 0.0
            start = {}  # of a group's first tile: from the prior, without a move
            for name, join in (("best", maximum), *([("sum", _log_sum)] if smooth else [])):
                begin = np.zeros((len(first), k))
                stay = moves if moves.ndim == 3 else np.broadcast_to(moves, (len(pdf), k, k)).copy()
                stay = stay.copy()
                stay[first] = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)
                whole = matrices(steps, emission if first_emits else silent, stay, join)
                begin = join(prior[None, :, None] + whole, 1)
                start[name] = begin
                head[f"m_{name}"], head[f"v_{name}"] = flat(matrices(steps, emission, moves, join)), flat(begin)
            yield head

    types = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in tiled.select(*by, "__tile").schema)
    kinds = ["best", "sum"] if smooth else ["best"]
    table = ", ".join(f"m_{x} array<double>, v_{x} array<double>" for x in kinds)
    tiles = cut_lineage(tiled.mapInPandas(summaries, f"{types}, {table}"))

    def carried(batches):
        for pdf in _chunks(batches, "__run"):
            steps = Steps(pdf["__run"].to_numpy())
            head = pdf[[*by, "__tile"]].copy()
            for name, join in (("best", maximum), *([("sum", _log_sum)] if smooth else [])):
                m, v = np.stack(pdf[f"m_{name}"].to_list()).reshape(-1, k, k), np.stack(pdf[f"v_{name}"].to_list())
                into, now = np.zeros((len(pdf), k)), None
                for i, (n, rows) in enumerate(steps.forward()):
                    if i:
                        into[rows] = now[:n]
                        now = join(now[:n, :, None] + m[rows], 1)
                    else:
                        now = v[rows]
                head[f"in_{name}"] = list(into)
                if name == "sum":
                    behind = np.zeros((len(pdf), k))
                    for _, rows in steps.backward():
                        inner = rows[~np.isin(rows, steps.starts)]
                        behind[inner - 1] = join(m[inner] + behind[inner][:, None, :], 2)
                    head["behind"] = list(behind)
            first = np.zeros(len(pdf), bool)
            first[steps.starts] = True
            head["first"] = first
            yield head

    more = ", ".join(f"in_{x} array<double>" for x in kinds) + (", behind array<double>" if smooth else "")
    carry = cut_lineage(_dealt(tiles, by, ["__tile"]).mapInPandas(carried, f"{types}, {more}, first boolean"))
    def walked(pdf):
        """Steps, scores and moves of rows, for each row and state the best state before, and the scores at the ends of runs."""
        steps, emission, moves = scored(pdf)
        into, first = np.stack(pdf["in_best"].to_list()), pdf["first"].to_numpy(bool)
        back = np.zeros((len(pdf), k), np.int32)
        now = np.empty((len(steps.starts), k))
        for i, (n, rows) in enumerate(steps.forward()):
            before = into[rows] if i == 0 else now[:n]
            go = before[:, :, None] + _of(moves, rows)
            back[rows] = _first_best(go, 1)
            step = go.max(axis=1) + emission[rows]
            if i == 0:
                own = first[rows]
                step[own] = prior + (emission[rows[own]] if first_emits else 0)
                back[rows[own]] = -1
            now[:n] = step
        return steps, emission, moves, back, now

    def linked(batches):
        for pdf in _chunks(batches, "__run"):
            steps, _, _, back, now = walked(pdf)
            at = np.tile(np.arange(k, dtype=np.int32), (len(steps.starts), 1))
            for n, rows in steps.backward():
                at[:n] = np.take_along_axis(back[rows], at[:n], 1)
            yield pdf.iloc[steps.starts][[*by, "__tile"]].assign(entry=list(at), ends=list(now))

    def rows_with(carry):
        met = _meeting(df.withColumn("__run", _run([*by, "__tile"])), carry, by)
        return met.repartition(*by, "__tile").sortWithinPartitions(*by, "__tile", *order)

    # no row is held between the passes: the first gives a row a tile, the second decodes again with the tile's last state known
    links = cut_lineage(rows_with(carry.select(*by, "__tile", "in_best", "first")).mapInPandas(linked, f"{types}, entry array<int>, ends array<double>"))

    def followed(batches):
        for pdf in _chunks(batches, "__run"):
            steps = Steps(pdf["__run"].to_numpy())
            entry, ends = np.stack(pdf["entry"].to_list()), np.stack(pdf["ends"].to_list())
            stop = np.empty(len(pdf), np.int32)
            last = steps.starts + steps.sizes - 1
            stop[last] = _first_best(ends[last], 1)
            for _, rows in steps.backward():
                inner = rows[~np.isin(rows, steps.starts)]
                stop[inner - 1] = entry[inner, stop[inner]]
            yield pdf[[*by, "__tile"]].assign(stop=stop)

    chosen = _dealt(links, by, ["__tile"]).mapInPandas(followed, f"{types}, stop int")

    def paths(batches):
        for pdf in _chunks(batches, "__run"):
            steps, emission, moves, back, _ = walked(pdf)
            stop, first = steps.starts + steps.sizes - 1, pdf["first"].to_numpy(bool)
            state, come = np.empty(len(pdf), np.int32), np.empty(len(pdf), np.int32)
            at = pdf["stop"].to_numpy()[stop].astype(np.int32)
            for n, rows in steps.backward():
                state[rows] = at[:n]
                come[rows] = back[rows, at[:n]]
                at[:n] = come[rows]
            out = pdf[kept].assign(state=state, before=come)
            if smooth:
                total_in, behind = np.stack(pdf["in_sum"].to_list()), np.stack(pdf["behind"].to_list())
                ahead, after = np.empty((len(pdf), k)), np.empty((len(pdf), k))
                for i, (n, rows) in enumerate(steps.forward()):
                    before = total_in[rows] if i == 0 else ahead[rows - 1]
                    step = _log_sum(before[:, :, None] + _of(moves, rows), 1) + emission[rows]
                    if i == 0:
                        step[first[rows]] = prior + (emission[rows[first[rows]]] if first_emits else 0)
                    ahead[rows] = step
                after[stop] = behind[stop]
                for _, rows in steps.backward():
                    inner = rows[~np.isin(rows, steps.starts)]
                    after[inner - 1] = _log_sum(_of(moves, inner) + (emission[inner] + after[inner])[:, None, :], 2)
                both = ahead + after
                both -= both.max(axis=1, keepdims=True)
                p = np.exp(both)
                out["posterior"] = list(p / p.sum(axis=1, keepdims=True))
            yield out

    schema = f"{_names(df.select(*kept))}, state int, before int" + (", posterior array<double>" if smooth else "")
    out = rows_with(_meeting(carry, chosen, by)).mapInPandas(paths, schema)
    return out.select(*kept, "state", F.nullif("before", F.lit(-1)).alias("before"), *(["posterior"] if smooth else []))


def _meeting(rows: DataFrame, carry: DataFrame, by: list[str]) -> DataFrame:
    """rows with what their tile carries; null keys meet null keys."""
    own = carry.select(*[F.col(c).alias(f"__c{i}") for i, c in enumerate([*by, "__tile"])], *[c for c in carry.columns if c not in (*by, "__tile")])
    on = None
    for i, c in enumerate([*by, "__tile"]):
        one = F.col(c).eqNullSafe(F.col(f"__c{i}"))
        on = one if on is None else on & one
    return rows.join(own, on).drop(*[f"__c{i}" for i in range(len(by) + 1)])
