"""Queries without SQL over whole tables against brute force, on a small fixture."""

import datetime
import random
from itertools import combinations

import pytest

from strandline.plans import registry


@pytest.fixture(scope="module")
def lineitem():
    r = random.Random(11)
    day = lambda: datetime.date(1992, 1, 1) + datetime.timedelta(days=r.randint(0, 120))
    return [(k, r.randint(1, 50), r.randint(1, 12), k % 7 + 1, float(r.randint(1, 50)), float(r.randint(900, 90000)), r.choice("RAN"), day()) for k in range(400)]


@pytest.fixture(scope="module")
def folder(spark, lineitem, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("tables"))
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate date"
    spark.createDataFrame(lineitem, schema).write.parquet(f"{top}/lineitem.parquet")
    return top


def intervals(rows, flag):
    """(id, contig, start, end, price) of one flag, or of all."""
    for order, part, supp, line, quantity, price, f, day in rows:
        start = (day - datetime.date(1992, 1, 1)).days
        if flag is None or f == flag:
            yield (order * 1000000 + part) * 10 + line, supp, start, start + int(quantity), price


def test_overlap_groups_takes_every_supplier(spark, folder, lineitem):
    own = list(intervals(lineitem, None))
    group = {x[0]: x[0] for x in own}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for x, y in combinations(own, 2):
        both = min(x[3], y[3]) - max(x[2], y[2])
        if x[1] == y[1] and both > 0 and both > 0.8 * (x[3] - x[2]) and both > 0.8 * (y[3] - y[2]):
            a, b = sorted((root(x[0]), root(y[0])))
            group[b] = a
    best = {}
    for x in own:
        key = (-x[4], x[2], x[0])
        best[root(x[0])] = min(best.get(root(x[0]), key), key)
    want = {g: k[2] for g, k in best.items()}
    assert len(want) < len(own)
    assert {r.root: r.name for r in registry.queries()["overlap_groups"](spark, folder).collect()} == want


def test_breakpoint_mates_takes_every_line_number(spark, folder, lineitem):
    own = {}
    for name, contig, start, end, _ in intervals(lineitem, "R"):
        own[name] = ((contig % 50, start, start + 2), ((contig * 7 + 3) % 50, end, end + 2))
    cluster, reach, n = {}, {}, 0
    for spot in sorted({s for both in own.values() for s in both}):
        if spot[0] not in reach or spot[1] > reach[spot[0]] + 1:
            n += 1
        reach[spot[0]] = max(spot[2], reach.get(spot[0], spot[2]))
        cluster[spot] = n
    held = {name: {cluster[s] for s in both} for name, both in own.items()}
    want = {name: sum(sum(c in other for other in held.values()) - 1 for c in mine) for name, mine in held.items()}
    assert any(want.values()) and len({name % 10 for name in want}) == 7
    assert {r.name: r.nmates for r in registry.queries()["breakpoint_mates"](spark, folder).collect()} == want


def test_streams_keep_rows_of_files_whose_times_interleave(spark, tmp_path):
    first = datetime.datetime(2024, 1, 1)
    rows = [(k, first + datetime.timedelta(hours=9 * k), k % 3, "ab"[k % 2], 1.0, "") for k in range(40)]
    for part in (rows[30:], rows[:20], rows[20:30]):  # the latest times come first
        spark.createDataFrame(part, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").coalesce(1).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    closed = max(r[1] for r in rows) - datetime.timedelta(hours=1)
    days, sittings = {}, 0
    for _, ts, _, kind, _, _ in rows:
        day = datetime.datetime(ts.year, ts.month, ts.day)
        if day + datetime.timedelta(days=1) <= closed:
            key = (kind, int(day.replace(tzinfo=datetime.timezone.utc).timestamp()))
            days[key] = days.get(key, 0) + 1
        sittings += ts + datetime.timedelta(hours=6) <= closed
    assert {(r.event_type, r.start): r.n for r in registry.queries()["stream_daily_counts"](spark, str(tmp_path)).collect()} == days
    assert [r.n for r in registry.queries()["stream_sessions"](spark, str(tmp_path)).collect()] == [1] * sittings
