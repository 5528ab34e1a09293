"""Blocks, rows of tracks and near duplicates against plain loops."""

import random

import pytest

from strandline.operators import proximal as P
from strandline.operators import tracks as T


@pytest.mark.parametrize("tile", [3, 1000])
def test_phase_blocks(spark, tile):
    r = random.Random(tile)
    rows = [(g, i // 2, r.choice([0, 0, 5, 6, None]), r.random() < 0.5, r.random() < 0.5, r.random() < 0.9) for g in ("a", None) for i in range(80)]
    rows += [x for x in rows for _ in range(2)]  # rows that tie
    want = []
    for g in ("a", None):
        own = sorted([(p, s or 0, a, b) for x, p, s, a, b, f in rows if x == g and f and a != b])
        blocks, held = [], None
        for pos, ps, a, b in own:
            if not blocks or ps and ps != held:
                blocks.append([pos, pos, ps or None, 0, 0])
                held = ps if not len(blocks) > 1 or ps else held
            held = ps or held
            blocks[-1][1], blocks[-1][3], blocks[-1][4] = pos + 1, blocks[-1][3] + a, blocks[-1][4] + b
        want += [(g, k + 1, *b) for k, b in enumerate(blocks) if b[3] + b[4] >= 2]
    out = T.phase_block_rows(spark.createDataFrame(rows, "contig string, pos long, ps long, first boolean, second boolean, phased boolean").repartition(3), ["contig"], tile=tile).collect()
    assert sorted([tuple(x) for x in out], key=str) == sorted(want, key=str)


@pytest.mark.parametrize(("seed", "rows"), [(1, 3), (2, 3), (3, 2), (4, 4)])
def test_rows_of_tracks(spark, seed, rows):
    r = random.Random(seed)
    genes = [(g, s, s + r.choice([0, 1, 3, 9, 40 if r.random() < 0.1 else 2]), k, "n") for g in ("a", "b") for k, s in enumerate(r.randint(0, 300) for _ in range(90))]
    want = {}
    for g in ("a", "b"):
        last = [min(x[1] for x in genes if x[0] == g) - 2 * rows] * rows
        for _, s, e, k, _ in sorted([x for x in genes if x[0] == g], key=lambda x: (x[1], x[2], x[3])):
            row = last.index(min(last))
            want[g, k] = row
            last[row] = e
    df = spark.createDataFrame([*genes, ("a", None, 3, 1000, "n")], "g string, start long, end long, id int, row string").drop("row").repartition(4)
    out = T.track_rows(df, ["g"], ["id"], rows, tile=50).collect()
    assert {(x.g, x.id): x.row for x in out} == want | {("a", 1000): None}


def test_near_earlier_rows_are_exact_for_a_crowded_key(spark):
    """Two thousand rows of one key, many at one spot, against all pairs."""
    r = random.Random(6)
    rows = [(1, i, r.choice([50.0, r.random() * 300]), r.choice([50.0, r.random() * 300])) for i in range(2000)] + [(2, 0, 1.0, 1.0), (2, 1, 1.0, 11.0), (2, 2, 1.0, 10.999), (2, 3, None, 1.0), (None, 5, 1.0, 1.0), (None, 6, 1.0, 1.0)]
    from pyspark.sql import functions as F

    out = {(x.k, x.i): x.near for x in P.near_earlier(spark.createDataFrame(rows, "k int, i int, x double, y double"), ["k"], "i", F.col("x"), F.col("y"), 10.0, "near").collect()}
    near = lambda a, b: None not in (*a, *b) and a[0] == b[0] and b[1] < a[1] and (a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2 < 100
    assert out == {(k, i): any(near((k, i, x, y), b) for b in rows) for k, i, x, y in rows}
    assert not out[2, 1] and out[2, 2]


def test_small_lanes_are_not_searched_for_diffusion(spark):
    rows = [(1, lane, k, 1, 1, 10 * k, 5) for lane in (1, 2) for k in range(3)] + [(2, 2, 9, 4, 9, 9000, 9000)]
    out = {x.key: x for x in P.proximal_duplicates(spark.createDataFrame(rows, "key int, lane int, id int, swath int, tile int, x int, y int"), ["key"], ["lane"], "id", 5, 15).collect()}
    assert (out[1].n, out[1].optical, out[1].diffusion, out[1].apart) == (6, 0, 2, 4)
