"""The search against all edits, and conversations in tiles against whole ones."""

import hashlib
import random
import zlib

import pytest

from strandline.llm import conversation_repair as C

NAMES = ["conv", *[x.strip().split(" ")[0] for x in C.RESULT.split(",")]]


def cheapest(rows):
    """Of all edits, by walking every one that can still be as cheap as deleting all."""
    found = []

    def walk(i, state, cost, audit):
        if cost > 4 * len(rows):
            return
        if i == len(rows) and state in C.ENDS:
            found.append((cost, audit))
        for role in "ua":
            if role in C.NEXT[state]:
                walk(i, C.NEXT[state][role], cost + 3, audit + "I")
        if i < len(rows):
            initial, fault = rows[i]
            walk(i + 1, state, cost + 4, audit + "D")
            if fault in (C.FINE, C.CUT):
                more = 3 * (fault == C.CUT)
                if initial in C.NEXT[state]:
                    walk(i + 1, C.NEXT[state][initial], cost + more, audit + "K")
                for role in "ua":
                    if role in C.NEXT[state]:
                        walk(i + 1, C.NEXT[state][role], cost + more + 3, audit + "R")

    walk(0, C.NOTHING, 0, "")
    return min(found)


@pytest.mark.parametrize("seed", range(6))
def test_the_search_is_the_least_of_all_edits(seed):
    r = random.Random(seed)
    for _ in range(80):
        rows = [(r.choice(["s", "u", "a", "u", "a", "t", ""]), r.choice([0, 0, 0, 1, 2, 3])) for _ in range(r.randint(0, 6))]
        assert C.solve(rows) == cheapest(rows), rows


def test_long_conversations_are_searched_in_line():
    rows = [("ua"[k % 2], C.FINE if k % 7 else C.CUT) for k in range(4000)]
    assert C.solve(rows) == (572 * 3, "K" * 4000)


def conversations():
    r = random.Random(5)
    rows = []
    for conv in [*range(12), None]:
        for k in range(r.choice([1, 3, 40, 70])):
            text = r.choice(["Fine.", "Cut", "", " \n", f"Text {k}!", "Fine.", None, f"no end {k % 3}"])
            rows.append((conv, r.choice([k, k, k, None, k // 2]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    return rows


@pytest.mark.parametrize("size", [1, 4, 13])
def test_tiles_give_the_whole_s_result(spark, size):
    rows = spark.createDataFrame([(*x, "c") for x in conversations()], "conv_id long, turn long, role string, text string, tile string").repartition(4)
    whole = {tuple(r[c] for c in NAMES) for r in C.repair(rows).collect()}
    assert {tuple(r[c] for c in NAMES) for r in C.repair(rows, size).collect()} == whole and len(whole) == 13


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two? Three!") for c in range(40) for t in (0, 1, None)] + [(None, None, None, None)]
    got = {}
    for r in C.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want = {0: [], 1: [(role, "")], 2: [(role, text.translate({ord(x): None for x in ".!?"}))], 3: [(role, text)] * 2, 4: [("user", text)]}.get(kind, [(role, text)])
        assert got.get((c, t), []) == want


def test_by_hand(spark):
    rows = [(1, 0, "system", "S."), (1, 2, "user", "Hello."), (1, 2, "user", "Hello."), (1, 3, "assistant", "Cut"), (2, None, "user", ""), (3, 5, "assistant", "A.")]
    out = {r.conv: tuple(r)[1:] for r in C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    sha = lambda *x: hashlib.sha256("\n".join(x).encode()).hexdigest()
    assert out["1"] == (1, 0, 1, 1, 1, 7, "KKDK", sha("system:S.", "user:Hello.", "assistant:Cut"))
    assert out["2"] == (0, 1, 0, 0, 0, 4, "D", sha()) and out["3"] == (0, 0, 0, 0, 0, 3, "IK", sha("user:", "assistant:A."))
