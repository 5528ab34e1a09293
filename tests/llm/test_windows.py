import hashlib
import random

import numpy as np
import pytest

from strandline.llm import substring_dedup, suffix_dedup
from strandline.llm.windows import smallest


def corpus(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choices("abcdeé", k=r.randint(1, 6))) for _ in range(60)]
    prose = lambda n: " ".join(r.choices(vocab, k=n))
    passages = [prose(r.randint(15, 60)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [prose(r.randint(0, 80)) if r.random() < 0.6 else r.choice(passages) for _ in range(r.randint(1, 5))]
        text = r.choice([" ", "\n", "\t "]).join(parts)
        if r.random() < 0.2 and rows:
            words = (rows[r.randrange(len(rows))][1] or "").split(" ")
            words[r.randrange(len(words))] = "edit"
            text = " ".join(words)
        rows.append((i, text))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "a" * 500), (204, "a" * 300), (205, "a " * 90), (206, "ab" * 200), (207, rows[5][1]), (208, rows[5][1])]
    rows += [(300 + i, f"start{i} " + passages[0] + f" end{i} " + passages[1][:80]) for i in range(40)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, n_words int, oid int")
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in substring_dedup.dedup_words(df).collect()}
    assert got == substring_dedup.brute_force(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "doc_id long, text string, n_bytes int, oid int")
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in suffix_dedup.dedup_bytes(df).collect()}
    assert got == suffix_dedup.brute_force(rows)


def test_pieces_of_long_texts(spark, monkeypatch):
    from strandline.llm import windows

    rows = corpus(3)
    monkeypatch.setattr(windows, "SLAB", 150)
    for module in (substring_dedup, suffix_dedup):
        plan = module.plan()
        parts = list(plan.runs((a, 1, b or "") for a, b in rows))
        windows_of = {}
        for p in parts:
            for oid, place in zip(p["oid"], p["place"], strict=True):
                windows_of.setdefault(int(oid), []).extend(plan.starts(np.array([place])))
        for a, b in rows:
            assert sorted(windows_of.get(a, [])) == list(range(len(plan.symbols(b or "")) - plan.length + 1))


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    schema = "doc_id long, text string"
    for f in (substring_dedup.dedup_words, suffix_dedup.dedup_bytes):
        assert f(spark.createDataFrame([], schema)).count() == 0
        rows = f(spark.createDataFrame([(1, text), (1, text), (None, text), (None, None)], schema)).collect()
        assert [r.n_removed for r in rows if r.doc_id == 1] == [0, 0]
        whole = [r for r in rows if r.doc_id is None and r[1]]
        assert len(whole) == 1 and whole[0].n_removed == whole[0][1]


def test_smallest_is_leftmost():
    names = np.array([5, 3, 3, 9, 1, 1, 7, 2], dtype=np.uint64)
    assert list(smallest(names, 3)) == [1, 1, 4, 4, 4, 5]


def test_characters_stay_whole(spark):
    shared = "".join(chr(0xE0 + (i * i // 3) % 23) for i in range(80))
    df = spark.createDataFrame([(1, "x" + shared, 81), (2, "\u0130" + shared + "z", 82), (3, None, None)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(df).collect()}
    assert got[1].text == "x" + shared and got[2].text == "\u0130z" and got[3].text is None
    assert got[2].n_chars == 2


def test_many_texts_under_one_id(spark):
    """Null ids and one shared id: texts stay apart, and one of them keeps the shared passage."""
    passage = " ".join(f"shared{i}" for i in range(30))
    rows = [(i, f"own{k} " * 25 + passage + f" end{k}") for k in range(1500) for i in (None, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.dedup_words(df, length=20).collect()
    assert len(got) == 3000
    kept = [r for r in got if "shared3 " in r.kept]
    assert [r.doc_id for r in kept] == [7]
    # texts are equal under both ids: of each, the one under 7 keeps its repeated words but for those that repeat inside it
    assert all(r.n_removed >= 30 for r in got if r.doc_id is None)
    cut = suffix_dedup.without_repeats(df.limit(0).unionAll(df.filter("doc_id is null"))).collect()
    assert len(cut) == 1500 and sum("shared3 " in r.text for r in cut) == 1
