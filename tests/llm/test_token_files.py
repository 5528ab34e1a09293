"""Token files: every row against the library, places, look-ups and stretches of the stream."""

import glob
import random

import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm import token_files as T

VOCAB = T.vocabulary("word_bpe_49k.json")


def texts():
    r = random.Random(11)
    plain = ["".join(r.choices("abcdefgeßéÀÉйЖ", k=r.randint(1, 8))) for _ in range(400)]
    odd = ["", " ", "\t", " ", "a\nb", "<|endoftext|>", "x<|startoftext|>y", "İstanbul", "ΣΑΣ", "漢字かな", "é", "I'll", "don't've", "12.5%", "??!", " ", "ﬁ", "\x01", "\x02", "a\x02b"]
    rows = [(i, " ".join(r.choices(plain + odd * 3, k=r.randint(0, 90)))) for i in range(2500)]
    return [*rows, (5000, None), (5001, ""), (5002, "漢" * 3000), (None, "no id"), (5003, "y" * 50_000)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ids") / "out")
    rows = texts()
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(*r, "z", 0) for r in rows], "doc_id long, text string, file string, ids int").repartition(5)
    T.write(docs, path, VOCAB, stripe=1 << 16)
    return path


def test_rows_are_the_library_s(spark, folder):
    out = sorted([tuple(r) for r in T.checksums(T.read(spark, folder)).collect()], key=lambda r: r[1])
    assert out == T.brute_force(texts(), VOCAB)


def test_files_keep_stripes_and_conditions_reach_them(spark, folder):
    stripes = [orc.ORCFile(f).nstripes for f in glob.glob(f"{folder}/rows/*.orc")]
    assert max(stripes) > 1
    one = T.read(spark, folder, F.col("doc_id") == 77)
    plan = one._jdf.queryExecution().explainString(one._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "EqualTo(doc_id,77)" in plan
    assert one.first().ids == [*Tokenizer.from_file(VOCAB).encode(dict(texts())[77], add_special_tokens=False).ids, T.END]


@pytest.mark.parametrize(("first", "stop"), [(0, 10), (1234, 40_000), (10**9, 10**9 + 5)])
def test_stretches(spark, folder, first, stop):
    whole = [i for r in T.read(spark, folder).orderBy("start").collect() for i in r.ids]
    parts = T.stretch(spark, folder, first, stop).orderBy("start").collect()
    assert [i for r in parts for i in r.ids] == whole[first:stop] and [r.start for r in parts] == sorted({r.start for r in parts})


def test_repeated_rows_and_ids(spark, tmp_path):
    rows = [(1, "one two"), (1, "one two"), (1, "three"), (None, "x"), (None, None), (0, "y z")] * 3
    T.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), f"{tmp_path}/o", VOCAB)
    out = T.read(spark, f"{tmp_path}/o").orderBy("start").collect()
    assert [r.doc_id for r in out] == [0] * 3 + [1] * 9 + [None] * 6
    place = 0
    for r in out:
        assert r.start == place and r.n_tokens == len(r.ids) and r.ids[-1] == T.END
        place += r.n_tokens


def test_empty(spark, tmp_path):
    T.write(spark.createDataFrame([], "doc_id long, text string"), f"{tmp_path}/o", VOCAB)
    assert T.read(spark, f"{tmp_path}/o").count() == 0 and T.stretch(spark, f"{tmp_path}/o", 0, 5).count() == 0
