import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandline.llm import bpe, token_counts

BYTE, WORD = bpe.vocabulary("byte_bpe_50k.json"), bpe.vocabulary("word_bpe_49k.json")
LETTERS = st.sampled_from(list("abt'sre  \n\t!!|<>.0123é漢字ΣİǺ\x85\xa0​\x1c😀") + ["<|endoftext|>", "<|startoftext|>", "'ll", "'ve", "the", " of", "  ", "aaaaaaaa", "᠎"])
TEXTS = st.lists(LETTERS, max_size=120).map("".join)


def ids(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def direct():
    held = {p: Tokenizer.from_file(p) for p in (BYTE, WORD)}
    return lambda p, text: held[p].encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words_encode_as_whole_texts(direct, text):
    own = bpe.codec(BYTE)
    got = own.batch([text])[0].tolist()
    assert got == direct(BYTE, text)
    assert own.text(got) == own.model.decode(got, skip_special_tokens=False) == text
    assert token_counts.counter(WORD).batch([text])[0] == len(direct(WORD, text))


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_tree_of_halves(direct, text, leaf):
    assert bpe.codec(BYTE).unsplit(text, leaf).tolist() == direct(BYTE, text)


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.integers(0, 60), st.integers(1, 20))
def test_chunks_resynchronise(direct, text, more, overlap):
    own, step = token_counts.counter(WORD), 2 * overlap + more
    chunks = [own.chunk(text[a : a + step + overlap], a, overlap) for a in range(0, max(1, len(text)), step)]
    assert own.spliced(text, chunks, overlap) == len(direct(WORD, text))


@pytest.mark.parametrize("kind", ["chinese", "base64", "one letter", "marks"])
def test_long_texts_without_spaces(direct, kind):
    r = random.Random(4)
    alphabet = {"chinese": [chr(0x4E00 + i * i % 9000) for i in range(400)], "base64": list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), "one letter": "a", "marks": ["e\u0301", "a", "\u0323", "'s", "!"]}[kind]
    text = "".join(r.choices(alphabet, k=150_000))
    own, encoded = token_counts.counter(WORD), []
    chunks = [own.chunk(text[a : a + 4096 + 256], a, 256) for a in range(0, len(text), 4096)]
    whole = own.chunk
    own.chunk = lambda t, *rest: encoded.append(len(t)) or whole(t, *rest)
    try:
        assert own.spliced(text, chunks, 256) == len(direct(WORD, text))
    finally:
        del own.chunk
    # widening stays local: but for the one letter, next to nothing is encoded again
    assert sum(encoded) < len(text) * (8 if kind == "one letter" else 0.2)


def test_whole_tables(spark, monkeypatch):
    for module, name in ((bpe, "PART"), (token_counts, "CHUNK")):
        monkeypatch.setattr(module, name, 700)
    r = random.Random(8)
    texts = [None, "", " ", "<|endoftext|> a <|endoftext|>", "x" * 5000, "漢" * 3000, "a b  c\n" * 900]
    texts += ["".join(r.choices(["word", " ", " the", "\n", "é", "!!", "12", "'s", "漢字"], k=r.choice([5, 100, 2000]))) for _ in range(30)]
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)] + [(None, texts[6], "n", 1), (4, texts[4], "n", 1), (4, texts[5], "n", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")
    got = sorted(((str(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in bpe.digests(bpe.encode(df, BYTE, ["doc_id"])).collect()))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    whole = [(str(i), ids(BYTE, t or ""), t or "") for i, t, *_ in rows]
    assert got == sorted((i, len(x), sha(",".join(map(str, x))), sha(t)) for i, x, t in whole)
    counts = sorted((str(x.doc_id), x.n_bytes, x.n_tokens) for x in token_counts.token_counts(df, WORD, ["doc_id"]).collect())
    assert counts == sorted((i, len(t.encode()), len(ids(WORD, t))) for i, _, t in whole)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, BYTE, ["doc_id"]).count() == token_counts.token_counts(empty, WORD, ["doc_id"]).count() == 0


def test_joins_in_one_long_run(direct):
    text = "".join(random.Random(3).choices("abcdefgh", k=30_000))
    own = bpe.codec(BYTE)
    assert np.array_equal(own.unsplit(text, 1000), direct(BYTE, text))


def test_vocabularies_of_another_kind_are_refused():
    bpe.codec(BYTE), token_counts.counter(WORD)
    with pytest.raises(ValueError):
        bpe.Codec(WORD)
    with pytest.raises(ValueError):
        token_counts.Counter(BYTE)
