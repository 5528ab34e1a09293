"""Every registered query of the folder on one small table, against the brute-force versions."""

import hashlib
import random
import zlib

import pytest
from tokenizers import Tokenizer

from strandline.llm import bpe, queries, simhash, source_mix, substring_dedup, suffix_dedup
from tests.llm.test_models import rules_by_hand

Q = queries.queries()
sha = lambda b: hashlib.sha256(b).hexdigest()


def documents():
    r = random.Random(21)
    vocab = ["".join(r.choices("abcdéßxyz", k=r.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choices(vocab, k=n))
    passage = prose(70)
    rows = [(i, prose(r.randint(0, 120)) + (" " + passage if i % 4 == 0 else "") + "\n" * (i % 3), r.choice(["a", "b", None])) for i in range(60)]
    rows += [(100 + i, rows[i][1], "c") for i in range(8)] + [(200, None, "a"), (201, "", None), (202, " \n\t", "b"), (203, "漢" * 300, "b"), (204, "x" * 70_000, "a")]
    return rows


ROWS = documents()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("llm"))
    spark.createDataFrame(ROWS, "doc_id long, text string, source string").write.parquet(f"{top}/documents.parquet")
    spark.createDataFrame([(k, u, "<p>") for k, u in enumerate(URLS)], "page_id long, url string, html string").write.parquet(f"{top}/pages.parquet")
    spark.createDataFrame([(1, ROWS[3][1]), (2, None), (3, "nothing-of-this")], "item_id long, text string").write.parquet(f"{top}/benchmark.parquet")
    spark.createDataFrame([(k // 5, k % 5, "user" if k % 2 else "assistant", ROWS[k][1]) for k in range(60)], "conv_id long, turn long, role string, text string").write.parquet(f"{top}/conversations.parquet")
    return top


R = random.Random(2)
URLS = [None, "", "http://example.com/en/7"] + [f"http://{R.choice(['a', 'b'])}.example.{R.choice(['com', 'net', 'org'])}/{R.choice(['en', 'de', 'es'])}/{R.randint(1, 99)}" for _ in range(200)]


def rows_of(spark, folder, name):
    return Q[name](spark, folder).collect()


def test_all_are_here():
    assert sorted(Q, key=lambda k: int(k[2:].split("_")[0])) == [k for k in Q] and [k.split("_")[0] for k in Q] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.oracle_sql()) == {"op1_source_mix", "op8_quality_rules", "op12_lexical_search", "op13_conversation_repair"}


def test_op1(spark, folder):
    out = rows_of(spark, folder, "op1_source_mix")
    assert {r.doc_id for r in out} == {i for i, *_ in ROWS} and all(0 <= r.taken <= 3 * r.size for r in out)
    source = {i: s for i, _, s in ROWS}
    for s in ("a", "b", "c", None):
        own = [r for r in out if source[r.doc_id] == s]
        assert sum(r.size for r in own) == own[0].source_size and abs(sum(r.taken for r in own) - own[0].target) <= 2 * source_mix.BLOCK


def test_op2(spark, folder):
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows_of(spark, folder, "op2_simhash")} == simhash.brute_force([(i, t) for i, t, _ in ROWS])


def test_op3(spark, folder):
    out = {r.doc_id: r for r in rows_of(spark, folder, "op3_masked_lm")}
    assert {i: r.n_words for i, r in out.items()} == {i: len((t or "").encode().split()) for i, t, _ in ROWS}
    assert all(r.log_probability < 0 for r in out.values() if r.n_words) and out[200].log_probability == 0 and out[200].per_word is None


def test_op4_and_op7(spark, folder):
    byte, word = (Tokenizer.from_file(bpe.vocabulary(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    want4, want7 = {}, {}
    for i, t, _ in ROWS:
        ids = byte.encode(t or "", add_special_tokens=False).ids
        want4[i] = (len(ids), sha(",".join(map(str, ids)).encode()), sha(byte.decode(ids, skip_special_tokens=False).encode()))
        n = len(word.encode(t or "", add_special_tokens=False).ids)
        want7[i] = (len((t or "").encode()), n, n > 2048)
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows_of(spark, folder, "op4_bpe")} == want4
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in rows_of(spark, folder, "op7_token_counts")} == want7


def test_op5(spark, folder):
    for r in rows_of(spark, folder, "op5_url_filter"):
        host, path, rule, said = rules_by_hand(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (said or r.verdict) and r.verdict in ("allow", "block")


def test_op6_and_op10(spark, folder):
    rows = [(i, t) for i, t, _ in ROWS]
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows_of(spark, folder, "op6_substring_dedup")} == substring_dedup.brute_force(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows_of(spark, folder, "op10_suffix_dedup")} == suffix_dedup.brute_force(rows)


def test_op9(spark, folder):
    out = {r.doc_id: r for r in rows_of(spark, folder, "op9_media")}
    for i, t, _ in ROWS:
        data = (t or "").encode()
        padded = data + bytes(-len(data) % 64 if data else 64)
        r = out[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), sha(padded), zlib.crc32(padded[-64:]))
        assert r.rgb_bytes == 3 * r.height * r.width and r.feature.startswith(f"{r.height}x{r.width}:")
    assert all(out[100 + i][1:] == out[i][1:] for i in range(8))


def test_queries_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for name, query in Q.items():
        assert query(spark, str(tmp_path)).count() == 0, name
