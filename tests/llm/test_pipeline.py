import random

import corpus_pipeline
from strandline.llm import bpe, quality_rules, simhash, suffix_dedup


def corpus():
    r = random.Random(7)
    vocab = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 7))) for _ in range(900)]
    prose = lambda n: " ".join(r.choices(vocab, k=n))
    passage = prose(60)
    rows = [(i, prose(r.randint(30, 200)) + (" " + passage if i % 9 == 0 else ""), "en", f"s{i % 4}") for i in range(150)]
    rows += [(1000 + i, rows[i][1], "en", "copy") for i in range(20)]
    rows += [(2000 + i, "### $$$ " * 40, "en", None) for i in range(5)] + [(3000, None, None, None), (3001, "short", "en", "s1")]
    return [(*x, len(x[1] or "")) for x in rows]


def test_stages_against_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    _, near, strings, mixed, tokens = (f for _, f in corpus_pipeline.STAGES)
    one = corpus_pipeline.rules(spark, docs, "")
    assert one.columns == docs.columns
    kept = {r.doc_id for r in one.collect()}
    assert kept == {r.doc_id for r in quality_rules.ledger(docs).collect() if not r.fail_mask} and not any(i >= 2000 for i in kept) and len(kept) == 170
    two = near(spark, one, "").cache()
    sets = {r.doc_id: set(simhash.shingles(r.text).tolist()) for r in one.collect()}
    same = {i: min(j for j in sets if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])) for i in sets}
    assert sorted(r.doc_id for r in two.collect()) == sorted(set(same.values())) and len(set(same.values())) < len(sets)
    three = strings(spark, two, "").cache()
    removed = suffix_dedup.brute_force([(r.doc_id, r.text) for r in two.collect()])
    for r in three.collect():
        assert len(r.text.encode()) == removed[r.doc_id][0] - removed[r.doc_id][1] and r.n_chars == len(r.text)
    four = mixed(spark, three, "").cache()
    texts = {r.doc_id: r.text for r in three.collect()}
    assert all(r.n_chars == len(r.text) and set(r.text.split()) <= set(texts[r.doc_id].split()) for r in four.collect()) and four.columns == docs.columns
    five = tokens(spark, four, "").collect()
    own = bpe.codec(bpe.vocabulary("byte_bpe_50k.json"))
    want = sorted((r.doc_id, own.library([r.text])[0], r.text) for r in four.collect())
    assert sorted((r.doc_id, list(r.ids), r.decoded) for r in five) == want


def test_whole_run(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out and all(r.n_tokens == len(r.ids) for r in out)
    assert corpus_pipeline.ORACLE_SQL is None and [k for k, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_strings", "source_mix", "bpe"]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"] and out.count() == 0
