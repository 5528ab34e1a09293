import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from strandline.llm import masked_lm, url_filter


def rules_by_hand(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = max([(len(t), t, v) for v, t in url_filter.RULES if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith("/" + t.split("/", 1)[1])], default=(0, None, None))
    return host, path, best[1], best[2]


URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.com/en/7", "https://a.Example.COM/en/70?x=http://y", "http://xexample.com/en/7", "http://com/en/", "http://a.net/de/8", "http://example.net/de/81#q", "http://a.example.net/de/8/", "ftp://b.org/es/", "http://b.org?/es/", "http://b.org#/es/", "x://É.org/es/\n1", "http://b.org/es"]


def test_rules_and_verdicts(spark):
    r = random.Random(1)
    urls = URLS + [f"http://{r.choice(['a', 'b', 'www.c'])}.example.{r.choice(['com', 'net', 'org'])}/{r.choice(['en', 'de', 'es', 'fr'])}/{r.randint(1, 99)}" for _ in range(400)]
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, length int")
    out = url_filter.judge(df).collect()
    assert len(out) == len(urls)
    for x in out:
        host, path, rule, said = rules_by_hand(urls[x.page_id])
        assert (x.host, x.path, x.rule) == (host, path, rule) and x.verdict in ("block", "allow")
        assert said is None or x.verdict == said
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty).count() == 0
    one = url_filter.judge(spark.createDataFrame([(1, None), (1, None)], "page_id long, url string")).collect()
    assert [x.verdict for x in one] == ["allow", "allow"]


def test_rules_are_those_of_the_contract(spark):
    want = {
        "http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/71": ("example.com/en/7", "allow"), "http://a.net/de/1": ("net/de/", "allow"), "http://net/de/": ("net/de/", "allow"),
        "http://www.example.net/de/7": ("net/de/", "allow"), "http://www.example.net/de/8": ("example.net/de/8", "block"), "http://a.org/es/": ("org/es/", "block"),
    }
    out = url_filter.judge(spark.createDataFrame(list(enumerate(want)), "page_id long, url string")).collect()
    assert [(x.rule, x.verdict) for x in sorted(out, key=lambda x: x.page_id)] == list(want.values())


def test_trees_on_held_out_urls(spark):
    r = random.Random(2)

    def url(bad):
        host = r.choice(["cheap-pills", "win-big", "spam-farm"]) if r.random() < 0.3 and bad else r.choice(["news", "docs", "shop"])
        tail = "&".join(f"k{k}={r.randint(1, 9**9)}" for k in range(r.randint(2, 6))) if bad else ""
        return f"http://{host}{r.randint(1, 30)}.{r.choice(['info', 'biz'] if bad and r.random() < 0.7 else ['org', 'net'])}/{'/'.join(r.choices(['a', 'bc', 'de'], k=r.randint(1, 3)))}" + (f"?{tail}" if tail else "")

    rows = [(url(bad), float(bad)) for bad in [True, False] * 400]
    learn = spark.createDataFrame(rows[:600], "url string, label double")
    held = spark.createDataFrame(rows[600:], "url string, label double")
    host, path = url_filter.split_url(F.col("url"))
    out = url_filter.scored(held.select("url", "label", host.alias("host"), path.alias("path")), *url_filter.train(learn)).collect()
    assert sum((x.score >= 0.5) == bool(x.label) for x in out) >= 0.93 * len(out)


def test_gradient_and_normalisation():
    r = np.random.default_rng(0)
    ids = [r.integers(0, masked_lm.BUCKETS, n).astype(np.int32) for n in (9, 1, 0, 4)]
    words, around = masked_lm.contexts(ids)
    assert len(words) == 14 and list(around[0][:2]) == [masked_lm.BUCKETS] * 2 and (words[:9] == ids[0]).all()
    flat = masked_lm.initial().astype(np.float64) + r.normal(0, 0.05, len(masked_lm.initial()))
    g = masked_lm.gradient(masked_lm.unpack(flat), words, around)
    loss = lambda f: -masked_lm.log_probability(masked_lm.unpack(f), words, around).mean()
    for k in [*np.argsort(-np.abs(g))[:10], *r.integers(0, len(flat), 20)]:
        d = np.zeros(len(flat))
        d[k] = 1e-5
        assert abs((loss(flat + d) - loss(flat - d)) / 2e-5 - g[k]) < 1e-5
    every = np.arange(masked_lm.BUCKETS)
    total = np.exp(masked_lm.log_probability(masked_lm.unpack(flat), every, np.repeat(around[3:4], len(every), axis=0))).sum()
    assert abs(total - 1) < 1e-9


def test_scores_with_and_without_shift():
    """Small logits go without a shift before exp, large ones don't overflow."""
    r = np.random.Generator(np.random.PCG64(6))
    words, around = r.integers(0, masked_lm.BUCKETS, 50), r.integers(0, masked_lm.BUCKETS + 1, (50, 2 * masked_lm.SIDE))
    for factor, shifted in ((1, False), (200, True)):
        p = {k: v * np.float32(factor) if k in "cm" else v for k, v in masked_lm.unpack(masked_lm.initial()).items()}
        own = masked_lm.Scorer(p)
        assert all(x == shifted for x in own.shift)
        found = own(words, around)
        own.shift = [True, True]
        assert np.isfinite(found).all() and np.allclose(found, own(words, around), atol=1e-5)


def test_training_tells_prose_from_shuffled_words(spark):
    r = random.Random(6)
    nxt = {w: r.choices([f"w{k}" for k in range(50)], k=2) for w in [f"w{k}" for k in range(50)]}

    def prose(n):
        out = ["w0"]
        while len(out) < n:
            out.append(r.choice(nxt[out[-1]]))
        return out

    rows = [(i, " ".join(prose(200))) for i in range(400)]
    df = spark.createDataFrame([*rows, (900, None), (901, " "), (None, "w1")], "doc_id long, text string")
    flat = masked_lm.train(df)
    held = [prose(150) for _ in range(20)]
    tests = [(i, " ".join(x)) for i, x in enumerate(held)] + [(100 + i, " ".join(r.sample(x, len(x)))) for i, x in enumerate(held)]
    got = {x.doc_id: x.log_probability / x.n_words for x in masked_lm.scores(spark.createDataFrame(tests, "doc_id long, text string"), flat, ["doc_id"]).collect()}
    assert all(got[i] > got[100 + i] + 0.3 for i in range(20))
    assert np.mean([got[i] for i in range(20)]) > -np.log(50)
    # held out, the network beats the frequencies of single words
    counts = Counter(w for _, t in rows for w in t.split())
    alone = np.mean([np.log(counts[w] / counts.total()) for x in held for w in x])
    assert np.mean([got[i] for i in range(20)]) > alone + 0.5
    # and neither partitions nor the order of rows change it
    again = masked_lm.train(df.repartition(5))
    assert np.array_equal(again.flat, flat.flat)
    edge = {x.doc_id: tuple(x)[1:] for x in masked_lm.scores(df, flat, ["doc_id"]).collect()}
    assert edge[900] == edge[901] == (0, 0.0) and edge[None][0] == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert masked_lm.scores(empty, masked_lm.train(empty), ["doc_id"]).count() == 0


def test_vocabulary_grows_and_tells_rare_words_from_frequent(spark):
    top = {}
    for k in range(400):
        top.setdefault(int(masked_lm.word_symbols(f"r{k}")[0] >> np.uint64(54)), []).append(f"r{k}")
    often, rare, unseen = max(top.values(), key=len)[:3]  # alike in the hash
    filler = [f"f{k}" for k in range(masked_lm.OWN)]
    rows = [(i, " ".join(filler)) for i in range(60)] + [(100 + i, f"f1 {often} f2") for i in range(50)] + [(200, f"f1 {rare} f2"), (200, f"f1 {rare} f2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = masked_lm.train(df)
    tests = spark.createDataFrame([(i, f"f1 {w} f2") for i, w in enumerate((often, rare, unseen))], "doc_id long, text string")
    got = {x.doc_id: x.log_probability for x in masked_lm.scores(tests, model, ["doc_id"]).collect()}
    assert abs(got[0] - got[1] - np.log(51 / 3)) < 1e-3 and abs(got[1] - got[2] - np.log(3)) < 1e-3
    assert sorted(r.n for r in model.counts.collect()) == [2, 50] + [60] * (masked_lm.OWN - 2) + [112] * 2
    assert len({int(x) for x in masked_lm.Entries(model.frequent)(np.concatenate([masked_lm.symbols(w) for w in filler]))}) == len(filler)
    assert np.isclose(np.exp(model.norms).sum(), masked_lm.SHARED + 52 + 2)
