import random
from itertools import combinations

import numpy as np

from strandline.llm import simhash
from strandline.operators.graph import components


def corpus():
    r = random.Random(5)
    vocab = ["w%d" % i for i in range(400)]
    rows, i = [], 0
    for _ in range(60):
        own = r.choices(vocab, k=r.randint(1, 120))
        for _ in range(r.choice([1, 1, 2, 6])):
            copy = list(own)
            if r.random() < 0.7:
                copy[r.randrange(len(copy))] = "edit%d" % r.randrange(50)
            rows.append((i, (" " if r.random() < 0.5 else "\n").join(copy)))
            i += 1
    return rows + [(900, None), (901, ""), (902, " \t"), (903, "One Two"), (904, "one two"), (905, "ONE\x0btwo")]


def as_rows(df):
    return {r.doc_id: (f"{r.fp & (1 << 64) - 1:016x}", r.component) for r in df.collect()}


def test_against_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, fp string, component int")
    assert as_rows(simhash.near_duplicates(df)) == simhash.brute_force(rows)


def test_hot_slots_lose_no_link(spark):
    r = random.Random(9)
    centre, points = 0x123456789ABCDEF0, set()
    while len(points) < 150:
        x = centre
        for _ in range(r.randint(0, 5)):
            x ^= 1 << r.randrange(64)
        points.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in points]
    nodes = spark.createDataFrame(signed, "fp long")
    want = {frozenset((a, b)) for (a,) in signed for (b,) in signed if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    for hot, segments in ((3, None), (1000, None), (1000, simhash.DEEP), (3, simhash.DEEP)):
        got = {frozenset((e.a, e.b)) for e in simhash.links(nodes, hot, segments).collect()}
        assert hot == 3 or got == want
        roots = {}
        for pairs in (got, want):
            group = {a: a for (a,) in signed}
            root = lambda x, g=group: x if g[x] == x else root(g[x], g)
            for p in pairs:
                a, b = sorted(map(root, p))
                group[b] = a
            roots[id(pairs)] = {x: root(x) for x in group}
        assert roots[id(got)] == roots[id(want)]


def test_segments_grow():
    assert simhash.depth(1 << 24) == simhash.SHALLOW and simhash.depth((1 << 24) + 1) == simhash.DEEP
    for segments in (simhash.SHALLOW, simhash.DEEP):
        assert sum(size for _, size, *_ in segments) == 64
        assert sum(near + far + 1 for *_, near, far in segments) > simhash.BITS  # the pigeonhole bound


def test_components(spark):
    r = random.Random(3)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(r.randrange(40), r.randrange(40)) for _ in range(25)] + [(7, 7), (7, 7)]
    got = {x.node: x.root for x in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    group = {x: x for p in pairs for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(group[a], group[b])
            changed |= group[a] != low or group[b] != low
            group[a] = group[b] = low
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: group[x] for x in linked}


def test_one_of_each_group_and_edge_rows(spark):
    schema = "doc_id long, text string, lang string"
    text = " ".join("w%d" % i for i in range(50))
    rows = [(3, text, "a"), (2, text, "b"), (2, text, "b"), (None, text, "c"), (None, "alone here", "d"), (9, None, None)]
    kept = simhash.one_of_each_group(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(2, text, "b"), (None, "alone here", "d"), (9, None, None)], key=str)
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def jaccard(a, b, words=5):
    sets = [{tuple(x[i : i + words]) for i in range(max(1, len(x) - words + 1))} for x in (a.lower().split(), b.lower().split())]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_groups_of_similar_texts(spark):
    """Groups by five-word shingles: nearly all pairs of 0.86 or more fall into one group, and no text of a group is far from all others."""
    r = random.Random(12)
    vocab = ["w%d" % i for i in range(3000)]
    rows = []
    for g in range(40):
        base = r.choices(vocab, k=r.choice([60, 150, 400, 900]))
        for c in range(1 if g % 4 == 0 else r.choice([2, 3, 30])):
            copy = list(base)
            for _ in range(r.randint(0, max(1, len(copy) // 70)) if c else 0):
                copy[r.randrange(len(copy))] = "edit%d" % r.randrange(9999)
            rows.append((len(rows), " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {x.doc_id for x in simhash.one_of_each_group(df).collect()}
    text = dict(rows)
    near = {(a, b): jaccard(text[a], text[b]) for a in text for b in text if a < b and set(text[a].split()[:3]) & set(text[b].split()[:3])}
    high = [p for p, j in near.items() if j >= 0.86]
    assert len(high) > 500
    # of such a pair at most one stays, the smallest of its group; a text that goes has another that resembles it
    missed = [p for p in high if p[0] in kept and p[1] in kept]
    assert len(missed) <= 0.01 * len(high) and not [p for p in missed if near[p] >= 0.92]
    for i in set(text) - kept:
        assert max(j for p, j in near.items() if i in p) >= 0.8
    assert {i for i in text if not any(i in p for p, j in near.items() if j > 0.5)} <= kept


def nodes_of(spark, texts):
    sets = [simhash.shingles(t) for t in texts]
    return spark.createDataFrame([(k, simhash.wide_fingerprint(x).tolist(), simhash.minima(x).tolist()) for k, x in enumerate(sets)], "node long, f array<long>, h array<long>")


def edited(r, base, similarity):
    """base with single words replaced until the similarity of five-word shingles is as low."""
    copy = list(base)
    while jaccard(" ".join(base), " ".join(copy)) > similarity:
        copy[r.randrange(len(copy))] = f"edit{r.random()}"
    return copy


def test_pairs_at_the_limit_meet(spark):
    """Of pairs of similarity 0.80 to 0.85 nine in ten and more are compared. Nothing here depends on the size of the corpus."""
    r = random.Random(31)
    texts = []
    for k in range(300):
        base = [f"v{k}_{r.randrange(10**6)}" for _ in range(r.choice([200, 400]))]
        texts += [" ".join(base), " ".join(edited(r, base, 0.84))]
    wanted = [(i, i + 1) for i in range(0, 600, 2) if jaccard(texts[i], texts[i + 1]) >= 0.8]
    found = {(x.a, x.b) for x in simhash.similar(nodes_of(spark, texts), simhash.WIDE).collect()}
    assert len(wanted) > 250 and sum(p in found for p in wanted) >= 0.93 * len(wanted)
    assert all(b == a + 1 and a % 2 == 0 for a, b in found)  # texts that share no shingle never meet


def test_a_crowd_of_several_families(spark):
    """Families that share a long passage, and so slots, each come out whole, in small and in crowded slots."""
    r = random.Random(17)
    passage = [f"p{k}" for k in range(150)]
    rows = []
    for g in range(12):
        base = [*passage, *[f"g{g}_{k}" for k in range(110)]]
        for c in range(25):
            copy = list(base)
            for _ in range(3 if c else 0):
                copy[r.randrange(150, len(copy))] = f"edit{r.random()}"
            rows.append((g * 1000 + c, " ".join(copy)))
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id for x in simhash.one_of_each_group(df).collect()} == {g * 1000 for g in range(12)}
    texts = [t for _, t in rows]
    links = simhash.similar(nodes_of(spark, texts), simhash.bits_apart(0.8, 2.5), hot=4).collect()
    group = list(range(len(rows)))
    for _ in range(len(rows)):
        before = list(group)
        for x in links:
            group[x.a] = group[x.b] = min(group[x.a], group[x.b])
        if before == group:
            break
    assert len({(i // 1000, root) for (i, _), root in zip(rows, group, strict=True)}) == 12


def resembling(sets, limit=0.8):
    """The smallest key that links of similar sets reach from each."""
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(sorted(sets), 2):
        both = len(sets[i] & sets[j])
        if both >= limit * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((root(i), root(j)))
            group[b] = a
    return {i: root(i) for i in sets}


def test_a_crowd_loses_no_pair(spark):
    """Texts that share most of a passage crowd the same slots; those of them that resemble each other by 0.8 are found among all."""
    r = random.Random(41)
    passage = [f"p{k}" for k in range(200)]
    rows = []
    for g in range(100):
        own = [f"g{g}_{k}" for k in range(34)]
        rows.append((len(rows), " ".join(passage + own)))
        for k in (3, 12, 20, 28):
            own[k + r.randrange(3)] = f"edit{g}_{k}"
        rows.append((len(rows), " ".join(passage + own)))
    want = resembling({i: set(simhash.shingles(t).tolist()) for i, t in rows})
    assert len(set(want.values())) == 100
    kept = {x.doc_id for x in simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == set(want.values())


def test_joined_sets_against_all_pairs(spark):
    r = random.Random(43)
    sets = {0: set(), 1: {7}, 2: {7, 8}}
    for g in range(25):
        base = r.sample(range(400), r.choice([4, 5, 9, 40, 120]))
        for _ in range(r.randint(1, 5)):
            own = set(base)
            for _ in range(r.randint(0, len(base) // 6)):
                own.discard(r.choice(base))
                own |= {r.randrange(400)} if r.random() < 0.5 else set()
            sets[len(sets)] = own
    root = {i: 1000 + i % 17 if i % 3 else i for i in sets}
    rows = [(i, root[i], sorted(x)) for i, x in sets.items()]
    for limit in (0.8, 0.6):
        want = {(i, j) for i, j in combinations(sets, 2) if root[i] != root[j] and sets[i] and len(sets[i] & sets[j]) >= limit * len(sets[i] | sets[j])}
        found = simhash.joined(spark.createDataFrame(rows, "node long, root long, own array<int>"), limit).collect()
        assert len(want) > 20 and sorted((x.a, x.b) for x in found) == sorted(want)


def compared(monkeypatch):
    """Numbers of pairs whose sets are compared, in order of the calls."""
    seen, check = [], simhash.checked

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return check(pairs, *rest)

    monkeypatch.setattr(simhash, "checked", counted)
    return seen


def test_a_family_of_edited_copies_lists_few_pairs(spark, monkeypatch):
    """Copies of one text, each with edits of its own, share rare elements in all pairs; those too far apart aren't listed."""
    seen = compared(monkeypatch)
    for n in (100, 200):
        r = random.Random(n)
        base, sets = [r.randrange(-(2**31), 2**31) for _ in range(150)], []
        for k in range(n):
            near = sets[-1] if k % 10 == 1 else base
            sets.append(list(near))
            for at in r.sample(range(150), 8 if near is not base else 14):
                sets[-1][at] = r.randrange(-(2**31), 2**31)
        want = [(a, b) for a, b in combinations(range(n), 2) if len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]})]
        rows = spark.createDataFrame([(k, k, x) for k, x in enumerate(sets)], "node long, root long, own array<int>")
        assert sorted((x.a, x.b) for x in simhash.joined(rows, 0.8).collect()) == want and len(want) >= n // 10
    assert seen[0] < 0.1 * 100 * 99 / 2 and seen[1] < 0.1 * 200 * 199 / 2


def test_first_pairs_too_far_apart_are_not_compared_by_sets(spark, monkeypatch):
    r = random.Random(53)
    base, rows = [f"b{k}" for k in range(150)], []
    for i in range(120):
        own = list(base)
        for k in r.sample(range(150), r.choice([1, 3, 5])):
            own[k] = f"edit{i}_{k}"
        rows.append((i, " ".join(own)))
    sets = {i: set(simhash.shingles(t).tolist()) for i, t in rows}
    want = resembling(sets)
    seen = compared(monkeypatch)
    kept = {x.doc_id for x in simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    links = sum(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in combinations(sets, 2))
    assert kept == set(want.values()) and 1 < len(kept) < 120
    assert sum(seen) < 1.5 * links


def test_parities_bound_the_difference():
    r = np.random.Generator(np.random.PCG64(8))
    for n in (0, 1, 50, 900):
        own, other = (r.integers(0, 1 << 64, n, dtype=np.uint64) for _ in range(2))
        other = np.concatenate((own[: n // 2], other[n // 2 :]))
        a, b = (simhash.parity(x).view(np.uint64) for x in (own, other))
        assert int(np.bitwise_count(a ^ b).sum()) <= len({*own.tolist()} ^ {*other.tolist()})


def test_minima_of_copies_and_of_nothing():
    a, b = (simhash.minima(simhash.shingles(t)) for t in ("one two three four five six", "six five four three two one"))
    assert (a == simhash.minima(simhash.shingles("ONE two three\nfour five six"))).all() and (a != b).all()
    assert simhash.minima(simhash.shingles(None)).tolist() == [0] * simhash.MINIMA


def test_wide_distance_follows_similarity():
    r = random.Random(4)
    own = [f"w{i}" for i in range(2000)]
    apart = []
    for _ in range(20):
        other = list(own)
        for k in range(0, 2000, 45):
            other[k] = f"x{r.random()}"
        a, b = (simhash.wide_fingerprint(simhash.shingles(" ".join(x))) for x in (own, other))
        apart.append(int(np.bitwise_count((a ^ b).view(np.uint64)).sum()))
        assert abs(jaccard(" ".join(own), " ".join(other)) - 0.8) < 0.02
    assert abs(np.mean(apart) - simhash.WIDE * np.arccos(1.6 / 1.8) / np.pi) < 8 and np.mean(np.array(apart) <= simhash.bits_apart(0.8, 2.5)) > 0.9
