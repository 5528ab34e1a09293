"""Queries on joins by order and by truth, fuzzy keys, sequences and graphs."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import fuzzy as Z
from strandline.operators import graph as G
from strandline.operators import matching as M
from strandline.operators import variants as V
from strandline.operators.ordered import across
from strandline.plans.base import ITEMS, code, code_sql, items, query, table
from strandline.plans.sessions import bounded_sql


MONTH = 30 * 86400


@query("""WITH o AS (SELECT o_custkey AS k, o_orderdate::TIMESTAMP AS t, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL)
SELECT e.event_id, coalesce(o.o_orderkey, -1) AS o_orderkey FROM (SELECT event_id, user_id AS k, ts AS t FROM events) e ASOF LEFT JOIN o ON e.k = o.k AND e.t >= o.t""")
def last_order_before(spark, sf):
    left = table(spark, sf, "events").select(F.col("user_id").alias("k"), F.col("ts").cast("timestamp").alias("t"), "event_id")
    right = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("t"), "o_orderkey")
    return M.as_of(left, right, ["k"], "t", tile=MONTH).select("event_id", F.coalesce("o_orderkey", F.lit(-1)).alias("o_orderkey"))


@query("""WITH o AS (SELECT o_custkey AS k, o_orderdate::TIMESTAMP AS t, max(o_orderkey) AS o_orderkey FROM orders GROUP BY ALL)
SELECT a.o_orderkey, coalesce(b.o_orderkey, -1) AS next_order FROM (SELECT o_orderkey, o_custkey AS k, o_orderdate::TIMESTAMP AS t FROM orders) a ASOF LEFT JOIN o b ON a.k = b.k AND a.t < b.t""")
def next_order_after(spark, sf):
    own = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("t"), "o_orderkey")
    return M.as_of(own, own.withColumnRenamed("o_orderkey", "next_order"), ["k"], "t", forward=True, strict=True, tile=MONTH).select("o_orderkey", F.coalesce("next_order", F.lit(-1)).alias("next_order"))


@query("""WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), c AS (SELECT user_id AS k, count(*) AS n FROM events GROUP BY 1)
SELECT k, coalesce(a.n, 0) AS open_n, coalesce(b.n, 0) AS filled_n, coalesce(c.n, 0) AS seen_n, a.n IS NOT NULL AS in_open, b.n IS NOT NULL AS in_filled, c.n IS NOT NULL AS in_seen FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)""")
def three_way_merge(spark, sf):
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    of = lambda s: orders.filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    sides = {"open": of("O"), "filled": of("F"), "seen": events.groupBy(F.col("user_id").alias("k")).agg(F.count("*").alias("n"))}
    return M.outer_merge(sides, ["k"]).fillna(0, ["open_n", "filled_n", "seen_n"])


@query("WITH g AS (SELECT DISTINCT l_partkey AS g, l_suppkey AS i FROM lineitem) SELECT x.i AS a, y.i AS b, count(*) AS n FROM g x JOIN g y ON x.g = y.g AND x.i < y.i GROUP BY ALL HAVING count(*) >= 3")
def shared_parts(spark, sf):
    return M.pair_counts(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey", 3)


def _svs(spark, sf, flag):
    own = items(spark, sf).filter(F.col("flag") == flag)
    other = F.pmod(F.col("contig") * 7 + 3, F.lit(50))
    return own.select(F.col("id").alias("name"), (F.col("contig") % 50).alias("chrom1"), F.col("start").alias("start1"), (F.col("start") + 2).alias("stop1"), other.alias("chrom2"), F.col("end").alias("start2"), (F.col("end") + 2).alias("stop2"), F.col("price").alias("qual"), F.col("flag").alias("source"))


def _svs_sql(name: str, flag: str) -> str:
    return f'{name} AS (SELECT id AS name, contig % 50 AS chrom1, start AS start1, start + 2 AS stop1, (contig * 7 + 3) % 50 AS chrom2, "end" AS start2, "end" + 2 AS stop2, price AS qual FROM items WHERE flag = \'{flag}\')'


def _ordered(name: str, widen: int) -> str:
    first = "(chrom1, greatest(start1 - {w}, 0), stop1 + {w}) > (chrom2, greatest(start2 - {w}, 0), stop2 + {w})".format(w=widen)
    pick = lambda a, b: f"CASE WHEN {first} THEN {b} ELSE {a} END"
    one = lambda k: (f"chrom{k}", f"greatest(start{k} - {widen}, 0)", f"stop{k} + {widen}")
    columns = [f"{pick(x, y)} AS {c}1, {pick(y, x)} AS {c}2" for c, x, y in zip("cse", one(1), one(2), strict=True)]
    return f"(SELECT name, {', '.join(columns)} FROM {name})"


@query(f"WITH {ITEMS}, {_svs_sql('calls', 'R')}, {_svs_sql('truth', 'A')} SELECT DISTINCT x.name, y.name AS truth FROM {_ordered('calls', 2)} x JOIN {_ordered('truth', 0)} y ON x.c1 = y.c1 AND x.c2 = y.c2 AND x.s1 < y.e1 AND y.s1 < x.e1 AND x.s2 < y.e2 AND y.s2 < x.e2")
def breakpoint_matches(spark, sf):
    return M.breakpoint_matches(_svs(spark, sf, "R"), _svs(spark, sf, "A"), 2, 8)


@query(f"""WITH {ITEMS} SELECT a.id AS name, b.id AS truth, least(a."end", b."end") - greatest(a.start, b.start) AS overlap FROM items a JOIN items b ON a.flag = 'R' AND b.flag = 'A' AND a.contig = b.contig AND a.start < b."end" AND b.start < a."end"
WHERE (least(a."end", b."end") - greatest(a.start, b.start)) > 0.8 * (a."end" - a.start) AND (least(a."end", b."end") - greatest(a.start, b.start)) > 0.8 * (b."end" - b.start)""")
def reciprocal_matches(spark, sf):
    own = items(spark, sf).withColumnRenamed("id", "name")
    return M.reciprocal_matches(own.filter("flag = 'R'"), own.filter("flag = 'A'"), 0.8, 8)


@query("""WITH d AS (SELECT l.quality = 1 AS truth, d.n_chars > 600 AS said, d.lang, l.toxic, d.n_chars FROM labels l JOIN documents d USING (doc_id)), g AS (SELECT *, unnest(CASE WHEN lang = 'en' THEN ['any', 'english'] ELSE ['any'] END) AS language, unnest(CASE WHEN toxic = 1 THEN ['any', 'toxic'] ELSE ['any', 'clean'] END) AS kind FROM (SELECT *, 1 AS one FROM d))
SELECT language, kind, count(*) FILTER (truth AND said) AS tp, count(*) FILTER (NOT truth AND said) AS fp, count(*) FILTER (truth AND NOT said) AS fn, round(count(*) FILTER (truth AND said) / nullif(count(*) FILTER (truth), 0), 8) AS sensitivity, round(count(*) FILTER (truth AND said) / nullif(count(*) FILTER (said), 0), 8) AS ppv
FROM (SELECT d.*, a.language, b.kind FROM d, (VALUES ('any'), ('english')) a(language), (VALUES ('any'), ('toxic'), ('clean')) b(kind) WHERE (language = 'any' OR lang = 'en') AND (kind = 'any' OR (kind = 'toxic') = (toxic = 1))) GROUP BY ALL""")
def truth_metric_grid(spark, sf):
    own = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    own = own.select((F.col("quality") == 1).alias("truth"), (F.col("n_chars") > 600).alias("said"), "lang", "toxic")
    always = F.lit(True)
    grid = {"language": {"any": always, "english": F.col("lang") == "en"}, "kind": {"any": always, "toxic": F.col("toxic") == 1, "clean": F.col("toxic") == 0}}
    return M.metric_grid(own, grid, M.confusion(F.col("truth"), F.col("said"))).withColumns({c: F.round(c, 8) for c in ("sensitivity", "ppv")})


def _reads(spark, sf):
    allowed = table(spark, sf, "part").filter("p_partkey % 3 = 0").groupBy(code(F.col("p_partkey")).alias("key")).agg(F.count("*").cast("double").alias("prior"))
    raw = code(F.col("l_partkey"))
    place = F.col("l_linenumber") % 8 + 1
    wrong = F.concat(F.expr("substring(raw, 1, place - 1)"), F.translate(F.expr("substring(raw, place, 1)"), "ACGT", "CGTA"), F.expr("substring(raw, place + 1)"))
    own = table(spark, sf, "lineitem").select(((F.col("l_orderkey") * 1000000 + F.col("l_partkey")) * 10 + F.col("l_linenumber")).alias("id"), "l_suppkey", raw.alias("raw"), place.alias("place"))
    keyed = own.select("id", "l_suppkey", F.when(F.col("l_suppkey") % 4 == 0, wrong).otherwise(F.col("raw")).alias("key"), F.translate(F.substring(F.md5(F.concat(F.lit("q"), F.col("id").cast("string"))), 1, 8), "0123456789abcdef", "5678:;<=>?@ABCDE").alias("qual"))
    return keyed, allowed


READS = f"""allowed AS (SELECT {code_sql('p_partkey')} AS key, count(*)::DOUBLE AS prior FROM part WHERE p_partkey % 3 = 0 GROUP BY 1),
reads AS (SELECT id, s AS l_suppkey, CASE WHEN s % 4 = 0 THEN substr(raw, 1, place - 1) || translate(substr(raw, place, 1), 'ACGT', 'CGTA') || substr(raw, place + 1) ELSE raw END AS key, translate(substr(md5('q' || id::VARCHAR), 1, 8), '0123456789abcdef', '5678:;<=>?@ABCDE') AS qual
FROM (SELECT (l_orderkey * 1000000 + l_partkey) * 10 + l_linenumber AS id, l_suppkey AS s, {code_sql('l_partkey')} AS raw, l_linenumber % 8 + 1 AS place FROM lineitem))"""


@query(f"WITH {READS} SELECT ok, count(*) AS n FROM (SELECT r.key, a.key IS NOT NULL AS ok FROM reads r LEFT JOIN allowed a USING (key)) GROUP BY ok")
def allow_list_counts(spark, sf):
    reads, allowed = _reads(spark, sf)
    return Z.exact_or_bad(reads, allowed, "key").groupBy("ok").agg(F.count("*").alias("n"))


@query(f"""WITH {READS}, k AS (SELECT DISTINCT key, qual FROM reads), n AS (SELECT k.key, k.qual, p, substr(k.key, 1, p - 1) || b || substr(k.key, p + 1) AS t FROM k, range(1, 9) r(p), (VALUES ('A'), ('C'), ('G'), ('T')) v(b) WHERE substr(k.key, p, 1) <> b AND k.key NOT IN (SELECT key FROM allowed)),
w AS (SELECT n.key, n.qual, n.t, prior * pow(10.0, -least(ascii(substr(n.qual, p, 1)) - 33, 33.0) / 10) AS w FROM n JOIN allowed a ON n.t = a.key), m AS (SELECT key, qual, sum(w) AS s, max(w) AS m, arg_max(t, (w, t)) AS t FROM w GROUP BY ALL)
SELECT r.id, CASE WHEN a.key IS NOT NULL THEN r.key ELSE m.t END AS corrected FROM reads r LEFT JOIN allowed a USING (key) LEFT JOIN m ON m.key = r.key AND m.qual = r.qual AND m.m > 0.6 * m.s""")
def corrected_keys(spark, sf):
    reads, allowed = _reads(spark, sf)
    distinct = reads.select("key", "qual").distinct().withColumn("rid", F.concat("key", "qual"))
    fixed = Z.corrected(distinct, allowed, ["rid"], 0.6).select("key", "qual", "corrected")
    return reads.join(fixed, ["key", "qual"]).select("id", "corrected")


@query(f"WITH k AS (SELECT DISTINCT {code_sql('p_partkey', 10)} AS k FROM part) SELECT a.k AS a, b.k AS b, hamming(a.k, b.k)::INT AS distance FROM k a JOIN k b ON a.k < b.k AND hamming(a.k, b.k) <= 2")
def keys_within_two(spark, sf):
    return Z.pairs_within(table(spark, sf, "part").select(code(F.col("p_partkey"), 10).alias("k")), "k", 2)


@query(f"""WITH s AS (SELECT {code_sql('l_partkey', 20, 'k')} AS seq, l_suppkey AS src FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)), k AS (SELECT substr(seq, i, 6) AS kmer, src FROM s, range(1, 16) r(i))
SELECT kmer, count(*) AS n, count(DISTINCT src) AS sources FROM k GROUP BY kmer HAVING count(*) >= 20 AND count(DISTINCT src) >= 10""")
def supported_kmers(spark, sf):
    reads = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct().select(code(F.col("l_partkey"), 20, "k").alias("seq"), "l_suppkey")
    return Z.supported_kmers(reads, "seq", "l_suppkey", 6, 20, 10)


@query(f"SELECT least(k, reverse(translate(k, 'ACGT', 'TGCA'))) AS kmer, count(*) AS n FROM (SELECT substr(s, i, 5) AS k FROM (SELECT {code_sql('p_partkey', 24)} AS s FROM part), range(1, 21) r(i)) GROUP BY 1")
def canonical_kmers(spark, sf):
    own = table(spark, sf, "part").select(F.explode(Z.kmers(code(F.col("p_partkey"), 24), 5)).alias("k"))
    return own.groupBy(Z.canonical(F.col("k")).alias("kmer")).agg(F.count("*").alias("n"))


@query()
def super_kmers(spark, sf):
    own = table(spark, sf, "part").select("p_partkey", F.posexplode(Z.super_kmers(code(F.col("p_partkey"), 32), 11, 5)).alias("n", "s"))
    return own.select("p_partkey", "n", "s.start", "s.length", "s.minimizer")


@query()
def minhash_pairs(spark, sf):
    own = table(spark, sf, "orders").join(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey"), "o_orderkey")
    sets = own.groupBy("o_custkey").agg(F.collect_set("l_suppkey").alias("items"))
    return Z.minhash_candidates(sets, "o_custkey", "items", 24, 3).withColumn("estimate", F.round("estimate", 6))


@query("""WITH s AS (SELECT l_orderkey AS k, list_distinct(list(l_suppkey)) AS v FROM lineitem GROUP BY 1), p AS (SELECT k, v, lead(v) OVER (ORDER BY k) AS w FROM s)
SELECT k, round(len(list_intersect(v, w)) / len(list_distinct(list_concat(v, w))), 8) AS similarity FROM p WHERE w IS NOT NULL""")
def set_similarity(spark, sf):
    own = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_set("l_suppkey").alias("v"))
    pairs = across(own, [], ["k"], {"w": ("lead", F.col("v"))}, 1 << 16)
    return pairs.filter("w is not null").select("k", F.round(Z.jaccard(F.col("v"), F.col("w")), 8).alias("similarity"))


EDGES = "e AS (SELECT DISTINCT least(o_custkey, s) AS a, greatest(o_custkey, s) AS b FROM (SELECT o_custkey, (o_custkey * 7 + 13) % 1500 AS s FROM orders) WHERE o_custkey <> s)"


@query(f"WITH RECURSIVE {EDGES}, u AS (SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e), r AS (SELECT x AS node, x AS root FROM u UNION SELECT u.y, r.root FROM r JOIN u ON r.node = u.x) SELECT node, min(root) AS root FROM r GROUP BY node")
def linked_customers(spark, sf):
    own = table(spark, sf, "orders").select(F.col("o_custkey").alias("a"), ((F.col("o_custkey") * 7 + 13) % 1500).alias("b"))
    return G.components(own)


@query("WITH e AS (SELECT user_id, event_id, row_number() OVER w - 1 AS place, first_value(event_id) OVER w AS path, count(*) OVER (PARTITION BY user_id) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) SELECT event_id AS node, path, place FROM e WHERE n > 1")
def event_paths(spark, sf):
    from pyspark.sql import Window as W

    own = table(spark, sf, "events").select(F.col("event_id").alias("a"), F.lead("event_id").over(W.partitionBy("user_id").orderBy("event_id")).alias("b"))
    return G.compressed_paths(own.filter("b is not null"))


def _ends_sql(k: int) -> str:
    return bounded_sql(f"c{k}", f"SELECT DISTINCT chrom{k} AS contig, start{k} AS s, stop{k} AS e FROM calls", 1, 40)


@query(f"""WITH RECURSIVE {ITEMS}, calls AS (SELECT *, 'R' AS source FROM ({_svs_sql("x", "R")[6:-1]}) UNION ALL SELECT *, 'A' FROM ({_svs_sql("x", "A")[6:-1]})), {_ends_sql(1)}, {_ends_sql(2)},
g AS (SELECT calls.*, x.g AS g1, y.g AS g2 FROM calls JOIN c1_o p ON p.contig = chrom1 AND p.s = start1 AND p.e = stop1 JOIN c1 x ON x.contig = p.contig AND x.k = p.k JOIN c2_o q ON q.contig = chrom2 AND q.s = start2 AND q.e = stop2 JOIN c2 y ON y.contig = q.contig AND y.k = q.k)
SELECT * EXCLUDE (source, g1, g2), count(*) OVER w AS n, CASE WHEN count(*) FILTER (source = 'A') OVER w > 0 AND count(*) FILTER (source = 'R') OVER w > 0 THEN 'A,R' ELSE source END AS sources FROM g WINDOW w AS (PARTITION BY chrom1, g1, chrom2, g2) QUALIFY row_number() OVER (PARTITION BY chrom1, g1, chrom2, g2 ORDER BY qual DESC, start1, start2, name) = 1""")
def best_of_break_clusters(spark, sf):
    calls = _svs(spark, sf, "R").unionByName(_svs(spark, sf, "A"))
    return V.best_calls(calls, 1, 40).withColumn("sources", F.array_join("sources", ","))


@query(f"""WITH RECURSIVE {ITEMS}, c AS (SELECT id AS name, contig, start, "end" AS e, price AS qual FROM items), l AS (SELECT DISTINCT a.name AS a, b.name AS b FROM c a JOIN c b ON a.contig = b.contig AND a.start < b.e AND b.start < a.e AND a.name < b.name
WHERE least(a.e, b.e) - greatest(a.start, b.start) > 0.8 * (a.e - a.start) AND least(a.e, b.e) - greatest(a.start, b.start) > 0.8 * (b.e - b.start)), u AS (SELECT a AS x, b AS y FROM l UNION SELECT b, a FROM l), r AS (SELECT x AS node, x AS root FROM u UNION SELECT u.y, least(r.root, u.y) FROM r JOIN u ON r.node = u.x),
g AS (SELECT c.*, coalesce(t.root, c.name) AS root FROM c LEFT JOIN (SELECT node, min(root) AS root FROM r GROUP BY node) t ON t.node = c.name)
SELECT root, name, contig, start, e AS "end", qual FROM g QUALIFY row_number() OVER (PARTITION BY root ORDER BY -qual, start, name) = 1""")
def overlap_groups(spark, sf):
    calls = items(spark, sf).select(F.col("id").alias("name"), "contig", "start", "end", F.col("price").alias("qual"))
    return V.selected(V.overlap_groups(calls, 0.8, 8), "quality")


@query(f"""WITH {ITEMS}, b AS (SELECT DISTINCT contig, (start // 60) * 60 AS start FROM items), f AS (SELECT id AS m, contig, start, "end" AS e, CASE flag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 0 END AS hp FROM items)
SELECT b.contig, b.start, count(DISTINCT m) AS n, count(DISTINCT CASE WHEN hp = 1 THEN m END) AS n1, count(DISTINCT CASE WHEN hp = 2 THEN m END) AS n2 FROM b LEFT JOIN f ON b.contig = f.contig AND f.start < b.start + 60 AND b.start < f.e GROUP BY ALL""")
def molecules_per_bin(spark, sf):
    own = items(spark, sf)
    bins = own.select("contig", (F.floor(F.col("start") / 60) * 60).alias("start")).distinct().withColumn("end", F.col("start") + 60)
    hp = F.when(F.col("flag") == "R", 1).when(F.col("flag") == "A", 2).otherwise(0)
    return V.molecule_counts(own.select("contig", "start", "end", F.col("id").alias("molecule"), hp.alias("hp")), bins, 64).drop("end")


@query(f"WITH {ITEMS}, b AS (SELECT contig, start // 60 AS bin, count(*) AS n FROM items GROUP BY ALL) SELECT contig, bin, n, n < 0.8 * avg(n) OVER (PARTITION BY contig) AS low FROM b")
def low_depth_bins(spark, sf):
    bins = items(spark, sf).groupBy("contig", F.floor(F.col("start") / 60).alias("bin")).agg(F.count("*").alias("n"))
    return V.low_bins(bins, ["contig"], "n")


@query(f"WITH {ITEMS} SELECT id, row_number() OVER (PARTITION BY contig, start, flag ORDER BY price DESC, id) > 1 AS duplicate FROM items")
def marked_duplicates(spark, sf):
    return V.duplicates(items(spark, sf), ["contig", "start", "flag"], [F.desc("price"), "id"]).select("id", "duplicate")
