"""Queries on ordered models; their groups are suppliers, users or customers. Spark streams have their twins here too."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import models as M
from strandline.operators import support as U
from strandline.operators import variants as V
from strandline.plans.base import ITEMS, chain_sql, code, code_sql, counts_sql, items, query, table
from strandline.streaming import windows as S


BINS = f"WITH RECURSIVE {ITEMS}, bins AS (SELECT contig, start // 30 AS bin, count(*) AS n FROM items GROUP BY ALL)"
STAY = "CASE WHEN a = b THEN ln(1 - {stay}) ELSE ln({change}) END"


@query(f"""{BINS}, {chain_sql("SELECT contig AS g, bin AS s, n AS c, " + counts_sql("n", "3.5", 6, 1.1) + " AS e FROM bins", 6, "[-ln(6), -ln(6), -ln(6), -ln(6), -ln(6), -ln(6)]", STAY.format(stay="0.001", change="0.001 / 5"), True)}
SELECT o.g AS contig, o.s AS bin, o.c AS n, p.state, round(q.p[p.state + 1], 6) AS confidence FROM c_o o JOIN c_p p USING (g, k) JOIN c_q q USING (g, k)""")
def copy_number_states(spark, sf):
    bins = items(spark, sf).groupBy("contig", F.floor(F.col("start") / 30).alias("bin")).agg(F.count("*").alias("n"))
    return M.copy_numbers(bins, ["contig"], ["bin"], "n", 3.5, tile=32).withColumn("confidence", F.round("confidence", 6))


AS_READ = 3


def _as_read_sql() -> str:
    """AS_READ rounds of decoding, each with the ploidy of the one before."""
    out, ploidy = [], "2.0"
    for k in range(1, AS_READ + 1):
        per_copy = f"((SELECT sum(v) / count(*) FROM shares) / {ploidy})"
        chain = chain_sql(f"SELECT contig AS g, bin AS s, v AS c, list_transform({counts_sql('floor(v + 0.5)', f'm{k}.m', 6, 1.1)}, lambda x: greatest(x, ln(1e-300))) AS e FROM shares, m{k}", 6, "[0, 0, 0, 0, 0, 0]", STAY.format(stay="5 * 0.001", change="0.001"))
        out += [f"m{k} AS MATERIALIZED (SELECT {per_copy} AS m)", chain.replace("c_", f"c{k}_"), f"f{k} AS MATERIALIZED (SELECT avg(state) AS p FROM c{k}_p WHERE state < 5)"]
        ploidy = f"(SELECT p FROM f{k})"
    return ", ".join(out)


@query(f"""WITH RECURSIVE {ITEMS}, shares AS MATERIALIZED (SELECT contig, b AS bin, sum(price / 10000 * (least("end", (b + 1) * 30) - greatest(start, b * 30)) / ("end" - start)) AS v FROM (SELECT *, unnest(range(start // 30, ("end" - 1) // 30 + 1)) AS b FROM items WHERE start < "end") GROUP BY ALL), {_as_read_sql()}
SELECT o.g AS contig, o.s AS bin, p.state, round(f{AS_READ}.p, 6) AS ploidy FROM c{AS_READ}_o o JOIN c{AS_READ}_p p USING (g, k), f{AS_READ}""")
def fractional_copy_numbers(spark, sf):
    """Copy numbers from the shares of intervals that fall into bins, with the ploidy estimated anew each round."""
    own = items(spark, sf).withColumn("v", F.col("price") / 10000)
    out, fit = M.copy_numbers_as_read(U.bin_shares(own, ["contig"], 30, "v"), ["contig"], ["bin"], "v", rounds=AS_READ, tile=32)
    return out.select("contig", "bin", "state").crossJoin(fit.select(F.round("ploidy", 6).alias("ploidy")))  # one row


@query(f"""WITH RECURSIVE {ITEMS}, bins AS (SELECT contig, start // 60 AS bin, count(*) FILTER (flag = 'R') AS r, count(*) FILTER (flag = 'A') AS a FROM items GROUP BY ALL),
{chain_sql("SELECT contig AS g, bin AS s, r, a AS o, [greatest(r, a) * ln(0.65) + least(r, a) * ln(1 - 0.65), greatest(r, a) * ln(0.9) + least(r, a) * ln(1 - 0.9)] AS e FROM bins", 2, "[ln(0.5), ln(0.5)]", STAY.format(stay="0.01", change="0.01"))}
SELECT o.g AS contig, o.s AS bin, o.r, o.o AS a, p.state = 1 AS deleted FROM c_o o JOIN c_p p USING (g, k)""")
def haplotype_deletions(spark, sf):
    n = lambda f: F.count(F.when(F.col("flag") == f, 1)).alias(f.lower())
    bins = items(spark, sf).groupBy("contig", F.floor(F.col("start") / 60).alias("bin")).agg(n("R"), n("A"))
    return M.deletions(bins, ["contig"], ["bin"], "r", "a", tile=32)


@query(f"""WITH RECURSIVE {chain_sql("SELECT user_id AS g, event_id AS s, CASE WHEN value > 50 THEN 1 ELSE 0 END AS parity, CASE WHEN value > 50 THEN [-1.0::DOUBLE, 0] ELSE [0.0::DOUBLE, -1] END AS e FROM events", 2, "[0, 0]", "CASE WHEN a = b THEN 0 ELSE -5 END")}
SELECT o.g AS user_id, o.s AS event_id, o.parity, o.parity <> p.state AS short_switch, coalesce(p.state <> lag(p.state) OVER (PARTITION BY o.g ORDER BY o.k), false) AS long_switch FROM c_o o JOIN c_p p USING (g, k)""")
def phase_switches(spark, sf):
    own = table(spark, sf, "events").select("user_id", "event_id", (F.col("value") > 50).cast("int").alias("parity"))
    return M.phase_switches(own, ["user_id"], ["event_id"], "parity", tile=1 << 16)


_BIT = lambda x, k: f"((({x} - 1) >> {k}) & 1)"
_TRIO_E = f"list_transform(range(1, 9), lambda b: -(p1[{_BIT('b', 2)} + 1] <> ch[{_BIT('b', 0)} + 1])::INT::DOUBLE - (p2[{_BIT('b', 1)} + 1] <> ch[2 - {_BIT('b', 0)}])::INT)"
_TRIO_T = "-25 * (" + " + ".join(f"({_BIT('a', k)} <> {_BIT('b', k)})::INT * o.same{k}" for k in range(3)) + ")"
_LETTERS = lambda a, b: f"[{code_sql('l_partkey', 1, a)}, {code_sql('l_partkey', 1, b)}]"
_SETS = ", ".join(f"CASE WHEN l_linenumber % {m} <> 0 THEN l_orderkey // 500 END AS set{k}" for k, m in ((2, 3), (1, 4), (0, 5)))


@query(f"""WITH RECURSIVE t AS (SELECT l_suppkey, (l_orderkey * 1000000 + l_partkey) * 10 + l_linenumber AS id, {_LETTERS("a", "b")} AS p1, {_LETTERS("c", "d")} AS p2, {_LETTERS("a", "c")} AS ch, {_SETS} FROM lineitem),
{chain_sql("SELECT l_suppkey AS g, id AS s, p1, p2, ch, " + ", ".join(f"coalesce(set{k} = lag(set{k}) OVER (PARTITION BY l_suppkey ORDER BY id), false)::INT AS same{k}" for k in range(3)) + f", {_TRIO_E} AS e FROM t", 8, "[0, 0, 0, 0, 0, 0, 0, 0]", _TRIO_T)},
v AS (SELECT *, list_distinct(list_intersect(p1, ch)) AS one, list_distinct(list_intersect(p2, ch)) AS two FROM c_o)
SELECT o.g AS l_suppkey, o.s AS id, p.state, len(one) = 0 OR len(two) = 0 OR (len(list_intersect(one, two)) = 1 AND list_sort(one) = list_sort(two) AND len(list_distinct(ch)) = 2) AS violation FROM v o JOIN c_p p USING (g, k)""")
def trio_states(spark, sf):
    pick = lambda a, b: F.array(code(F.col("l_partkey"), 1, a), code(F.col("l_partkey"), 1, b))
    phase = lambda m: F.when(F.col("l_linenumber") % m != 0, F.floor(F.col("l_orderkey") / 500))
    own = table(spark, sf, "lineitem").select("l_suppkey", ((F.col("l_orderkey") * 1000000 + F.col("l_partkey")) * 10 + F.col("l_linenumber")).alias("id"), pick("a", "b").alias("p1"), pick("c", "d").alias("p2"), pick("a", "c").alias("ch"), phase(3).alias("p1_set"), phase(4).alias("p2_set"), phase(5).alias("ch_set"))
    return M.trio_states(own, ["l_suppkey"], ["id"], tile=1 << 36, keep=[]).select("l_suppkey", "id", "state", "violation")


@query("""WITH c AS (SELECT l_orderkey, ln(CASE WHEN l_suppkey % 3 = 0 THEN 0.05 ELSE 0.95 END) AS a, ln(CASE WHEN l_suppkey % 3 = 0 THEN 0.95 ELSE 0.05 END) AS b, ln(0.5) AS m FROM lineitem), s AS (SELECT l_orderkey, sum(a) + ln(0.99 / 2) AS a, sum(b) + ln(0.99 / 2) AS b, sum(m) + ln(0.01) AS m FROM c GROUP BY 1)
SELECT l_orderkey, round(exp(a) / (exp(a) + exp(b) + exp(m)), 6) AS h0, round(exp(b) / (exp(a) + exp(b) + exp(m)), 6) AS h1, round(exp(m) / (exp(a) + exp(b) + exp(m)), 6) AS hmix FROM s""")
def haplotype_posteriors(spark, sf):
    p = F.when(F.col("l_suppkey") % 3 == 0, 0.05).otherwise(0.95)
    calls = table(spark, sf, "lineitem").select("l_orderkey", F.ln(p).alias("hap0"), F.ln(1 - p).alias("hap1"), F.ln(F.lit(0.5)).alias("mix"))
    return M.haplotype_posterior(calls, ["l_orderkey"]).select("l_orderkey", *[F.round(c, 6).alias(c) for c in ("h0", "h1", "hmix")])


@query("""WITH c AS (SELECT l_partkey, count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'O') AS h00, count(*) FILTER (l_returnflag <> 'R' AND l_linestatus <> 'O') AS h11, count(*) FILTER (l_returnflag = 'R' AND l_linestatus <> 'O') AS h01, count(*) FILTER (l_returnflag <> 'R' AND l_linestatus = 'O') AS h10 FROM lineitem GROUP BY 1)
SELECT l_partkey, round(greatest((h00 + h11) * log10(0.999) + (h01 + h10) * log10(0.001), (h01 + h10) * log10(0.999) + (h00 + h11) * log10(0.001)) - (h00 + h11 + h01 + h10) * log10(0.5), 6) AS score FROM c""")
def haplotype_support(spark, sf):
    a, h = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    n = lambda c: F.count(F.when(c, 1))
    own = table(spark, sf, "lineitem").groupBy("l_partkey").agg(n(a & h).alias("h00"), n(~a & ~h).alias("h11"), n(a & ~h).alias("h01"), n(~a & h).alias("h10"))
    return own.select("l_partkey", F.round(M.support_score(F.col("h00"), F.col("h11"), F.col("h01"), F.col("h10")), 6).alias("score"))


def _rounds(n: int) -> str:
    """Tables s0 .. sn of shares, round by round."""
    one = "avg(1 / (1 + exp(least(b - a, 700)) * (1 - share) / share))"
    step = "s{k} AS (SELECT g, CASE WHEN abs(new - share) > 1e-4 THEN least(greatest(new, 1e-9), 1 - 1e-9) ELSE share END AS share, abs(new - share) <= 1e-4 AS settled FROM (SELECT r.g, {one} AS new, any_value(share) AS share FROM r JOIN s{p} USING (g) GROUP BY r.g))"
    return ", ".join(step.format(k=k, p=k - 1, one=one.replace("share", "s%d.share" % (k - 1))) for k in range(1, n + 1)).replace("any_value(share)", "any_value(share)")


@query(f"WITH r AS (SELECT l_suppkey AS g, -pow((x - 900) / 200, 2) / 2 AS a, -pow((x - 1500) / 200, 2) / 2 AS b FROM (SELECT l_suppkey, l_extendedprice / l_quantity AS x FROM lineitem)), s0 AS (SELECT DISTINCT g, 0.5::DOUBLE AS share FROM r), {_rounds(5)} SELECT g AS l_suppkey, round(share, 6) AS share, settled FROM s5")
def mixture_shares(spark, sf):
    x = F.col("l_extendedprice") / F.col("l_quantity")
    own = table(spark, sf, "lineitem").select("l_suppkey", (-F.pow((x - 900) / 200, 2) / 2).alias("a"), (-F.pow((x - 1500) / 200, 2) / 2).alias("b"))
    return M.expectation(own, ["l_suppkey"], "a", "b").withColumn("share", F.round("share", 6))


@query()
def allele_alignments(spark, sf):
    own = table(spark, sf, "part").select("p_partkey", F.concat(code(F.col("p_partkey"), 10), code(F.col("p_size"), 12, "x")).alias("seq"), F.transform(F.sequence(F.lit(1), F.lit(3)), lambda k: F.translate(F.substring(F.md5(F.concat(F.lit("x"), (F.col("p_size") + k - 1).cast("string"))), 1, 12), "0123456789abcdef", "ACGTACGTACGTACGT")).alias("alleles"))
    return M.best_allele(own, ["p_partkey"], "seq", "alleles").select("p_partkey", F.coalesce("allele", F.lit(-1)).alias("allele"), "score", "margin")


@query(f"""WITH {ITEMS}, f AS (SELECT contig AS key, id // 10000000 % 4 AS contig, min(start) AS start, max(start) + 1 AS "end", id // 10000000 % 4 AS ps, CASE WHEN contig % 2 = 0 THEN 0.999 ELSE 0.5 END AS h0 FROM items WHERE flag = 'R' GROUP BY ALL)
SELECT i.id, coalesce(f.ps, -1) AS ps, coalesce(CASE WHEN f.h0 > 0.995 THEN 1 END, 0) AS hp FROM items i LEFT JOIN f ON i.contig = f.key AND i.id // 10000000 % 4 = f.contig AND i.start >= f.start AND i.start < f."end\"""")
def attached_phasing(spark, sf):
    own = items(spark, sf).select("id", F.col("contig").alias("key"), F.col("start").alias("pos"), (F.expr("id div 10000000") % 4).alias("contig"), "flag")
    frags = own.filter("flag = 'R'").groupBy("key", "contig").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"))
    frags = frags.select("*", F.col("contig").alias("ps"), F.col("start").alias("ps_start"), F.col("end").alias("ps_end"), F.when(F.col("key") % 2 == 0, 0.999).otherwise(0.5).alias("h0"), F.lit(0.0).alias("h1"))
    out = V.attached(own.drop("flag"), frags)
    return out.select("id", F.coalesce("ps", F.lit(-1)).alias("ps"), F.coalesce("hp", F.lit(0)).alias("hp"))


EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


#: All files in one trigger: the watermark moves after it, so no row of a later file is late.
EVERY = (1 << 31) - 1


def _stream(spark, sf, files=1):
    return S.events(spark, f"{sf}/events.parquet", EVENT_SCHEMA, files).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


def _place(spark, name):
    """A new folder for a stream's state and result, in the shared folder that the cluster names."""
    import uuid

    from strandline.lineage import shared_folder

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT event_type, epoch(d)::BIGINT AS start, count(*) AS n FROM (SELECT event_type, date_trunc('day', ts) AS d FROM events) WHERE d + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events) GROUP BY event_type, d")
def stream_daily_counts(spark, sf):
    own = S.counts(_stream(spark, sf, EVERY), "ts", ["event_type"], "1 day")
    at = _place(spark, "daily")
    return S.collected(own, f"{at}/rows", f"{at}/state").select("event_type", F.unix_seconds("start").alias("start"), "n")


@query("""WITH s AS (SELECT user_id, ts, sum(CASE WHEN ts - p <= INTERVAL 6 HOUR THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events))
SELECT user_id, epoch(date_trunc('second', min(ts)))::BIGINT AS start, epoch(date_trunc('second', max(ts)))::BIGINT AS last, count(*) AS n FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_sessions(spark, sf):
    at = _place(spark, "sessions")
    own = S.sessions(_stream(spark, sf, EVERY), "ts", ["user_id"], "6 hours")
    return S.collected(own, f"{at}/rows", f"{at}/state").select("user_id", F.unix_seconds("start").alias("start"), F.unix_seconds("last").alias("last"), "n")


@query("SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1")
def stream_distinct(spark, sf):
    at = _place(spark, "distinct")
    own = S.distinct(_stream(spark, sf).select("user_id", "event_type", "ts"), "ts", ["user_id", "event_type"], "3650 days")
    return S.collected(own, f"{at}/rows", f"{at}/state").groupBy("event_type").agg(F.count("*").alias("users"))


@query("SELECT a.event_id AS seen, b.event_id AS bought FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 12 HOUR WHERE a.event_type = 'view' AND b.event_type = 'purchase'")
def stream_pairs(spark, sf):
    """Two streams read side by side, rows of one key paired as they come."""
    at = _place(spark, "pairs")
    side = lambda kind, name, time: _stream(spark, sf, EVERY).filter(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(name), F.col("ts").alias(time))
    own = S.paired(side("view", "seen", "seen_at"), side("purchase", "bought", "bought_at"), ["user_id"], "seen_at", "bought_at", "12 hours")
    return S.collected(own.select("seen", "bought"), f"{at}/rows", f"{at}/state")


@query("SELECT user_id, event_id AS place, false AS late FROM events")
def stream_ordered_flush(spark, sf):
    at = _place(spark, "flush")
    own = S.flushed(_stream(spark, sf).select("ts", "user_id", F.col("event_id").alias("place")), "ts", "user_id", "place", 300, 3000)
    return S.collected(own, f"{at}/rows", f"{at}/state")
