"""Queries on neighbouring rows: sessions, molecules, islands, runs, clusters, sliding windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import sessions as S
from strandline.operators.ordered import across
from strandline.plans.base import ITEMS, greedy_sql, items, query, table

GAP, WEEK, YEAR = 6 * 3600, 7 * 86400, 366


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.unix_seconds(F.col("ts").cast("timestamp")).alias("pos"))


EVENTS = "e AS (SELECT event_id, user_id, event_type, value, epoch(ts)::BIGINT AS pos FROM (SELECT *, date_trunc('second', ts) AS t FROM events))".replace("epoch(ts)", "epoch(t)")
NUMBERED = f"{EVENTS}, s AS (SELECT *, sum(CASE WHEN pos - prev <= {GAP} THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY pos, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (SELECT *, lag(pos) OVER (PARTITION BY user_id ORDER BY pos, event_id) AS prev FROM e))"


@query(f"WITH {NUMBERED} SELECT user_id, session::BIGINT AS session, min(pos) AS start, max(pos) AS \"end\", count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, session")
def session_molecules(spark, sf):
    own = S.gap_sessions(_events(spark, sf), ["user_id"], "pos", GAP, ties=["event_id"], tile=WEEK)
    return own.groupBy("user_id", "session").agg(F.min("pos").alias("start"), F.max("pos").alias("end"), F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query(f"""WITH {NUMBERED}, g AS (SELECT *, min(CASE WHEN value >= 60 THEN pos END) OVER w AS a, max(CASE WHEN value >= 60 THEN pos END) OVER w AS z FROM s WINDOW w AS (PARTITION BY user_id, session))
SELECT user_id, min(pos) AS start, max(pos) AS "end", count(*) AS n, CASE WHEN count(*) > 1 THEN round((max(pos) - min(pos)) * (count(*) + 1) / (count(*) - 1), 4) END AS length FROM g WHERE pos BETWEEN a AND z GROUP BY user_id, session""")
def trimmed_molecules(spark, sf):
    own = S.molecules(_events(spark, sf), ["user_id"], "pos", GAP, "value", 60, WEEK)
    return own.withColumn("length", F.round(S.estimated_length(F.col("end") - F.col("start"), F.col("n")), 4))


def _chains(reach: str, window: int) -> str:
    return f"""WITH {ITEMS}, r AS (SELECT *, {reach} AS reach FROM items), c AS (
SELECT *, sum(CASE WHEN start > reach + {window} OR reach IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY contig ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS k FROM r)"""


FURTHEST = 'max("end") OVER (PARTITION BY contig ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)'


@query(_chains(FURTHEST, 2) + ' SELECT contig, k::BIGINT AS fragment, min(start) AS start, max("end") AS "end", count(*) AS n FROM c GROUP BY contig, k')
def end_gap_fragments(spark, sf):
    return S.end_gap_fragments(items(spark, sf), ["contig"], 2, tile=YEAR)


@query(_chains('lag("end") OVER (PARTITION BY contig ORDER BY start, "end")', 2) + ' SELECT contig, k::BIGINT AS fragment, min(start) AS start, max("end") FILTER (start = s AND "end" = z) AS "end", count(*) AS n FROM (SELECT *, max(start) OVER (PARTITION BY contig, k) AS s, last_value("end") OVER (PARTITION BY contig, k ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS z FROM c) GROUP BY contig, k')
def end_gap_fragments_last(spark, sf):
    return S.end_gap_fragments(items(spark, sf), ["contig"], 2, compat=True, tile=YEAR)


@query(_chains(FURTHEST, 5) + " SELECT contig, k::BIGINT AS cluster, count(*) AS n, min(id) AS first_id FROM c GROUP BY contig, k")
def gap_clusters(spark, sf):
    return S.clusters(items(spark, sf), ["contig"], 5, tile=YEAR).groupBy("contig", "cluster").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


BOUNDED = dict(joins="o.s - r.reach <= {w} AND greatest(o.e, r.reach) - r.a <= {most}", carry="r.a ; greatest(o.e, r.reach)", first="o.s AS a, o.e AS reach")


def bounded_sql(name: str, rows: str, window: int, most: int) -> str:
    return greedy_sql(name, rows, BOUNDED["joins"].format(w=window, most=most), BOUNDED["carry"], BOUNDED["first"])


@query(f'WITH RECURSIVE {ITEMS}, {bounded_sql("c", "SELECT contig, start AS s, \"end\" AS e FROM items", 5, 120)} SELECT contig, g::BIGINT AS cluster, count(*) AS n, min(s) AS start, max(e) AS "end" FROM c JOIN c_o USING (contig, k) GROUP BY contig, g')
def bounded_clusters(spark, sf):
    return S.clusters(items(spark, sf), ["contig"], 5, most=120, tile=YEAR).groupBy("contig", "cluster").agg(F.count("*").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"))


@query(f"WITH {ITEMS}, d AS (SELECT contig, start, start - row_number() OVER (PARTITION BY contig ORDER BY start) AS k FROM (SELECT DISTINCT contig, start FROM items)) SELECT contig, min(start) AS start, max(start) + 1 AS \"end\", count(*) AS n FROM d GROUP BY contig, k")
def day_islands(spark, sf):
    return S.islands(items(spark, sf), ["contig"], "start", YEAR)


@query(f"WITH {EVENTS}, r AS (SELECT *, sum(CASE WHEN event_type IS NOT DISTINCT FROM p AND k > 1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY pos, event_id ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS k FROM e WINDOW w AS (PARTITION BY user_id ORDER BY pos, event_id))) SELECT user_id, run::BIGINT AS run, any_value(event_type) AS event_type, count(*) AS n, min(pos) AS first, max(pos) AS last FROM r GROUP BY user_id, run")
def event_runs(spark, sf):
    return S.run_lengths(_events(spark, sf), ["user_id"], ["pos", "event_id"], "event_type", WEEK)


@query(f"WITH {EVENTS} SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY pos, event_id ROWS UNBOUNDED PRECEDING) AS bought FROM e")
def carried_values(spark, sf):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return S.carried(_events(spark, sf), bought, ["user_id"], ["pos", "event_id"], "bought", WEEK).select("event_id", "bought")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) <= 2")
def best_items(spark, sf):
    own = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return S.best_of(own, ["l_orderkey"], [F.desc("l_extendedprice"), "l_linenumber"], 2)


@query(f"WITH {ITEMS}, x AS (SELECT contig, start, unnest(range(greatest(0, ceil((start - 27) / 7.0)::BIGINT), start // 7 + 1)) * 7 AS w FROM items) SELECT contig, w AS window_start, count(*) AS n FROM x GROUP BY contig, w")
def sliding_windows(spark, sf):
    own = items(spark, sf).select("contig", F.explode(S.sliding(F.col("start"), 28, 7)).alias("window_start"))
    return own.groupBy("contig", "window_start").agg(F.count("*").alias("n"))


@query(f"WITH {ITEMS} SELECT contig, (start // 30) * 30 AS bin, count(*) AS n, count(DISTINCT flag) AS flags FROM items GROUP BY contig, start // 30")
def tumbling_bins(spark, sf):
    bin_ = (F.floor(F.col("start") / 30) * 30).alias("bin")
    return items(spark, sf).groupBy("contig", bin_).agg(F.count("*").alias("n"), F.count_distinct("flag").alias("flags"))


WEEKS = 'SELECT contig, start // 7 * 7 AS s, start // 7 * 7 + 7 AS e, count(*) AS n FROM items GROUP BY ALL'


@query(f'WITH RECURSIVE {ITEMS}, {greedy_sql("c", WEEKS, "r.sum <= 20 AND o.e - r.a <= 180", "r.a ; r.sum + o.n", "o.s AS a, o.n AS sum")} SELECT contig, min(s) AS start, max(e) AS "end", sum(n)::BIGINT AS n FROM c JOIN c_o USING (contig, k) GROUP BY contig, g')
def coalesced_windows(spark, sf):
    weeks = items(spark, sf).groupBy("contig", (F.floor(F.col("start") / 7) * 7).alias("start")).agg(F.count("*").alias("n"))
    return S.coalesced_windows(weeks.withColumn("end", F.col("start") + 7), ["contig"], 20, 180, YEAR)


@query(f'WITH RECURSIVE {ITEMS}, {greedy_sql("c", "SELECT DISTINCT contig, start AS s, " + chr(34) + "end" + chr(34) + " AS e FROM items", "o.s < r.reach", "r.reach", "o.e AS reach")} SELECT contig, arg_min(s, k) AS start, arg_min(e, k) AS "end" FROM c JOIN c_o USING (contig, k) GROUP BY contig, g')
def windows_apart(spark, sf):
    return S.apart(items(spark, sf).select("contig", "start", "end").distinct(), ["contig"], YEAR)


@query(f"WITH {EVENTS} SELECT event_id, coalesce(pos - lag(pos) OVER w, 0) AS step, coalesce(event_type = lag(event_type) OVER w, false) AS same FROM e WINDOW w AS (PARTITION BY user_id ORDER BY pos, event_id)")
def row_differences(spark, sf):
    own = across(_events(spark, sf), ["user_id"], ["pos", "event_id"], {"p": ("lag", F.col("pos")), "t": ("lag", F.col("event_type"))}, WEEK)
    return own.select("event_id", F.coalesce(F.col("pos") - F.col("p"), F.lit(0)).alias("step"), F.coalesce(F.col("event_type") == F.col("t"), F.lit(False)).alias("same"))
