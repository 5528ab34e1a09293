"""Queries on mergeable statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.operators import aggregates as A
from strandline.operators import intervals as I
from strandline.plans.base import items, query, table
from strandline.plans.intervals import DEPTH


@query("SELECT l_returnflag, floor(l_quantity / 5) * 5 AS l_quantity, count(*) AS n FROM lineitem GROUP BY ALL")
def quantity_histogram(spark, sf):
    return A.histogram(table(spark, sf, "lineitem"), "l_quantity", ["l_returnflag"], 5)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL")
def combined_histograms(spark, sf):
    own = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", F.pmod("l_suppkey", F.lit(7)).alias("part"))
    return A.combined(A.histogram(own, "l_linestatus", ["part", "l_returnflag"]), ["l_returnflag", "l_linestatus"])


@query("SELECT o_orderpriority, max(v) AS nx FROM (SELECT o_orderpriority, v, sum(v) OVER (PARTITION BY o_orderpriority ORDER BY v DESC) AS c, sum(v) OVER (PARTITION BY o_orderpriority) AS t FROM (SELECT o_orderpriority, floor(o_totalprice)::BIGINT AS v FROM orders)) WHERE c >= 0.5 * t GROUP BY o_orderpriority")
def n50_prices(spark, sf):
    return A.nx(table(spark, sf, "orders").select("o_orderpriority", F.floor("o_totalprice").alias("v")), "v", 0.5, ["o_orderpriority"])


@query("WITH k AS (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT min(n) AS threshold FROM (SELECT n, sum(n) OVER (ORDER BY n) AS c, sum(n) OVER () AS t FROM k) WHERE c > 0.01 * t")
def n99_threshold(spark, sf):
    own = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")).withColumnRenamed("n", "rows")
    return A.low_share_threshold(own, "rows", 0.01)


@query("""WITH m AS (SELECT l_returnflag, l_quantity - avg(l_quantity) OVER (PARTITION BY l_returnflag) AS d, l_quantity AS v FROM lineitem)
SELECT l_returnflag, count(*) AS n, round(avg(v), 6) AS mean, round(var_samp(v), 6) AS variance, round(avg(d ** 3) / avg(d ** 2) ** 1.5, 6) AS skewness, round(avg(d ** 4) / avg(d ** 2) ** 2 - 3, 6) AS kurtosis, min(v) AS low, max(v) AS high FROM m GROUP BY l_returnflag""")
def moment_sketch(spark, sf):
    out = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(*A.moments("l_quantity"))
    return out.select("l_returnflag", "n", *[F.round(c, 6).alias(c) for c in ("mean", "variance", "skewness", "kurtosis")], "low", "high")


@query("SELECT l_linestatus, round(sum(l_discount * l_quantity) / sum(l_quantity), 8) AS mean, round(sqrt(sum(l_discount * l_discount * l_quantity) / sum(l_quantity) - (sum(l_discount * l_quantity) / sum(l_quantity)) ** 2), 8) AS deviation FROM lineitem GROUP BY 1")
def weighted_discount(spark, sf):
    mean, deviation = A.weighted(F.col("l_discount"), F.col("l_quantity"))
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(F.round(mean, 8).alias("mean"), F.round(deviation, 8).alias("deviation"))


@query(f"""WITH {DEPTH}, h AS (SELECT depth AS v, sum("end" - start)::BIGINT AS n FROM dp WHERE "end" IS NOT NULL GROUP BY depth), c AS (SELECT *, sum(n) OVER (ORDER BY v) AS c, sum(n) OVER () AS t FROM h)
SELECT round(sum(v * n) / sum(n), 6) AS mean, min(CASE WHEN c > t // 2 THEN v END)::BIGINT AS median, round(coalesce(sum(CASE WHEN v = 0 THEN n END), 0) / sum(n), 8) AS zero,
round(sqrt(sum(v * v * n) / sum(n) - (sum(v * n) / sum(n)) ** 2 - sum(v * n) / sum(n)) / (sum(v * n) / sum(n)), 6) AS dpcv, round(sum(CASE WHEN v <= 10 THEN n ELSE 0 END) / sum(n), 8) AS tail FROM c""")
def depth_summary(spark, sf):
    runs = I.depth(items(spark, sf), "contig", tile=256)
    spans = runs.groupBy("contig").agg(F.min("start").alias("s"), F.max("end").alias("e"), F.sum(F.col("end") - F.col("start")).alias("full"))
    zero = spans.select(F.lit(0).cast("long").alias("v"), (F.col("e") - F.col("s") - F.col("full")).alias("n"))
    counts = runs.select(F.col("depth").alias("v"), (F.col("end") - F.col("start")).alias("n")).unionAll(zero).groupBy("v").agg(F.sum("n").alias("n")).filter("n > 0")
    tail = counts.agg(F.round(A.tail_share(F.col("v"), F.col("n"), 10), 8).alias("tail"))
    out = A.depth_statistics(counts, "v").select(F.round("mean", 6).alias("mean"), "median", F.round("zero", 8).alias("zero"), F.round("dpcv", 6).alias("dpcv"))
    return out.join(F.broadcast(tail))  # one row each


@query("WITH k AS (SELECT l_returnflag, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_returnflag, round(sum(n) * sum(n) / sum(n * n), 6) AS diversity FROM k GROUP BY 1")
def effective_diversity(spark, sf):
    own = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.count("*").alias("n"))
    return own.groupBy("l_returnflag").agg(F.round(A.effective_diversity(F.col("n")), 6).alias("diversity"))


@query("WITH k AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), p AS (SELECT user_id, n / sum(n) OVER (PARTITION BY user_id) AS p FROM k) SELECT user_id, round(sum(-p * log2(p)), 8) AS entropy FROM p GROUP BY 1")
def event_entropy(spark, sf):
    return A.entropy(table(spark, sf, "events"), "event_type", ["user_id"]).select("user_id", F.round("entropy", 8).alias("entropy"))


@query("WITH k AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), a AS (SELECT event_type, count(*) / (SELECT count(*) FROM events) AS q FROM events GROUP BY 1), p AS (SELECT user_id, event_type, n / sum(n) OVER (PARTITION BY user_id) AS p FROM k) SELECT user_id, round(sum(p * log2(p / q)), 8) AS divergence FROM p JOIN a USING (event_type) GROUP BY 1")
def event_divergence(spark, sf):
    own = table(spark, sf, "events").select("user_id", "event_type")
    all_ = A.histogram(own, "event_type").select("event_type", F.col("n").alias("m")).join(own.agg(F.count("*").alias("t")))  # a row for each type of event, and one row
    mine = A.histogram(own, "event_type", ["user_id"]).join(own.groupBy("user_id").agg(F.count("*").alias("u")), "user_id")
    both = mine.join(all_, "event_type")
    return both.groupBy("user_id").agg(F.round(A.divergence(F.col("n") / F.col("u"), F.col("m") / F.col("t")), 8).alias("divergence"))


@query("SELECT size, count(*) AS n FROM (SELECT count(*) AS size FROM lineitem GROUP BY l_suppkey, l_shipdate::DATE, l_returnflag) GROUP BY size")
def duplicate_histogram(spark, sf):
    own = table(spark, sf, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("d"), "l_returnflag")
    return A.group_sizes(own, ["l_suppkey", "d", "l_returnflag"])


@query("WITH s AS (SELECT l_returnflag, count(*) AS size FROM lineitem GROUP BY l_returnflag, l_suppkey, l_shipdate::DATE) SELECT l_returnflag, round(avg(size), 8) AS mean, round(stddev_pop(size), 8) AS deviation, round(1 - count(*) / sum(size), 8) AS duplicates FROM s GROUP BY 1")
def duplicate_rates(spark, sf):
    own = table(spark, sf, "lineitem").select("l_returnflag", "l_suppkey", F.to_date("l_shipdate").alias("d"))
    out = A.duplicate_rates(A.group_sizes(own, ["l_suppkey", "d"], ["l_returnflag"]), ["l_returnflag"])
    return out.select("l_returnflag", *[F.round(c, 8).alias(c) for c in ("mean", "deviation", "duplicates")])


@query("""WITH r AS (SELECT l_suppkey, l_shipdate::DATE AS d, l_returnflag AS f, (l_orderkey * 31 + l_linenumber * 17) % 100 AS h FROM lineitem), p AS (SELECT unnest([25, 50, 100]) AS percent), s AS (SELECT unnest([true, false]) AS split),
g AS (SELECT percent, split, count(*) AS size FROM r, p, s WHERE h < percent GROUP BY percent, split, l_suppkey, d, CASE WHEN split THEN f END) SELECT percent, split, size, count(*) AS n FROM g GROUP BY ALL""")
def duplicate_battery(spark, sf):
    own = table(spark, sf, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("d"), "l_returnflag", ((F.col("l_orderkey") * 31 + F.col("l_linenumber") * 17) % 100).alias("h"))
    return A.duplicate_battery(own, ["l_suppkey", "d"], "l_returnflag", F.col("h"), [25, 50, 100])


@query("WITH k AS (SELECT l_partkey, sum(l_quantity) AS v FROM lineitem GROUP BY 1), m AS (SELECT quantile_cont(v, 0.5) AS m, quantile_cont(v, 0.98) AS q FROM k) SELECT l_partkey, v FROM k, m WHERE v > greatest(1.5 * m, q)")
def outlier_parts(spark, sf):
    own = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("v"))
    return A.outliers(own, "v", 1.5, 0.98)


@query("SELECT l_suppkey, list_extract(v, least(floor(0.75 * n)::BIGINT + 1, n)) - list_extract(v, least(floor(0.25 * n)::BIGINT + 1, n)) AS iqr FROM (SELECT l_suppkey, list_sort(list(l_quantity)) AS v, count(*) AS n FROM lineitem GROUP BY 1)")
def generalised_iqr(spark, sf):
    return A.generalised_iqr(table(spark, sf, "lineitem"), "l_quantity", ["l_suppkey"])


@query("WITH k AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS a, count(*) FILTER (o_orderstatus <> 'O') AS b FROM orders GROUP BY 1) SELECT o_custkey, round((a * (a - 1) / 2 + b * (b - 1) / 2) / ((a + b) * (a + b - 1) / 2), 8) AS rate FROM k WHERE a + b > 1")
def correct_pair_rate(spark, sf):
    n = lambda c: F.count(F.when(c, 1))
    own = table(spark, sf, "orders").groupBy("o_custkey").agg(n(F.col("o_orderstatus") == "O").alias("a"), n(F.col("o_orderstatus") != "O").alias("b"))
    return own.filter("a + b > 1").select("o_custkey", F.round(A.pair_rate([F.col("a"), F.col("b")]), 8).alias("rate"))


@query("SELECT o_orderpriority, coalesce(o_orderstatus, 'all') AS o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((o_orderpriority, o_orderstatus), (o_orderpriority))")
def sample_lane_rollup(spark, sf):
    own = table(spark, sf, "orders").groupingSets([["o_orderpriority", "o_orderstatus"], ["o_orderpriority"]], "o_orderpriority", "o_orderstatus")
    return own.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn("o_orderstatus", F.coalesce("o_orderstatus", F.lit("all")))


@query("SELECT round(1 / sum(p * p), 6) AS bins FROM (SELECT count(*) / (SELECT count(*) FROM lineitem) AS p FROM lineitem GROUP BY l_partkey)")
def effective_bins(spark, sf):
    own = A.histogram(table(spark, sf, "lineitem"), "l_partkey")
    return own.agg(F.round(A.effective_diversity(F.col("n")), 6).alias("bins"))
