"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Targets: sources in code-point order, null last, weigh 1, 2, 3, repeating, and share all words; a
target stops at ``MOST`` times its source's words and the excess is shared again by weight, which is
one water level over the sources. Blocks of ``BLOCK`` words go to sources by the highest quotients
target / (2k + 1), then each source's blocks go to its shards the same way. Only seats near the
proportional share are ranked; the ones below are certain.

Within a shard, documents stand in a seeded order on one line of words. A quota takes the whole line
as often as it fits and then whole blocks in a seeded order, so no document is taken more than
``MOST`` times; where the last block of a shard would pass that, it is cut there. Shards are ranges of a
seeded hash of doc_id. A source has one shard for each ``SHARD_WORDS`` words or so, in powers of two and
``2 ** DEPTH`` at most: a small source is one shard, so that its target isn't lost in parts too short
for a block, and one that holds a third of all rows is dealt to many tasks.

Null texts and texts without words have size 0 and nothing is taken. Null and repeated ids are allowed:
rows that tie are alike. Columns of the table with other names are kept by ``mixed`` and ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.llm.common import n_words, table, words

SEED, BLOCK, MOST, SHARD_WORDS, DEPTH = 17, 16, 3, 1 << 16, 16
PRIME = 2147483647
#: Quotas are broadcast up to this many rows, joined by a shuffle beyond.
BROADCAST_ROWS = 200_000

_KEY = ["__src", "__none"]


def _div(a: Column, b: Column | int) -> Column:
    """Whole quotient of numbers that aren't negative."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def sized(docs: DataFrame) -> DataFrame:
    seeded = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return docs.withColumns({"__size": n_words(F.col("text")), "__src": F.coalesce("source", F.lit("")), "__none": F.col("source").isNull(), "__order": seeded, "__cell": F.conv(F.substring(seeded, 1, 4), 16, 10).cast("long")})


def depth(size: Column) -> Column:
    """How many bits of the hash tell the shards of a source of so many words apart."""
    return F.when(size < SHARD_WORDS, 0).otherwise(F.least(F.lit(DEPTH), F.length(F.bin(_div(size, SHARD_WORDS))))).cast("int")


def shard() -> Column:
    return F.call_function("shiftright", F.col("__cell"), F.lit(DEPTH) - F.col("__depth"))


def targets(sizes: DataFrame) -> DataFrame:
    """From rows (__src, __none, size) of all sources: place, total, target. As many rows as sources."""
    every, place = W.partitionBy(), W.orderBy("__none", "__src")
    level = W.orderBy("ratio", "place").rowsBetween(W.unboundedPreceding, W.currentRow)
    df = sizes.withColumn("place", F.row_number().over(place)).withColumn("weight", (F.col("place") - 1) % 3 + 1)
    df = df.withColumns({"total": F.sum("size").over(every), "weights": F.sum("weight").over(every), "sources": F.count("*").over(every), "cap": MOST * F.col("size"), "ratio": MOST * F.col("size") / F.col("weight")})
    df = df.withColumns({"before": F.sum("cap").over(level) - F.col("cap"), "rest": F.col("weights") - F.sum("weight").over(level) + F.col("weight"), "step": F.row_number().over(W.orderBy("ratio", "place"))})
    fits = (F.col("total") - F.col("before")) * F.col("weight") <= F.col("cap") * F.col("rest")
    df = df.withColumn("at", F.min(F.when(fits, F.col("step"))).over(every))
    at = lambda c: F.max(F.when(F.col("step") == F.col("at"), F.col(c))).over(every)
    df = df.withColumns({"used": at("before"), "share": at("rest")})
    free = ((F.col("total") - F.col("used")) * F.col("weight")).cast("double") / F.col("share")
    return df.withColumn("target", F.when(F.col("step") < F.col("at"), F.col("cap").cast("double")).otherwise(free))


def seats(df: DataFrame, by: list[str], votes: str, seat_total: str, vote_total: str, members: str, order: list[str]) -> DataFrame:
    """df with quota: seat_total seats of each group ``by`` to its rows by highest quotients votes / (2k + 1), at most MOST * size of each."""
    share = F.coalesce(F.try_divide(F.col(votes), F.col(vote_total)), F.lit(0.0))
    near = F.floor(F.col(seat_total) * share).cast("long")
    width = F.ceil(share * F.col(members) / 2).cast("long") + 2
    most = _div(MOST * F.col("size") + BLOCK - 1, BLOCK)
    df = df.withColumns({"low": F.least(most, F.greatest(F.lit(0).cast("long"), near - width)), "high": F.least(most, near + width)})
    df = df.withColumn("left", F.col(seat_total) - F.sum("low").over(W.partitionBy(*by)))
    asked = df.filter(F.col("high") > F.col("low")).withColumn("k", F.explode(F.sequence("low", F.col("high") - 1)))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc(F.col(votes) / (2 * F.col("k") + 1)), *order, "k"))
    keys = list(dict.fromkeys([*by, *order]))
    won = asked.withColumn("n", rank).filter(F.col("n") <= F.col("left")).groupBy(*keys).agg(F.count("*").alias("won"))
    return df.join(won, keys, "left").withColumn("quota", F.col("low") + F.coalesce("won", F.lit(0))).drop("low", "high", "left", "won")


def quotas(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (__src, __none, __depth) and rows (__src, __none, __shard, __source_size, __target, __line, __quota); from ``sized()`` rows."""
    cells = cut_lineage(docs.groupBy(*_KEY, "__cell").agg(F.sum("__size").alias("size")))
    depths = cut_lineage(cells.groupBy(*_KEY).agg(depth(F.sum("size")).alias("__depth")))
    shards = cut_lineage(cells.join(small(depths), _KEY).groupBy(*_KEY, shard().alias("__shard")).agg(F.sum("size").alias("size")))
    sources = targets(shards.groupBy(*_KEY).agg(F.sum("size").alias("size"), F.count(F.when(F.col("size") > 0, 1)).alias("members")))
    sources = sources.withColumns({"blocks": _div(F.col("total") + BLOCK // 2, BLOCK), "all": F.lit(0)}).withColumn("whole", F.col("total").cast("double"))
    sources = seats(sources, ["all"], "target", "blocks", "whole", "sources", ["place"])
    own = sources.select(*_KEY, F.col("size").alias("source_size"), "target", "members", F.col("quota").alias("source_quota"))
    plan = seats(shards.join(own, _KEY), _KEY, "size", "source_quota", "source_size", "members", ["__shard"])
    return depths, cut_lineage(plan.select(*_KEY, "__shard", F.col("source_size").alias("__source_size"), F.col("target").alias("__target"), F.col("size").alias("__line"), F.col("quota").alias("__quota")))


def small(df: DataFrame) -> DataFrame:
    """df, written before, to be broadcast if it is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def planned(docs: DataFrame) -> DataFrame:
    """docs with __size, __source_size, __target, __from (place on the shard's line), __epochs and what the seeded choice of blocks needs."""
    all_docs = sized(docs)
    depths, plan = quotas(all_docs.select("__size", *_KEY, "__cell"))
    line = W.partitionBy(*_KEY, "__shard").orderBy("__order", "__size").rowsBetween(W.unboundedPreceding, W.currentRow)
    df = all_docs.join(small(depths), _KEY).withColumn("__shard", shard()).join(small(plan), [*_KEY, "__shard"])
    df = df.withColumn("__from", F.sum("__size").over(line) - F.col("__size"))
    want, whole = F.least(F.col("__quota") * BLOCK, MOST * F.col("__line")), F.greatest(F.col("__line"), F.lit(1))
    df = df.withColumns({"__epochs": _div(want, whole), "__rest": want % whole, "__n": _div(F.col("__line"), BLOCK)})
    seeded = F.md5(F.concat(F.lit(f"{SEED}/"), F.col("__shard").cast("string"), F.lit("/"), "__src"))
    return df.withColumns({"__full": _div(F.col("__rest"), BLOCK), "__part": F.col("__rest") % BLOCK, "__turn": F.conv(F.substring(seeded, 1, 6), 16, 10).cast("long")})


def _taken_of_block(j: Column) -> Column:
    """How many words of block j, from its first on, the last round takes."""
    rank = (PRIME * j + F.col("__turn")) % F.greatest(F.col("__n"), F.lit(1))
    part = F.when(F.col("__full") == F.col("__n"), F.col("__part")).otherwise(F.lit(0))
    return F.when(j >= F.col("__n"), part).when(rank < F.col("__full"), F.lit(BLOCK)).when(rank == F.col("__full"), F.col("__part")).otherwise(F.lit(0))


def taken() -> Column:
    a, b = F.col("__from"), F.col("__from") + F.col("__size")
    piece = lambda j: F.greatest(F.lit(0).cast("long"), F.least(b, j * BLOCK + _taken_of_block(j)) - F.greatest(a, j * BLOCK))
    last = F.aggregate(F.sequence(_div(a, BLOCK), _div(b - 1, BLOCK)), F.lit(0).cast("long"), lambda t, j: t + piece(j))
    return F.when(F.col("__size") == 0, F.lit(0).cast("long")).otherwise(F.col("__epochs") * F.col("__size") + last)


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself, in the columns of docs: each document as often as whole rounds take it, and once more with the words that the last round takes. n_chars, where there is one, follows."""
    df = planned(docs)

    def chosen(i: Column) -> Column:
        at = F.col("__from") + i
        return at % BLOCK < _taken_of_block(_div(at, BLOCK))

    some = F.filter(words(F.col("text")), lambda w, i: chosen(i.cast("long")))
    df = df.withColumn("__some", F.when(F.col("__rest") > 0, some))
    copies = F.concat(F.transform(F.sequence(F.lit(0).cast("long"), F.col("__epochs")), lambda i: F.when(i < F.col("__epochs"), F.struct(F.lit(True).alias("whole"), F.lit(None).cast("string").alias("text"))).when(F.size("__some") > 0, F.struct(F.lit(False).alias("whole"), F.array_join("__some", " ").alias("text")))))
    df = df.filter(F.col("__size") > 0).withColumn("__copy", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    df = df.withColumn("text", F.when(F.col("__copy.whole"), F.col("text")).otherwise(F.col("__copy.text")))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.col("__copy.whole"), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return df.select(*docs.columns)


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = planned(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return df.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), taken().alias("taken"))


def _seats_sql(table: str, by: str, votes: str, seat_total: str, vote_total: str, members: str, order: str) -> str:
    return f"""
{table}_low AS (
  SELECT *, least(({MOST} * size + {BLOCK - 1}) // {BLOCK}, greatest(0, near - width)) AS low, least(({MOST} * size + {BLOCK - 1}) // {BLOCK}, near + width) AS high FROM (
    SELECT *, floor({seat_total} * coalesce({votes} / nullif({vote_total}, 0), 0))::BIGINT AS near, ceil(coalesce({votes} / nullif({vote_total}, 0), 0) * {members} / 2)::BIGINT + 2 AS width FROM {table})
), {table}_left AS (
  SELECT *, {seat_total} - sum(low) OVER ({by}) AS remaining FROM {table}_low
), {table}_won AS (
  SELECT src, none, {order}, count(*) AS won FROM (
    SELECT *, row_number() OVER ({by} ORDER BY {votes} / (2 * k + 1) DESC, {order}, k) AS n FROM (SELECT *, unnest(range(low, high)) AS k FROM {table}_left)
  ) WHERE n <= remaining GROUP BY src, none, {order}
), {table}_quota AS (
  SELECT a.*, a.low + coalesce(b.won, 0) AS quota FROM {table}_left a LEFT JOIN {table}_won b ON a.src = b.src AND a.none = b.none AND a.{order} = b.{order}
)"""


ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS none, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS ord FROM documents
), dp AS (
  SELECT src, none, CASE WHEN sum(size) < {SHARD_WORDS} THEN 0 ELSE least({DEPTH}, length(bin(sum(size)::BIGINT // {SHARD_WORDS}))) END::INT AS depth FROM d GROUP BY ALL
), ds AS (
  SELECT d.*, ('0x' || substr(ord, 1, 4))::BIGINT >> ({DEPTH} - depth) AS shard FROM d JOIN dp USING (src, none)
), sh AS (
  SELECT src, none, shard, sum(size)::BIGINT AS size FROM ds GROUP BY ALL
), s0 AS (
  SELECT src, none, sum(size)::BIGINT AS size, count(*) FILTER (size > 0) AS members FROM sh GROUP BY ALL
), s1 AS (
  SELECT *, row_number() OVER (ORDER BY none, src) AS place, sum(size) OVER ()::BIGINT AS total, count(*) OVER () AS sources FROM s0
), s2 AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, {MOST} * size AS cap FROM s1
), s3 AS (
  SELECT *, sum(cap) OVER o - cap AS used_before, sum(weight) OVER () - sum(weight) OVER o + weight AS rest, row_number() OVER (ORDER BY cap / weight, place) AS stp
  FROM s2 WINDOW o AS (ORDER BY cap / weight, place ROWS UNBOUNDED PRECEDING)
), s4 AS (
  SELECT *, min(CASE WHEN (total - used_before) * weight <= cap * rest THEN stp END) OVER () AS lvl FROM s3
), s5 AS (
  SELECT *, max(CASE WHEN stp = lvl THEN used_before END) OVER () AS used, max(CASE WHEN stp = lvl THEN rest END) OVER () AS share FROM s4
), so AS (
  SELECT *, CASE WHEN stp < lvl THEN cap::DOUBLE ELSE ((total - used) * weight)::DOUBLE / share::DOUBLE END AS target, (total + {BLOCK // 2}) // {BLOCK} AS blocks, total::DOUBLE AS whole FROM s5
), {_seats_sql("so", "", "target", "blocks", "whole", "sources", "place")},
sd AS (
  SELECT sh.*, q.size AS source_size, q.target, q.members, q.quota AS source_quota FROM sh JOIN so_quota q USING (src, none)
), {_seats_sql("sd", "PARTITION BY src, none", "size", "source_quota", "source_size", "members", "shard")},
j AS (
  SELECT d.*, q.source_size, q.target, sum(d.size) OVER (PARTITION BY src, none, shard ORDER BY ord, d.size ROWS UNBOUNDED PRECEDING) - d.size AS a,
         least(q.quota * {BLOCK}, {MOST} * q.size) // greatest(q.size, 1) AS epochs, least(q.quota * {BLOCK}, {MOST} * q.size) % greatest(q.size, 1) AS rest, q.size // {BLOCK} AS n,
         ('0x' || substr(md5('{SEED}/' || shard || '/' || src), 1, 6))::BIGINT AS turn
  FROM ds d JOIN sd_quota q USING (src, none, shard)
), b AS (
  SELECT *, row_number() OVER () AS r, rest // {BLOCK} AS full_blocks, rest % {BLOCK} AS part FROM j
), e AS (
  SELECT r, sum(greatest(0, least(a + size, k * {BLOCK} + CASE WHEN k >= n THEN (CASE WHEN full_blocks = n THEN part ELSE 0 END)
      WHEN ({PRIME} * k + turn) % greatest(n, 1) < full_blocks THEN {BLOCK} WHEN ({PRIME} * k + turn) % greatest(n, 1) = full_blocks THEN part ELSE 0 END) - greatest(a, k * {BLOCK}))) AS last
  FROM (SELECT *, unnest(range((a // {BLOCK})::BIGINT, ((a + size - 1) // {BLOCK})::BIGINT + 1)) AS k FROM b WHERE size > 0) GROUP BY r
)
SELECT doc_id, size, source_size, target, (epochs * size + coalesce(last, 0))::BIGINT AS taken FROM b LEFT JOIN e USING (r)
"""
