"""Registering queries with their SQL, and the shapes that tables take in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with DuckDB SQL for the same rows where there is one."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as intervals of days: contig is the supplier, and an item lasts as many days as its quantity."""
    day = F.datediff(F.col("l_shipdate"), F.lit("1992-01-01")).cast("long")
    df = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("contig"), day.alias("start"), (day + F.col("l_quantity").cast("long")).alias("end"), ((F.col("l_orderkey") * 1000000 + F.col("l_partkey")) * 10 + F.col("l_linenumber")).alias("id"), F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("price"))
    return df


#: The same in SQL; use as a common table expression.
ITEMS = """items AS (
  SELECT l_suppkey AS contig, date_diff('day', DATE '1992-01-01', l_shipdate::DATE)::BIGINT AS start,
         date_diff('day', DATE '1992-01-01', l_shipdate::DATE)::BIGINT + l_quantity::BIGINT AS "end",
         (l_orderkey * 1000000 + l_partkey) * 10 + l_linenumber AS id, l_returnflag AS flag, l_extendedprice AS price FROM lineitem
)"""

#: Eight letters of A, C, G, T that depend on a number, in both languages.
HEX, ACGT = "0123456789abcdef", "ACGTACGTACGTACGT"


def code(number, n: int = 8, salt: str = ""):
    return F.translate(F.substring(F.md5(F.concat(F.lit(salt), number.cast("string"))), 1, n), HEX, ACGT)


def code_sql(number: str, n: int = 8, salt: str = "") -> str:
    return f"translate(substr(md5('{salt}' || ({number})::VARCHAR), 1, {n}), '{HEX}', '{ACGT}')"


def greedy_sql(name: str, rows: str, joins: str, carry: str, first: str) -> str:
    """Recursive tables ``{name}_o`` (rows numbered by k within contig in order of s, e) and ``{name}``: one row for each of them with g, the number of its group. ``rows`` gives contig, s, e and what else is used; ``first`` are the columns of the state at the first row of a group, ``carry`` at a row that joins; ``joins`` says when, with r for the state and o for the row."""
    state = [x.split(" AS ")[1] for x in first.split(", ")]
    carried = dict(zip(state, [x.strip() for x in carry.split(" ; ")], strict=True))
    begin = {x.split(" AS ")[1]: x.split(" AS ")[0] for x in first.split(", ")}
    step = ", ".join(f"CASE WHEN {joins} THEN {carried[c]} ELSE {begin[c]} END AS {c}" for c in state)
    return f"""{name}_o AS (SELECT *, row_number() OVER (PARTITION BY contig ORDER BY s, e) AS k FROM ({rows})), {name} AS (
  SELECT o.contig, o.k, 1 AS g, {first} FROM {name}_o o WHERE k = 1 UNION ALL
  SELECT o.contig, o.k, CASE WHEN {joins} THEN r.g ELSE r.g + 1 END AS g, {step} FROM {name} r JOIN {name}_o o ON o.contig = r.contig AND o.k = r.k + 1)"""


def chain_sql(rows: str, states: int, prior: str, moves: str, smooth: bool = False) -> str:
    """Recursive tables ``c_o`` (rows g, e, .. numbered by k within g in order of s) and ``c_p``: the state of each row, of scores within 1e-9 the smallest, counted from 0, and with ``smooth`` ``c_q``, the probabilities of all states. ``rows`` gives g, s, e (the list of log scores); ``prior`` is a list, ``moves`` the log score of a move from state a to b (from 1) into row o."""
    every, go = f"range(1, {states + 1})", f"list_transform(range(1, {states + 1}), lambda b: list_transform(range(1, {states + 1}), lambda a: r.v[a] + {moves}))"
    first = "list_position(list_transform({x}, lambda y: y >= list_max({x}) - 1e-9), true)"
    add = "list_max({x}) + ln(list_sum(list_transform({x}, lambda y: exp(y - list_max({x})))))"
    begin = f"list_transform({every}, lambda b: ({prior})[b] + e[b])"
    out = f"""c_o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY s) AS k, count(*) OVER (PARTITION BY g) AS n FROM ({rows})), c_f AS (
  SELECT g, k, n, {begin} AS v, NULL::BIGINT[] AS back FROM c_o WHERE k = 1 UNION ALL
  SELECT g, k, n, list_transform(go, lambda x, b: list_max(x) + e[b]), list_transform(go, lambda x: {first.format(x="x")}::BIGINT) FROM (SELECT o.g, o.k, o.n, o.e, {go} AS go FROM c_f r JOIN c_o o ON o.g = r.g AND o.k = r.k + 1)), c_p AS (
  SELECT g, k, {first.format(x="v")}::BIGINT - 1 AS state FROM c_f WHERE k = n UNION ALL SELECT f.g, f.k - 1, f.back[p.state + 1] - 1 FROM c_p p JOIN c_f f ON f.g = p.g AND f.k = p.k WHERE f.k > 1)"""
    if smooth:
        behind = f"list_transform({every}, lambda a: list_transform({every}, lambda b: r.v[b] + o.e[b] + {moves}))"
        out += f""", c_a AS (SELECT g, k, {begin} AS v FROM c_o WHERE k = 1 UNION ALL SELECT g, k, list_transform(go, lambda x, b: {add.format(x="x")} + e[b]) FROM (SELECT o.g, o.k, o.e, {go} AS go FROM c_a r JOIN c_o o ON o.g = r.g AND o.k = r.k + 1)), c_b AS (
  SELECT g, k, list_transform({every}, lambda b: 0.0::DOUBLE) AS v FROM c_o WHERE k = n UNION ALL SELECT g, k, list_transform(go, lambda x: {add.format(x="x")}) FROM (SELECT o.g, o.k - 1 AS k, {behind} AS go FROM c_b r JOIN c_o o ON o.g = r.g AND o.k = r.k WHERE o.k > 1)),
c_q AS (SELECT g, k, list_transform(w, lambda x: exp(x - list_max(w)) / list_sum(list_transform(w, lambda y: exp(y - list_max(w))))) AS p FROM (SELECT a.g, a.k, list_transform({every}, lambda b: a.v[b] + z.v[b]) AS w FROM c_a a JOIN c_b z USING (g, k)))"""
    return out


def counts_sql(count: str, per_copy: str, states: int, alpha: float) -> str:
    """The list of log-likelihoods of a count under negative binomials for 0, 1, .. copies."""
    size = f"(greatest(s_, 0.05) * {per_copy} / ({alpha} - 1))"
    return f"list_transform(range(0, {states}), lambda s_: lgamma({count} + {size}) - lgamma({size}) - lgamma({count} + 1.0) - {size} * ln({alpha}) + {count} * ln(({alpha} - 1) / {alpha}))"
