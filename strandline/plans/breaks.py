"""Queries on breaks: a supplier is a locus, a twelfth of the orders a key, an item a read pair."""

from __future__ import annotations

from math import log

from pyspark.sql import functions as F

from strandline.operators import breaks as B
from strandline.plans.base import query, table

SURVIVAL = [log(max(1e-6, 1 - k / 100)) for k in range(120)]
LEAST, CHIMERAS, REACH, ROUNDS = -50.0, 1e-4, 90, 3


def _add(a: str, b: str) -> str:
    return f"(greatest({a}, {b}) + ln(1 + exp(-abs(({a}) - ({b})))))"


def _mixed(p: str) -> str:
    return _add(f"ln(1 - {CHIMERAS}) + {p}", f"ln({CHIMERAS}) + {LEAST}")


def _calls_sql() -> str:
    chance = lambda n: f"ln(greatest(1e-6, 1 - least(greatest({n}, 0), 119) / 100.0))"
    none = _mixed(_add(f"ln(0.99) + {chance('outer2 - outer1')}", f"ln(0.01) + {LEAST}"))
    insert = f"CASE WHEN split THEN 0.0 ELSE {chance('b1 - outer1 + outer2 - b2')} END"
    broken = _mixed(_add(f"ln(0.99) + {insert}", f"ln(0.01) + {LEAST}"))
    hp = "least(CASE h1 WHEN 0 THEN a0 ELSE a1 END, CASE h2 WHEN 0 THEN z0 ELSE z1 END)"
    het = _add(f"ln({hp}) + sv", f"ln(1 - {hp}) + none_")
    best = "m{k} AS MATERIALIZED (SELECT * FROM (SELECT locus, b1, b2, h1, h2, sum(" + het + ") AS het FROM c JOIN w{k} USING (locus, key), (SELECT x AS h1, y AS h2 FROM range(2) a(x), range(2) b(y)) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY locus ORDER BY round(het, 9) DESC, b1, b2, h1, h2) = 1)"
    p = f"exp(sv + ln({hp}) - {_add(f'sv + ln({hp})', f'none_ + ln(1 - {hp})')})"
    steps = []
    for k in range(ROUNDS):
        steps.append(best.format(k=k))
        steps.append(f"n{k} AS MATERIALIZED (SELECT locus, key, settled, a0 AS o0, z0 AS q0, a1 AS o1, z1 AS q1, CASE WHEN settled THEN NULL ELSE {p} END AS p, h1, h2 FROM w{k} JOIN m{k} USING (locus) JOIN c USING (locus, b1, b2, key))")
        new = {f"{s}{h}": f"CASE WHEN p IS NULL THEN {o}{h} WHEN {w} = {h} THEN p ELSE 1 - p END" for s, o, w in (("a", "o", "h1"), ("z", "q", "h2")) for h in (0, 1)}
        steps.append(f"w{k + 1} AS MATERIALIZED (SELECT locus, key, " + ", ".join(f"{v} AS {x}" for x, v in new.items()) + f", settled OR max(greatest({', '.join(f'abs({v} - {o}{x[1]})' for (x, v), o in zip(new.items(), 'ooqq', strict=True))})) OVER (PARTITION BY locus) <= 1e-4 AS settled FROM n{k})")
    steps.append(best.format(k=ROUNDS))
    return f"""WITH p AS (SELECT l_suppkey AS locus, l_orderkey % 12 AS key, 950 + l_partkey % 40 AS outer1, l_returnflag <> 'R' AS normal, l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 1 AS split, CASE WHEN l_returnflag = 'R' THEN 1300 + l_quantity::BIGINT % 20 ELSE 975 + l_partkey % 40 END AS inner2, CASE WHEN l_returnflag = 'R' THEN 1305 + l_quantity::BIGINT % 20 ELSE 980 + l_partkey % 40 + l_quantity::BIGINT % 20 END AS outer2 FROM lineitem),
g AS (SELECT s_suppkey AS locus, 1000 + 10 * x AS b1, 1280 + 10 * y AS b2 FROM supplier, range(3) a(x), range(3) b(y)),
c AS MATERIALIZED (SELECT locus, b1, b2, key, sum(n) AS none_, sum(CASE WHEN (outer1 + 5 > b1 AND outer1 < b2) OR (outer2 > b1 AND inner2 < b2) THEN {LEAST} WHEN NOT normal AND b1 BETWEEN outer1 + 5 AND outer1 + 5 + {REACH} - 1 AND b2 BETWEEN inner2 - {REACH} + 1 AND inner2 THEN {broken} ELSE n END) AS sv FROM (SELECT *, {none} AS n FROM p JOIN g USING (locus)) GROUP BY ALL),
w0 AS (SELECT locus, key, a AS a0, 1 - a AS a1, 0.05 + 0.9 * a AS z0, 0.95 - 0.9 * a AS z1, false AS settled FROM (SELECT l_suppkey AS locus, l_orderkey % 12 AS key, (count(*) FILTER (l_returnflag = 'R') + 1) / (count(*) + 2) AS a FROM lineitem GROUP BY ALL)),
{", ".join(steps)},
h AS (SELECT * FROM (SELECT locus, b1 AS c1, b2 AS c2, sum(sv) AS hom, sum(none_) AS none_ FROM c GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY locus ORDER BY round(hom, 9) DESC, c1, c2) = 1),
z AS (SELECT locus, none_ AS none, hom, het, round(hom, 9) >= round(het, 9) AS is_hom, c1, c2, b1, b2, h1, h2 FROM h JOIN m{ROUNDS} USING (locus)),
y AS (SELECT *, CASE WHEN is_hom THEN c1 ELSE b1 END AS x1, CASE WHEN is_hom THEN c2 ELSE b2 END AS x2 FROM z)
SELECT y.locus, round(none, 4) AS none, round(hom, 4) AS hom, round(het, 4) AS het, CASE WHEN is_hom THEN 'hom' ELSE 'het' END AS zygosity, x1 AS b1, x2 AS b2, CASE WHEN NOT is_hom THEN h1 END AS hap1, CASE WHEN NOT is_hom THEN h2 END AS hap2, (SELECT count(*) FROM c WHERE c.locus = y.locus AND c.b1 = x1 AND c.b2 = x2 AND sv > none_) AS support, (SELECT bool_and(settled) FROM w{ROUNDS} w WHERE w.locus = y.locus) AS settled FROM y"""


@query(_calls_sql())
def break_models(spark, sf):
    """The likeliest deletion of each locus, homozygous or on one haplotype of the keys."""
    x, q, far = F.col("l_partkey") % 40, F.col("l_quantity").cast("long") % 20, F.col("l_returnflag") == "R"
    items = table(spark, sf, "lineitem").select("*", F.col("l_suppkey").alias("locus"), (F.col("l_orderkey") % 12).alias("key"))
    pairs = items.select("locus", "key", (950 + x).alias("outer1"), (955 + x).alias("inner1"), F.when(far, 1300 + q).otherwise(975 + x).alias("inner2"), F.when(far, 1305 + q).otherwise(980 + x + q).alias("outer2"), F.lit(0.01).alias("wrong"), (~far).alias("normal"), (far & (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 1)).alias("split"))
    grid = F.explode(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda a: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda b: F.struct((1000 + 10 * a).alias("b1"), (1280 + 10 * b).alias("b2"))))))
    cells = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("locus"), grid.alias("c")).select("locus", "c.b1", "c.b2")
    share = items.groupBy("locus", "key").agg(((F.count(F.when(far, 1)) + 1) / (F.count("*") + 2)).alias("a"))
    a = F.col("a")
    phases = share.select("locus", "key", a.alias("a0"), (1 - a).alias("a1"), (0.05 + 0.9 * a).alias("z0"), (0.95 - 0.9 * a).alias("z1"), F.lit(False).alias("same"))
    out = B.break_models(B.pair_chances(pairs, cells, SURVIVAL, REACH, CHIMERAS, LEAST), phases, ROUNDS)
    return out.select("locus", *[F.round(k, 4).alias(k) for k in ("none", "hom", "het")], "zygosity", "b1", "b2", "hap1", "hap2", "support", "settled")
