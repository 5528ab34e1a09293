"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document; the ledger keeps the measurements and one bit for
each rule failed. A policy is a version name and the bits that it rejects on, so a change of policy
reads the ledger and not the texts. Ablations are bitwise aggregates over the few distinct masks.

Null and blank texts measure zero and fail ``few_words``. Repeated rows get the same result each.
Columns of the table beside doc_id and text are kept by ``ledger`` unless they carry one of its names.
Words in repeated windows are found by 64-bit hashes of five words within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import let, table, words

BLANKS, SYMBOLS, UPPER = " \t\n\x0b\x0c\r", "#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs", "n_stutter")

#: Rule: what fails it, over the measurements. The place in this table is the rule's bit; add new rules at the end.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
    "upper_case": "100 * n_upper > 30 * word_chars",
    "exclamation": "10 * n_bangs > 3 * n_words",
    "stutter": "5 * n_stutter > n_words",
}
BIT = {rule: 1 << i for i, rule in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]

#: Version: the bits that reject.
POLICIES = {
    "base": BASE,
    "2024-1": BASE | BIT["symbols"] | BIT["word_length"],
    "2024-2": sum(BIT.values()),
}
CURRENT = "2024-2"


def _chars(text: Column, of: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, of, ""))).cast("long")


def repeat_words(own: Column, window: int = WINDOW) -> Column:
    """Words that stand in a window of words found twice or more in the array of words."""
    n = F.size(own)
    hashes = F.when(n >= window, F.slice(F.transform(own, lambda w, i: F.xxhash64(w, *[F.get(own, i + k) for k in range(1, window)])), 1, n - window + 1)).otherwise(F.array().cast("array<long>"))

    def positions(s: Column) -> Column:
        twin = lambda e, i: (e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"])
        return F.sort_array(F.transform(F.filter(s, lambda e, i: F.coalesce(twin(e, i), F.lit(False))), lambda e: e["i"]))

    def cover(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def count(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(let(pairs, positions), cover))

    return let(hashes, count)


def measured(docs: DataFrame) -> DataFrame:
    """docs with the measurements."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    values = {
        "n_words": let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("r"), F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False)))).cast("long").alias("s"))),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": _chars(text, SYMBOLS),
        "n_dup_lines": let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("r"))),
        "n_upper": _chars(text, UPPER),
        "n_bangs": _chars(text, "!"),
    }
    both = docs.drop(*MEASURES).withColumns({f"__{k}" if k in ("n_words", "n_dup_lines") else k: v for k, v in values.items()})
    split = {"n_words": "__n_words.n", "n_repeat_words": "__n_words.r", "n_stutter": "__n_words.s", "n_lines": "__n_dup_lines.n", "n_dup_lines": "__n_dup_lines.r"}
    return both.withColumns({k: F.col(v) for k, v in split.items()}).drop("__n_words", "__n_dup_lines")


def ledger(docs: DataFrame) -> DataFrame:
    """docs, the measurements and fail_mask."""
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long") for name, rule in RULES.items()]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return measured(docs.drop("fail_mask")).withColumn("fail_mask", mask)


def rejected(policy: str | int = CURRENT, mask: str = "fail_mask") -> Column:
    bits = POLICIES[policy] if isinstance(policy, str) else policy
    return F.col(mask).bitwiseAND(F.lit(bits)) != 0


def ablations(held: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For each rule of a policy: how many documents fail it, are rejected by it alone, and are kept without it."""
    bits = POLICIES[policy]
    masks = held.groupBy(F.col("fail_mask").bitwiseAND(F.lit(bits)).alias("m")).agg(F.count("*").alias("n"))
    rules = F.explode(F.map_from_arrays(F.array(*map(F.lit, BIT)), F.array(*[F.lit(b).cast("long") for b in BIT.values()]))).alias("rule", "bit")
    one = masks.select("m", "n", rules).filter(F.col("bit").bitwiseAND(F.lit(bits)) != 0)
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    return one.groupBy("rule").agg(
        total(F.col("m").bitwiseAND(F.col("bit")) != 0).alias("fail"),
        total(F.col("m") == F.col("bit")).alias("fail_alone"),
        total(F.col("m").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
        F.bit_or(F.when(F.col("m").bitwiseAND(F.col("bit")) != 0, F.col("m"))).alias("fails_with"),
    )


def keep_good(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of docs that the policy keeps."""
    own = docs.select(*docs.columns, F.struct(*docs.columns).alias("__row")).select("__row", F.col("text"))
    return ledger(own).filter(~rejected(policy)).select("__row.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return held.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", rejected("base").alias("base_failed"), (~rejected()).alias("kept"), "fail_mask")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d
), p AS (
  SELECT r, i, list_slice(w, i, i + 4) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)
), b AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM p) WHERE c > 1
), g AS (
  SELECT r, sum(least(5, coalesce(nx - i, 5))) AS n FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nx FROM b) GROUP BY r
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(g.n, 0)::BIGINT AS n_repeat_words,
         len(l)::BIGINT AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(t, '[^!]', '', 'g'))::BIGINT AS n_bangs,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1]))::BIGINT AS n_stutter
  FROM w LEFT JOIN g USING (r)
), f AS (
  SELECT *, (""" + " + ".join(f"CASE WHEN {rule} THEN {BIT[name]} ELSE 0 END" for name, rule in RULES.items()) + rf""")::BIGINT AS fail_mask FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_mask & {BASE}) <> 0 AS base_failed,
       (fail_mask & {POLICIES[CURRENT]}) = 0 AS kept, fail_mask FROM f
"""
