"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for the rest.

A rule is a host and the beginning of a path; it fits its host and all subdomains, and the longest rule
that fits decides. The trees learn from labelled URLs: ``train`` takes any; the registered query
labels URLs by the rules that decide them, so that the trees carry a list's taste over to URLs that no
rule knows. Training rows are the ``MOST_LABELLED`` with the smallest hashes; half of them give the
statistics of host suffixes, smoothed towards the mean, and half grow the trees.

Null URLs and URLs without ``://`` have an empty host and path. Without labelled URLs of both kinds the
verdict of URLs that no rule decides is that of the labels there are, allow if there are none.
Repeated rows get the same result each. Columns with other names are kept by ``features``.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import let, table

MOST_LABELLED, SMOOTH, SEED = 20_000, 20, 5
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "other_ratio", "entropy", "parameters", "fragment", "longest_label", "suffix_rate", "suffix_seen", "top_rate")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def decided(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null for none."""
    rule, verdict = [], []
    for said, text in sorted(rules, key=lambda r: -len(r[1])):
        own, _, start = text.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{start}")
        rule.append(F.when(fits, F.lit(text)))
        verdict.append(F.when(fits, F.lit(said)))
    return F.coalesce(*rule), F.coalesce(*verdict)


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def features(urls: DataFrame, stats: DataFrame) -> DataFrame:
    """urls (url, host, path, ...) with the lexical features; stats as ``suffix_statistics`` gives them, at most a row for each labelled URL."""
    url = F.coalesce(F.col("url"), F.lit(""))
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    other = F.length(F.translate(F.lower(url), LOWER + "0123456789./:", ""))
    ratio = lambda n: F.coalesce(F.try_divide(n, F.length(url)), F.lit(0.0))
    counts = lambda chars: F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.size(chars))
    entropy = let(F.split(url, ""), lambda chars: F.aggregate(counts(chars), F.lit(0.0), lambda a, p: a - p * F.log2(p)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    df = urls.withColumns({
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"), "depth": F.length("path") - F.length(F.translate("path", "/", "")),
        "labels": F.size(F.split("host", r"\.")), "digit_ratio": ratio(digits), "other_ratio": ratio(other), "entropy": entropy,
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")), "fragment": F.contains(url, F.lit("#")).cast("int"),
        "longest_label": F.array_max(F.transform(F.split("host", r"\."), lambda x: F.length(x))), "__two": _suffix(F.col("host"), 2), "__top": _suffix(F.col("host"), 1),
    })
    of = lambda n, c: F.broadcast(stats.filter(F.col("labels_of") == n).select(F.col("suffix").alias(c), F.col("rate").alias(f"{c}_rate"), F.col("seen").alias(f"{c}_seen"), F.col("mean").alias(f"{c}_mean")))
    df = df.join(of(2, "__two"), "__two", "left").join(of(1, "__top"), "__top", "left")
    return df.withColumns({"suffix_rate": F.coalesce("__two_rate", "__top_mean", F.lit(0.5)), "suffix_seen": F.log1p(F.coalesce("__two_seen", F.lit(0))), "top_rate": F.coalesce("__top_rate", F.lit(0.5))})


def suffix_statistics(labelled: DataFrame) -> DataFrame:
    """Rows (labels_of, suffix, seen, rate, mean) of host suffixes of one and two labels; from rows (host, label)."""
    suffix = F.explode(F.array(*[F.struct(F.lit(n).alias("labels_of"), _suffix(F.col("host"), n).alias("suffix")) for n in (1, 2)])).alias("s")
    mean = labelled.agg(F.coalesce(F.avg("label"), F.lit(0.5)).alias("mean"))
    counts = labelled.select("label", suffix).groupBy("s.labels_of", "s.suffix").agg(F.count("*").alias("seen"), F.sum("label").alias("hits"))
    return counts.join(F.broadcast(mean)).select("labels_of", "suffix", "seen", ((F.col("hits") + SMOOTH * F.col("mean")) / (F.col("seen") + SMOOTH)).alias("rate"), "mean")


def train(labelled: DataFrame, most: int = MOST_LABELLED) -> tuple[GBTClassificationModel | None, DataFrame, float]:
    """The trees, the suffix statistics and the share of label 1; from rows (url, label) with labels 0 and 1."""
    spark = labelled.sparkSession
    host, path = split_url(F.col("url"))
    few = labelled.select("url", F.col("label").cast("double").alias("label"), F.xxhash64("url").alias("h")).orderBy("h", "url", "label").limit(most)
    rows = [tuple(r) for r in few.collect()]  # a bounded sample, sent out again to be split the same way twice
    few = spark.createDataFrame(rows, "url string, label double, h long").select("url", "label", "h", host.alias("host"), path.alias("path"))
    stats = suffix_statistics(few.filter(F.col("h") % 2 == 0))
    share = sum(r[1] for r in rows) / len(rows) if rows else 0.0
    grown = [r[1] for r in rows if r[2] % 2]
    if len(set(grown)) < 2:
        return None, stats, share
    half = assembled(features(few.filter(F.col("h") % 2 != 0), stats)).select("label", "features").coalesce(4)
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=12, maxDepth=4, stepSize=0.3, seed=SEED, cacheNodeIds=False)
    return trees.fit(half), stats, share


def assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def scored(urls: DataFrame, model: GBTClassificationModel | None, stats: DataFrame, share: float) -> DataFrame:
    """urls (url, host, path, ...) with score, the probability of label 1."""
    if model is None:
        return urls.withColumn("score", F.lit(float(share)))
    out = model.transform(assembled(features(urls, stats)))
    return out.select(*urls.columns, vector_to_array("probability")[1].alias("score"))


def judge(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, score); labelled: (url, label), 1 to block; by default the pages that a rule decides."""
    host, path = split_url(F.col("url"))
    own = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, said = decided(F.col("host"), F.col("path"), rules)
    own = own.select("page_id", "url", "host", "path", rule.alias("rule"), said.alias("said"))
    if labelled is None:
        labelled = own.filter(F.col("said").isNotNull()).select("url", (F.col("said") == "block").cast("double").alias("label"))
    out = scored(own, *train(labelled))
    verdict = F.coalesce("said", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round("score", 6).alias("score"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
