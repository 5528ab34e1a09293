"""A training corpus from documents: quality rules, near-dedup, repeated strings, a mix of sources, tokens.

Every stage takes what its predecessor kept. Decisions take effect: rejected documents go, one document
of each near-duplicate group stays (the smallest id), repeated strings are cut out of texts, the mix repeats
and shortens documents to meet its targets, and the last stage gives the tokens of what is left. Near duplicates
are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Null and blank texts are rejected by the first stage; null ids order last, and of repeated rows the second stage
keeps one; ties go by id, then by a hash of the text. An empty table gives an empty one. Columns of documents are
kept by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.llm import bpe, quality_rules, simhash, source_mix, suffix_dedup


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = bpe.encode(docs, bpe.vocabulary("byte_bpe_50k.json"), ["doc_id", "lang", "source"])
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [("quality_rules", rules), ("near_duplicates", near_duplicates), ("repeated_strings", repeated_strings), ("source_mix", mix), ("bpe", tokens)]
#: Fingerprints, byte strings and vocabularies are beyond SQL: the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut_lineage(docs)
    return docs
