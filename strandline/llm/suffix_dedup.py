"""Removal of repeated byte strings by refined bucket identifiers.

Not a sort of every suffix, which would shuffle many times the input (README). As in bucket-pointer refinement, the identifier of the first 2k bytes at a place comes from those of k
bytes at it and k bytes further on, so that six rounds reach 64 bytes and an overlapping pair reaches ``length``; but identifiers are hashes of the pairs, the same in every task, and not ranks in a sorted order. Places are
named by their smallest ``q``-byte bucket, runs of one name are compared by Spark's sort, and only names with different runs are refined (see ``windows``).

Nulls and empty texts: nothing is removed. Repeated rows (same id, same text) are one document and
get the same result each. Rows of equal id but different text are ordered by a hash of the text.
Null ids come last. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import NO_ID, mix, random_table, table
from strandline.llm.windows import Plan, covered, intervals, keyed, marked, with_spans

LENGTH, Q = 100, 24
_FIRST = (random_table(256, 10), random_table(256, 11))
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def byte_symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def refine(bucket: np.ndarray, later: int) -> np.ndarray:
    """Buckets of longer prefixes, from the buckets at i and at i + later."""
    return mix(bucket[:-later] * _PAIR + bucket[later:])


def buckets(data: np.ndarray, first: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """Bucket identifiers of all prefixes of the given increasing lengths."""
    bucket, have, out = first[data], 1, []
    for length in lengths:
        while have * 2 <= length:
            bucket, have = refine(bucket, have), have * 2
        out.append(bucket if have == length else refine(bucket, length - have))
    return out


def plan(length: int = LENGTH, q: int = Q) -> Plan:
    half, block = 1 << (length.bit_length() - 1), max(1, length // 12)
    return Plan(length, q, half, block, byte_symbols, lambda x: buckets(x, _FIRST[0], q, half, length), lambda x: buckets(x, _FIRST[1], length)[0])


def dedup_bytes(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, removed, kept): removed holds [start, end) byte intervals; kept the bytes left."""
    schema = "doc_id long, n_bytes long, n_removed long, removed array<array<long>>, kept binary"

    def cut(batches):
        for pdf in batches:
            rows = []
            for oid, text, spans in zip(pdf["oid"], pdf["text"], pdf["spans"], strict=True):
                data = byte_symbols(text)
                gone = covered(spans, length, len(data))
                rows.append((oid, len(data), int(gone.sum()), intervals(gone).tolist(), data[~gone].tobytes()))
            yield type(pdf)(rows, columns=["doc_id", "n_bytes", "n_removed", "removed", "kept"])

    out = with_spans(keyed(docs), plan(length, q)).mapInPandas(cut, schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def without_repeats(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """docs with whole characters that lie in repeated strings cut from their texts; null texts stay null. n_chars, where there is one, follows."""
    from strandline.llm.windows import repeated_windows

    @F.pandas_udf("string")
    def cut(text, spans):
        def one(t, s):
            if t is None or s is None or not len(s):
                return t
            data = byte_symbols(t)
            gone = covered(s, length, len(data))
            head = (data & 0xC0) != 0x80
            whole = np.logical_and.reduceat(gone, np.flatnonzero(head))
            return data[~whole[np.cumsum(head) - 1]].tobytes().decode()

        return type(text)([one(t, s) for t, s in zip(text, spans, strict=True)], dtype=object)

    spans = repeated_windows(keyed(docs), plan(length, q)).select(F.col("oid").alias("__oid"), F.col("mark").alias("__mark"), F.col("spans").alias("__spans"))
    tagged = marked(docs, "__oid", "__mark")
    out = tagged.join(spans, ["__oid", "__mark"], "left").withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(cut("text", "__spans")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__spans").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*docs.columns)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str]], length: int = LENGTH) -> dict[int, tuple[int, int, int, str]]:
    """The same by a set of all strings, for tests."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        out[doc_id] = len(data), int(gone.sum()), len(intervals(gone)), hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()
    return out
