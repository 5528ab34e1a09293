"""Substring dedup: Rabin-Karp hashes of windows of ``length`` words, compared in runs.

Not a count of every window, which would shuffle several times the input (README): windows are named by their smallest ``q``-word hash,
neighbouring windows of one name are one row with the Rabin-Karp hashes of the first and the last of them, and Spark sorts and compares
these rows; only where a name has different runs are its windows listed one by one, by two hashes each (see ``windows``). Windows that also start earlier merge into maximal removal intervals.

Nulls and texts without words: nothing is removed, kept text is empty. Repeated rows (same id, same
text) are one document and get the same result each. Rows of equal id but different text are ordered
by a hash of the text. Null ids come last. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import NO_ID, mix, random_table, table
from strandline.llm.windows import Plan, covered, intervals, keyed, with_spans

LENGTH, Q = 20, 7
_BYTE, _STEP = random_table(256, 6), np.uint64(0x5851F42D4C957F2D | 1)
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[0x20, 9, 10, 11, 12, 13]] = True


@lru_cache(8)
def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), modulo 2^64; n is a power of two, so few are kept."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _power(base: np.uint64, n: int) -> np.ndarray:
    return powers(int(base), 1 << max(1, n - 1).bit_length() if n > 1 else 2)[:n]


def word_symbols(text: str) -> np.ndarray:
    """A 64-bit identifier of each word."""
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    blank = _IS_BLANK[data]
    start = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    if not len(start):
        return np.empty(0, np.uint64)
    where = np.arange(len(data))
    begin = np.repeat(start, np.diff(np.append(start, len(data))))
    lead = start[0]
    value = _BYTE[data[lead:]] * _power(_STEP, int((where[lead:] - begin).max()) + 1)[where[lead:] - begin]
    value[blank[lead:]] = 0
    return mix(np.add.reduceat(value, start - lead))


def rolling(symbols: np.ndarray, base: np.uint64, *lengths: int) -> list[np.ndarray]:
    """Rabin-Karp hashes of all windows of each length: differences of prefix sums, brought to one exponent."""
    n = len(symbols)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(symbols * _power(base, n), out=total[1:])
    back = _power(np.uint64(pow(int(base), -1, 1 << 64)), n)
    return [mix((total[k:] - total[: n - k + 1]) * back[: n - k + 1]) for k in lengths]


def plan(length: int = LENGTH, q: int = Q) -> Plan:
    half, block = (length + 1) * 3 // 5, max(1, length // 5)
    return Plan(length, q, half, block, word_symbols, lambda x: rolling(x, _BASE[0], q, half, length), lambda x: rolling(x, _BASE[1], length)[0])


def dedup_words(docs: DataFrame, length: int = LENGTH, q: int = Q) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, removed, kept): removed holds [start, end) word intervals; kept the words left, joined by one space."""
    schema = "doc_id long, n_words long, n_removed long, removed array<array<long>>, kept string"

    def cut(batches):
        for pdf in batches:
            rows = []
            for oid, text, spans in zip(pdf["oid"], pdf["text"], pdf["spans"], strict=True):
                own = text.encode().split()
                gone = covered(spans, length, len(own))
                left = [w for w, g in zip(own, gone, strict=True) if not g] if gone.any() else own
                rows.append((oid, len(own), len(own) - len(left), intervals(gone).tolist(), b" ".join(left).decode()))
            yield type(pdf)(rows, columns=["doc_id", "n_words", "n_removed", "removed", "kept"])

    out = with_spans(keyed(docs), plan(length, q)).mapInPandas(cut, schema)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_words(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str]], length: int = LENGTH) -> dict[int, tuple[int, int, str]]:
    """The same by a dictionary of all windows, for tests."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        own = (text or "").encode().split()
        gone = [False] * len(own)
        for s in range(len(own) - length + 1):
            w = tuple(own[s : s + length])
            if w in seen:
                gone[s : s + length] = [True] * length
            seen.add(w)
        left = b" ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out[doc_id] = len(own), sum(gone), hashlib.sha256(left).hexdigest()
    return out
