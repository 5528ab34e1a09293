"""Ranked lexical search by k2-treaps over the term-document grid.

Documents are indexed in shards, the stretches of a partition that hold about ``TOKENS`` terms. A shard is a grid of its terms (rows, the frequent
ones first) by its documents (columns), stored as a quadtree: a cell that holds nothing isn't there, every other one has four bits that say which of its quarters are,
and the maximum of the impacts below it, as the difference from the cell above. An impact is the part of a
score that document and term frequency give; a term's weight multiplies it when a query comes, so the index serves any weights.

A search walks down the row paths of all terms of an item together: a range of documents is bounded by the sum
of weight times maximum over the cells that the item's terms have there. The ranges with the highest bounds are split first, many at
once as numpy rows, until the k-th best score is above every bound left; ranges with an equal bound are still split, so ties
go by the smaller id. A task carries each item's best from shard to shard, and only these leave it.

Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. Null, empty and term-less
texts are no documents of the collection, and such items find nothing. Null ids order last; every one of repeated rows is a document,
and repeated items are ranked each. An empty table ranks nothing. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage, new_folder, remove_folder
from strandline.llm.bpe import few
from strandline.llm.common import NO_ID, order_id, table

#: Terms of a shard; a longer document is a shard of its own.
TOKENS, DOCS, K, BATCH = 1 << 21, 1 << 14, 10, 64
#: Items of one block, and terms of all blocks up to which they are broadcast.
BLOCK, BROADCAST_TERMS = 1 << 10, 1 << 21
#: Items whose best rows a task holds before it passes them on.
HELD = 1 << 16
_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_COUNT = np.array([bin(x).count("1") for x in range(16)], np.int8)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def collection(docs: DataFrame) -> DataFrame:
    """One row (N, L): the documents with terms and all their terms."""

    def each(batches):
        for b in batches:
            n = [len(terms(x.as_py())) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(bool, n))], pa.int64()), pa.array([sum(n)], pa.int64())], ["n_docs", "n_terms"])

    own = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(each, "n_docs long, n_terms long")
    return own.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("N"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("L"))


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers at the even places of 64."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


def grid(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray, height: int) -> tuple[np.ndarray, np.ndarray]:
    """The quadtree of distinct points: four bits for each inner cell and maxima as differences from the cell above, both level by level."""
    code = (_spread(rows) << np.uint64(1)) | _spread(columns)
    order = np.argsort(code, kind="stable")
    code, top = code[order], impacts[order].astype(np.int64)
    bits, less = [], []
    for _ in range(height):
        up = code >> np.uint64(2)
        first = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
        above = np.maximum.reduceat(top, first)
        less.append(np.repeat(above, np.diff(np.append(first, len(code)))) - top)
        bits.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), first))
        code, top = up[first], above
    less.append(top)
    return np.concatenate([np.empty(0, np.uint8), *bits[::-1]]), np.concatenate(less[::-1])


class Treap:
    """A shard's quadtree with its cells numbered level by level; cell ``none`` stands for all that aren't there."""

    def __init__(self, bits: np.ndarray, less: np.ndarray, height: int):
        self.height, self.none = height, len(less)
        own = _COUNT[bits].astype(np.int64)
        self.first = np.zeros(len(less) + 1, np.int32)
        self.first[: len(bits)] = 1 + np.cumsum(own) - own
        self.bits = np.zeros(len(less) + 1, np.uint8)
        self.bits[: len(bits)] = bits
        self.top = np.zeros(len(less) + 1, np.int64)
        self.top[0], a, b = less[0] if len(less) else 0, 0, 1
        while b < len(less):  # the level after cells a .. b
            n = int(own[a:b].sum())
            self.top[b : b + n] = np.repeat(self.top[a:b], own[a:b]) - less[b : b + n]
            a, b = b, b + n

    def best(self, rows: np.ndarray, weights: np.ndarray, k: int, best: list, order: list) -> list:
        """The k best (-score, order, column) of ``best`` and the columns of the grid."""
        bound = np.array([int((self.top[0] * weights).sum())])
        level, column, cells = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int32)
        batch = BATCH
        while True:
            least = -best[k - 1][0] if len(best) >= k else 1
            keep = bound >= least
            if not keep.any():
                return best
            if not keep.all():
                bound, level, column, cells = bound[keep], level[keep], column[keep], cells[keep]
            if len(bound) > batch:
                at = np.argpartition(-bound, batch)
                now, rest = at[:batch], at[batch:]
                held = bound[rest], level[rest], column[rest], cells[rest]
                bound, level, column, cells = bound[now], level[now], column[now], cells[now]
            else:
                held = None
            batch = min(2 * batch, 1 << 12)
            done = level == self.height
            if done.any():
                scores, at = bound[done], column[done]
                if len(scores) > k:
                    high = scores >= np.partition(scores, -k)[-k]
                    scores, at = scores[high], at[high]
                found = [(-s, order[c], c) for s, c in zip(scores.tolist(), at.tolist(), strict=True)]
                best = sorted([*best, *found], key=lambda x: x[:2])[:k]
                bound, level, column, cells = bound[~done], level[~done], column[~done], cells[~done]
            new = [held] if held else []
            if len(bound):
                side = ((rows[None, :] >> (self.height - 1 - level)[:, None]) & 1).astype(np.uint8) << 1
                bits, first = self.bits[cells], self.first[cells]
                for half in (0, 1):
                    q = side | half
                    down = np.where(bits >> q & 1, first + _COUNT[bits & ((1 << q) - 1).astype(np.uint8)], self.none).astype(np.int32)
                    sums = self.top[down] @ weights
                    some = sums > 0
                    new.append((sums[some], level[some] + 1, 2 * column[some] + half, down[some]))
            if not new:
                return best
            bound, level, column, cells = (np.concatenate(x) for x in zip(*new, strict=True))


SHARD = "shard long, height int, doc_ids array<long>, terms array<string>, counts array<int>, bits binary, less binary"


def shards(docs: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """Rows of ``SHARD``: every document with terms is in one shard. ``counts`` has the documents of each term; its place is its row in the grid."""

    def made(held, number):
        vocab: dict = defaultdict()
        vocab.default_factory = vocab.__len__
        codes = np.array([vocab[w] for _, own in held for w in own], np.int64)
        sizes = np.array([len(own) for _, own in held], np.int64)
        pairs, tf = np.unique(np.repeat(np.arange(len(held)), sizes) * len(vocab) + codes, return_counts=True)
        column, code = np.divmod(pairs, len(vocab))
        m = 10 + (90 * sizes * n_docs) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[column])
        counts = np.bincount(code, minlength=len(vocab))
        place = np.argsort(-counts, kind="stable")
        row = np.empty(len(vocab), np.int64)
        row[place] = np.arange(len(vocab))
        height = max(len(vocab) - 1, len(held) - 1).bit_length()
        bits, less = grid(row[code], column, impact, height)
        names = np.array(list(vocab), dtype=object)[place]
        packed = (bits[::2] << 4 | np.append(bits[1::2], np.zeros(len(bits) % 2, np.uint8))).tobytes()
        values = [[number], [height], [[i for i, _ in held]], [[w.decode() for w in names]], [counts[place].tolist()], [packed], [zlib.compress(less.astype("<u4").tobytes(), 1)]]
        types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], ["shard", "height", "doc_ids", "terms", "counts", "bits", "less"])

    def each(batches):
        from pyspark import TaskContext

        held, size, number = [], 0, TaskContext.get().partitionId() << 32
        for whole in batches:
            for b in few(whole):
                for i, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                    own = terms(text.as_py())
                    if held and (size + len(own) > TOKENS or len(held) == DOCS):
                        yield made(held, number)
                        held, size, number = [], 0, number + 1
                    if own:
                        held.append((i, own))
                        size += len(own)
        if held:
            yield made(held, number)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(each, SHARD)


def build(docs: DataFrame, path: str) -> None:
    """Writes the index of docs (doc_id, text) below path: tables ``shards`` and ``collection``."""
    size = collection(docs)
    size.write.parquet(f"{path}/collection")
    n, length = docs.sparkSession.read.parquet(f"{path}/collection").first()
    shards(docs, n, max(length, 1)).write.option("compression", "zstd").parquet(f"{path}/shards")


def search(spark: SparkSession, path: str, items: DataFrame, k: int = K) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): the k best documents of the index for each row of items (item_id, text)."""
    whole = spark.read.parquet(f"{path}/shards")
    n = spark.read.parquet(f"{path}/collection").first()["N"]

    def listed(batches):
        for b in batches:
            own = [sorted(set(terms(x.as_py()))) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("item"), pa.array([[w.decode() for w in x] for x in own], pa.list_(pa.string()))], ["item", "terms"])

    items = items.select("item_id", F.col("text").cast("string").alias("text"))
    asked = cut_lineage(items.select("item_id", F.monotonically_increasing_id().alias("item"), "text"))  # a row of items is an item
    named = cut_lineage(asked.select("item", "text").mapInArrow(listed, "item long, terms array<string>").select("item", F.explode("terms").alias("term")))
    wanted = named.select("term").distinct()
    counts = whole.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.counts").alias("df"))
    df = counts.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.ln((2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = cut_lineage(named.join(df.select("term", weight.alias("w")).filter("w > 0"), "term"))
    size = weighted.agg(F.count("*"), F.count_distinct("item")).first()
    blocks = weighted.groupBy("item").agg(F.collect_list(F.struct("term", "w")).alias("x")).groupBy(F.pmod(F.xxhash64("item"), F.lit(-(-size[1] // BLOCK) or 1)).alias("block")).agg(F.collect_list(F.struct("item", "x")).alias("items"))
    pairs = whole.drop("counts").crossJoin(F.broadcast(blocks) if size[0] <= BROADCAST_TERMS else blocks)  # the query set in blocks

    def found(batches):
        best: dict[int, list] = {}
        last = treap = row = ids = None

        def passed():
            flat = [(i, d, -s) for i, own in best.items() for s, _, d in own]
            best.clear()
            columns = list(zip(*flat, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

        for b in batches:
            for i in range(b.num_rows):
                shard, items_ = b.column("shard")[i].as_py(), b.column("items")[i].as_py()
                if shard != last:
                    last, ids = shard, b.column("doc_ids")[i].as_py()
                    row = {w: j for j, w in enumerate(b.column("terms")[i].as_py())}
                    packed = np.frombuffer(b.column("bits")[i].as_py(), np.uint8)
                    less = np.frombuffer(zlib.decompress(b.column("less")[i].as_py()), "<u4").astype(np.int64)
                    bits = np.stack((packed >> 4, packed & 15), axis=1).reshape(-1)
                    treap = Treap(bits[:-1] if len(bits) and not bits[-1] else bits, less, b.column("height")[i].as_py())
                    order = [NO_ID if x is None else x for x in ids]
                for it in items_:
                    mine = [(row[x["term"]], x["w"]) for x in it["x"] if x["term"] in row]
                    if mine:
                        rows, weights = (np.array(v, np.int64) for v in zip(*mine, strict=True))
                        old = [(s, o, ("old", d)) for s, o, d in best.get(it["item"], [])]
                        new = treap.best(rows, weights, k, old, order)
                        best[it["item"]] = [(s, o, c[1] if isinstance(c, tuple) else ids[c]) for s, o, c in new]
                if len(best) > HELD:
                    yield passed()
        yield passed()

    near = pairs.mapInArrow(found, "item long, doc_id long, score long").withColumn("__oid", order_id())
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), "__oid"))
    ranked = near.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "lexical-index")
    build(table(spark, sf_dir, "documents"), path)
    out = cut_lineage(search(spark, path, table(spark, sf_dir, "benchmark")))
    remove_folder(spark, path)
    return out


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""WITH d AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents), g AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1), c AS (SELECT count(*) AS N_, sum(n)::BIGINT AS L_ FROM g),
i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark)), t AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * N_ + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, c GROUP BY term, N_),
s AS (SELECT i.item_id, t.doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * g.n * c.N_) // c.L_))))::BIGINT AS score FROM i JOIN t USING (term) JOIN w USING (term) JOIN g ON g.doc_id = t.doc_id, c GROUP BY 1, 2)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= {K}"""


def brute_force(docs: list[tuple], items: list[tuple], k: int = K) -> dict:
    """item_id to its ranked (doc_id, score), over all pairs."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = {}
    for item, text in items:
        own = set(terms(text))
        scored = []
        for i, c in counted:
            m = 10 + 90 * c.total() * n // total
            score = sum(floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score:
                scored.append((-score, i is None, i or 0, i))
        out[item] = [(i, -s) for s, _, _, i in sorted(scored)[:k]]
    return out
