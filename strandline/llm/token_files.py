"""Token ids of documents in ORC files, for training jobs that read them in parallel or look documents up.

Documents are dealt to files by ranges of their ids and sorted within, encoded, and written as rows of an ORC table:
Spark's writer stores integers run-length encoded, keeps minima and maxima of every ``STRIDE`` rows and of every stripe, and a
Bloom filter on ``doc_id``. A row has its document's ids with the end id, and where they start in the file; ``files`` is a
second table, one row a file with its number of ids, from which a row's place among all ids follows. So a reader takes the
stripes of a file in parallel, skips those that can't hold a document (``read``) or a stretch of the token stream
(``stretch``), and never needs the rows before them.

The vocabulary has word ends, and its pattern never crosses white space, so ids of a text are those of its words, and words that a worker has met are looked
up. New words of characters that every Unicode version classes alike go to a second, faster library with the same
merges, others to the first.

Null texts are empty and have the end id alone. Null ids come after all others; rows of one id are in the order of a hash of
their texts, repeated rows next to each other, each with ids of its own. An empty table gives files without rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage, new_folder, remove_folder
from strandline.llm.bpe import byte_of_char, few, vocabulary
from strandline.llm.common import order_id, table
from strandline.llm.token_counts import Counter
from strandline.llm.windows import text_mark

END, HELD = 2, 1_000_000
STRIPE, STRIDE = 16 << 20, 1000
#: The vocabulary's own pattern, with marks of ours between words. Fixed value.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}\x02]+")
#: Words of these characters are lower-cased and classed alike by every library.
_SURE = re.compile("[!-~\u00a1-\u012f\u0131-\u017f\u0400-\u045f]*")


class Ids(Counter):
    """Ids of texts, as little-endian 32-bit integers."""

    def __init__(self, path: str):
        import tiktoken

        super().__init__(path)
        file = json.loads(self.model.to_str())
        vocab, suffix, chars = file["model"]["vocab"], file["model"].get("end_of_word_suffix") or "", byte_of_char()
        pattern = file["pre_tokenizer"].get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex", "")
        joined = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in file["model"]["merges"]]
        self.quick = None
        # the ids of such vocabularies are the order of their merges; \x01 ends a piece, \x02 stands between words
        if suffix and pattern == PIECE.pattern.replace(r"\x02", "") and all(a < b for a, b in zip(joined, joined[1:], strict=False)):
            special = {t.content for t in self.model.get_added_tokens_decoder().values()}
            of = lambda t: bytes(chars[c] for c in t.removesuffix(suffix)) + b"\x01" * t.endswith(suffix)
            ranks = {of(t): i for t, i in vocab.items() if t not in special}
            self.parting = ranks[b"\x02"]
            self.quick = tiktoken.Encoding("own", pat_str=r"\x02|[^\x01\x02]+\x01", mergeable_ranks=ranks, special_tokens={})

    def new(self, words: list[str]) -> list[bytes]:
        """The ids of each word alone."""
        sure = self.quick is not None
        easy = {k for k, w in enumerate(words) if sure and _SURE.fullmatch(w) and "<|" not in w}
        out = [b"" if k in easy else np.array(self.model.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for k, w in enumerate(words)]
        if easy:
            order = sorted(easy)
            text = PIECE.sub("\\g<0>\x01", "\x02".join([words[k] for k in order]).lower())
            ids = np.asarray(self.quick.encode_to_numpy(text, disallowed_special=())).astype("<u4")
            ends = [*np.flatnonzero(ids == self.parting).tolist(), len(ids)]
            data, begin = ids.tobytes(), 0
            for k, end in zip(order, ends, strict=True):
                out[k] = data[4 * begin : 4 * end]
                begin = end + 1
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        words, held, new = [t.replace("\n", " ").split(" ") for t in texts], self.held, set()
        for own in words:
            new.update(own)
        asked = list(new.difference(held))
        if len(held) + len(asked) > HELD:  # keep what this batch uses
            self.held = held = {w: held[w] for w in new if w in held}
        held.update(zip(asked, self.new(asked), strict=True))
        return [b"".join(map(held.__getitem__, own)) for own in words]


@lru_cache(2)
def encoder(path: str) -> Ids:
    return Ids(path)


def write(docs: DataFrame, path: str, tokenizer: str, end: int = END, stripe: int = STRIPE, stride: int = STRIDE) -> None:
    """Writes the ids of docs (doc_id, text) below path: tables ``rows`` and ``files``."""
    last = np.array([end], "<u4").tobytes()

    def encoded(batches):
        own, number, start = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for whole in batches:
            for b in few(whole, 1 << 23):
                data = [x + last for x in own.encode(b.column("text").to_pylist())]
                n = np.array([len(x) >> 2 for x in data], np.int64)
                ends = np.concatenate(([0], np.cumsum(n)))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(data), "<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.full(len(n), number, np.int32)), pa.array(start + ends[:-1]), pa.array(n), ids], ["doc_id", "file", "start", "n_tokens", "ids"])
                start += int(ends[-1])

    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    order = ["__oid", "__mark", "__row"]  # the row's number lets copies of one row be split
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), order_id().alias("__oid"), F.col("doc_id").isNull().alias("__none"), text_mark(F.col("text")).alias("__mark"), F.monotonically_increasing_id().alias("__row"), text)
    order.insert(1, "__none")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    out = dealt.mapInArrow(encoded, "doc_id long, file int, start long, n_tokens long, ids array<int>")
    kept = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.stripe.size": str(stripe), "orc.row.index.stride": str(stride), "orc.rows.between.memory.checks": str(stride)}
    out.write.options(compression="zstd", **kept).orc(f"{path}/rows")
    rows_of = docs.sparkSession.read.orc(f"{path}/rows")
    files = rows_of.groupBy("file").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_ids"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    before = F.sum("n_ids").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1))  # one row a file
    files.withColumn("base", F.coalesce(before, F.lit(0))).write.orc(f"{path}/files")


def read(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of the documents; start counts from the first id of all. A condition on doc_id reaches the files' indexes and Bloom filters."""
    rows = spark.read.orc(f"{path}/rows")
    rows = rows if where is None else rows.filter(where)
    files = spark.read.orc(f"{path}/files").select("file", "base")
    return rows.join(files, "file").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")


def stretch(spark: SparkSession, path: str, first: int, stop: int) -> DataFrame:
    """Rows (doc_id, start, ids): the ids of the token stream from first on, up to stop, by document. Only the files and stripes that hold some are read."""
    held = spark.read.orc(f"{path}/files").filter((F.col("base") < stop) & (F.col("base") + F.col("n_ids") > first)).orderBy("base").select("file", "base").collect()  # as many as the stretch has files
    out = None
    for r in held:
        rows = spark.read.orc(f"{path}/rows").filter((F.col("file") == r.file) & (F.col("start") < stop - r.base) & (F.col("start") + F.col("n_tokens") > first - r.base))
        a = F.greatest(F.lit(first - r.base) - F.col("start"), F.lit(0))
        b = F.least(F.lit(stop - r.base) - F.col("start"), F.col("n_tokens"))
        own = rows.select("doc_id", (F.col("start") + a + r.base).alias("start"), F.slice("ids", (a + 1).cast("int"), (b - a).cast("int")).alias("ids"))
        out = own if out is None else out.unionAll(own)
    return spark.createDataFrame([], "doc_id long, start long, ids array<int>") if out is None else out


def checksums(rows: DataFrame) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) of rows that were read."""

    def each(batches):
        for b in batches:
            ids = b.column("ids")
            data, at = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B"), (4 * ids.offsets.to_numpy().astype(np.int64)).tolist()
            crc = [zlib.crc32(data[i:j]) for i, j in zip(at, at[1:], strict=False)]
            n = np.diff(np.array(at)) >> 2
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "ids").mapInArrow(each, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    write(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    out = cut_lineage(checksums(read(spark, path)))
    remove_folder(spark, path)
    return out


def brute_force(rows: list[tuple], tokenizer: str, end: int = END) -> list[tuple]:
    """(doc_id, start, n_tokens, ids_crc32) by the library alone, for rows of one text an id."""
    from tokenizers import Tokenizer

    model, start, out = Tokenizer.from_file(tokenizer), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*model.encode(text or "", add_special_tokens=False).ids, end]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out
