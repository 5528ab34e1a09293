"""BPE encoding and decoding with a public byte-level vocabulary, exactly as its library encodes whole texts.

A space between two characters that aren't white space always begins a new piece of the vocabulary's
pattern. Text without such a space that is longer than ``LEAF``, and documents longer than ``PART``, are encoded by tree
concatenation: halves are encoded on their own (the parts of a document as rows of their own, in
parallel), and at each join a window of tokens is encoded again and doubled until its first and last
tokens agree exactly with both sides. Tokens of a text are the right ones if each neighbouring pair is,
and every pair of the result stands inside one encoding.

Null texts are empty: no tokens, decoded to an empty text. Repeated rows get the same result each. The
vocabulary's path is a parameter; every worker opens it by that path. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import table

LEAF, PART, WINDOW, MARGIN = 1 << 12, 1 << 16, 8, 16
_CUT = re.compile(r" (?<=\S )(?=\S)")


def byte_of_char() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: The pattern of byte-level vocabularies of this kind, as the second library takes it. Fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of characters that every Unicode version classes alike, and none of the special tokens, go to the faster library.
_OTHER = re.compile("[^\x00-\u04ff]")


def check_kind(file: dict) -> None:
    """Fails for vocabularies that ``PATTERN`` doesn't split as their own file says, or whose ids aren't the order of their merges."""
    split, model = file.get("pre_tokenizer") or {}, file["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    joined = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model.get("merges", [])]
    if not plain or file.get("normalizer") or model.get("ignore_merges") or any(a >= b for a, b in zip(joined, joined[1:], strict=False)):
        raise ValueError("not a byte-level vocabulary of the kind that this operator encodes")


class Codec:
    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        check_kind(json.loads(self.model.to_str()))
        chars, special = byte_of_char(), {t.content for t in self.model.get_added_tokens_decoder().values()}
        self.bytes_of = [b""] * self.model.get_vocab_size()
        for token, i in self.model.get_vocab().items():
            self.bytes_of[i] = token.encode() if token in special else bytes(chars[c] for c in token)
        self.special = re.compile("|".join(map(re.escape, sorted(special)))) if special else None
        # the ids of such vocabularies are the order of their merges, which is what the other library takes
        self.ranks = {t: i for i, t in enumerate(self.bytes_of) if t.decode("utf-8", "replace") not in special}
        self.quick = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def unsplit(self, text: str, leaf: int | None = None) -> np.ndarray:
        """Ids of a text that may have no place to cut it: halves, joined."""
        if len(text) <= (leaf or LEAF):
            return self.whole(text)
        half = len(text) // 2
        return self.joined(self.unsplit(text[:half], leaf), self.unsplit(text[half:], leaf))

    def joined(self, left: np.ndarray, right: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """The ids of the whole from those of its two parts."""
        k = window
        while len(left) and len(right):
            i, j = max(0, len(left) - k), min(len(right), k)
            while i and self.bytes_of[left[i]][0] & 0xC0 == 0x80:
                i -= 1
            while j < len(right) and self.bytes_of[right[j]][0] & 0xC0 == 0x80:
                j += 1
            new = self.whole(self.text([*left[i:].tolist(), *right[:j].tolist()]))
            if (i == 0 or self._agree(new, left[i:])) and (j == len(right) or self._agree(new[::-1], right[:j][::-1])):
                return np.concatenate((left[:i], new, right[j:]))
            k *= 2
        return left if len(left) else right

    def _agree(self, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether both begin with the same tokens, two at least, of MARGIN bytes or more."""
        size = 0
        for n, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=False)):
            if x != y:
                return False
            size += len(self.bytes_of[x])
            if n and size >= MARGIN:
                return True
        return False

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return [self.cut(t) if len(t) > LEAF and max(map(len, t.split(" "))) > LEAF else self.whole(t) for t in texts]

    def whole(self, text: str) -> np.ndarray:
        if _OTHER.search(text) or self.special and self.special.search(text):
            return np.array(self.library([text])[0], np.int32)
        return np.asarray(self.quick.encode_to_numpy(text, disallowed_special=())).astype(np.int32)

    def cut(self, text: str) -> np.ndarray:
        """The ids of a text with words longer than LEAF: between cuts that are sure, the words by trees and the rest as it is."""
        out, held = [], ""
        first, *rest = _CUT.split(text)
        for w in [first, *[" " + w for w in rest]]:
            if len(w) > LEAF:
                out += [self.whole(held)] * bool(held) + [self.unsplit(w)]
                held = ""
            else:
                held += w
        return np.concatenate([*out, *[self.whole(held)] * bool(held)])

    def text(self, ids) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> Codec:
    return Codec(path)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, np.empty(0, np.int32)]), pa.int32()))


def few(batch: pa.RecordBatch, most: int = 1 << 22):
    """Parts of a batch of at most so many bytes, or one row."""
    ends = np.cumsum([len(x.as_buffer() or b"") if x.is_valid else 0 for x in batch.column("text")]) if batch.num_rows else []
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield batch.slice(a, b - a)
        a = b


def long_parts(rows: DataFrame, keys: list[str], size: int, overlap: int) -> tuple[DataFrame, str]:
    """The texts longer than ``size`` in parts, one row each, dealt out evenly, and the types of the columns that tell texts and parts apart. Repeated rows are one text and a count."""
    long = rows.filter(F.length("text") > size).groupBy(*keys, F.xxhash64("text").alias("__mark"), F.sha2("text", 256).alias("__sha")).agg(F.count("*").alias("__n"), F.first("text").alias("text"))
    starts = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / size).cast("int"))
    parts = F.posexplode(F.transform(starts, lambda i: F.substring("text", i * size + 1, F.lit(size + overlap))))
    return long.select(*keys, "__mark", "__sha", "__n", parts.alias("__part", "text")).repartition(*keys, "__mark", "__part"), "__mark long, __sha string, __n long, __part int"


def repeated(whole: DataFrame) -> DataFrame:
    return whole.withColumn("__row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))))


def encode(docs: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Rows (*keys, ids, decoded) of all rows of docs; the text column is text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keys, text.alias("text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def ids_of(batches, decoded=True):
        own = codec(path)
        for whole in batches:
            for b in few(whole):
                ids = own.batch(b.column("text").to_pylist())
                columns = [*[b.column(k) for k in b.schema.names if k != "text"], _lists(ids)]
                names = [*[k for k in b.schema.names if k != "text"], "ids"]
                if decoded:
                    columns.append(pa.array([own.text(x.tolist()) for x in ids], pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)

    def joined_ids(batches):
        own = codec(path)
        for b in batches:
            out = []
            for parts in b.column("parts"):
                ids = [p["ids"].values.to_numpy() for p in parts]
                while len(ids) > 1:
                    ids = [own.joined(*ids[k : k + 2]) if k + 1 < len(ids) else ids[k] for k in range(0, len(ids), 2)]
                out.append(ids[0])
            rest = [k for k in b.schema.names if k != "parts"]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], _lists(out), pa.array([own.text(x.tolist()) for x in out], pa.string())], [*rest, "ids", "decoded"])

    short = rows.filter(F.length("text") <= PART).mapInArrow(ids_of, f"{types}, ids array<int>, decoded string")
    parts, of = long_parts(rows, keys, PART, 0)
    parts = parts.mapInArrow(lambda b: ids_of(b, False), f"{types}, {of}, ids array<int>")
    tree = parts.groupBy(*keys, "__mark", "__sha", "__n").agg(F.array_sort(F.collect_list(F.struct("__part", "ids"))).alias("parts"))
    whole = tree.mapInArrow(joined_ids, f"{types}, {of.replace(', __part int', '')}, ids array<int>, decoded string")
    return short.unionAll(repeated(whole).select(*keys, "ids", "decoded"))


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), ["doc_id"])
    return digests(out)


def digests(encoded: DataFrame) -> DataFrame:
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256) if isinstance(c, str) else F.sha2(c.cast("binary"), 256)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sha(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"), sha("decoded").alias("decoded_sha256"))
