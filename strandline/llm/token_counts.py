"""Token counts of whole texts with a public vocabulary, exactly as its library gives them.

The vocabulary's pattern never crosses a space, so counts add up over words, and words that a worker has
met are looked up. Documents longer than ``CHUNK`` are counted by overlap resynchronisation: overlapping
chunks, rows of their own, are encoded with offsets, and neighbours are spliced inside their overlap. A
sequence of tokens is the right one if each neighbouring pair is, so a splice is proven where both chunks
have the same token at the same place, right after white space or after another such token: the pairs before
it stand in the one encoding and those after it in the other. Where an overlap has no such place, it is
widened to the two chunks, which are encoded as one; chunks meet in a tree, so a text without
any such place (one letter, repeated) is encoded a logarithmic number of times.

Null texts are empty. Repeated rows get the same result each. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.bpe import few, long_parts, repeated, vocabulary
from strandline.llm.common import table

CHUNK, OVERLAP, LIMIT, HELD, TOGETHER = 1 << 16, 256, 2048, 300_000, 2000
#: White space of the vocabulary's pattern: the Unicode property.
SPACE = frozenset(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def check_kind(file: dict) -> None:
    """Fails for vocabularies whose pieces aren't what a pattern matches, with what stands between left out: only there a space parts tokens for sure."""
    split = file.get("pre_tokenizer") or {}
    parts = split.get("pretokenizers", [split])
    pattern = parts[0].get("pattern", {}).get("Regex", "") if parts else ""
    if parts[0].get("type") != "Split" or parts[0].get("behavior") != "Removed" or not parts[0].get("invert") or re.search(pattern.replace("\\p{L}", "a-z").replace("\\p{N}", "0-9"), " "):
        raise ValueError("not a vocabulary of the kind that this operator counts")


class Counter:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        check_kind(json.loads(self.model.to_str()))
        special = {t.content: i for i, t in self.model.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, sorted(special)))) if special else None
        self.between, self.mark = max(special.items(), key=lambda x: x[1]) if special else (None, None)
        self.held: dict[str, int] = {}

    def counts(self, words: list[str]) -> list[int]:
        """Of each word alone. Words stand in one text with a special token between them, which nothing reaches across."""
        out: list[int] = []
        for a in range(0, len(words), TOGETHER):
            part = words[a : a + TOGETHER]
            text = self.between.join(part) if self.between else ""
            if not self.between or len(self.special.findall(text)) != len(part) - 1:  # words with such tokens of their own
                out += [len(self.model.encode(w, add_special_tokens=False).ids) for w in part]
                continue
            ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            ends = np.concatenate((np.flatnonzero(ids == self.mark), [len(ids)]))
            out += (np.diff(ends, prepend=-1) - 1).tolist()
        return out

    def batch(self, texts: list[str]) -> list[int]:
        words, held, new = [t.split(" ") for t in texts], self.held, set()
        for own in words:
            new.update(own)
        if len(held) + len(new) > HELD:  # keep what this batch uses
            self.held = held = {w: held[w] for w in new if w in held}
        asked = [w for w in new if w not in held]
        held.update(zip(asked, self.counts(asked), strict=True))
        return [sum([held[w] for w in own]) for own in words]

    def chunk(self, text: str, begin: int, overlap: int) -> Chunk:
        """The encoding of a text that stands at ``begin`` of its document: its tokens at either end, ``overlap`` characters deep."""
        e = self.model.encode(text, add_special_tokens=False)
        at, ids = np.array(e.offsets, np.int64).reshape(-1, 2), np.array(e.ids, np.int64)
        # tokens that share a character stand together, as their offsets don't tell them apart
        new = np.ones(len(ids), bool)
        new[1:] = at[1:, 0] >= np.maximum.accumulate(at[:, 1])[:-1]
        first = np.flatnonzero(new)
        if not len(first):
            return Chunk(begin, begin + len(text), 0, np.empty((0, 5), np.int64), np.empty((0, 5), np.int64))
        place = np.arange(len(ids)) - np.repeat(first, np.diff(np.append(first, len(ids))))
        with np.errstate(over="ignore"):
            names = np.add.reduceat((ids + 1) * np.int64(0x9E3779B97F4A7C1) ** place, first)
        start, end = at[first, 0], np.maximum.reduceat(at[:, 1], first)
        blank = np.fromiter((k > 0 and text[k - 1] in SPACE for k in start.tolist()), bool, len(first))
        tokens = np.column_stack((start + begin, end + begin, names, first, blank))
        head, tail = start < overlap, start >= len(text) - overlap
        return Chunk(begin, begin + len(text), len(ids), tokens[head], tokens[tail])

    def spliced(self, text: str, chunks: list[Chunk], overlap: int = OVERLAP) -> int:
        """The number of tokens of a text from its chunks, each of which overlaps the next."""
        while len(chunks) > 1:
            pairs = [chunks[k : k + 2] for k in range(0, len(chunks), 2)]
            chunks = [spliced_pair(*p) or self.chunk(text[p[0].begin : p[1].stop], p[0].begin, overlap) if len(p) > 1 else p[0] for p in pairs]
        return chunks[0].n


class Chunk(NamedTuple):
    begin: int
    stop: int
    n: int
    head: np.ndarray  # rows (start, end, name, number in the chunk, whether white space stands before) of tokens, or of those that share characters
    tail: np.ndarray


def spliced_pair(left: Chunk, right: Chunk) -> Chunk | None:
    """Both chunks as one, spliced at a token that both have; None if their overlap has no place for it."""
    mine = {(a, b, i): (k, blank) for a, b, i, k, blank in left.tail.tolist()}
    before = None  # how far the numbers of the last common token are apart
    for a, b, i, k, blank in right.head.tolist():
        met = mine.get((a, b, i))
        shift = met[0] - k if met else None
        if met and (blank and met[1] or before == shift):
            return Chunk(left.begin, right.stop, right.n + shift, left.head, right.tail + np.array([0, 0, 0, shift, 0]))
        before = shift
    return None


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Rows (*keys, n_bytes, n_tokens) of all rows of docs."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(*keys, F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def counted(batches):
        own = counter(path)
        for whole in batches:
            for b in few(whole, 1 << 21):
                rest = [k for k in b.schema.names if k != "text"]
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], pa.array(own.batch(b.column("text").to_pylist()), pa.int64())], [*rest, "n_tokens"])

    def offsets(batches):
        own = counter(path)
        for b in batches:
            found = [own.chunk(x.as_py(), k.as_py() * CHUNK, OVERLAP) for x, k in zip(b.column("text"), b.column("__part"), strict=True)]
            rest = [k for k in b.schema.names if k != "text"]
            own_text = pa.array([x.as_py()[:CHUNK] for x in b.column("text")], pa.string())
            sizes = [pa.array([getattr(f, k) for f in found], pa.int64()) for k in ("begin", "stop", "n")]
            ends = [pa.array([getattr(f, k).reshape(-1) for f in found], pa.list_(pa.int64())) for k in ("head", "tail")]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], own_text, *sizes, *ends], [*rest, "own", *Chunk._fields])

    def spliced(batches):
        own = counter(path)
        for b in batches:
            tokens = lambda x: np.array(x, np.int64).reshape(-1, 5)
            n = [own.spliced("".join([c["own"] for c in doc]), [Chunk(c["begin"], c["stop"], c["n"], tokens(c["head"]), tokens(c["tail"])) for c in doc]) for doc in map(lambda x: x.as_py(), b.column("chunks"))]
            rest = [k for k in b.schema.names if k != "chunks"]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], pa.array(n, pa.int64())], [*rest, "n_tokens"])

    short = rows.filter(F.length("text") <= CHUNK).mapInArrow(counted, f"{types}, n_tokens long")
    parts, of = long_parts(rows, [*keys, "n_bytes"], CHUNK, OVERLAP)
    each = parts.mapInArrow(offsets, f"{types}, {of}, own string, begin long, stop long, n long, head array<long>, tail array<long>")
    docs_of = each.groupBy(*keys, "n_bytes", "__mark", "__sha", "__n").agg(F.array_sort(F.collect_list(F.struct("__part", "own", *Chunk._fields))).alias("chunks"))
    whole = docs_of.mapInArrow(spliced, f"{types}, {of.replace(', __part int', '')}, n_tokens long")
    return short.unionAll(repeated(whole).select(*keys, "n_bytes", "n_tokens"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), ["doc_id"])
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
