"""Language-model scoring by masked pseudo-likelihood.

A window network predicts every word from the two words on either side of it, never from itself: their
embeddings, one hidden layer, and a softmax in two steps, over classes and over the members of a class,
so probabilities add up to one over all ``CLASSES * MEMBERS`` entries. A document's score is the sum
of the conditional log-probabilities of its words.

The vocabulary comes from counts of all words of the corpus. The ``OWN`` most frequent have entries of their own;
the others share hashed entries, and the probability of an entry is split among its words by their counts, with one
count more for each and one for all words never seen. Counts of words are a table: it grows with the corpus and is
joined, and only the frequent words and the totals of the shared entries reach the driver.

The network is trained in numpy on every document: documents are dealt to trainers by a hash of id and text (so that
copies of one text are spread), one trainer for each ``2 ** SHARE`` words of the corpus and a few in any case, so that neither the cluster nor its
partitions change the result. Each takes steps from common weights on its own documents, and Spark averages the weights,
by numbers of words. Half of the documents train the first round and half the second.

Words are told apart by a hash of their lower-cased UTF-8. Null and blank texts have no words and score 0.
Repeated rows get the same result each. Other columns are ignored.
"""

from __future__ import annotations

from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.llm.common import table
from strandline.llm.substring_dedup import word_symbols

CLASSES, MEMBERS, SIDE, EMBED, HIDDEN = 32, 32, 2, 24, 32
BUCKETS, ROUNDS, STEP, RATE, SEED, SCALE = CLASSES * MEMBERS, 2, 2048, 0.1, 3, 1 << 16
OWN, LARGE = 768, 60
SHARE, LEAST, FEW = 21, 14, 8  # words of a trainer in both rounds, as powers of two; up to so many trainers do with the lesser number
SHARED, FINE, TABLE = BUCKETS - OWN, 1 << 30, 20
SHAPES = {"e": (BUCKETS + 1, EMBED), "w": (2 * SIDE * EMBED, HIDDEN), "b": (HIDDEN,), "c": (HIDDEN, CLASSES), "cb": (CLASSES,), "m": (HIDDEN, MEMBERS), "mb": (CLASSES, MEMBERS)}


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[k], at = flat[at : at + n].reshape(shape), at + n
    return out


def initial() -> np.ndarray:
    r = np.random.Generator(np.random.PCG64(SEED))
    parts = [r.normal(0, {"e": 0.3}.get(k, shape[0] ** -0.5), shape) if k in "ewcm" else np.zeros(shape) for k, shape in SHAPES.items()]
    return np.concatenate([p.reshape(-1) for p in parts]).astype(np.float32)


class Model(NamedTuple):
    flat: np.ndarray
    frequent: np.ndarray  # symbols of the words with entries of their own, the most frequent first
    norms: np.ndarray  # of each shared entry: the logarithm of its words' counts, one count more for each and one
    counts: DataFrame  # (symbol, n) of all words


def symbols(text: str | None) -> np.ndarray:
    return word_symbols((text or "").encode().lower().decode("utf-8", "replace"))


class Entries:
    """The entry of each symbol. Frequent symbols stand in a table by their first bits; the few that share a slot are looked for in order."""

    def __init__(self, frequent: np.ndarray):
        self.order = np.argsort(frequent)
        self.frequent = frequent
        slots = (frequent >> np.uint64(64 - TABLE)).astype(np.int64)
        self.table = np.full(1 << TABLE, -1, np.int16)
        self.table[slots] = np.arange(len(frequent), dtype=np.int16)
        slot, n = np.unique(slots, return_counts=True)
        self.table[slot[n > 1]] = -2

    def __call__(self, own: np.ndarray) -> np.ndarray:
        out = (OWN + (own >> np.uint64(54)) % np.uint64(SHARED)).astype(np.int32)
        if len(self.frequent):
            at = self.table[own >> np.uint64(64 - TABLE)]
            met = np.flatnonzero(at >= 0)
            met = met[self.frequent[at[met]] == own[met]]
            out[met] = at[met]
            several = np.flatnonzero(at == -2)
            if len(several):
                near = self.order[np.minimum(np.searchsorted(self.frequent, own[several], sorter=self.order), len(self.frequent) - 1)]
                known = self.frequent[near] == own[several]
                out[several[known]] = near[known]
        return out


def counted(docs: DataFrame) -> DataFrame:
    """Rows (symbol, n) of all words of docs."""

    def each(batches):
        for b in batches:
            own = pa.array(np.concatenate([symbols(x.as_py()) for x in b.column("text")] or [np.empty(0, np.uint64)]).view(np.int64)).value_counts()
            yield pa.RecordBatch.from_arrays([own.field("values"), own.field("counts")], ["symbol", "n"])

    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(each, "symbol long, n long")
    return cut_lineage(rows.groupBy("symbol").agg(F.sum("n").alias("n")))


def vocabulary(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent symbols and norms, from rows (symbol, n)."""
    top = counts.orderBy(F.desc("n"), "symbol").limit(OWN).collect()
    frequent = np.array([r.symbol for r in top], np.int64).view(np.uint64)
    bucket = F.shiftrightunsigned("symbol", 54) % SHARED
    totals = np.ones(SHARED)
    for r in counts.groupBy(bucket.alias("bucket")).agg((F.sum("n") + F.count("*")).alias("n")).collect():  # as many rows as shared entries
        totals[r.bucket] += r.n
    for r in top:
        totals[((int(r.symbol) & (1 << 64) - 1) >> 54) % SHARED] -= r.n + 1
    return frequent, np.log(totals)


def contexts(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Every word of the documents, and the words on either side; beyond a document's ends stands a bucket of its own."""
    edge = np.full(SIDE, BUCKETS, np.int32)
    line = np.concatenate([x for own in ids for x in (own, edge)] or [edge])
    line = np.concatenate((edge, line))
    at = np.flatnonzero(line != BUCKETS)
    around = np.array([k for k in range(-SIDE, SIDE + 1) if k])
    return line[at], line[at[:, None] + around]


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)  # of short rows several times as fast as sum()


def _softmax(x: np.ndarray) -> np.ndarray:
    np.exp(np.clip(x, -60, 60, out=x), out=x)
    x /= _row_sums(x)[:, None]
    return x


def forward(p: dict[str, np.ndarray], words: np.ndarray, around: np.ndarray):
    x = p["e"].take(around.reshape(-1), axis=0).reshape(len(words), 2 * SIDE * EMBED)
    h = np.tanh(x @ p["w"] + p["b"])
    kind = words // MEMBERS
    return x, h, kind, _softmax(h @ p["c"] + p["cb"]), _softmax(h @ p["m"] + p["mb"].take(kind, axis=0))


class Scorer:
    """Log-probabilities under fixed weights: the first layer is worked out once for every entry at every place."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p
        self.places = [p["e"] @ p["w"][k * EMBED : (k + 1) * EMBED] for k in range(2 * SIDE)]
        # hidden units are within one of zero, which bounds the logits; small ones need no shift before exp
        self.shift = [np.abs(p[k]).sum(axis=0).max() + np.abs(p[b]).max() > LARGE for k, b in (("c", "cb"), ("m", "mb"))]

    def __call__(self, words: np.ndarray, around: np.ndarray) -> np.ndarray:
        p, rows, kind = self.p, np.arange(len(words)), words // MEMBERS
        h = self.places[0].take(around[:, 0], axis=0) + p["b"]
        for k in range(1, 2 * SIDE):
            h += self.places[k].take(around[:, k], axis=0)
        np.tanh(h, out=h)
        out = np.zeros(len(words), h.dtype)
        for x, at, shift in ((h @ p["c"] + p["cb"], kind, self.shift[0]), (h @ p["m"] + p["mb"].take(kind, axis=0), words % MEMBERS, self.shift[1])):
            if shift:
                x -= x.max(axis=1)[:, None]
            out += x[rows, at]
            out -= np.log(_row_sums(np.exp(x, out=x)))
        return out


def log_probability(p: dict[str, np.ndarray], words: np.ndarray, around: np.ndarray) -> np.ndarray:
    return Scorer(p)(words, around)


def _by_row(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows of values by index."""
    out = np.zeros((n, values.shape[1]), np.float32)
    order = np.argsort(index.astype(np.int16), kind="stable")  # 16 bits: a radix sort
    own = index[order]
    start = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
    out[own[start]] = np.add.reduceat(values.take(order, axis=0), start, axis=0)
    return out


def gradient(p: dict[str, np.ndarray], words: np.ndarray, around: np.ndarray) -> np.ndarray:
    """Of the mean negative log-probability."""
    n, rows = len(words), np.arange(len(words))
    x, h, kind, pc, pm = forward(p, words, around)
    pc[rows, kind] -= 1
    pm[rows, words % MEMBERS] -= 1
    pc /= n
    pm /= n
    z = (pc @ p["c"].T + pm @ p["m"].T) * (1 - h * h)
    e = _by_row(around.reshape(-1), (z @ p["w"].T).reshape(-1, EMBED), BUCKETS + 1)
    parts = {"e": e, "w": x.T @ z, "b": z.sum(axis=0), "c": h.T @ pc, "cb": pc.sum(axis=0), "m": h.T @ pm, "mb": _by_row(kind, pm, CLASSES)}
    return np.concatenate([parts[k].reshape(-1) for k in SHAPES])


class Trainer:
    def __init__(self, flat: np.ndarray):
        self.flat, self.seen, self.held, self.n = flat.copy(), np.full(len(flat), 1e-6, np.float32), [], 0
        self.view = unpack(self.flat)

    def add(self, ids: np.ndarray) -> None:
        for part in np.split(ids, range(1 << 16, len(ids), 1 << 16)):  # a very long text trains in stretches
            self.held.append(part)
            self.n += len(part)
            if sum(map(len, self.held)) >= 1 << 16:
                self.learn()

    def learn(self) -> None:
        words, around = contexts(self.held)
        self.held = []
        order = np.random.Generator(np.random.PCG64(SEED + self.n)).permutation(len(words))
        for a in range(0, len(words), STEP):
            pick = order[a : a + STEP]
            g = gradient(self.view, words[pick], around[pick])
            self.seen += g * g
            self.flat -= RATE * g / np.sqrt(self.seen)


def train(docs: DataFrame) -> Model:
    """The vocabulary and the weights, from all documents."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counts = counted(docs)
    (frequent, norms), flat = vocabulary(counts), initial()

    n = counts.agg(F.sum("n")).first()[0] or 0
    trainers = max(n >> SHARE, min(FEW, n >> LEAST), 1)

    def tokenised(batches):
        at = Entries(frequent)
        for b in batches:
            ids = [at(symbols(x.as_py())).astype(np.int16).tobytes() for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("trainer"), b.column("deal"), pa.array(ids, pa.binary())], ["trainer", "deal", "ids"])

    for turn in range(ROUNDS):

        def trained(batches, flat=flat):
            rows = ((k.as_py(), x.as_py()) for b in batches for k, x in zip(b.column("trainer"), b.column("ids"), strict=True))
            for _, held in groupby(rows, key=lambda row: row[0]):
                own = Trainer(flat)
                for _, x in held:
                    own.add(np.frombuffer(x, np.int16).astype(np.int32))
                own.learn()
                if own.n:
                    yield pa.RecordBatch.from_arrays([pa.array([own.n]), pa.array([own.flat], pa.list_(pa.float32()))], ["n", "w"])

        rows = docs.select(F.xxhash64("doc_id", text, F.lit(SEED)).alias("deal"), text.alias("text")).filter(F.pmod("deal", F.lit(ROUNDS)) == turn)
        rows = rows.select(F.pmod(F.shiftrightunsigned("deal", 8), F.lit(trainers)).cast("long").alias("trainer"), "deal", "text")
        dealt = rows.mapInArrow(tokenised, "trainer long, deal long, ids binary").repartition("trainer").sortWithinPartitions("trainer", "deal", "ids")
        each = dealt.mapInArrow(trained, "n long, w array<float>").select("n", F.posexplode("w").alias("at", "w"))
        # whole numbers, so that the order of the sums doesn't matter
        mean = each.groupBy("at").agg((F.sum((F.col("w") * SCALE).cast("long") * F.col("n")) / F.sum("n") / SCALE).alias("w"))
        got = mean.collect()  # as many rows as the network has weights
        if got:
            flat = flat.copy()
            flat[[r["at"] for r in got]] = [r["w"] for r in got]
    return Model(flat, frequent, norms, counts)


def scores(docs: DataFrame, model: Model, keys: list[str]) -> DataFrame:
    """Rows (*keys, n_words, log_probability) of all rows of docs."""
    rows = docs.select(*keys, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    flat, frequent, norms, counts = model

    def each(batches):
        score, at = Scorer(unpack(flat)), Entries(frequent)
        for b in batches:
            own = [symbols(x.as_py()) for x in b.column("text")]
            ids = [at(x) for x in own]
            split = [np.unique(x[k >= OWN], return_counts=True) for x, k in zip(own, ids, strict=True)]
            sums, a = [], 0
            while a < len(ids):
                z, n = a, 0
                while z < len(ids) and (z == a or n + len(ids[z]) <= 1 << 15):
                    n += len(ids[z])
                    z += 1
                words, around = contexts(ids[a:z])
                logs = np.concatenate([score(words[k : k + (1 << 13)], around[k : k + (1 << 13)]) for k in range(0, len(words), 1 << 13)] or [np.zeros(0)])
                logs = logs - np.where(words >= OWN, norms[np.maximum(words - OWN, 0)], 0.0)
                ends = np.cumsum([len(x) for x in ids[a:z]])
                total = np.concatenate(([0.0], np.cumsum(logs, dtype=np.float64)))
                sums.append(total[ends] - total[np.concatenate(([0], ends[:-1]))])
                a = z
            rest = [k for k in b.schema.names if k != "text"]
            starts = pa.array(np.cumsum([0, *[len(x) for x, _ in split]]), pa.int32())
            lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate([np.empty(0, np.int64), *[x[k].view(np.int64) for x in split]]))) for k in (0, 1)]
            out = [pa.array([len(x) for x in ids], pa.int64()), pa.array(np.concatenate(sums) if sums else np.zeros(0), pa.float64()), *lists]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], *out], [*rest, "n_words", "log_probability", "__symbols", "__times"])

    scored = rows.mapInArrow(each, f"{types}, n_words long, log_probability double, __symbols array<long>, __times array<long>")
    scored = cut_lineage(scored.withColumn("__row", F.monotonically_increasing_id()))
    words = scored.select("__row", F.explode(F.arrays_zip("__symbols", "__times")).alias("w")).select("__row", F.col("w.__symbols").alias("symbol"), F.col("w.__times").alias("times"))
    # whole numbers, so that the order of the sums doesn't matter; a word never seen counts one, of logarithm zero
    more = words.join(counts, "symbol").groupBy("__row").agg((F.sum((F.col("times") * F.log1p("n") * FINE).cast("long")) / FINE).alias("__more"))
    own = scored.drop("__symbols", "__times").join(more, "__row", "left")
    return own.withColumn("log_probability", F.col("log_probability") + F.coalesce("__more", F.lit(0.0))).drop("__row", "__more")


def op3_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = scores(docs, train(docs), ["doc_id"])
    return out.select("doc_id", "n_words", F.round("log_probability", 2).alias("log_probability"), F.round(F.try_divide("log_probability", "n_words"), 4).alias("per_word"))
