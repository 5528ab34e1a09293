"""SimHash near-dedup by multi-index hashing.

A fingerprint has a bit for each bit that over half of the hashes of a text's word shingles share.
Distinct fingerprints are indexed by segments, whose bits grow with their number, so that a slot of the
table holds a few of them by chance at any size: up to 2^24 fingerprints by segments of 22, 21 and 21 bits
(four differing bits leave the first equal, or at most one differing bit in the second or third), beyond
by two of 32 bits (at most two differing bits in one of them). Each fingerprint looks up the Hamming ball of
a segment's radius; of radius two, one bit is flipped on either side. Matches are verified over all 64 bits.

Copies of one text are one fingerprint. Where a crowd of different near copies shares a slot, ``HOT`` of them
over what chance gives, all their pairs are links, too many to list: such fingerprints are indexed by a
single segment of all 64 bits instead, with balls of radius two on either side, which meet exactly if two
fingerprints differ in at most four bits. Members of a point are linked to its smallest one. A point lies in at
most 2,081 balls, so no group grows with the data and no link is lost.

``one_of_each_group`` is the same method for a similarity: texts whose sets of five-word shingles resemble each
other by ``SIMILARITY`` or more. Four bits of 64 are far less than such texts differ by, so its fingerprints have
``WIDE`` bits. Matches that differ in far fewer bits than two sets of that Jaccard similarity are expected to
(``bits_apart``; 2.5 standard deviations) are taken, those in far more are not, and those between are checked by their
shingle sets. The table holds, of ``INDEXED`` segments of ``SEGMENT`` bits, the value and all values with one more bit set: half of the Hamming ball of
radius one. Such halves meet for values that are equal, differ in one bit, or differ in two bits of which either side has
one. A slot is such a value together with one of ``MINIMA`` smallest shingle hashes of the text (segment k takes the k-th, around), so texts
that share no shingle never meet, however many there are, and segments needn't deepen with the corpus: what share of similar pairs meet is the same at
every size (at similarity 0.8 about 98 in 100, of 0.9 next to all). Equal sets are one fingerprint. The rows of a slot are in
order of a second minimum, so that the texts of one family are neighbours where several families share it. First every member meets the smallest of the slot, the smallest of its family and the one before it; in slots of over ``CROWD``
those whose own value it is meet the two smallest: the smallest of the slot first, and the others only where they are of another group by then. That finds most groups without listing pairs. Slots whose members are all of one group then have no link to add.
The members of all others are joined by their shingle sets, exactly (``joined``, by prefixes in order of frequency): so any two texts
that share a slot and resemble each other come into one group, however crowded the slot. Before sets are compared, pairs are dropped for which
parities of their elements by hash (``parity``) prove that the sets differ by too much: of a family of edited copies, whose members all share rare elements,
few but the similar pairs are left.

Null and blank texts have fingerprint zero and link like any other. Null ids order last. Repeated rows
get the same result each. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.lineage import cut_lineage
from strandline.llm.common import NO_ID, mix, order_id, random_table, table
from strandline.llm.substring_dedup import rolling, word_symbols
from strandline.llm.windows import BROADCAST_ROWS, text_mark
from strandline.operators.graph import components

WORDS, BITS, SEED, HOT = 4, 4, 42, 64
#: First bit, bits, and the radius of the balls in the table and of those looked up.
SHALLOW, DEEP = ((0, 22, 0, 0), (22, 21, 0, 1), (43, 21, 0, 1)), ((0, 32, 1, 1), (32, 32, 1, 1))
_PART = 1 << 15
SHINGLE, SIMILARITY, WIDE = 5, 0.8, 512
INDEXED, SEGMENT, MINIMA, CROWD, TILE = 16, 20, 8, 16, 1024
PARITY, NARROW = 1024, 256  # bits of a text's parities, and of those that stand with every element of a prefix
_REMIX = random_table(2 * (WIDE // 64), 21).reshape(2, -1) | np.uint64(1)
_ORDERS = random_table(MINIMA, 22)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    own = (text or "").encode().lower().split()
    if not own:
        return 0
    if len(own) <= words:
        return xxhash.xxh64_intdigest(b" ".join(own), SEED)
    data = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(own) - words + 1].tolist()
    ends = (ends[words - 1 :] - 1).tolist()
    total, n, digest = np.zeros(64, np.int64), len(starts), xxhash.xxh64_intdigest
    for k in range(0, n, _PART):
        hashes = np.array([digest(data[a:b], SEED) for a, b in zip(starts[k : k + _PART], ends[k : k + _PART], strict=True)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        total += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Rows (oid, mark, fp) of all rows of docs; fp is the fingerprint as a signed long."""

    def each(batches):
        for b in batches:
            fp = np.array([fingerprint(x.as_py()) for x in b.column("text")], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("oid"), b.column("mark"), pa.array(fp)], ["oid", "mark", "fp"])

    rows = docs.select(order_id().alias("oid"), text_mark(F.col("text")).alias("mark"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(each, "oid long, mark long, fp long")


def depth(n: int) -> tuple:
    """The segments for so many distinct fingerprints."""
    return SHALLOW if n <= 1 << 24 else DEEP


def links(nodes: DataFrame, hot: int = HOT, segments: tuple | None = None) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp), enough to connect all that differ in at most four bits."""
    n = nodes.count()
    segments = segments or depth(n)
    held, asked = [], []
    for k, (first, size, near, far) in enumerate(segments):
        own = F.shiftrightunsigned("fp", first).bitwiseAND((1 << size) - 1)
        slot = lambda key, k=k: F.shiftleft(F.lit(k).cast("long"), 32).bitwiseOR(key)
        ball = lambda radius, own=own, slot=slot, size=size: [slot(own), *([slot(own.bitwiseXOR(F.lit(1 << i).cast("long"))) for i in range(size)] if radius else [])]
        held += ball(near)
        if near or not far:
            asked += ball(far)
        else:  # of the two directions of a flipped bit only the rising one is followed
            asked += [slot(own), *[F.when(own.bitwiseAND(1 << i) == 0, slot(own.bitwiseOR(F.lit(1 << i).cast("long")))) for i in range(size)]]
    index = nodes.select("fp", F.explode(F.array(*held)).alias("slot"))
    asks = nodes.select("fp", F.explode(F.filter(F.array(*asked), lambda s: s.isNotNull())).alias("slot"))
    chance = max(n * (1 + size * near) >> size for _, size, near, _ in segments)
    full = cut_lineage(index.groupBy("slot").agg(F.count("*").alias("n")).filter(F.col("n") > hot + 4 * chance).select("slot"))
    far = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = asks.withColumnRenamed("fp", "a").join(full, "slot", "left_anti").join(index.withColumnRenamed("fp", "b"), "slot")
    near = near.filter((far <= BITS) & (F.col("a") != F.col("b"))).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    crowd = asks.join(full, "slot", "left_semi").select("fp").distinct()
    masks = [0, *[1 << i for i in range(64)], *[(1 << i) | (1 << j) for i, j in combinations(range(64), 2)]]
    signed = np.array(masks, dtype=np.uint64).view(np.int64).tolist()
    balls = crowd.repartition("fp").select("fp", F.explode(F.transform(F.lit(signed), lambda m: F.col("fp").bitwiseXOR(m))).alias("point"))
    met = balls.withColumn("least", F.min("fp").over(W.partitionBy("point"))).filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b"))
    return near.unionAll(met).distinct()


def grouped(prints: DataFrame) -> DataFrame:
    """Rows (fp, component): the smallest oid that links reach from a fingerprint; from rows (oid, fp)."""
    nodes = cut_lineage(prints.groupBy("fp").agg(F.min("oid").alias("oid")))
    roots = components(links(nodes.select("fp")))
    of = cut_lineage(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = cut_lineage(of.groupBy("root").agg(F.min("oid").alias("component")))  # on its own, so that the join can split a large group
    return of.select("fp", "root").join(least, "root").select("fp", "component")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, mark, fp, component) of all rows of docs."""
    prints = cut_lineage(fingerprints(docs))
    own = prints.join(grouped(prints), "fp")
    return own.select(F.when(F.col("oid") != NO_ID, F.col("oid")).alias("doc_id"), "oid", "mark", "fp", "component")


def shingles(text: str | None, words: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of a text's word shingles; of fewer words the whole sequence is one."""
    own = word_symbols((text or "").encode().lower().decode())
    return np.unique(rolling(own, _REMIX[0, 0], min(words, len(own)))[0]) if len(own) else own


def scattered(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits are as good as independent, which the sums over shingles need."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def wide_fingerprint(own: np.ndarray) -> np.ndarray:
    """A bit for each of WIDE hash bits that over half of the shingles have; as longs."""
    total = np.zeros(WIDE, np.int64)
    for k in range(0, len(own), _PART >> 3):
        hashes = scattered(own[k : k + (_PART >> 3), None] + _REMIX[1])
        total += np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8), bitorder="little").reshape(-1, WIDE).sum(axis=0, dtype=np.uint32)
    return np.packbits(2 * total > len(own), bitorder="little").view("<i8")


def minima(own: np.ndarray) -> np.ndarray:
    """The smallest shingle hash in each of MINIMA orders; as longs, zeros for no shingles."""
    least = np.full(MINIMA, ~np.uint64(0) if len(own) else np.uint64(0))
    for k in range(0, len(own), _PART):
        least = np.minimum(least, mix(own[None, k : k + _PART] ^ _ORDERS[:, None]).min(axis=1))
    return least.view("<i8")


def parity(own: np.ndarray) -> np.ndarray:
    """Of each of PARITY values of the last bits, whether an odd number of shingles has it; as longs. Sets differ in no fewer elements than their parities differ in bits."""
    return np.packbits(np.bincount((own & np.uint64(PARITY - 1)).astype(np.int64), minlength=PARITY) & 1, bitorder="little").view("<i8")


def most_apart(similarity: float) -> float:
    """The elements in which two sets of this similarity differ at most, as a share of their sizes' sum."""
    return (1 - similarity) / (1 + similarity)


def bits_apart(similarity: float, deviations: float = 0.0) -> int:
    """The bits in which fingerprints of sets of this Jaccard similarity differ on average, two sets of equal size being arccos(2s / (1 + s)) apart, and so many standard deviations more."""
    p = float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)
    return round(WIDE * p + deviations * (WIDE * p * (1 - p)) ** 0.5)


def wide_prints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """Rows (oid, mark, n, s, t, f, h, p) of all rows of docs: n shingles, s and t name their set, f is its fingerprint, h its minima, p its parities."""

    def each(batches):
        for b in batches:
            sets = [shingles(x.as_py(), words) for x in b.column("text")]
            names = [pa.array(np.array([mix(x * r + np.uint64(1)).sum(dtype=np.uint64) for x in sets], dtype=np.uint64).view(np.int64)) for r in _REMIX[:, 1]]
            sizes = pa.array([len(x) for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("oid"), b.column("mark"), sizes, *names, *[pa.array([make(x) for x in sets], pa.list_(pa.int64())) for make in (wide_fingerprint, minima, parity)]], ["oid", "mark", "n", "s", "t", "f", "h", "p"])

    rows = docs.select(order_id().alias("oid"), text_mark(F.col("text")).alias("mark"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(each, "oid long, mark long, n long, s long, t long, f array<long>, h array<long>, p array<long>")


def met(nodes: DataFrame, hot: int = CROWD) -> DataFrame:
    """Rows (slot, node, others) of the slots that several nodes (node, f, h) share: others are those of the slot that the node is compared with first."""
    size = SEGMENT
    masks = F.lit([0, *[1 << i for i in range(size)]]).cast("array<bigint>")

    def ball(k: int):
        at, shift = divmod(k * size, 64)
        own = F.shiftrightunsigned(F.get("f", at), shift)
        if shift + size > 64:
            own = own.bitwiseOR(F.shiftleft(F.get("f", at + 1), 64 - shift))
        own = own.bitwiseAND(F.lit((1 << size) - 1).cast("long"))
        fine = F.hash(F.get("h", (k + 1) % MINIMA))
        slot = lambda m: F.xxhash64(F.lit(k), own.bitwiseOR(m), F.get("h", k % MINIMA))
        return F.transform(F.filter(masks, lambda m: own.bitwiseAND(m) == 0), lambda m: F.struct(slot(m).alias("slot"), fine.alias("fine"), (m == 0).alias("own")))

    keys = nodes.select("node", F.explode(F.flatten(F.array(*[ball(k) for k in range(INDEXED)]))).alias("x"))
    keys = keys.select((F.col("node") * 2 + F.when(F.col("x.own"), 0).otherwise(1)).alias("key"), "x.slot", "x.fine")  # the last bit: whether the slot is the text's own, not a neighbour's
    keys = keys.repartition("slot").sortWithinPartitions("slot", "fine", "key")  # one sort for all windows
    line, slot, family = W.partitionBy("slot").orderBy("fine", "key"), W.partitionBy("slot"), W.partitionBy("slot", "fine")
    shared = keys.withColumns({"n": F.count("*").over(slot), "least": F.min("key").over(slot)}).filter("n > 1")
    shared = shared.withColumn("first", F.min("key").over(family)).withColumn("last", F.lag("key").over(line))
    small = F.col("n") <= hot
    asked = F.when(small | (F.col("key") % 2 == 0), F.array("least", "first", F.when(small, F.col("last"))))
    return shared.select("slot", F.shiftright("key", 1).alias("node"), F.transform(asked, lambda k: F.shiftright(k, 1)).alias("others"))


def asked(shared: DataFrame, first: int = 1, n: int = 3) -> DataFrame:
    """The pairs (a, b) that are compared first, of the n others from the first on; from the rows of ``met``."""
    pairs = shared.select(F.explode(F.slice("others", first, n)).alias("a"), F.col("node").alias("b")).filter("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def of_two_groups(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes aren't of one group so far, by rows (node, root)."""
    root = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"root_{name}"))
    both = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left")
    return both.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def starred(pairs: DataFrame, nodes: DataFrame, most: int, similarity: float | None = None) -> DataFrame:
    """The pairs (a, b, bits) of nodes whose fingerprints differ in at most ``most`` bits, without those whose parities rule out the similarity, if one is given."""
    more = ["n", "p"] if similarity else []
    side = lambda name: nodes.select(F.col("node").alias(name), *[F.col(k).alias(f"{k}_{name}") for k in ("f", *more)])
    apart = lambda k: F.aggregate(F.zip_with(f"{k}_a", f"{k}_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    found = pairs.join(side("a"), "a").join(side("b"), "b")
    if similarity:
        found = found.filter(apart("p") <= (F.col("n_a") + F.col("n_b")) * most_apart(similarity) + 1e-6)
    return found.select("a", "b", apart("f").alias("bits")).filter(F.col("bits") <= most)


def similar(nodes: DataFrame, most: int, hot: int = CROWD) -> DataFrame:
    """Edges (a, b, bits) between nodes (node, f, h) whose fingerprints differ in at most ``most`` bits, of those that are compared first."""
    return starred(asked(met(nodes, hot)), nodes, most)


def mixed(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (node, root) of the nodes in slots whose members are of several groups so far; from the rows of ``met`` and (node, root)."""
    own = shared.select("slot", "node").join(roots, "node", "left").select("slot", "node", F.coalesce("root", "node").alias("root"))
    slot = W.partitionBy("slot")
    return own.withColumns({"least": F.min("root").over(slot), "most": F.max("root").over(slot)}).filter("least <> most").select("node", "root").distinct()


def shingle_sets(texts: DataFrame, words: int) -> DataFrame:
    """The rows of texts (node, text, ...) with own in place of the text: 32 bits of the hash of each shingle."""

    def each(batches):
        for b in batches:
            sets = [np.unique(shingles(x.as_py(), words).astype(np.uint32)).view(np.int32) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], pa.array(sets, pa.list_(pa.int32()))], [*rest, "own"])

    rest = [k for k in texts.columns if k != "text"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*rest).schema.fields)
    return texts.select(*rest, F.col("text").cast("string").alias("text")).mapInArrow(each, f"{types}, own array<int>")


def checked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets (node, own) are similar."""
    side = lambda name: sets.select(F.col("node").alias(name), F.col("own").alias(f"own_{name}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("own_a", "own_b"))
    return both.filter(shared >= similarity * (F.size("own_a") + F.size("own_b") - shared)).select("a", "b")


def joined(sets: DataFrame, similarity: float) -> DataFrame:
    """All pairs (a, b) of different groups whose sets are similar, exactly; from rows (node, root, own).

    By prefixes: in order of the number of sets that hold an element, the first element that two similar sets share stands among the
    first of either, and in the smaller set still earlier; what follows it must be enough for the overlap. Members of one group don't meet, nor do sets whose parities are too far apart.
    """
    each = sets.select("node", "root", F.size("own").alias("n"), F.explode("own").alias("x"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("x").bitwiseAND(63).cast("int"))
    odd = [F.bit_xor(F.when(F.shiftright("x", 6).bitwiseAND(NARROW // 64 - 1) == k, bit).otherwise(0)).alias(f"p{k}") for k in range(NARROW // 64)]
    line = each.join(each.groupBy("x").agg(F.count("*").alias("often")), "x").groupBy("node", "root", "n").agg(F.sort_array(F.collect_list(F.struct("often", "x"))).alias("line"), *odd)
    parities = [f"p{k}" for k in range(NARROW // 64)]
    first = lambda share: (F.col("n") - F.ceil(F.col("n") * share - 1e-6) + 1).cast("int")
    least = 2 * similarity / (1 + similarity)
    rows = line.select("node", "root", "n", *parities, first(least).alias("early"), F.posexplode(F.slice("line.x", 1, first(similarity))).alias("at", "x"))
    rows = cut_lineage(rows.groupBy("x", "root").agg(*[F.collect_list(F.when(when, F.struct("n", "node", "at", *parities))).alias(k) for k, when in (("held", F.col("at") < F.col("early")), ("asked", F.lit(True)))]))
    element = W.partitionBy("x")
    rows = rows.withColumns({"lo": F.min("root").over(element), "hi": F.max("root").over(element)}).filter("lo <> hi")
    enough = lambda a, b: F.least(a.n - a["at"], b.n - b["at"]) >= (a.n + b.n) * (least / 2) - 1e-6
    near = lambda a, b: sum(F.bit_count(a[k].bitwiseXOR(b[k])) for k in parities) <= (a.n + b.n) * most_apart(similarity) + 1e-6
    fits = lambda a: lambda b: (F.struct(a.n, a.node) < F.struct(b.n, b.node)) & (a.n >= b.n * similarity - 1e-6) & enough(a, b) & near(a, b)
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("root"), F.ceil(F.count("*").over(element) / TILE)))
    tiles = rows.groupBy("x", "tile").agg(F.collect_list(F.struct("root", "asked")).alias("groups"))  # so many rows meet as there are groups and tiles, not pairs
    others = F.flatten(F.transform(F.filter("groups", lambda g: g.root != F.col("root")), lambda g: g.asked))
    met_ = rows.filter(F.size("held") > 0).select("x", "root", "held").join(tiles, "x").select("held", others.alias("asked"))
    pairs = met_.select(F.explode("held").alias("a"), "asked").select("a", F.explode(F.filter("asked", fits(F.col("a")))).alias("b"))
    pairs = pairs.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()
    return checked(pairs, sets, similarity)


def one_of_each_group(docs: DataFrame, words: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs with the smallest id of their group of similar texts; of repeated rows one."""
    prints = cut_lineage(wide_prints(docs, words))
    sets = prints.groupBy("s", "t").agg(F.min(F.struct("oid", "mark")).alias("best"), *[F.first(k).alias(k) for k in ("n", "f", "h", "p")])
    nodes = cut_lineage(sets.select(F.monotonically_increasing_id().alias("node"), "best", "n", "f", "h", "p"))
    own = docs.withColumns({"__oid": order_id(), "__mark": text_mark(F.col("text"))})
    most, least = bits_apart(similarity, 2.5), bits_apart(similarity, -2.5)

    def sets_of(few: DataFrame) -> DataFrame:
        few = cut_lineage(few.join(nodes.select("node", F.col("best.oid").alias("__oid"), F.col("best.mark").alias("__mark")), "node"))
        few = F.broadcast(few) if few.count() <= BROADCAST_ROWS else few
        return shingle_sets(own.join(few, ["__oid", "__mark"]).dropDuplicates(["node"]).select(*[k for k in few.columns if k[:2] != "__"], "text"), words)

    def linked(pairs: DataFrame) -> DataFrame:
        found = cut_lineage(starred(pairs, nodes, most, similarity))
        unsure = found.filter(F.col("bits") > least)
        return cut_lineage(found.filter(F.col("bits") <= least).select("a", "b").unionAll(checked(unsure, sets_of(unsure.select(F.explode(F.array("a", "b")).alias("node")).distinct()), similarity)))

    def joined_by(more: DataFrame, roots: DataFrame) -> DataFrame:
        return roots if more.isEmpty() else components(more.unionAll(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    shared = cut_lineage(met(nodes))
    smallest = cut_lineage(asked(shared, 1, 1))
    roots = components(linked(smallest))
    roots = joined_by(linked(of_two_groups(asked(shared, 2, 2).join(smallest, ["a", "b"], "left_anti"), roots)), roots)
    roots = joined_by(cut_lineage(joined(cut_lineage(sets_of(mixed(shared, roots))), similarity)), roots)
    grouped_ = nodes.select("node", "best").join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("best").alias("best"))
    best = grouped_.select(F.col("best.oid").alias("__oid"), F.col("best.mark").alias("__mark"))
    return own.join(best, ["__oid", "__mark"], "left_semi").dropDuplicates(["__oid", "__mark"]).select(*docs.columns)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    component = F.when(F.col("component") != NO_ID, F.col("component")).alias("component_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component)


def brute_force(rows: list[tuple[int, str]]) -> dict[int, tuple[str, int]]:
    """The same over all pairs, for tests."""
    prints = {i: fingerprint(t) for i, t in rows}
    group = {i: i for i in prints}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j in combinations(sorted(prints), 2):
        if (prints[i] ^ prints[j]).bit_count() <= BITS:
            a, b = sorted((root(i), root(j)))
            group[b] = a
    return {i: (f"{prints[i]:016x}", root(i)) for i in prints}
