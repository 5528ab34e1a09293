"""Scalar functions on reads, qualities, loci and names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET = 33


def mask(seq: Column, start: int, end: int) -> Column:
    """seq with N outside [start, end)."""
    n = F.length(seq)
    inside = F.substring(seq, F.lit(start + 1), F.greatest(F.least(F.lit(end), n) - start, F.lit(0)))
    return F.concat(F.repeat(F.lit("N"), F.least(F.lit(start), n)), inside, F.repeat(F.lit("N"), F.greatest(n - end, F.lit(0))))


def qualities(qual: Column) -> Column:
    """Array of whole numbers from Phred+33 letters."""
    return F.when(F.length(qual) > 0, F.transform(F.split(qual, ""), lambda c: F.ascii(c) - OFFSET)).otherwise(F.array().cast("array<int>"))


def quality_summary(qual: Column) -> Column:
    """Struct: low, mean, expected_errors, q20, q30; nulls for an empty read."""
    q = qualities(qual)
    total = lambda f: F.aggregate(q, F.lit(0.0), lambda t, x: t + f(x))
    at_least = lambda c: F.size(F.filter(q, lambda x: x >= c))
    return F.struct(F.array_min(q).alias("low"), F.try_divide(total(lambda x: x.cast("double")), F.size(q)).alias("mean"), total(lambda x: F.pow(F.lit(10.0), -x / 10.0)).alias("expected_errors"), at_least(20).alias("q20"), at_least(30).alias("q30"))


def trim_length(qual: Column, least: int, k: int) -> Column:
    """The length of the longest prefix whose last k letters all have quality ``least`` or more; 0 for none."""
    good = F.transform(qualities(qual), lambda x: (x >= least).cast("int"))
    n = F.size(good)
    ends = F.filter(F.sequence(F.lit(k), F.greatest(n, F.lit(k))), lambda e: F.coalesce(F.forall(F.slice(good, e - k + 1, F.lit(k)), lambda x: x == 1) & (e <= n), F.lit(False)))
    return F.coalesce(F.array_max(ends), F.lit(0))


def gc_share(seq: Column) -> Column:
    """Of the letters that aren't N."""
    count = lambda letters: F.length(seq) - F.length(F.translate(seq, letters, ""))
    return F.try_divide(count("GCgc").cast("double"), F.length(seq) - count("Nn"))


def locus(text: Column) -> Column:
    """Struct contig, start, end of ``contig:start..end`` (or ``-``); the word None and anything else give null."""
    pattern = r"^(.+):(\d+)(?:\.\.|-)(\d+)$"
    part = lambda k: F.regexp_extract(text, pattern, k)
    return F.when(text.rlike(pattern), F.struct(part(1).alias("contig"), part(2).cast("long").alias("start"), part(3).cast("long").alias("end")))


def locus_text(contig: Column, start: Column, end: Column) -> Column:
    return F.concat(contig, F.lit(":"), start.cast("string"), F.lit(".."), end.cast("string"))


def contig_name(name: Column) -> Column:
    """With the prefix chr."""
    return F.concat(F.lit("chr"), F.regexp_replace(name, "^chr", ""))


def contig_order(name: Column) -> Column:
    """Orders numbered contigs by number and before named ones."""
    bare = F.regexp_replace(name, "^chr", "")
    number = bare.try_cast("long")
    return F.struct(number.isNull().alias("named"), number.alias("number"), bare.alias("name"))


def natural_order(name: Column) -> Column:
    """Orders names with their digits as numbers."""
    return F.transform(F.regexp_extract_all(name, F.lit(r"\d+|\D+"), 0), lambda p: F.struct(p.try_cast("long").isNull().alias("text"), p.try_cast("long").alias("number"), p.alias("part")))


def pack_read_group(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def read_position(name: Column) -> Column:
    """Struct lane, tile, x, y of a read name whose last four of seven fields are these."""
    p = F.split(name, ":")
    at = lambda k: F.get(p, k).try_cast("int")
    return F.when(F.size(p) >= 7, F.struct(at(3).alias("lane"), at(4).alias("tile"), at(5).alias("x"), at(6).alias("y")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def cigar(text: Column) -> Column:
    """Array of (length, op)."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"\d+[MIDNSHP=X]"), 0), lambda x: F.struct(F.regexp_extract(x, r"\d+", 0).cast("int").alias("length"), F.regexp_extract(x, r"\D$", 0).alias("op")))


def cigar_bases(ops: Column, kinds: str) -> Column:
    return F.aggregate(F.filter(ops, lambda x: x["op"].isin(*kinds)), F.lit(0), lambda t, x: t + x["length"])


def reference_end(pos: Column, ops: Column) -> Column:
    return pos + cigar_bases(ops, "MDN=X")


def one_clip(ops: Column) -> Column:
    """Exactly one clipped end and one match."""
    n = lambda kinds: F.size(F.filter(ops, lambda x: x["op"].isin(*kinds)))
    return (F.size(ops) == 2) & (n("SH") == 1) & (n("M") == 1)


def split_alignments(tag: Column) -> Column:
    """Array of (contig, pos from 0, strand, cigar, mapq, nm) of a supplementary-alignment tag."""
    rows = F.filter(F.split(F.coalesce(tag, F.lit("")), ";"), lambda x: x != "")
    f = lambda x, k: F.get(F.split(x, ","), k)
    return F.transform(rows, lambda x: F.struct(f(x, 0).alias("contig"), (f(x, 1).cast("long") - 1).alias("pos"), f(x, 2).alias("strand"), f(x, 3).alias("cigar"), f(x, 4).cast("int").alias("mapq"), f(x, 5).cast("int").alias("nm")))


def stringent(mapq: Column, primary: Column, same_contig: Column, distance: Column, n_ops: Column, key: Column | None = None) -> Column:
    """Reads of full mapping quality, one match operation, and a mate that is far or elsewhere."""
    ok = (mapq >= 60) & primary & (~same_contig | (distance >= 20)) & (n_ops == 1)
    return F.coalesce(ok if key is None else ok & key.isNotNull(), F.lit(False))


def pair_type(same_contig: Column, reverse1: Column, reverse2: Column, insert: Column, most_insert: int, most_fragment: int = 10**6) -> Column:
    """What a read pair supports: NORMAL, INV, TDUP, DEL or TRANS_ and the strands."""
    side = lambda r: F.when(r, "R").otherwise("F")
    normal = same_contig & ~reverse1 & reverse2 & (insert < most_insert)
    far = ~same_contig | (insert > most_fragment)
    return F.when(normal, "NORMAL").when(far, F.concat(F.lit("TRANS_"), side(reverse1), side(reverse2))).when(reverse1 == reverse2, "INV").when(reverse1, "TDUP").otherwise("DEL")


def variant_type(ref: Column, alt: Column) -> Column:
    """S, I, D or C; X where an allele is missing."""
    r, a = F.length(ref), F.length(alt)
    return F.when(ref.isNull() | alt.isNull() | (r == 0) | (a == 0), "X").when((r == 1) & (a == 1), "S").when((a > r) & F.startswith(alt, ref), "I").when((r > a) & F.startswith(ref, alt), "D").otherwise("C")


def transition(ref: Column, alt: Column) -> Column:
    return F.concat(ref, alt).isin("AG", "GA", "CT", "TC")


def shuffled_share(key: Column, seed: int, modulus: int = 1 << 20) -> Column:
    """A number in [0, 1) that depends on the key alone: filters by it keep or drop all rows of a key together."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(modulus)) / modulus


#: Letters that stand for several bases. Fixed values.
DEGENERATE = {"R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


def site_sequences(site: str) -> list[str]:
    """All plain sequences that a site with degenerate letters stands for, on both strands."""
    out = [""]
    for letter in site:
        out = [s + b for s in out for b in DEGENERATE.get(letter, letter)]
    other = str.maketrans("ACGT", "TGCA")
    return sorted({*out, *[s.translate(other)[::-1] for s in out]})


def site_positions(seq: Column, site: str) -> Column:
    """Array of the positions from 0 at which the site begins, on either strand."""
    k = len(site)
    return F.filter(F.sequence(F.lit(0), F.greatest(F.length(seq) - k, F.lit(0))), lambda i: F.substring(seq, i + 1, F.lit(k)).isin(*site_sequences(site)))


def reference_offsets(ops: Column) -> Column:
    """For each base of a read its offset on the reference from the alignment's start; null for inserted and soft-clipped bases. Skipped stretches count as deletions, hard clips as nothing."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(state, op):
        n, aligned = op["length"], op["op"].isin("M", "=", "X")
        bases = F.when(aligned, F.transform(F.sequence(F.lit(1), n), lambda k: state["at"] + k - 1)).when(op["op"].isin("I", "S"), F.transform(F.sequence(F.lit(1), n), lambda k: F.lit(None).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.struct((state["at"] + F.when(aligned | op["op"].isin("D", "N"), n).otherwise(0)).alias("at"), F.concat(state["out"], bases).alias("out"))

    return F.aggregate(ops, start, step, lambda s: s["out"])


def trimmed(seq: Column, qual: Column, key: int, spacer: int) -> Column:
    """Struct key, key_qual, seq, qual of a read that begins with a key and a spacer."""
    rest = lambda c: F.substring(c, F.lit(key + spacer + 1), F.greatest(F.length(c), F.lit(1)))
    return F.struct(F.substring(seq, 1, key).alias("key"), F.substring(qual, 1, key).alias("key_qual"), rest(seq).alias("seq"), rest(qual).alias("qual"))


def primitive(ref: Column, alt: Column) -> Column:
    """One of the alleles is a single base."""
    return (F.length(ref) == 1) | (F.length(alt) == 1)


def allele_length(ref: Column, alt: Column) -> Column:
    return F.length(alt) - F.length(ref)


def allele_keys(text: Column) -> Column:
    """Array for each allele (separated by commas) of the keys that hold it (separated by semicolons)."""
    return F.transform(F.split(text, ","), lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, ";")))


#: Two bits for each base. Fixed values.
BITS = "AGCT"


def packed_key(seq: Column) -> Column:
    """A whole number from a sequence of up to 31 bases, two bits each, the first base lowest; null where there is another letter."""
    value = F.aggregate(F.split(F.reverse(seq), ""), F.lit(0).cast("long"), lambda t, c: t * 4 + F.instr(F.lit(BITS), c) - 1)
    return F.when(seq.rlike(f"^[{BITS}]{{1,31}}$"), value)


def unpacked_key(value: Column, length: int) -> Column:
    """The sequence of ``length`` bases, 31 at most, that ``packed_key`` made a number of."""
    base = lambda k: F.substring(F.lit(BITS), F.shiftrightunsigned(value, 2 * k).bitwiseAND(F.lit(3).cast("long")).cast("int") + 1, F.lit(1))
    return F.concat(*[base(k) for k in range(length)])


def group_of(key: Column) -> Column:
    """Struct seq and group of a key ``SEQ-7``; group 1 where there is none."""
    return F.struct(F.substring_index(key, "-", 1).alias("seq"), F.coalesce(F.nullif(F.regexp_extract(key, r"-(\d+)$", 1), F.lit("")).cast("int"), F.lit(1)).alias("group"))
