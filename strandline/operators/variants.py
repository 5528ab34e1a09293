"""Structural variants, variants and copy numbers: merging call sets, filters, phase blocks, molecule counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators.aggregates import pair_rate, ratio
from strandline.operators.graph import components
from strandline.operators.intervals import overlap_join, point_join
from strandline.operators.ordered import TILE
from strandline.operators.sessions import best_of, clusters


def break_clusters(calls: DataFrame, window: int, most: int | None = None) -> DataFrame:
    """calls with c1 and c2: clusters of the first and the second breakpoints; a group of calls shares both."""
    for k in (1, 2):
        ends = calls.select(F.col(f"chrom{k}").alias("contig"), F.col(f"start{k}").alias("start"), F.col(f"stop{k}").alias("end")).distinct()
        numbered = clusters(ends, ["contig"], window, most).select(F.col("contig").alias(f"chrom{k}"), F.col("start").alias(f"start{k}"), F.col("end").alias(f"stop{k}"), F.col("cluster").alias(f"c{k}"))
        calls = calls.join(numbered, [f"chrom{k}", f"start{k}", f"stop{k}"])
    return calls


def best_calls(calls: DataFrame, window: int, most: int | None = None) -> DataFrame:
    """The best call of each pair of clusters, with n, the number of calls, and sources, where they came from (column source)."""
    own = break_clusters(calls, window, most)
    group = ["chrom1", "c1", "chrom2", "c2"]
    sums = own.groupBy(*group).agg(F.count("*").alias("n"), F.array_sort(F.collect_set("source")).alias("sources"))
    return best_of(own, group, [F.desc("qual"), "start1", "start2", "name"]).drop("source").join(sums, group).drop("c1", "c2")


def overlap_groups(calls: DataFrame, share: float, base: int = 1 << 14) -> DataFrame:
    """calls (name, contig, start, end, qual) with root: linked by reciprocal overlap of more than ``share``."""
    right = calls.select(F.col("name").alias("b"), "contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"))
    both = F.least("end", "end_r") - F.greatest("start", "start_r")
    links = overlap_join(calls.select(F.col("name").alias("a"), "contig", "start", "end"), right, "contig", base).filter(F.col("a") < F.col("b"))
    links = links.filter((both > share * (F.col("end") - F.col("start"))) & (both > share * (F.col("end_r") - F.col("start_r")))).select("a", "b")
    return calls.join(components(links).withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))


SELECTIONS = {
    "first": lambda: F.struct(F.col("start"), F.col("end"), F.col("name")),
    "widest": lambda: F.struct(F.col("start") - F.col("end"), F.col("start"), F.col("name")),
    "quality": lambda: F.struct(-F.col("qual"), F.col("start"), F.col("name")),
    "random": lambda: F.struct(F.xxhash64("name"), F.col("name")),
}


def selected(grouped: DataFrame, strategy: str, group: str = "root") -> DataFrame:
    """One call of each group by a named strategy."""
    return grouped.groupBy(group).agg(F.min_by(F.struct(*[c for c in grouped.columns if c != group]), SELECTIONS[strategy]()).alias("r")).select("r.*", group)


def call_filters(rules: dict[str, Column]) -> Column:
    """The names of the rules that a call fails, in order; a null condition doesn't fail."""
    return F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))


def phase_blocks(variants: DataFrame) -> DataFrame:
    """(contig, ps, start, end, n, het, phased_share, correct_pairs) of phased variants; in_truth columns: parity 0, 1 or null against the truth."""
    return variants.filter("ps is not null").groupBy("contig", "ps").agg(
        F.min("pos").alias("start"), F.max("pos").alias("end"), F.count("*").alias("n"), F.count(F.when(F.col("het"), 1)).alias("het"),
        ratio(F.count(F.when(F.col("phased"), 1)), F.count("*")).alias("phased_share"),
        pair_rate([F.count(F.when(F.col("parity") == k, 1)) for k in (0, 1)]).alias("correct_pairs"),
    )


def attached(reads: DataFrame, fragments: DataFrame, confidence: float = 0.995) -> DataFrame:
    """reads (key, contig, pos, ...) with hp and ps of the fragment of the same key that holds pos inside its phase set: 1 or 2 where its haplotype's probability is above ``confidence``."""
    own = fragments.select("key", "contig", F.greatest("start", "ps_start").alias("start_r"), F.least("end", "ps_end").alias("end_r"), "ps", "h0", "h1").filter("start_r < end_r")
    ids = [c for c in reads.columns]
    hits = point_join(reads, own, ["key", "contig"])
    best = best_of(hits, ids, ["start_r", "ps"]).select(*ids, "ps", F.when(F.col("h0") > confidence, 1).when(F.col("h1") > confidence, 2).alias("hp"))
    return reads.join(best, ids, "left")


def molecule_counts(fragments: DataFrame, bins: DataFrame, base: int = 1 << 14) -> DataFrame:
    """(contig, start, end, n, n1, n2): distinct molecules that touch each bin, of all and of each haplotype."""
    right = fragments.select("contig", F.col("start").alias("start_r"), F.col("end").alias("end_r"), "molecule", "hp")
    bin_ = ["contig", "start", "end"]
    hits = overlap_join(bins.select(*bin_), right, "contig", base).select(*bin_, "molecule", "hp").repartition(*bin_)  # one shuffle for both counts
    each = hits.groupBy(*bin_, "molecule").agg(*[F.max((F.col("hp") == h).cast("long")).alias(f"__h{h}") for h in (1, 2)])
    counts = each.groupBy(*bin_).agg(F.count("*").alias("n"), *[F.sum(f"__h{h}").alias(f"n{h}") for h in (1, 2)])
    return bins.join(counts, ["contig", "start", "end"], "left").fillna(0, ["n", "n1", "n2"])


def low_bins(bins: DataFrame, by: list[str], value: str, share: float = 0.8) -> DataFrame:
    """bins with low: below ``share`` of the mean of their group."""
    return bins.withColumn("low", F.col(value) < share * F.avg(value).over(W.partitionBy(*by)))


def duplicates(reads: DataFrame, key: list[str], order: list) -> DataFrame:
    """reads with duplicate: all rows of a key but the first in order."""
    return reads.withColumn("duplicate", F.row_number().over(W.partitionBy(*key).orderBy(*order)) > 1)


def near_duplicates(reads: DataFrame, key: list[str], place: str, distance: float, anchors: int = 100) -> DataFrame:
    """(key, optical): pairs of rows of a key whose places (x, y) are within ``distance`` of each other, one of them among the first ``anchors`` of the key; as many pairs as anchors times rows at most."""
    order = W.partitionBy(*key).orderBy("id")
    own = reads.select(*key, "id", place).withColumn("rank", F.row_number().over(order))
    a = own.filter(F.col("rank") <= anchors).select(*key, F.col("rank").alias("ra"), F.col(place).alias("pa"))
    b = own.select(*key, F.col("rank").alias("rb"), F.col(place).alias("pb"))
    dx, dy = F.col("pa.x") - F.col("pb.x"), F.col("pa.y") - F.col("pb.y")
    return a.join(b, key).filter((F.col("ra") < F.col("rb")) & (dx * dx + dy * dy <= distance * distance)).groupBy(*key).agg(F.count("*").alias("optical"))


def truth_types(ref: Column, obs: Column) -> Column:
    return F.when(ref & obs, "TP").when(obs, "FP").when(ref, "FN")


def compared_sets(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """(key, side) of two sets of rows: ``both``, ``left`` or ``right``. Filters on side give the intersection and the differences, a count by side their sizes."""
    one = lambda df, name: df.select(*key).distinct().withColumn(name, F.lit(True))
    both = one(left, "__l").join(one(right, "__r"), key, "full_outer")
    return both.select(*key, F.when(F.col("__l") & F.col("__r"), "both").when(F.col("__l"), "left").otherwise("right").alias("side"))


def in_lockstep(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """The join of two sides that must have the same keys; the job fails at a key that one of them lacks."""
    joined = left.withColumn("__l", F.lit(True)).join(right.withColumn("__r", F.lit(True)), key, "full_outer")
    out_of_step = F.raise_error(F.concat(F.lit("out of step at "), F.concat_ws(":", *[F.col(k).cast("string") for k in key]))).cast("boolean")
    return joined.filter(F.when(F.col("__l") & F.col("__r"), F.lit(True)).otherwise(out_of_step)).drop("__l", "__r")


def annotated(variants: DataFrame, names: DataFrame, key: tuple[str, ...] = ("contig", "pos", "ref", "alt")) -> DataFrame:
    """variants with the smallest name that a table of known variants (key, name) has for them, null for none."""
    return variants.join(names.groupBy(*key).agg(F.min("name").alias("name")), list(key), "left")


def _keep_best(pdf, share: float):
    """Calls in order of start: one that overlaps the last kept by ``share`` of both joins it, and the better one is kept."""
    import pandas as pd

    pdf = pdf.sort_values(["start", "end", "name", "qual"], kind="stable")
    rows, start, stop, best = [], None, None, None
    for r in pdf.itertuples(index=False):
        if best is not None:
            shared = min(stop, r.end) - r.start
            if min(shared / (stop - start), shared / (r.end - r.start)) >= share:
                rows[-1][1].add(r.kind)
                if r.qual > best.qual:
                    best, stop = r, r.end
                    rows[-1][0] = r
                continue
        best, start, stop = r, r.start, r.end
        rows.append([r, {r.kind}])
    return pd.DataFrame([(r.name, r.contig, r.start, r.end, r.qual, r.kind if len(kinds) == 1 else "UNK") for r, kinds in rows], columns=["name", "contig", "start", "end", "qual", "kind"])


def kept_best(calls: DataFrame, share: float, tile: int = TILE) -> DataFrame:
    """calls (name, contig, start, end, qual, kind) swept from the left, those that overlap the last group's span by ``share`` of both lengths joined to it and its best kept; a group of several kinds gets the kind UNK. Chains that don't touch are cut apart first, so that a task holds a few chains."""
    chained = clusters(calls.select("name", "contig", "start", "end", "qual", "kind"), ["contig"], 0, tile=tile)
    schema = chained.drop("cluster").schema
    # chains don't touch, so one sweep takes several of them
    return chained.groupBy("contig", F.floor(F.col("cluster") / 256)).applyInPandas(lambda pdf: _keep_best(pdf.drop(columns="cluster"), share), schema)


def key_clusters(calls: DataFrame, by: list[str], share: float) -> DataFrame:
    """calls (name, qual, keys: array) of each group in order of name: one whose keys resemble a cluster's (by Jaccard share, or by a count of 1 and more) joins the first such cluster and replaces it if it is better; what the clusters hold at the end."""
    names = [f.name for f in calls.schema.fields]

    def every(pdf):
        rows = [r for _, own in pdf.sort_values("name", kind="stable").groupby(by, sort=False, dropna=False) for r in pick(own)]
        return type(pdf)(rows, columns=names)

    def pick(own):
        held = []
        for r in own.itertuples(index=False):
            keys = frozenset(r.keys)
            for c in held:
                both = len(c[0] & keys)
                if (both if share >= 1 else both / max(len(c[0] | keys), 1)) >= share:
                    if r.qual > c[1].qual:
                        c[0], c[1] = keys, r
                    break
            else:
                held.append([keys, r])
        return [tuple(c[1]) for c in held]

    # many small groups share a call
    return calls.groupBy(F.pmod(F.xxhash64(*by), F.lit(4096))).applyInPandas(every, calls.schema)
