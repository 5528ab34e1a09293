"""Reading by range, file names, identifiers, sorted and sharded layouts, and dense profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.operators.intervals import overlap_join
from strandline.operators.ordered import TILE, across, numbered


def fastq_name(path: Column) -> Column:
    """Struct sample, lane, read, group of a file name ``<sample>_S<n>_L<lane>_<R1|R2|I1|I2>_<group>.fastq[.gz]``; null for others."""
    pattern = r"([^/]+)_S\d+_L(\d{3})_([RI]\d)_(\d{3})\.fastq(?:\.gz)?$"
    part = lambda k: F.regexp_extract(path, pattern, k)
    return F.when(F.regexp_like(path, F.lit(pattern)), F.struct(part(1).alias("sample"), part(2).cast("int").alias("lane"), part(3).alias("read"), part(4).cast("int").alias("group")))


def ranges(df: DataFrame, queries: DataFrame, base: int = 1 << 14) -> DataFrame:
    """Rows (contig, start, end, ...) in any of the queries (contig, start_r, end_r), once for each query: those that end at or after its start and start before its end."""
    widened = queries.withColumn("start_r", F.col("start_r") - 1)
    return overlap_join(df, widened, "contig", base).withColumn("start_r", F.col("start_r") + 1)


def key_ids(keys: DataFrame, key: str) -> DataFrame:
    """(key, id): distinct keys numbered from 0 in order. Each range of keys counts its own, so no task sees all of them."""
    own = keys.select(key).filter(F.col(key).isNotNull()).distinct().repartitionByRange(key).sortWithinPartitions(key).withColumn("__part", F.spark_partition_id())
    inside = F.row_number().over(W.partitionBy("__part").orderBy(key))
    sizes = own.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return own.withColumn("__k", inside).join(before, "__part").select(key, (F.col("__before") + F.col("__k") - 1).alias("id"))


def sorted_by_key(df: DataFrame, key: str, *then: str) -> DataFrame:
    """Ranges of keys, sorted inside; rows without a key are spread by the other columns and come as a null key first."""
    return df.repartitionByRange(key, *then).sortWithinPartitions(key, *then)


def sharded(df: DataFrame, key: str, other: str, shards: int) -> DataFrame:
    """df with shard: by the key, or by the other column where there is no key, so that rows without one don't meet in one place."""
    own = F.when(F.col(key).isNotNull(), F.xxhash64(key)).otherwise(F.xxhash64(other))
    return df.withColumn("shard", F.pmod(own, F.lit(shards)).cast("int"))


def dense(df: DataFrame, size: int, value: str) -> DataFrame:
    """Ranges (contig, start, end, value) as bins of ``size`` from the range's first bin to its last: (contig, bin, value)."""
    bins = F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size)))
    return df.filter("start < end").select("contig", bins.alias("bin"), value)


def bin_ranges(df: DataFrame, size: int, value: str, tile: int = TILE) -> DataFrame:
    """The reverse: runs of neighbouring bins of equal value as ranges."""
    own = across(df, ["contig"], ["bin"], {"__before": ("lag", F.struct(F.col("bin").alias("bin"), F.col(value).alias("v")))}, tile)
    new = (F.col("bin") != F.col("__before.bin") + 1) | ~F.col(value).eqNullSafe(F.col("__before.v"))
    own = numbered(own, ["contig"], ["bin"], new, "__run", tile)
    return own.groupBy("contig", "__run").agg((F.min("bin") * size).alias("start"), ((F.max("bin") + 1) * size).alias("end"), F.first(value).alias(value)).drop("__run")


def vcf_lines(df: DataFrame, sample: str = "sample") -> DataFrame:
    """Variant rows (contig, pos from 1, id, alt, info, qual, filters) as lines in order, header first."""
    columns = "#CHROM POS ID REF ALT QUAL FILTER INFO".split()
    head = df.sparkSession.createDataFrame([(0, "##fileformat=VCFv4.2"), (1, "\t".join(columns))], "k int, value string")
    body = df.select(F.lit(2).alias("k"), "contig", "pos", F.concat_ws("\t", "contig", F.col("pos").cast("string"), "id", F.lit("N"), "alt", F.coalesce(F.col("qual").cast("string"), F.lit(".")), F.when(F.col("filters").isin("", "."), "PASS").otherwise(F.col("filters")), "info").alias("value"))
    return head.unionByName(body, allowMissingColumns=True).orderBy("k", "contig", "pos", "value").select("value")


def fastq_files(spark: SparkSession, folder: str, reads: tuple[str, ...] = ("R1", "R2")) -> DataFrame:
    """(path, sample, lane, read, group) of the read files under a folder, by their names; the contents aren't read."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.fastq*").load(folder).select("path")
    return paths.select("path", fastq_name(F.col("path")).alias("n")).filter(F.col("n.read").isin(*reads)).select("path", "n.*")
