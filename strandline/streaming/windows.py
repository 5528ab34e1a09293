"""Streaming twins of the batch operators, on event time."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def events(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    """The Parquet files of a folder, or one file, as a stream."""
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if own.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(own).isDirectory():
        return source.parquet(path)
    return source.option("pathGlobFilter", own.getName()).parquet(own.getParent().toString())


def counts(df: DataFrame, time: str, keys: list[str], size: str, step: str | None = None, late: str = "1 hour") -> DataFrame:
    """Tumbling windows, or sliding ones with ``step``."""
    w = F.window(time, size, step) if step else F.window(time, size)
    return df.withWatermark(time, late).groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n")).select("w.start", "w.end", *keys, "n")


def sessions(df: DataFrame, time: str, keys: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Gap sessions; in append mode a session comes out when the watermark has passed its end."""
    own = df.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n"), F.max(time).alias("last"))
    return own.select(*keys, F.col("w.start").alias("start"), "last", "n")


def distinct(df: DataFrame, time: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark's delay."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def paired(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, within: str, late: str = "1 hour") -> DataFrame:
    """Pairs of rows of two streams with equal keys, the right one at the left one's time or up to ``within`` later; state older than that and the watermarks is dropped."""
    a, b = left.withWatermark(left_time, late), right.withWatermark(right_time, late)
    for k in keys:
        b = b.withColumnRenamed(k, f"__{k}")
    near = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"INTERVAL {within}"))
    for k in keys:
        near = near & (F.col(k) == F.col(f"__{k}"))
    return a.join(b, near).drop(*[f"__{k}" for k in keys])


def flushed(df: DataFrame, time: str, key: str, value: str, hold: int, most: int) -> DataFrame:
    """Rows of each key in the order of their value, held back until the value has moved on by more than ``hold`` or more than ``most`` rows wait; what is left comes out when the watermark passes. The position-ordered buffer of a sorted pass."""
    schema = f"{key} long, {value} long, late boolean"

    def step(keys: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting = list(state.get[0]) if state.exists else []
        done = state.get[1] if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({key: keys[0], value: waiting, "late": False})
            return
        fresh = sorted(v for p in parts for v in p[value])
        late = [v for v in fresh if done is not None and v < done]
        waiting = sorted(waiting + [v for v in fresh if done is None or v >= done])
        edge = waiting[-1] - hold if waiting else 0
        n = max(sum(v < edge for v in waiting), len(waiting) - most)
        out, waiting = waiting[:n], waiting[n:]
        state.update((waiting, max([x for x in (done, out[-1] if out else None) if x is not None], default=None)))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), 0) + 3_600_000)
        yield pd.DataFrame({key: keys[0], value: [*late, *out], "late": [True] * len(late) + [False] * len(out)})

    return df.withWatermark(time, "1 hour").groupBy(key).applyInPandasWithState(step, schema, "waiting array<long>, done long", "append", GroupStateTimeout.EventTimeTimeout)


def collected(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """The result of running the stream over what there is now: written to Parquet and read back."""
    query = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(sink)
