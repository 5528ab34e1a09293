"""Media columns: texts stored in progressive JPEG streams, read back as bytes, coefficients and RGB tensors.

The payload is a text's UTF-8 with zero bytes up to a positive multiple of 64; null texts are empty. It is
stored in the stream's coefficients without loss (see ``jpeg``). Repeated rows get the same result each;
equal texts give equal values, whatever else is in the table. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import jpeg
from strandline.llm.bpe import few
from strandline.llm.common import table


def features(rgb: np.ndarray) -> str:
    """Height, width, the mean of each channel in thousandths, and a checksum of the tensor."""
    total = rgb.reshape(-1, 3).sum(axis=0, dtype=np.int64) * 1000 // (rgb.shape[0] * rgb.shape[1])
    return f"{rgb.shape[0]}x{rgb.shape[1]}:" + ",".join(map(str, total.tolist())) + f":{zlib.crc32(rgb.tobytes()):08x}"


def media(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (*keys, n_bytes, media, payload, height, width, rgb, feature) of all rows of docs. media is the stream, payload what is read back from it, rgb the full-resolution tensor as bytes (row, column, channel)."""
    rows = docs.select(*keys, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def one(text: str) -> tuple:
        data = text.encode()
        stream = jpeg.write(data + bytes(-len(data) % jpeg.UNIT if data else jpeg.UNIT))
        frame = jpeg.read(stream)
        rgb = frame.pixels()
        return len(data), stream, jpeg.payload(frame), frame.height, frame.width, rgb.tobytes(), features(rgb)

    def each(batches):
        for whole in batches:
            for b in few(whole):
                out = [one(x.as_py()) for x in b.column("text")]
                rest = [k for k in b.schema.names if k != "text"]
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.string()]
                columns = [pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*[b.column(k) for k in rest], *columns], [*rest, "n_bytes", "media", "payload", "height", "width", "rgb", "feature"])

    return rows.mapInArrow(each, f"{types}, n_bytes long, media binary, payload binary, height int, width int, rgb binary, feature string")


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media(table(spark, sf_dir, "documents"), ["doc_id"])
    tail = F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32")
    return out.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"), tail,
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), "feature",
        "height", "width", F.octet_length("rgb").cast("long").alias("rgb_bytes"),
    )
