"""Packed keys come back whole at every length."""

import random

from pyspark.sql import functions as F

from strandline.functions import sequence as S


def test_packed_keys_of_every_length(spark):
    r = random.Random(1)
    keys = ["T" * 31, *["".join(r.choices("ACGT", k=n)) for n in range(1, 32) for _ in range(3)]]
    for n in range(1, 32):
        own = spark.createDataFrame([(k,) for k in keys if len(k) == n], "key string")
        out = own.select("key", S.unpacked_key(S.packed_key(F.col("key")), n).alias("back")).collect()
        assert out and all(x.key == x.back for x in out)
