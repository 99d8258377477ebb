"""Shared helpers."""

import zlib

from pyspark.sql import functions as F

from diurna.llm import common


def test_training_rows(spark):
    rows = spark.range(-50, 500).select("id", common.is_training_row(F.col("id")).alias("t")).collect()
    assert all(r["t"] == (zlib.crc32(str(r["id"]).encode()) % 3 != 1) for r in rows)


def test_ascii_lower(spark):
    texts = [None, "", "ABC xyz", "ÀÉÎ ABC", "İSTANBUL", "K Å ẞ", "\x00Z", "\U00010400 AZ", "z" * 50000 + "Z"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(common.ascii_lower(F.col("t"))).collect()]
    assert got == ["".join(c.lower() if "A" <= c <= "Z" else c for c in t or "") for t in texts]


def test_stash_writes_to_the_shared_folder(spark):
    df = common.stash(spark.range(5).withColumn("x", F.array(F.lit(None).cast("string"))), "test")
    assert df.count() == 5 and all("/diurna/test-" in f for f in df.inputFiles())
    assert common.stash(spark.range(0), "none").count() == 0
