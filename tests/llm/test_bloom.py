from pyspark.sql import functions as F

from foulee.llm import bloom
from foulee.session import staged


def test_membership_is_exact_at_any_fill(spark, monkeypatch):
    rows = spark.range(6000).select((F.col("id") % 3000).alias("key"), "id").unionByName(spark.createDataFrame([(None, 7)], "key long, id long"))
    keys = staged(spark.range(0, 3000, 3).select(F.col("id").alias("key")), "keys")
    for most in (bloom.MAX_BITS, 1):
        monkeypatch.setattr(bloom, "size_for", lambda n, _=0, most=most: bloom.BLOCK_BITS if most == 1 else 1 << 17)
        for found in (bloom.among(rows, keys, "key"), bloom.members(rows, keys, "key").select("key", "id")):
            assert sorted(r.id for r in found.collect()) == [i for i in range(6000) if i % 3 == 0]
    none = keys.limit(0)
    assert bloom.among(rows, staged(none, "keys"), "key").count() == 0 and bloom.among(rows.limit(0), keys, "key").count() == 0


def test_columns_of_any_name(spark):
    rows = spark.range(100).select(
        "id", F.col("id").alias("block"), F.lit("b").alias("bitmap"), F.lit(1).alias("_maybe"), F.lit(2).alias("_doubt"), F.lit(3).alias("a.b")
    )
    keys = staged(spark.range(0, 100, 7), "keys")
    for found in (bloom.among(rows, keys, "id"), bloom.members(rows, keys, "id")):
        assert sorted(map(tuple, found.select(*[f"`{c}`" for c in rows.columns]).collect())) == [(i, i, "b", 1, 2, 3) for i in range(0, 100, 7)]
