"""Dealing the rows of crowded keys over pairs of tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foulee.operators.lookup import left_lookup
from foulee.session import staged

_BUCKETS = 1 << 16


def deal(rows: DataFrame, keys: Sequence[str], spread_by: Sequence[str], tile: int) -> DataFrame:
    """``rows`` with low and high, so that any two rows of a key meet in a group (keys, low, high).

    A key with more than ``tile`` rows is cut into tiles by a hash of ``spread_by``; each row goes to every
    group that holds its tile, and a group has two tiles at most. Other keys stay one group.
    """
    # Few buckets are counted first, so that a task sends a bounded number of counts; only keys of crowded
    # buckets are counted one by one. Both tables are written, so Spark knows how small they are.
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))
    full = rows.groupBy(bucket.alias("bucket")).count().filter(F.col("count") > tile).select("bucket")
    full = staged(full, "crowded_buckets")
    counted = rows.select(*keys, bucket.alias("bucket")).join(full, "bucket", "left_semi").groupBy(*keys).count()
    crowded = counted.filter(F.col("count") > tile)
    crowded = crowded.select(*keys, F.ceil(F.col("count") / tile).cast("int").alias("tiles"))
    dealt = left_lookup(rows, staged(crowded, "crowded_keys"), keys, unique=True)
    own = F.when(F.col("tiles").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread_by), F.col("tiles")).cast("int"))
    dealt = dealt.select(*rows.columns, own.alias("own"), F.coalesce("tiles", F.lit(1)).alias("tiles"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    dealt = dealt.select(*rows.columns, "own", other)
    return dealt.select(*rows.columns, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
