"""Deduplication and dimension lookups that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_FINGERPRINT = "_cle_repartie"


def keep_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; null keys count as one key. The smallest row survives.

    ``dropDuplicates`` keeps whichever row a task sees first. Taking the minimum over the other
    columns, in column order with nulls first, makes the survivor the same on every run, and is
    still a partial aggregate: copies collapse before the shuffle, so a key holding a third of
    all rows reaches its reducer as one row per map task.
    """
    others = [name for name in df.columns if name not in keys]
    if not others:
        return df.distinct()
    survivors = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_garde"))
    return survivors.select(
        *[F.col(name) if name in keys else F.col("_garde")[name].alias(name) for name in df.columns]
    )


def left_lookup(
    df: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    unique: bool = False,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """``df`` left-joined to ``dimension`` on ``keys``, never adding rows.

    The dimension is reduced to one row per key unless it is known to be ``unique``. No broadcast
    is forced: Spark broadcasts the dimension when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise. For that second
    case the join also compares a hash of the key. It changes no match, but it differs from the
    keys the dimension was grouped by, so both sides get an exchange directly under the join,
    which is what lets adaptive execution split a hot key. Rows without a key match nothing; a
    hash of their ``spread_by`` columns, if given, keeps them from meeting in one partition. Name
    only columns the result needs anyway: the join has to carry them.
    """
    one_per_key = dimension if unique else keep_one(dimension, keys)
    fingerprint = F.xxhash64(*keys)
    if spread_by:
        no_key = reduce(or_, [F.col(key).isNull() for key in keys])
        fingerprint = F.when(no_key, F.xxhash64(*spread_by)).otherwise(fingerprint)
    return (
        df.withColumn(_FINGERPRINT, fingerprint)
        .join(one_per_key.withColumn(_FINGERPRINT, F.xxhash64(*keys)), on=[*keys, _FINGERPRINT], how="left")
        .select(*df.columns, *[name for name in dimension.columns if name not in keys])
    )
