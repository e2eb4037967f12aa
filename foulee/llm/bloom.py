"""A blocked Bloom filter as a table of bitmaps, in DataFrame expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foulee.llm.frames import col, fresh
from foulee.session import staged

BITS_PER_ROW = 16
#: 32 MB: what a broadcast of a filter may hold, whatever the input.
MAX_BITS = 1 << 28
#: Bits of one bitmap of ``bitmap_construct_agg``: a block.
BLOCK_BITS = 32768
PROBES = 2


def size_for(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two of bits, by the number of rows. A fuller filter only has more false positives."""
    bits = BLOCK_BITS
    while bits < min(rows * BITS_PER_ROW, max_bits):
        bits *= 2
    return bits


def probes(key: Column, bits: int) -> tuple[Column, list[Column]]:
    """A key's block and its bits within the block, from one 64-bit hash."""
    hashed = F.xxhash64(key)
    block = F.shiftrightunsigned(hashed, 34) % F.lit(max(1, bits // BLOCK_BITS))
    return block, [F.shiftright(hashed, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]


def bitmaps(rows: DataFrame, key: Column, bits: int, at_least: int = 1) -> DataFrame:
    """block and bitmap of the bits that at least so many rows set. Counts combine before the shuffle."""
    block, own = probes(key, bits)
    # A row whose probes fall on the same bit must not look like two rows.
    positions = rows.select(block.alias("block"), F.explode(F.array_distinct(F.array(*own))).alias("bit"))
    often = positions.groupBy("block", "bit").count().filter(F.col("count") >= at_least)
    return often.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.bit_get(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1


def tested(rows: DataFrame, key: Column, bits: int, filters: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``: false only if the filter cannot hold the key. The filter's size has a bound."""
    block, own = probes(key, bits)
    at, bitmap = fresh([*rows.columns, name], "block"), fresh([*rows.columns, name], "bitmap")
    filters = filters.select(F.col("block").alias(at), F.col("bitmap").alias(bitmap))
    joined = rows.withColumn(at, block).join(F.broadcast(filters), at, "left")
    maybe = F.col(bitmap).isNotNull()
    for bit in own:
        maybe = maybe & _is_set(F.col(bitmap), bit)
    return joined.select(*[col(own_name) for own_name in rows.columns], F.coalesce(maybe, F.lit(False)).alias(name))


def members(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows whose column ``name`` is in ``keys``, a written table of distinct keys with more columns or none.
    Only rows that the filter lets through are shuffled."""
    bits = size_for(keys.count())
    filters = staged(bitmaps(keys, F.col(name), bits), "members")
    mark = fresh([*rows.columns, *keys.columns], "_maybe")
    return tested(rows, F.col(name), bits, filters, mark).filter(mark).drop(mark).join(keys, name)


def among(rows: DataFrame, keys: DataFrame, name: str) -> DataFrame:
    """The rows whose column ``name`` is in ``keys``, a written table of distinct keys.

    A first filter drops most other rows. Its false positives are found by their keys alone and make a second
    filter: what that one does not know is in for certain and is not shuffled; the few others are joined.
    """
    bits = size_for(keys.count())
    filters = staged(bitmaps(keys, F.col(name), bits), "members")
    mark, doubt = fresh(rows.columns, "_maybe"), fresh(rows.columns, "_doubt")
    maybe = tested(rows, F.col(name), bits, filters, mark).filter(mark).drop(mark)
    wrong = staged(maybe.select(name).distinct().join(keys, name, "left_anti"), "false_positives")
    few = size_for(wrong.count())
    doubtful = staged(bitmaps(wrong, F.col(name), few), "doubtful")
    marked = tested(maybe, F.col(name), few, doubtful, doubt)
    sure, unsure = (marked.filter(condition).drop(doubt) for condition in (~F.col(doubt), F.col(doubt)))
    return sure.unionByName(unsure.join(keys, name, "left_semi"))
