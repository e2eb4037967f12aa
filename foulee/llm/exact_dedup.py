"""Exact deduplication by two passes over a Bloom filter.

Pass one counts, in a blocked Bloom filter, how many rows set each bit. A text that occurs twice sets
all its bits twice, so a row with a bit that was set once only is unique. Pass two tests every row:
unique rows go straight to the result; only the others are shuffled, by digest, and grouped exactly.
A false positive of the filter costs a shuffled row, never a wrong result.

The filter has a power of two of bits, 16 a row and at most ``max_filter_bits``
(32 MB by default), so the broadcast has that bound whatever the input. A fuller filter lets more rows
into the shuffle; a large cluster raises the bound.

Everything is DataFrame expressions. Hot groups: copies collapse in partial aggregates, and the join
that brings the survivor back to the copies has an exchange of its own on both sides, so adaptive
execution splits a digest that holds a third of all rows.

Cases: null text counts as empty; empty texts equal each other. A null id is never preferred to an id.
Rows that repeat with the same id are copies like any other: one of them stays. An empty table gives an
empty result. Columns of the input never clash with internal ones, as they travel in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foulee.llm import bloom
from foulee.llm.frames import col, read
from foulee.operators.lookup import left_lookup
from foulee.session import staged

SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def fingerprinted(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """doc (the row, if carried), id, digest of the normalised text, code points of the original."""
    kept = [F.struct(*[col(name) for name in docs.columns]).alias("doc")] if carry else []
    text = F.coalesce(col(text_col), F.lit(""))
    return docs.select(
        *kept,
        col(id_col).alias("id"),
        F.sha2(normalised(text), 256).alias("digest"),
        F.length(text).cast("long").alias("n"),
    )


def mark_copies(rows: DataFrame, n_rows: int, max_filter_bits: int = bloom.MAX_BITS) -> DataFrame:
    """``rows`` of ``fingerprinted`` with keep_id, group_size and kept.

    Of equal digests the row with the most code points stays, then the smallest id.
    """
    bits = bloom.size_for(n_rows, max_filter_bits)
    twice = staged(bloom.bitmaps(rows, F.col("digest"), bits, at_least=2), "repeated_bits")
    tested = bloom.tested(rows, F.col("digest"), bits, twice, "maybe")
    unique = tested.filter(~F.col("maybe")).select(
        *rows.columns,
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    # Written once, so the row numbers that tell repeated rows apart never change.
    suspects = staged(
        tested.filter("maybe").select(*rows.columns, F.monotonically_increasing_id().alias("row")), "suspects"
    )
    order = F.struct((-F.col("n")).alias("n"), F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"))
    survivors = suspects.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    survivors = survivors.select(
        "digest", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"
    )
    grouped = left_lookup(suspects, survivors, ["digest"], unique=True).select(
        *rows.columns, "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
    )
    return unique.unionByName(grouped)


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_filter_bits: int = bloom.MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Unique rows are never shuffled."""
    marked = mark_copies(fingerprinted(docs, id_col, text_col, carry=True), docs.count(), max_filter_bits)
    return marked.filter("kept").select(*[F.col("doc")[name].alias(name) for name in docs.columns])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    # Texts are read once; from here on a row is an id, a digest and a length.
    rows = staged(fingerprinted(docs, "doc_id", "text", carry=False), "digests")
    return mark_copies(rows, rows.count()).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


ORACLE_OP9 = """
WITH hashed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM hashed
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
