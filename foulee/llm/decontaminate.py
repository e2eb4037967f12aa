"""Benchmark decontamination by exact word windows.

Words of the benchmark get numbers. A document becomes an array of these numbers (0: a word that no
benchmark item has), so only windows without a 0 can hit; their hashes are looked up in the sorted hashes
of all benchmark windows, and a hit is verified against the window's own words. A window is ``width``
consecutive words; a shorter item is one window of its length. Every word inside an occurrence is hit.

The benchmark is broadcast in blocks of at most ``block_bytes`` of text, so no task ever holds more of it,
however large it is: one block, nearly always, is one pass over the documents, and each further block is
another pass whose hits are merged. Documents are never shuffled with one block.

Cases: null and empty text has no words and stays. An item without words has no window; an item without
id marks words but is not listed. Items that repeat count once. Empty benchmark: nothing is hit.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee.llm.frames import annotate, col, fresh, read, row_hashes, ship_package
from foulee.operators.lookup import left_lookup
from foulee.session import staged

WIDTH = 10
BLOCK_BYTES = 32 << 20

#: In UTF-8, words are runs of ASCII digits and letters (lower-cased) and of all bytes above ASCII.
_WORD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD).split()


class Windows:
    """The windows of some benchmark items, as arrays of word numbers for each length."""

    def __init__(self, items: Iterable[tuple[str | None, bytes | None]], width: int = WIDTH) -> None:
        self.number: dict[bytes, int] = {}
        self.owners: dict[bytes, set[str]] = defaultdict(set)
        hashes = defaultdict(set)
        for item, text in items:
            numbers = np.array([self.number.setdefault(w, len(self.number) + 1) for w in words(text)], np.int32)
            length = min(width, len(numbers))
            if not length:
                continue
            rows = np.lib.stride_tricks.sliding_window_view(numbers, length)
            hashes[length].update(self._hash(rows).tolist())
            for row in rows:
                self.owners[row.tobytes()] |= {item} - {None}
        self.hashes = {length: np.array(sorted(found), np.uint64) for length, found in hashes.items()}

    @staticmethod
    def _hash(rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), np.uint64)
        for i in range(rows.shape[1]):
            out = out * _BASE + rows[:, i].astype(np.uint64)
        return out

    def scan(self, text: bytes | None) -> tuple[int, list[int], list[str]]:
        """Number of words, positions of the words that are hit, items that hit."""
        tokens = words(text)
        numbers = np.fromiter((self.number.get(w, 0) for w in tokens), np.int32, len(tokens))
        hit, items = np.zeros(len(tokens) + 1, np.int32), set()
        unknown = np.concatenate(([0], np.cumsum(numbers == 0)))
        for length, known in self.hashes.items():
            if length > len(tokens):
                continue
            at = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(at):
                continue
            rows = numbers[at[:, None] + np.arange(length)]
            place = np.searchsorted(known, hashed := self._hash(rows))
            near = known[np.minimum(place, len(known) - 1)] == hashed
            for start, row in zip(at[near].tolist(), rows[near]):
                owners = self.owners.get(row.tobytes())  # the words themselves, not their hash
                if owners is not None:
                    hit[start] += 1
                    hit[start + length] -= 1
                    items |= owners
        return len(tokens), np.flatnonzero(np.cumsum(hit[:-1])).tolist(), sorted(items)


def _pass(docs: DataFrame, text_col: str, keep: Sequence[str], items: DataFrame, names: Sequence[str], width: int):
    """One block against all documents. The block's size was checked by the caller."""
    rows = [(row.item, row.text.encode() if row.text else None) for row in items.collect()]
    block = docs.sparkSession.sparkContext.broadcast(Windows(rows, width))

    def make():
        windows = block.value

        def work(texts):
            found = [windows.scan(text) for text in texts]
            counts, hits, owners = zip(*found)
            return [
                pa.array(counts, pa.int64()),
                pa.array(hits, pa.list_(pa.int32())),
                pa.array(owners, pa.list_(pa.string())),
            ]

        return work

    kinds = [T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType())]
    return annotate(docs, text_col, keep, [T.StructField(*pair) for pair in zip(names, kinds)], make)


def mark(
    docs: DataFrame,
    text_col: str,
    keep: Sequence[str],
    benchmark: DataFrame,
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
    names: Sequence[str] = ("n_words", "hits", "items"),
) -> DataFrame:
    """Columns ``keep`` of every document, its number of words, positions of hit words and items that hit."""
    items = benchmark.select(col(item_col).cast("string").alias("item"), col(item_text_col).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A part is far from full on average, so that uneven parts stay under the bound too.
    parts = 1 if size <= block_bytes else -(-2 * size // block_bytes)
    if parts == 1:
        return _pass(docs, text_col, keep, items, names, width)
    row = [fresh(docs.columns, name) for name in ("row_hash", "row_hash_2")]
    own = [col(name) for name in docs.columns]
    docs = docs.select(*own, *[hashed.alias(name) for hashed, name in zip(row_hashes(own), row)])
    items = items.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
    count, hits, owners = names
    found = []
    for part in range(parts):
        one = items.filter(F.col("part") == part).drop("part")
        if part == 0:
            first = _pass(docs, text_col, [*keep, *row], one, names, width)
        else:
            more = _pass(docs, text_col, row, one, names, width).filter(F.size(hits) > 0)
            found.append(staged(more.drop(count).distinct(), "hits"))
    added = reduce(DataFrame.unionByName, found).groupBy(*row)
    added = added.agg(F.flatten(F.collect_list(hits)).alias("more"), F.flatten(F.collect_list(owners)).alias("others"))
    empty = [F.array().cast("array<int>"), F.array().cast("array<string>")]
    return left_lookup(first, added, row, unique=True).select(
        *[col(name) for name in keep],
        count,
        F.array_sort(F.array_union(hits, F.coalesce("more", empty[0]))).alias(hits),
        F.array_sort(F.array_union(owners, F.coalesce("others", empty[1]))).alias(owners),
    )


def _cut(text: bytes | None, hits: list[int]) -> str | None:
    """The text without the stretches of hit words; what separates two hit words goes with them."""
    if text is None or not hits:
        return text and text.decode()
    spans, at = [], 0
    shown = text.translate(_WORD)
    for word in shown.split():
        at = shown.index(word, at)
        spans.append((at, at + len(word)))
        at += len(word)
    out, done, hit = [], 0, set(hits)
    for i in hits:
        if i - 1 not in hit:
            out.append(text[done : spans[i][0]])
        done = spans[i][1]
    return b"".join([*out, text[done:]]).decode()


def remove(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", what: str = "documents", **options
) -> DataFrame:
    """``docs`` without the documents (or, ``what="spans"``, without the stretches) that hit the benchmark."""
    names = [fresh(docs.columns, name) for name in ("n_words", "hits", "items")]
    marked = mark(docs, text_col, docs.columns, benchmark, names=names, **options)
    if what == "documents":
        return marked.filter(F.size(names[1]) == 0).select(*[col(name) for name in docs.columns])

    ship_package(docs.sparkSession)

    @F.udf("string")
    def cut(text, hits):
        return _cut(None if text is None else text.encode(), hits)

    clean = F.when(F.size(names[1]) == 0, col(text_col)).otherwise(cut(col(text_col), col(names[1])))
    return marked.select(*[clean.alias(name) if name == text_col else col(name) for name in docs.columns])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    marked = mark(docs, "text", ["doc_id"], read(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


ORACLE_OP5 = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), sized AS (
  SELECT item_id, words, least(10, len(words)) AS width FROM item WHERE len(words) > 0
), wanted AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, width, array_to_string(words[i : i + width - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - width + 2)) AS i FROM sized)
), placed AS (
  SELECT doc_id, width, i, array_to_string(words[i : i + width - 1], ' ') AS gram
  FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS i
        FROM doc, (SELECT DISTINCT width FROM wanted) WHERE len(words) >= width)
), hit AS (
  SELECT DISTINCT doc_id, width, i, item_id FROM placed JOIN wanted USING (width, gram)
), hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + width)) AS place FROM hit) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
