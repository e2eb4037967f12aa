"""Near-duplicates by SimHash fingerprints that differ in few bits.

Fingerprints: a document's word shingles are hashed, and a bit of the fingerprint is set if it is set in
more than half of the hashes. Equal fingerprints collapse before anything is compared.

Candidates: 64 bits are cut into ``radius + 2`` blocks. Two fingerprints within the radius agree on two
blocks at least, so one row for each pair of blocks finds every link (exact, no sampling). A key that
more than ``TILE`` fingerprints share is dealt over pairs of tiles, so that a task never holds more than
two tiles of it and no bucket is cut short.

Comparison: the fingerprints of many buckets are stored as 64 bit planes, 64 fingerprints to a word. For
each distance ``s`` in the sorted order, all rows are compared with the row ``s`` further at once: planes are
xored, carry-save counters add the differences, and words in which every lane exceeded the radius are
abandoned. A bucket returns a star for each local component, never its pairs.

Cases: null text and text without words have fingerprint zero, and are linked like any other. A null id
never names a component that also has an id. Repeated rows share a fingerprint. An empty table gives an
empty result. Texts are read whole; columns other than id and text are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee.llm import bloom
from foulee.llm.components import components
from foulee.llm.frames import annotate, col, fresh, map_arrow, read, row_hashes
from foulee.llm.tiles import deal
from foulee.operators.lookup import left_lookup
from foulee.session import staged

WORDS = 3
RADIUS = 2
SEED = 42
#: Fingerprints of one key that are compared within one task.
TILE = 2048
#: Hashes that are counted at a time.
_CHUNK = 1 << 15
_PLANES = 8


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """Signed 64-bit SimHash of a text's lower-cased word shingles, repeats included."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    # Joined by single spaces, every shingle is one stretch of the buffer.
    buffer = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words, len(tokens))
    starts, ends = starts[: len(tokens) - width + 1], ends[width - 1 :]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist())
        hashes = np.array([digest(buffer[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str, keep: Sequence[str], words: int = WORDS) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` and ``fp``."""

    def make():
        return lambda texts: [pa.array([fingerprint(text, words) for text in texts], pa.int64())]

    return annotate(docs, text_col, keep, [T.StructField("fp", T.LongType())], make)


def _union(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Joins the sets of many pairs at once; every entry of ``parent`` names a root."""
    while True:
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            return parent
        left, right = left[apart], right[apart]
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while True:
            above = parent[parent]
            if np.array_equal(above, parent):
                break
            parent = above


def local_roots(fps: np.ndarray, ends: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint the first one of its component. Only rows of the same run are compared;
    ``ends`` has the end of each row's run."""
    n = len(fps)
    words = (n + 63) // 64
    index, parent = np.arange(n), np.arange(n)
    longest = int((ends - index).max(initial=0))
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[:n] = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    planes = np.zeros((64, words + longest // 64 + 2), np.uint64)
    planes[:, :words] = packed
    counters = radius.bit_length()
    bias = (1 << counters) - 1 - radius  # so that a carry leaves the counters at radius + 1
    full = ~np.uint64(0)
    for s in range(1, longest):
        lanes = np.zeros(words * 64, np.uint8)
        lanes[:n] = ends - index > s
        lanes = np.packbits(lanes, bitorder="little").view("<u8")
        live = np.flatnonzero(lanes)
        over = ~lanes[live]
        count = [np.full(len(live), full if bias >> k & 1 else 0, np.uint64) for k in range(counters)]
        skip, shift = s // 64, np.uint64(s % 64)
        for at in range(0, 64, _PLANES):
            some = planes[at : at + _PLANES]
            other = some[:, live + skip]
            if shift:
                other = other >> shift | some[:, live + skip + 1] << np.uint64(64 - s % 64)
            for difference in some[:, live] ^ other:
                for k in range(counters):
                    count[k], difference = count[k] ^ difference, count[k] & difference
                over |= difference
            alive = over != full
            if not alive.all():
                live, over = live[alive], over[alive]
                count = [c[alive] for c in count]
                if not len(live):
                    break
        if len(live):
            near = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").reshape(len(live), 64)
            word, lane = np.nonzero(near)
            left = live[word] * 64 + lane
            parent = _union(parent, left, left + s)
    return parent


def _stars(radius: int):
    """Links within each bucket. Rows come sorted by bucket; a bucket may span batches."""

    def flush(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        sizes = np.diff(np.append(starts, len(fps)))
        shared = np.repeat(sizes > 1, sizes)  # a fingerprint alone in its bucket has no candidate
        fps, sizes = fps[shared], sizes[sizes > 1]
        root = local_roots(fps.view("<u8"), np.repeat(np.cumsum(sizes), sizes), radius)
        linked = root != np.arange(len(root))
        return pa.RecordBatch.from_arrays([pa.array(fps[linked]), pa.array(fps[root[linked]])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            keys = np.concatenate([keys, np.stack(columns[:4], axis=1).astype(np.int64)])
            fps = np.concatenate([fps, columns[4]])
            changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            if len(changes):
                yield flush(keys[: changes[-1]], fps[: changes[-1]])
                keys, fps = keys[changes[-1] :], fps[changes[-1] :]
        if len(fps):
            yield flush(keys, fps)

    return run


def _block_keys(fp: Column, radius: int) -> list[Column]:
    """For each pair of blocks, the number of the pair and the bits of both blocks."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [
        F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) for low, high in zip(edges, edges[1:])
    ]
    return [
        F.struct(F.lit(i).alias("pair"), F.shiftleft(a, 32).bitwiseOR(b).alias("bits"))
        for i, (a, b) in enumerate(combinations(blocks, 2))
    ]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect all fingerprints of ``fps`` (distinct ``fp``) within the radius."""
    keyed = fps.select("fp", F.inline(F.array(*_block_keys(F.col("fp"), radius))))
    dealt = deal(keyed, ["pair", "bits"], ["fp"], tile).select("pair", "bits", "low", "high", "fp")
    keys = ["pair", "bits", "low", "high"]
    sorted_rows = dealt.repartition(*keys).sortWithinPartitions(*keys, "fp")
    return map_arrow(sorted_rows, _stars(radius), "a long, b long")


def label(marks: DataFrame, id_col: str, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``marks`` (an id and ``fp``) with ``component``, the smallest id of all documents reachable, and ``root``, a
    fingerprint that names the component even where ids are null or repeat in others."""
    fps = staged(marks.groupBy("fp").agg(F.min(col(id_col)).alias("first")), "distinct_fingerprints")
    roots = components(links(fps.select("fp"), radius, tile))
    rooted = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    rooted = staged(rooted.join(fps, F.col("node") == F.col("fp")).select("fp", "root", "first"), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = left_lookup(rooted, least, ["root"], unique=True).select("fp", "root", "least")
    named = left_lookup(fps, named, ["fp"], unique=True)
    named = named.select("fp", F.coalesce("least", "first").alias("component"), F.coalesce("root", "fp").alias("root"))
    return left_lookup(marks, named, ["fp"], unique=True)


def _without(rows: DataFrame, odd: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` without those of ``odd`` (row0, row1, stays) that do not stay, and one of each that does."""
    bits = bloom.size_for(odd.count())
    filters = staged(bloom.bitmaps(odd, F.col("row0"), bits), "odd_row_filter")
    maybe, stays = fresh(rows.columns, "maybe"), fresh([*rows.columns, "maybe"], "stays")
    tested = bloom.tested(rows, col(names[0]), bits, filters, maybe)
    odd = odd.select(F.col("row0").alias(names[0]), F.col("row1").alias(names[1]), F.col("stays").alias(stays))
    looked_up = left_lookup(tested.filter(maybe).drop(maybe), odd, list(names), unique=True)
    parts = [
        tested.filter(~F.col(maybe)).drop(maybe),
        looked_up.filter(F.col(stays).isNull()).drop(stays),
        # A row may be repeated as a whole; the copies are equal, so any of them can stay.
        looked_up.filter(F.col(stays)).drop(stays).dropDuplicates(list(names)),
    ]
    return reduce(DataFrame.unionByName, parts)


def keep_first(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, then hash of the row.

    Only rows that may go are shuffled: a Bloom filter of those that go lets all others pass.
    """
    names = [fresh(docs.columns, name) for name in ("row_hash", "row_hash_2")]
    own = [col(name) for name in docs.columns]
    hashed = docs.select(*own, *[h.alias(n) for h, n in zip(row_hashes(own), names)])
    marks = hashed.select(col(id_col).alias("id"), *[col(n).alias(f"row{i}") for i, n in enumerate(names)], col(text_col).alias("text"))
    marks = label(staged(fingerprints(marks, "text", ["id", "row0", "row1"], words), "fingerprints"), "id", radius)
    # Counted for each row first: a component that holds a third of all rows shrinks before it meets.
    rows = marks.groupBy("root", "row0", "row1").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    rows = staged(rows, "component_rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "row0", "row1")
    first = rows.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows"))
    # Components of one row that occurs once are not looked at again.
    first = first.filter("rows > 1").select("root", "first.row0", "first.row1", F.lit(True).alias("stays"))
    crowded = left_lookup(rows, first.select("root").withColumn("crowded", F.lit(True)), ["root"], unique=True)
    crowded = crowded.filter("crowded or copies > 1")
    chosen = left_lookup(crowded, first, ["root", "row0", "row1"], unique=True)
    stays = F.coalesce("stays", F.col("crowded").isNull())
    odd = staged(chosen.select("row0", "row1", "copies", stays.alias("stays")).filter("not stays or copies > 1").drop("copies"), "odd_rows")
    return _without(hashed, odd, names).select(*own)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = staged(fingerprints(read(spark, sf_dir, "documents"), "text", ["doc_id"]), "fingerprints")
    return label(marks, "doc_id").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
