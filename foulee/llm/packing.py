"""Best-fit packing of token sequences, in bulk-synchronous rounds.

Documents of equal length are interchangeable, and so are gaps of equal size. The rounds therefore run
over size classes: at most ``max_tokens`` of documents and of gaps, whatever the input. A round takes the
documents and the gaps in order of size and sweeps for the successor of each length, the smallest gap that
holds it. Where several lengths want one gap the longest document goes first, and within a length the rank
decides. Gaps are updated and the rounds go on until every document has its place; lengths without a gap
open sequences. A length fills a sequence before it takes the next of equal gap. What a round decides are intervals: documents of one length with ranks from ``a`` on go to
the sequences from ``s`` on, one each, at offset ``o``.

The rows stay where they are: the tokenizing task numbers the rows of each length as it writes them, sums
over the tasks turn that into ranks, and a broadcast of the intervals (their number does not grow with the
rows) places each row. Only one narrow join is shuffled, whose key holds the task, so no length is hot.

Cases: null and empty text is one piece that holds the end id alone. Repeated rows are packed each. An
empty table gives an empty result. Nothing is dropped: only documents longer than a sequence are cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foulee.llm.frames import annotate, map_arrow, read
from foulee.llm.word_bpe import encoder
from foulee.operators.lookup import left_lookup
from foulee.session import staged

MAX_TOKENS = 2048
END_ID = 0

_PIECE = "struct<piece:int,start:long,length:long,ids_crc32:long,part:int,nth:long>"


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def pieces(
    docs: DataFrame, text_col: str, keep: Sequence[str], tokenizer: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Columns ``keep`` and one row per piece of each text's ids and the end id, numbered by task (part)
    and, within it, by length (nth)."""
    fields = [T.StructField("pieces", T.DataType.fromDDL(f"array<{_PIECE}>"))]
    if with_ids:
        fields.append(T.StructField("ids", T.DataType.fromDDL("array<array<int>>")))
    kind = pa.list_(
        pa.struct(
            [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32()), ("nth", pa.int64())]
        )
    )

    def make():
        encode, part = encoder(tokenizer).encode, TaskContext.get().partitionId()
        seen = [0] * (max_tokens + 1)
        end = int(end_id).to_bytes(4, "little")

        def work(texts):
            rows, ids = [], []
            for found in encode([(text or b"").decode() for text in texts]):
                found += end
                total = len(found) // 4
                own = []
                for i, start in enumerate(range(0, total, max_tokens)):
                    length = min(max_tokens, total - start)
                    own.append((i, start, length, zlib.crc32(found[4 * start : 4 * (start + length)]), part, seen[length]))
                    seen[length] += 1
                rows.append([dict(zip(("piece", "start", "length", "ids_crc32", "part", "nth"), one)) for one in own])
                if with_ids:
                    ids.append([np.frombuffer(found[4 * a : 4 * (a + n)], "<u4").astype(np.int32) for _, a, n, *_ in own])
            made = [pa.array(rows, kind)]
            return [*made, pa.array(ids, pa.list_(pa.list_(pa.int32())))] if with_ids else made

        return work

    found = annotate(docs, text_col, keep, fields, make)
    if with_ids:
        found = found.select(*keep, F.inline(F.arrays_zip("pieces", "ids")))
        return found.select(*keep, "pieces.*", "ids")
    return found.select(*keep, F.inline("pieces"))


def plan(counts: dict[int, int], size: int = MAX_TOKENS) -> np.ndarray:
    """Intervals (length, first rank, first sequence, offset, number) that place ``counts`` pieces of each length."""
    waiting = dict(counts)
    ranks = dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap to (first sequence, number)
    out, opened = [], 0

    def place(length: int, first: int, number: int, offset: int) -> None:
        out.append((length, ranks[length], first, offset, number))
        ranks[length] += number
        waiting[length] -= number

    def fill(length: int, first: int, many: int, gap: int) -> tuple[int, int]:
        """Fills sequences of one gap, one after the other; how many of them, and the largest gap left in those."""
        full, rest = divmod(waiting[length], gap // length)
        if full >= many:
            full, rest = many, 0
        for i in range(gap // length if full else rest):
            place(length, first, full + (i < rest), size - gap + i * length)
        left = [(gap % length, first, full)] * (full > 0) + [(gap - rest * length, first + full, 1)] * (rest > 0)
        for own, start, number in left:
            freed.setdefault(own, []).append((start, number))
        return full + (rest > 0), max(own for own, *_ in left)

    while any(waiting.values()):
        # Successor sweep: longest first, so that the larger of two claims to a gap wins.
        open_gaps, claims = sorted(gaps), []
        at = len(open_gaps)
        for length in sorted((n for n, count in waiting.items() if count), reverse=True):
            while at and open_gaps[at - 1] >= length:
                at -= 1
            claims.append((length, open_gaps[at] if at < len(open_gaps) else None))
        freed: dict[int, list[tuple[int, int]]] = {}
        for gap, wanted in groupby(claims, key=lambda claim: claim[1]):
            if gap is None:
                largest = 0
                for length, _ in wanted:
                    if length <= largest:
                        break  # it may fit what has just been opened
                    number, left = fill(length, opened, -(-waiting[length] // (size // length)), size)
                    largest = max(largest, left)
                    opened += number
                continue
            runs = gaps.pop(gap)
            for length, _ in wanted:
                while runs and waiting[length]:
                    first, many = runs.pop()
                    took, _ = fill(length, first, many, gap)
                    if took < many:
                        runs.append((first + took, many - took))
            if runs:
                freed.setdefault(gap, []).extend(runs)
        freed.pop(0, None)
        for gap, runs in freed.items():
            gaps.setdefault(gap, []).extend(runs)
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def _places(intervals, columns: Sequence[str]):
    """Adds sequence_id and offset to rows with a length and a rank, by binary search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = intervals.value
        key = table[:, 0] << 48 | table[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.num_columns - 2 + i).to_numpy() for i in range(2))
            at = np.searchsorted(key, length << 48 | rank, side="right") - 1
            sequence = table[at, 2] + rank - table[at, 1]
            made = [pa.array(sequence), pa.array(table[at, 3])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *made], [*columns, "sequence_id", "offset"])

    return run


def pack(parts: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``parts``, a written table from ``pieces``, with sequence_id and offset instead of part and nth."""
    counts = parts.groupBy("part", "length").agg((F.max("nth") + 1).alias("count"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = staged(counts.withColumn("before", F.coalesce(F.sum("count").over(earlier), F.lit(0))), "lengths")
    # At most max_tokens rows.
    totals = {row.length: row.total for row in counts.groupBy("length").agg(F.sum("count").alias("total")).collect()}
    intervals = parts.sparkSession.sparkContext.broadcast(plan(totals, max_tokens))
    columns = [name for name in parts.columns if name not in ("part", "nth")]
    ranked = left_lookup(parts, counts.drop("count"), ["part", "length"], unique=True)
    ranked = ranked.select(*columns, F.col("length").alias("_length"), (F.col("before") + F.col("nth")).alias("_rank"))
    schema = T.StructType([*[parts.schema[name] for name in columns]])
    schema = schema.add("sequence_id", "long").add("offset", "long")
    return map_arrow(ranked, _places(intervals, columns), schema)


def best_fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
    max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (and the ids, if asked for)."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = staged(pieces(docs, "text", ["doc_id"], tokenizer or tokenizer_path(), max_tokens, end_id, with_ids), "pieces")
    return pack(parts, max_tokens).withColumnRenamed("doc_id", id_col)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(read(spark, sf_dir, "documents"))
