"""Language identification by bit-sliced Bloom filters of character n-grams.

One table serves all languages: a slot is a bit mask with one bit per language, an n-gram sets its
language's bit in ``PROBES`` slots, and the AND of these slots names all languages that contain the n-gram.
A text's languages are compared by popcounts, each corrected for its filter's false positive rate.

Learning takes at most about ``max_docs`` labelled documents of each language, chosen by a hash of the id
(a documented bound: the filters hold n-grams that at least ``MIN_SHARE`` of a language's documents have, so
their number has the bound n-grams per document / ``MIN_SHARE``, whatever the corpus). A quarter of all
documents, by CRC-32 of the id, is never learned from. Prediction reads nothing but the text, whole.

Cases: null text, empty text and text without letters are ``und`` with score 0; so is everything if
nothing could be learned. A null id is neither learned from nor held out. Equal counts go to the language
that comes first in order. Repeated rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee.llm.frames import annotate, col, fresh, map_arrow, read, slices

SIZES = (2, 3, 4)
MIN_SHARE = 0.01
MAX_DOCS = 4000
PROBES = 3
SLOTS_PER_GRAM = 8
UNKNOWN = "und"
#: Share of a text's n-grams that its language must know for the text to be kept by ``identified``.
MIN_SCORE = 0.2
_CHUNK = 1 << 16


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def grams(text: bytes | None) -> Iterator[np.ndarray]:
    """Hashes of the n-grams within words, word ends marked, in pieces of bounded size."""
    points = np.frombuffer((text or b"").decode().lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return
    first = np.concatenate(([True], letter[:-1]))  # of what is no letter, one mark is left
    word = np.concatenate(([0], np.where(letter, points, 0)[letter | first], [0])).astype(np.uint64)
    for at in range(0, len(word), _CHUNK):
        for size in SIZES:
            part = word[at : at + _CHUNK + size - 1]
            count = len(part) - size + 1
            if count <= 0:
                continue
            h, inner = np.full(count, size, np.uint64), np.ones(count, bool)
            for i in range(size):
                own = part[i : i + count]
                h = h * np.uint64(0x9E3779B97F4A7C15) + own
                if 0 < i < size - 1:
                    inner &= own > 0
            if size == 2:
                inner &= (part[:count] > 0) | (part[1 : 1 + count] > 0)
            yield _mix(h[inner])


class Filters:
    """The bit-sliced filter of all languages."""

    def __init__(self, found: dict[str, np.ndarray]) -> None:
        self.languages = sorted(found)
        total = sum(map(len, found.values()))
        self.bits = max(10, int(max(total, 1) * SLOTS_PER_GRAM - 1).bit_length())
        self.table = np.zeros((1 << self.bits, -(-max(len(found), 1) // 8)), np.uint8)
        for i, name in enumerate(self.languages):
            for slot in self._slots(found[name]):
                self.table[slot, i // 8] |= np.uint8(1 << i % 8)  # the same value wherever a slot repeats
        fill = np.array([np.count_nonzero(self.table[:, i // 8] >> (i % 8) & 1) for i in range(len(found))]) / len(self.table)
        self.false = fill**PROBES

    def _slots(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Independent places for each probe, from halves of the hash."""
        low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
        mask = np.uint64((1 << self.bits) - 1)
        return [((low + np.uint64(i) * high) & mask).astype(np.int64) for i in range(PROBES)]

    def predict(self, text: bytes | None) -> tuple[str, float]:
        n, hits = 0, np.zeros(len(self.languages))
        for hashes in grams(text):
            n += len(hashes)
            if not self.languages:
                continue
            found = None
            for slot in self._slots(hashes):
                found = self.table[slot] if found is None else found & self.table[slot]
            masks = np.unpackbits(found, axis=1, bitorder="little")
            hits += masks[:, : len(hits)].sum(0)
        if not n or not len(hits):
            return UNKNOWN, 0.0
        share = np.clip((hits / n - self.false) / np.maximum(1 - self.false, 1e-9), 0, 1)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def _remainder(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 4


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of each language have an n-gram."""
    for batch in slices(batches, 1):
        languages = np.array(batch.column(0).to_pylist(), object)
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for name in sorted(set(languages)):
            own = [np.unique(np.concatenate([*grams(texts[i]), np.zeros(0, np.uint64)])) for i in np.flatnonzero(languages == name)]
            hashes, counts = np.unique(np.concatenate(own), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(hashes), pa.string()), pa.array(hashes.view(np.int64)), pa.array(counts)],
                ["lang", "gram", "documents"],
            )


#: Places in the draw of documents to learn from.
DRAWS = 1 << 60


def _draw(hashed: Column) -> Column:
    """A hash as a place in the draw, its low bits first."""
    low, high = F.pmod(hashed, F.lit(1 << 20)), F.shiftrightunsigned(hashed, 20).bitwiseAND(F.lit((1 << 40) - 1))
    return F.shiftleft(low, 40) + high


def sample_limit(count: int, max_docs: int) -> int:
    """Places below which a share of ``count`` documents falls that is about ``max_docs``: never none."""
    return max(1, max_docs * DRAWS // count)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS) -> Filters:
    """Filters from labelled documents that are not held out."""
    labelled = docs.select(col(lang_col).alias("lang"), col(text_col).alias("text"), col(id_col).alias("id"))
    labelled = labelled.filter(F.col("lang").isNotNull() & (_remainder(F.col("id")) != 2))
    counts = {row.lang: row["count"] for row in labelled.groupBy("lang").count().collect()}  # a row per language
    place, limit = _draw(F.xxhash64(F.lit("sample"), "id")), F.lit(DRAWS)
    for name, count in counts.items():
        if count > max_docs:
            limit = F.when(F.col("lang") == name, F.lit(sample_limit(count, max_docs))).otherwise(limit)
    sample = labelled.filter(place < limit).select("lang", "text")
    seen = sample.groupBy("lang").count().withColumnRenamed("count", "all")
    counted = map_arrow(sample, _document_counts, "lang string, gram long, documents long")
    shares = counted.groupBy("lang", "gram").agg(F.sum("documents").alias("documents"))
    common = shares.join(seen, "lang").filter(F.col("documents") >= F.col("all") * MIN_SHARE)
    found = {name: [] for name in counts}
    for row in common.select("lang", "gram").toLocalIterator():
        found[row.lang].append(row.gram)
    return Filters({name: np.array(kept, np.int64).view(np.uint64) for name, kept in found.items()})


def predict(docs: DataFrame, filters: Filters, text_col: str, keep: Sequence[str], names: Sequence[str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep``, the language and the share of the text's n-grams that it knows."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def make():
        own = shared.value

        def work(texts):
            found = [own.predict(text) for text in texts]
            return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

        return work

    return annotate(docs, text_col, keep, [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())], make)


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without the documents whose language stays unknown or hardly knows the text."""
    names = [fresh(docs.columns, name) for name in ("lang_pred", "score")]
    found = predict(docs, learn(docs, id_col, text_col, lang_col), text_col, docs.columns, names)
    sure = (col(names[0]) != UNKNOWN) & (col(names[1]) >= min_score)
    return found.filter(sure).select(*[col(name) for name in docs.columns])


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = predict(docs, learn(docs), "text", ["doc_id"])
    held_out = F.coalesce(_remainder(F.col("doc_id")) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
