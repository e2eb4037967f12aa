"""Quality by importance resampling: how much likelier a text is under the target than under the raw corpus.

Hashed word n-grams (n up to ``NGRAMS``) fall into ``BUCKETS`` buckets. Two generative models, of the target
(documents labelled as good) and of all documents, are smoothed bucket frequencies; a document's log weight
is the sum over its n-grams of the difference of their log probabilities. Adding Gumbel noise to the log weights
and taking the largest samples without replacement in proportion to the weights.

Both models count every document they stand for: a task adds up its documents in one array of ``BUCKETS`` counters, so what is
gathered is bounded by tasks and buckets, not by n-grams, and no frequent n-gram meets in one task. The sample is a share
of all documents; its last key is found by counting in a few passes over ranges of keys, without a global sort.

Noise comes from a hash of the id and the text, so a run can be repeated. A long text has a weight of large size either
way, as importance weights have.

Cases: null and empty texts have log weight 0. Ids without a label, and labels without a document, are not target; a
document with any good label is target once. Without target documents every log weight is 0. Rows that repeat are each
weighted; equal keys are taken together, so ties may make the sample larger by their number. Empty tables give
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee.llm import bloom
from foulee.llm.frames import annotate, col, map_arrow, read, slices
from foulee.session import staged

BUCKETS = 1 << 16
NGRAMS = 2
SMOOTHING = 1.0
#: Share of the documents that the query samples.
SHARE = 0.5
_CACHED = 500_000
_PIECE = 1 << 18
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Buckets of a text's word n-grams, ASCII lower-cased, words between white space."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> Iterator[np.ndarray]:
        words = (text or b"").lower().split()
        if len(self.known) > _CACHED:
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        for n in range(1, NGRAMS + 1):
            for at in range(0, len(hashes) - n + 1, _PIECE):
                count = min(_PIECE, len(hashes) - n + 1 - at)
                h = np.full(count, n, np.uint64)
                for i in range(n):
                    h = (h ^ hashes[at + i : at + i + count]) * _PRIME
                    h ^= h >> np.uint64(32)
                yield (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """How many n-grams of all documents fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, found = Grams(), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches, 0):
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                for buckets in grams(text):
                    np.add.at(found, buckets, 1)
        used = np.flatnonzero(found)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(found[used])], ["bucket", "n"])

    rows = map_arrow(docs.select(col(text_col).alias("text")), count, "bucket int, n long")
    table = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows
    out = np.zeros(BUCKETS)
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each bucket log p(target) - log p(raw); zero if there is no target."""
    if not target.sum():
        return np.zeros(len(raw))
    log = [np.log(found + SMOOTHING) - np.log((found + SMOOTHING).sum()) for found in (target, raw)]
    return log[0] - log[1]


def weigh(docs: DataFrame, text_col: str, keep: Sequence[str], ratio: np.ndarray, names: Sequence[str] = ("log_weight", "n_grams")) -> DataFrame:
    """Columns ``keep``, the log weight and the number of n-grams of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def make():
        grams, own = Grams(), shared.value

        def work(texts):
            weights, sizes = [], []
            for text in texts:
                total, n = 0.0, 0
                for buckets in grams(text):
                    total += float(own[buckets].sum())
                    n += len(buckets)
                weights.append(total)
                sizes.append(n)
            return [pa.array(weights, pa.float64()), pa.array(sizes, pa.int64())]

        return work

    return annotate(docs, text_col, keep, [T.StructField(names[0], T.DoubleType()), T.StructField(names[1], T.LongType())], make)


def gumbel(*seed: Column) -> Column:
    """Standard Gumbel noise from a hash of the columns."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), *seed), 11) + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, name: str, k: int) -> float | None:
    """The k-th largest value of a column of a written table, by counting values in ever smaller ranges."""
    low, high, n = keys.agg(F.min(name), F.max(name), F.count(name)).first()
    if not n or k <= 0:
        return None
    k = min(k, n)
    while True:
        width = (high - low) / 1024
        cells = keys.filter(F.col(name).between(low, high))
        if low + width == low or high - width == high or width == 0:
            # Only neighbouring doubles are left.
            values = sorted(((r[0], r[1]) for r in cells.groupBy(name).count().collect()), reverse=True)
            for value, count in values:
                k -= count
                if k <= 0:
                    return value
        cell = F.least(F.floor((F.col(name) - F.lit(low)) / F.lit(width)), F.lit(1023))
        bounds = cells.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)), F.min(name), F.max(name)).collect()
        for _, count, first, last in sorted(bounds, reverse=True):
            if k <= count:
                if first == last:
                    return first
                low, high = first, last
                break
            k -= count


def sample(weighed: DataFrame, key: str, share: float) -> DataFrame:
    """``weighed``, a written table, with ``selected``: whether the key is among the largest ``share``."""
    n = weighed.count()
    limit = kth_largest(weighed, key, round(n * share))
    return weighed.withColumn("selected", F.lit(False) if limit is None else F.col(key) >= limit)


def op4_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    good = read(spark, sf_dir, "labels").filter("quality = 1 and doc_id is not null").select("doc_id").distinct()
    target = bloom.among(docs, staged(good, "good"), "doc_id")
    ratio = log_ratio(counts(docs, "text"), counts(target, "text"))
    weighed = weigh(docs.withColumn("noise", gumbel("doc_id", "text")), "text", ["doc_id", "noise"], ratio)
    weighed = staged(weighed.withColumn("sample_key", F.col("log_weight") + F.col("noise")).drop("noise"), "weights")
    return sample(weighed, "sample_key", SHARE)
