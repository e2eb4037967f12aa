"""Groups spelling variants: words one edit apart, and the form that the rarer one is likely meant to be.

A pair is found by pivotal bigrams. Bigrams are ranked by the number of words that have them, rarest first:

* A word's prefix is its three rarest bigrams and all that rank like the third. One edit breaks at most one of two
  disjoint bigrams, so of two disjoint bigrams of the prefix, the pivots, one is in any near word. They are the pair of
  least total frequency, by dynamic programming over the positions.
* If the other word's prefix ends at the same or a later rank, the pivot that survived is in that prefix too: pivots meet
  prefixes, and a pair needs its meeting only in the direction in which the pivots' prefix ends first.
* Position limits: the edit is on one side of the surviving bigram, so the words are equal on the other. A key is a bigram
  with all that stands before it, or with all that stands after it. Equal keys mean equal positions from that end.
* Of the pairs under a key, lengths may differ by one, and a signature of letters (each flips one of 64 bits) by two bits.
  What is left is verified letter by letter.

Keys of more than ``TILE`` words are dealt over pairs of tiles, so no task gets a whole hot key, and only verified pairs
leave a task. Words, counts and pairs stay tables; the driver holds a count for each of 65,536 bigram classes.

Cases: null text has no words; a null id counts as empty text where the id matters. Rows that repeat count each time.
Words of any length are whole. An empty table gives an empty result. Ties: of near words equally frequent, the
smallest in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foulee.llm.frames import col, map_arrow, read, slices
from foulee.llm.tiles import deal
from foulee.operators.lookup import left_lookup
from foulee.session import staged

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
TILE = 16384
#: Words that a counting task holds before it passes its counts on.
HELD = 500_000
#: Code points that a word needs to hold two disjoint bigrams after any one edit.
LEAST = 4
#: Longer words are looked at one by one.
SHORT = 64
CLASSES = 1 << 16
_WINDOW = 1 << 20
_ROWS = 1 << 18

_RUN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\xbf])+")
_BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")

#: What one zero byte does to a register of CRC-32, by its low byte.
_ZERO_STEP = np.array([~zlib.crc32(bytes([i]), 0xFFFFFFFF) & 0xFFFFFFFF for i in range(256)], np.uint32)


def _windows(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between runs."""
    start = 0
    while start < len(text):
        cut = _BREAK.search(text, min(start + _WINDOW, len(text)))
        end = cut.start() if cut else len(text)
        yield text[start : end + 1]
        start = end + 1


def _zeros_after(crc: np.ndarray, steps: int) -> np.ndarray:
    """For each checksum, what it adds to that of 0 to ``steps`` more bytes: checksums are linear."""
    out = np.zeros((len(crc), steps + 1), np.uint32)
    out[:, 0] = crc
    register = crc.astype(np.uint32)
    for i in range(1, steps + 1):
        register = _ZERO_STEP[register & 0xFF] ^ (register >> 8)
        out[:, i] = register
    return out


class Words:
    """Counts of a task's words; of ``misspell`` runs of a document, by checksum, one loses a letter."""

    def __init__(self, misspell: int | None) -> None:
        self.misspell = misspell
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.crc, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.counts, self.other = np.zeros(0, np.int64), Counter()

    def add(self, ids: list[bytes], texts: list[bytes]) -> None:
        runs, numbers = [], []
        for text in texts:
            own = _RUN.findall(text.lower())
            runs += own
            numbers.append(len(own))
        new = list(set(runs).difference(self.known))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.crc = np.append(self.crc, np.fromiter(map(zlib.crc32, new), np.uint32, len(new)))
        self.size = np.append(self.size, np.fromiter(map(len, new), np.int64, len(new)))
        self.counts = np.append(self.counts, np.zeros(len(new), np.int64))
        word = np.fromiter(map(self.known.__getitem__, runs), np.int64, len(runs))
        if self.misspell:
            start = np.array([zlib.crc32(i + b":") for i in ids], np.uint32)
            doc, size = np.repeat(np.arange(len(ids)), numbers), self.size[word]
            crc = self.crc[word] ^ _zeros_after(start, SHORT)[doc, np.minimum(size, SHORT)]
            for at in np.flatnonzero(size > SHORT).tolist():
                crc[at] = zlib.crc32(runs[at], int(start[doc[at]]))
            hit = crc % np.uint32(self.misspell) == 0
            for at in np.flatnonzero(hit).tolist():
                letters = runs[at].decode()
                k = int(crc[at]) % len(letters)
                self.other[(letters[:k] + letters[k + 1 :]).encode()] += 1
            word = word[~hit]
        self.counts += np.bincount(word, minlength=len(self.counts))

    def rows(self, min_length: int) -> Iterator[pa.RecordBatch]:
        totals = Counter({w: n for w, n in zip(self.known, self.counts.tolist()) if n})
        totals.update(self.other)
        words = pa.array([*totals], pa.binary()).cast(pa.string())
        table = pa.Table.from_arrays([words, pa.array([*totals.values()], pa.int64())], ["word", "n"])
        long_enough = pc.greater_equal(pc.utf8_length(words), min_length)
        yield from table.filter(long_enough).to_batches(max_chunksize=1 << 16)
        self.clear()


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT, misspell: int | None = None,
) -> DataFrame:
    """word and n: runs of letters (A-Z lower-cased) of at least so many code points and occurrences.

    ``misspell`` plants errors of known kind: where it divides the CRC-32 of ``<id>:<run>``, the run loses its letter
    number CRC-32 modulo length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(misspell)
        for batch in slices(batches, 1):
            ids, texts = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            parts = [(i, part) for i, text in zip(ids, texts) if text for part in _windows(text)]
            # A slice is small unless it is one long text, whose windows go one by one.
            for group in [parts] if len(texts) > 1 else [[part] for part in parts]:
                words.add([i for i, _ in group], [part for _, part in group])
                if len(words.known) + len(words.other) > HELD:
                    yield from words.rows(min_length)
        yield from words.rows(min_length)

    text_id = F.coalesce(col(id_col).cast("string"), F.lit(""))
    counted = map_arrow(docs.select(text_id.alias("id"), col(text_col).alias("text")), run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, a row each with zeros after its end; and the lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = max(1, int(sizes.max(initial=0)))
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width), sizes


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _bigrams(letters: np.ndarray) -> np.ndarray:
    pair = letters[:, :-1].astype(np.uint64) << np.uint64(21) | letters[:, 1:].astype(np.uint64)
    return (_mix(pair) >> np.uint64(48)).astype(np.int64)


def _parts(words: list[str]) -> Iterator[np.ndarray]:
    """Places of the short words, and of each long word alone, so that rows of letters stay narrow."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    if (sizes <= SHORT).any():
        yield np.flatnonzero(sizes <= SHORT)
    for at in np.flatnonzero(sizes > SHORT):
        yield np.array([at])


def bigram_counts(words: DataFrame) -> np.ndarray:
    """How often the words have bigrams of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            own = batch.column(0).to_pylist()
            for part in _parts(own):
                letters, sizes = _letters([own[i] for i in part])
                there = np.arange(letters.shape[1] - 1) < sizes[:, None] - 1
                total += np.bincount(_bigrams(letters)[there], minlength=CLASSES)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], ["class", "n"])

    found = map_arrow(words.select("word"), run, "class int, n long").groupBy("class").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES, np.int64)
    out[found["class"].to_numpy()] = found["n"].to_numpy()
    return out


def prefix_and_pivots(rank: np.ndarray, cost: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows of bigrams: which are in the prefix, which are pivots, and the rank at which the prefix ends."""
    n, width = rank.shape
    there = np.arange(width) < sizes[:, None] - 1
    last = np.partition(np.where(there, rank, CLASSES), 2, axis=1)[:, 2]
    prefix = there & (rank <= last[:, None])
    # Cheapest pair of positions two apart or more: for each second one, the cheapest first one before it.
    price = np.where(prefix, cost.astype(float), np.inf)
    row = np.arange(n)
    best, first, second = np.full(n, np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
    cheapest, where = np.full(n, np.inf), np.zeros(n, np.int64)
    for j in range(2, width):
        better = price[:, j - 2] < cheapest
        cheapest, where = np.where(better, price[:, j - 2], cheapest), np.where(better, j - 2, where)
        total = cheapest + price[:, j]
        better = total < best
        best, first, second = np.where(better, total, best), np.where(better, where, first), np.where(better, j, second)
    pivot = np.zeros((n, width), bool)
    pivot[row, first] = pivot[row, second] = True
    return prefix, pivot & prefix, last


def _sides(letters: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of each bigram with all before it, and with all after it."""
    width = letters.shape[1]
    place, size = np.arange(width, dtype=np.uint64), sizes[:, None].astype(np.uint64)
    code = letters.astype(np.uint64)
    there = place < size
    before = np.where(there, _mix(code << np.uint64(32) | place + np.uint64(1)), np.uint64(0)).cumsum(axis=1)
    from_end = np.where(there, size - place, np.uint64(0))
    after = np.where(there, _mix(code << np.uint64(32) | np.uint64(1 << 31) | from_end), np.uint64(0))
    after = after[:, ::-1].cumsum(axis=1)[:, ::-1]
    return _mix(before[:, 1:] + place[1:]), _mix(after[:, :-1] + (from_end[:, :-1] << np.uint64(20)) + np.uint64(1))


def entries_of(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """key, word, n, signature, last and pivot: two rows for each bigram of a word's prefix."""
    order = np.empty(CLASSES, np.int64)
    order[np.lexsort((np.arange(CLASSES), counts))] = np.arange(CLASSES)
    tables = words.sparkSession.sparkContext.broadcast((order, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, often = tables.value
        for batch in slices(batches, 0):
            own = batch.column(0).to_pylist()
            for part in _parts(own):
                letters, sizes = _letters([own[i] for i in part])
                if sizes.min() < LEAST:
                    raise ValueError(f"words need {LEAST} code points for two disjoint bigrams")
                grams = _bigrams(letters)
                prefix, pivot, last = prefix_and_pivots(rank[grams], often[grams], sizes)
                there = np.arange(letters.shape[1]) < sizes[:, None]
                bits = np.where(there, np.uint64(1) << (_mix(letters.astype(np.uint64)) >> np.uint64(58)), np.uint64(0))
                signature = np.bitwise_xor.reduce(bits, axis=1).view(np.int64)
                row, at = np.nonzero(prefix)
                place = pa.array(np.tile(part[row], 2))
                row, keys = np.tile(row, 2), np.concatenate([side[row, at] for side in _sides(letters, sizes)])
                found = [
                    pa.array(keys.view(np.int64)), batch.column(0).take(place), batch.column(1).take(place),
                    pa.array(signature[row]), pa.array(last[row].astype(np.int32)), pa.array(pivot[row, np.tile(at, 2)]),
                ]
                yield pa.RecordBatch.from_arrays(found, ["key", "word", "n", "signature", "last", "pivot"])

    return map_arrow(words.select("word", "n"), run, "key long, word string, n long, signature long, last int, pivot boolean")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _verified(words: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of places are one edit apart; word i is the shorter one or as long."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    good = np.zeros(len(i), bool)
    short = sizes[j] <= SHORT
    used = np.unique(np.concatenate([i[short], j[short]]))
    row = np.searchsorted(used, np.stack([i, j]))
    letters, own = _letters([words[k] for k in used.tolist()])
    for chosen in np.array_split(np.flatnonzero(short), max(1, -(-int(short.sum()) // _ROWS))):
        a, b = row[0, chosen], row[1, chosen]
        # Equal from the start up to the edit, and equal after it with the longer word one letter ahead.
        same = letters[a] == letters[b]
        until = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))
        ahead = np.zeros_like(same)
        ahead[:, :-1] = letters[a][:, :-1] == letters[b][:, 1:]
        equal_length = own[a] == own[b]
        place = np.arange(same.shape[1])
        replaced = (same | (place <= until[:, None])).all(axis=1) & (until < own[a])
        inserted = (ahead | (place < until[:, None]) | (place >= own[a][:, None])).all(axis=1)
        good[chosen] = np.where(equal_length, replaced, inserted)
    for k in np.flatnonzero(~short).tolist():
        good[k] = one_edit(words[i[k]], words[j[k]])
    return good


def _pairs(table: pa.Table) -> pa.RecordBatch:
    """Near pairs of words that share a key (key, low, high), each once for this table."""
    size = pc.utf8_length(table["word"])
    table = table.append_column("size", size).sort_by([(k, "ascending") for k in ("key", "low", "high", "size")])
    key, low, high, signature, last, pivot, size = (
        table[name].to_numpy() for name in ("key", "low", "high", "signature", "last", "pivot", "size")
    )
    change = (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    end = np.append(np.flatnonzero(change) + 1, len(key))[np.concatenate(([0], np.cumsum(change)))]
    signature = signature.view(np.uint64)
    rest, left, right = np.arange(len(key)), [], []
    for s in range(1, len(key)):
        # Rows of a key are in order of length: what is too long for a row is followed by longer ones.
        rest = rest[end[rest] > rest + s]
        rest = rest[size[rest + s] <= size[rest] + 1]
        if not len(rest):
            break
        i, j = rest, rest + s
        met = (np.bitwise_count(signature[i] ^ signature[j]) <= 2) & (
            (pivot[i] & (last[i] <= last[j])) | (pivot[j] & (last[j] <= last[i]))
        )
        left.append(i[met])
        right.append(j[met])
    i, j = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (left, right))
    if len(i):
        good = _verified(table["word"].to_pylist(), i, j)
        i, j = i[good], j[good]
    word, n = table["word"].combine_chunks(), table["n"].combine_chunks()
    turned = pc.greater(word.take(pa.array(i)), word.take(pa.array(j))).to_numpy(zero_copy_only=False)
    at = [pa.array(np.where(turned, j, i)), pa.array(np.where(turned, i, j))]
    columns = [x.take(place) for place in at for x in (word, n)]
    found = pa.Table.from_arrays(columns, ["word", "n", "other", "other_n"])
    found = found.group_by(found.column_names).aggregate([]).combine_chunks()
    return pa.RecordBatch.from_arrays([column.combine_chunks() for column in found.columns], found.column_names)


_PAIR = "word string, n long, other string, other_n long"
_KEYS = ["key", "low", "high"]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows that come in order of their keys."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        if held.num_rows < _ROWS:
            continue
        keys = [held[name].to_numpy() for name in _KEYS]
        changes = np.flatnonzero(np.logical_or.reduce([key[1:] != key[:-1] for key in keys]))
        if len(changes):
            yield _pairs(held.slice(0, int(changes[-1]) + 1))
            held = held.slice(int(changes[-1]) + 1)
    if held is not None and held.num_rows:
        yield _pairs(held)


def near_pairs(words: DataFrame, tile: int = TILE) -> DataFrame:
    """Pairs (word, n, other, other_n) of ``words`` (word, n), a written table of distinct words of at least four code
    points; each pair once, the smaller word first."""
    entries = staged(entries_of(words, bigram_counts(words)), "spelling_entries")
    dealt = deal(entries, ["key"], ["word"], tile).repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    return map_arrow(dealt, _meet, _PAIR).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root, the last of the forms that follow from it, for each row of ``forms`` (word, form), a written table.
    Each round doubles the steps, so a chain of m forms takes log2(m) rounds."""
    found = staged(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = left_lookup(found, further, ["root"], unique=True)
        if moved.filter("further is not null").isEmpty():
            return found
        found = staged(moved.select("word", F.coalesce("further", "root").alias("root")), "spelling_roots")


def variants(words: DataFrame, ratio: int = RATIO, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row of ``words`` (word, n): distinct, of four code points or more."""
    words = staged(words.select("word", "n"), "spelling_words")
    pairs = near_pairs(words, tile).select("word", "n", "other", "other_n")
    both = F.explode(
        F.array(
            F.struct("word", "n", "other", "other_n"),
            F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")),
        )
    )
    near = pairs.select(both.alias("pair")).select("pair.*")
    alone = words.select("word", "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("long").alias("other_n"))
    # Most frequent first, then the smallest.
    best = F.min(F.when(F.col("other").isNotNull(), F.struct((-F.col("other_n")).alias("less"), "other")))
    found = near.unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.count("other").alias("n_near"), best.alias("best")
    )
    meant = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    found = staged(
        found.select(
            "word", F.when(meant, F.col("best.other")).alias("form"), "n", "n_near", F.when(meant, -F.col("best.less")).alias("form_n")
        ),
        "spelling_forms",
    )
    ends = roots(found.filter("form is not null"))
    found = left_lookup(found, ends, ["word"], unique=True)
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(word_counts(read(spark, sf_dir, "documents"), misspell=199))
