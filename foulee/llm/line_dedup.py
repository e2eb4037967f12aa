"""Line deduplication by an exact set-similarity join of lines' words.

A line goes if an earlier line (by document id, then line number) has a Jaccard similarity of ``threshold``
or more of their sets of words. Equal sets are one set with the position of its first line, so only different
sets are joined:

* Rarity: words are counted in a sketch of ``SKETCH`` counters (a fixed size, so it can be broadcast). Any
  order of words gives the same result; counts that are too high only lengthen lists. A word whose counter
  is 1 is in no other line and needs no entry.
* Prefix filter: two similar sets share one of their ``size - ceil(threshold * size) + 1`` rarest words. A task gives a
  set's prefix words once, with the earliest position at which it met the set.
* Lists: an entry of a word's list is a set's name, position, size, the word's place and a signature. Entries of one set
  from several tasks become one with the earliest position, so of two entries the later one is the line that would go,
  whatever the order in which tasks read the rows. A list of more than ``TILE`` entries is dealt over pairs of tiles; only
  words whose counter is above that are counted for it.
* Length and positional filters: of the pairs in a list, those whose sizes and places leave room for enough common
  words. A list is in order of size, so pairs of too different sizes are never made. Then the signature: each word flips
  one of 64 bits (of 128 in sets of ``WIDE`` words or more), so two sets differ in at least as many words as their
  signatures differ in bits.
* Each list gives the ``paired`` earlier candidates whose signatures differ least from a set's. The best of these is
  verified first, then, for sets that it does not settle, the others, and last, for sets that are still open and had
  more of them in a list, all candidates of these lists. No candidate is left out.
* Verification: the words of the sets concerned are read from the texts again (Bloom filters say in which texts
  and lines) and compared with those of their candidates, at most ``SHARD`` with one copy of a candidate's words.

Words are runs of letters and digits, ASCII lower-cased, as 64-bit hashes. Sets have names of 96 bits.

Cases: null text has no lines; a line without words always stays. Rows that repeat with the same id and text
are one document and get equal results. A null id comes last in order. An empty table gives an empty result. Texts and
lines may be of any length: all work on a text grows with its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foulee.llm import bloom
from foulee.llm.frames import col, fresh, map_arrow, read, ship_package, slices
from foulee.llm.line_words import MANY, by_line, mix, tokens
from foulee.llm.tiles import deal
from foulee.operators.lookup import left_lookup
from foulee.session import staged

THRESHOLD = 0.8
SKETCH = 1 << 22
TILE = 4096
PAIRED = 4
SHARD = 128
#: Words of a set from which on its signature has 128 bits: 64 say little of that many words.
WIDE = 40
#: Names and positions that a task remembers; more only repeat entries.
_REMEMBERED = 500_000
#: Entries that are compared at a time, if lists are not longer.
_ROWS = 1 << 17
#: Counters of the sketch that travel as one row.
_COUNTERS = 4096


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(col(id_col), col(text_col))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("row"), col(text_col).alias("text"))


def _texts(batch: pa.RecordBatch, at: int) -> list[bytes | None]:
    return batch.column(at).cast(pa.binary()).to_pylist()


def least_overlap(a, b, threshold: float):
    """Common words that sets of these sizes need; the small term guards against rounding."""
    return np.ceil(threshold / (1 + threshold) * (a + b) - 1e-9)


def sketch(docs: DataFrame, text_col: str) -> np.ndarray:
    """How often words fall on each counter: at least the number of lines that have the word. Counters travel and are
    added up in blocks, each of them a row with the used ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)
        for batch in slices(batches, 0):
            np.add.at(counts, (tokens(_texts(batch, 0))[0] & np.uint64(SKETCH - 1)).astype(np.int64), 1)
        used = np.flatnonzero(counts)
        starts = np.searchsorted(used, np.arange(0, SKETCH + 1, _COUNTERS))
        ends = pa.array(starts.astype(np.int32))
        at, n = (pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((used % _COUNTERS).astype(np.int32), counts[used]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(starts) - 1, dtype=np.int32)), at, n], ["block", "at", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, np.zeros(_COUNTERS, np.int64)

        def done() -> pa.RecordBatch:
            held = np.minimum(total, (1 << 31) - 1).astype("<i4").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([held], pa.binary())], ["block", "counts"])

        for batch in batches:
            for own, at, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if own != block:
                    if block is not None:
                        yield done()
                    block, total = own, np.zeros(_COUNTERS, np.int64)
                total[at.values.to_numpy()] += n.values.to_numpy()
        if block is not None:
            yield done()

    counted = map_arrow(docs.select(col(text_col).alias("text")), count, "block int, at array<int>, n array<long>")
    added = map_arrow(counted.repartition("block").sortWithinPartitions("block"), add, "block int, counts binary")
    out = np.zeros((SKETCH // _COUNTERS, _COUNTERS), np.int32)
    for row in added.toArrow().to_pylist():  # SKETCH counters of 4 bytes
        out[row["block"]] = np.frombuffer(row["counts"], "<i4")
    return out.ravel()


class Sets:
    """The sets of words of a slice's lines: words in order of rarity, and what names a set."""

    def __init__(self, texts: list[bytes | None], counts: np.ndarray | None = None, wanted=None) -> None:
        """``wanted`` says of texts' places and line numbers which lines are of use."""
        hashes, line, first = tokens(texts)
        if wanted is not None:
            text = np.repeat(np.arange(len(texts)), np.diff(first))
            use = wanted(text, np.arange(first[-1]) - first[text])
            hashes, line = hashes[use[line]], line[use[line]]
        often = np.zeros(len(hashes), np.int64)
        if counts is not None:
            often = counts[(hashes & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.int64)
        self.words, line, self.often = by_line(hashes, line, often)
        self.starts = np.flatnonzero(np.concatenate(([True], line[1:] != line[:-1])))[: len(line)]
        self.sizes = np.diff(np.append(self.starts, len(line)))
        used = line[self.starts]
        self.text = np.searchsorted(first, used, side="right") - 1
        self.number = used - first[self.text]

    def words_of(self, i: int) -> np.ndarray:
        return self.words[self.starts[i] : self.starts[i] + self.sizes[i]]

    def names(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Two hashes of each set, 64 and 32 bits, and the halves of its signature; a small set's is folded into one."""
        if not len(self.starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        h1, h2 = (np.add.reduceat(mix(self.words, i), self.starts) for i in (1, 2))
        place = mix(self.words, 3)
        bit, second = np.uint64(1) << (place >> np.uint64(58)), (place & np.uint64(1)).astype(bool)
        halves = [np.bitwise_xor.reduceat(np.where(second == half, bit, np.uint64(0)), self.starts) for half in (False, True)]
        wide = self.sizes >= WIDE
        first, other = np.where(wide, halves[0], halves[0] ^ halves[1]), np.where(wide, halves[1], np.uint64(0))
        return h1.view(np.int64), (h2 >> np.uint64(32)).astype(np.uint32).view(np.int32), first.view(np.int64), other.view(np.int64)


def _place(row: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Hash of a line's position."""
    return mix(mix(row.view(np.uint64), 11) + number.astype(np.uint64), 12).view(np.int64)


_SET = "h1 long, h2 int"
_LISTS = "first_place int, words array<long>, often array<long>"
_LINE = f"row long, line int, {_SET}, size int, signature long, signature_2 long, {_LISTS}"


def lines_of(docs: DataFrame, id_col: str, text_col: str, threshold: float, counts, tile: int) -> DataFrame:
    """A row for each line with words: doc_id, row, line, the set's name, size and signature, and the prefix words with
    the place of the first, ``words`` and then ``often``: those whose lists may have more than ``tile`` entries. Sets that a
    task has met at an earlier position have no prefix words: one entry is enough. ``counts`` is the sketch, as a broadcast."""
    crowd = min(tile, MANY - 1)  # from MANY on words are not in order of their counters
    docs = _keyed(docs, id_col, text_col)
    schema = T.StructType([docs.schema["doc_id"], *T.DataType.fromDDL(_LINE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: dict[tuple, tuple] = {}
        for batch in slices(batches, 2):
            found = Sets(_texts(batch, 2), counts.value)
            h1, h2, signature, signature_2 = found.names()
            at = pa.array(found.text)
            doc_id, row = batch.column(0).take(at), batch.column(1).take(at)
            if len(met) > _REMEMBERED:
                met.clear()
            new = np.zeros(len(h1), bool)
            where = zip(doc_id.to_pylist(), row.to_pylist(), found.number.tolist())
            for i, (name, (own, key, number)) in enumerate(zip(zip(h1.tolist(), h2.tolist()), where)):
                position = (own is None, own, key, number)
                before = met.get(name)
                if before is None or position < before:
                    met[name] = position
                    new[i] = True
            line = np.repeat(np.arange(len(h1)), found.sizes)
            place = np.arange(len(found.words)) - found.starts[line]
            prefix = found.sizes - np.ceil(threshold * found.sizes - 1e-9).astype(int) + 1
            listed = (place < prefix[line]) & (found.often > 1) & new[line]
            # Words are in order of rarity: first those that are in no other line, then the listed ones, the frequent ones last.
            lists = [pa.array(np.bincount(line[found.often <= 1], minlength=len(h1)).astype(np.int32))]
            for some in (listed & (found.often <= crowd), listed & (found.often > crowd)):
                offsets = np.concatenate(([0], np.cumsum(np.bincount(line[some], minlength=len(h1)))))
                lists.append(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found.words[some].view(np.int64))))
            yield pa.RecordBatch.from_arrays(
                [
                    doc_id, row, pa.array(found.number.astype(np.int32)), pa.array(h1), pa.array(h2),
                    pa.array(found.sizes.astype(np.int32)), pa.array(signature), pa.array(signature_2), *lists,
                ],
                schema.names,
            )

    return map_arrow(docs, run, schema)


def position(prefix: str = "") -> Column:
    """Order of lines: by id, null last; rows of one id by their hash."""
    names = [f"{prefix}{name}" for name in ("doc_id", "row", "line")]
    return F.struct(F.col(names[0]).isNull().alias("no_id"), *[F.col(n).alias(n.removeprefix(prefix)) for n in names])


#: An entry in nine longs, with word and tile: name and size, signature, position with the word's place.
_ENTRY = ["h1", "h2_size", "signature", "signature_2", "doc_id", "row", "line_place"]
#: Of an entry's size, the bit that says that its set needs no more candidates.
_SETTLED = 1 << 31


def _two(high: str, low: str) -> Column:
    """Two ints as a long."""
    return F.shiftleft(F.col(high).cast("long"), 32).bitwiseOR(F.col(low).cast("long"))


def _entries(lines: DataFrame, words: str) -> DataFrame:
    """Rows of the lists of these words."""
    before = F.col("first_place") if words == "words" else F.col("first_place") + F.size("words")
    sets = [before.alias("before"), "h1", _two("h2", "size").alias("h2_size"), "signature", "signature_2", "doc_id", "row", "line"]
    spread = lines.filter(F.size(words) > 0).select(F.posexplode(words).alias("nth", "word"), *sets)
    return spread.withColumn("place", F.col("before") + F.col("nth")).select("word", *_ENTRY[:6], _two("line", "place").alias("line_place"))


def _entries_under(lines: DataFrame, words: DataFrame) -> DataFrame:
    """Rows of the lists of ``words``, a written table of distinct ones."""
    bitmaps = lines.sparkSession.sparkContext.broadcast(_filter_of(words, "word", words.count()))
    listed = lines.select(F.concat("words", "often").alias("words"), *[name for name in lines.columns if name not in ("words", "often")])
    narrow = listed.select("words", "first_place", "line", "h1", _two("h2", "size").alias("h2_size"), "signature", "signature_2", "doc_id", "row")
    names = ["word", *_ENTRY]
    kinds = {"doc_id": lines.schema["doc_id"].dataType}
    schema = T.StructType([T.StructField(name, kinds.get(name, T.LongType())) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, sizes = batch.column(0).flatten().to_numpy(), batch.column(0).value_lengths().to_numpy()
            some = np.flatnonzero(_among(word, bitmaps.value))
            if not len(some):
                continue
            at = np.repeat(np.arange(batch.num_rows), sizes)[some]
            first, line = (batch.column(i).to_numpy()[at].astype(np.int64) for i in (1, 2))
            place = first + some - (np.cumsum(sizes) - sizes)[at]
            columns = [column.take(pa.array(at)) for column in batch.columns[3:]]
            yield pa.RecordBatch.from_arrays([pa.array(word[some]), *columns, pa.array(line << 32 | place)], names)

    return map_arrow(narrow, run, schema).join(words, "word", "left_semi")


def _ranks(entries: pa.Table, at: np.ndarray) -> np.ndarray:
    """Of the entries at these places, the order of their positions."""
    own = pa.table([entries.column(i) for i in (6, 7, 8)], ["doc_id", "row", "line_place"]).take(pa.array(at))
    order = pc.sort_indices(own, sort_keys=[(name, "ascending") for name in own.column_names], null_placement="at_end")
    out = np.empty(len(at), np.int64)
    out[order.to_numpy()] = np.arange(len(at))
    return out


def _first_of_each(entries: pa.Table, run: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Places of the entry of the earliest position of each set in a list."""
    key = h1.view(np.uint64) ^ mix(run.astype(np.uint64), 13)
    order = np.argsort(key)
    a, b = order[1:], order[:-1]
    other = (run[a] != run[b]) | (h1[a] != h1[b]) | (h2[a] != h2[b])
    if ((key[a] == key[b]) & other).any():
        order = np.lexsort((h2, h1, run))
        a, b = order[1:], order[:-1]
        other = (run[a] != run[b]) | (h1[a] != h1[b]) | (h2[a] != h2[b])
    starts = np.flatnonzero(np.concatenate(([True], other)))
    sizes = np.diff(np.append(starts, len(run)))
    repeated = np.repeat(sizes > 1, sizes)
    several, group = order[repeated], np.repeat(np.arange(len(sizes)), sizes)[repeated]
    by = np.lexsort((_ranks(entries, several), group))
    several, group = several[by], group[by]
    return np.concatenate((order[~repeated], several[np.diff(group, prepend=-1) > 0]))


def _candidates(threshold: float, paired: int | None):
    """Pairs of sets of a list that pass the filters: the later one and the nearest earlier ones, ``paired`` at most, with
    the word as ``more`` if it has others. Rows come list by list."""

    def runs(batch: pa.Table) -> pa.RecordBatch:
        batch = batch.combine_chunks()
        word, tile, h1, h2_size, signature, signature_2 = (batch.column(i).to_numpy() for i in range(6))
        run = np.concatenate(([0], np.cumsum((word ^ tile)[1:] != (word ^ tile)[:-1])))
        size, place = h2_size & (_SETTLED - 1), batch.column(8).to_numpy() & 0xFFFFFFFF
        open_ = (h2_size & _SETTLED) == 0
        first = _first_of_each(batch, run, h1, h2_size >> 32)
        # In order of size within a list.
        first = first[np.argsort(run[first] << 32 | size[first])]
        run, size, place, open_ = (x[first] for x in (run, size, place, open_))
        halves = [x[first].view(np.uint64) for x in (signature, signature_2)]
        folded, wide = halves[0] ^ halves[1], size >= WIDE
        end = np.searchsorted(run, run, side="right")
        reach = np.floor(size / threshold + 1e-9)
        rest, out = np.arange(len(run)), [np.zeros((3, 0), np.int64)]
        for s in range(1, len(run)):
            rest = rest[end[rest] > rest + s]
            rest = rest[size[rest + s] <= reach[rest]]
            if not len(rest):
                break
            i, j = rest, rest + s
            need = least_overlap(size[i], size[j], threshold)
            most = size[i] + size[j] - 2 * need
            fits = np.bitwise_count(folded[i] ^ folded[j]) <= most
            fits &= np.minimum(size[i] - place[i], size[j] - place[j]) >= need
            fits &= open_[i] | open_[j]
            i, j, most = i[fits], j[fits], most[fits]
            # The folded halves differ in fewer bits than the halves do. Lists are in order of size: j is the larger.
            bits = sum(np.bitwise_count(half[i] ^ half[j]).astype(np.int64) for half in halves)
            bits = np.where(wide[i], bits, np.bitwise_count(folded[i] ^ folded[j]))
            fits = bits <= most
            i, j, bits = i[fits], j[fits], bits[fits]
            out.append(np.stack([i, j, bits * 1000 // (size[i] + size[j])]))
        i, j, apart = np.concatenate(out, axis=1)
        met = np.zeros(len(run), bool)
        met[i] = met[j] = True
        rank = np.zeros(len(run), np.int64)
        rank[met] = _ranks(batch, first[met])
        later = np.where(rank[i] > rank[j], i, j)
        use = open_[later]
        later, earlier, apart = later[use], (i + j - later)[use], apart[use]
        order = np.lexsort((rank[earlier], apart, later))
        later, earlier, apart = later[order], earlier[order], apart[order]
        starts = np.flatnonzero(np.concatenate(([True], later[1:] != later[:-1])))[: len(later)]
        sizes = np.diff(np.append(starts, len(later)))
        nth, more = np.arange(len(later)) - np.repeat(starts, sizes), np.repeat(sizes, sizes)
        if paired is not None:
            kept = nth < paired
            later, earlier, apart, more = later[kept], earlier[kept], apart[kept], more[kept] > paired
        else:
            more = np.zeros(len(later), bool)
        columns = []
        for side in (first[later], first[earlier]):
            doc_id, row = (batch.column(i).combine_chunks().take(pa.array(side)) for i in (6, 7))
            line = (batch.column(8).to_numpy()[side] >> 32).astype(np.int32)
            columns += [pa.array(h1[side]), pa.array((h2_size[side] >> 32).astype(np.int32)), doc_id, row, pa.array(line)]
        columns += [pa.array(apart.astype(np.int32)), pa.array(word[first[later]], mask=~more)]
        return pa.RecordBatch.from_arrays(columns, [*_X, *_E, "apart", "more"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            if held.num_rows < _ROWS:
                continue
            key = held.column(0).to_numpy() ^ held.column(1).to_numpy()
            changes = np.flatnonzero(key[1:] != key[:-1])
            if len(changes):
                yield runs(held.slice(0, int(changes[-1]) + 1))
                held = held.slice(int(changes[-1]) + 1)
        if held is not None and held.num_rows:
            yield runs(held)

    return run


_X = ["h1", "h2", "doc_id", "row", "line"]
_E = [f"e_{name}" for name in _X]


def _dealt(entries: DataFrame, tile: int) -> DataFrame:
    """``entries`` with the tile of the list; an entry of a list of more than ``tile`` comes once for each of its tiles."""
    dealt = deal(entries, ["word"], ["h1"], tile)
    return dealt.select("word", _two("low", "high").alias("tile"), *_ENTRY)


def candidates(entries: DataFrame, threshold: float, paired: int | None) -> DataFrame:
    """Later and earlier sets (name and position each) of the pairs under any word and tile, how many bits their signatures
    are ``apart`` for a thousand words, and ``more``."""
    # One long to sort by. Lists that it mixes up are one list with some more pairs to look at.
    key = F.col("word").bitwiseXOR(F.col("tile"))
    dealt = entries.select("word", "tile", *_ENTRY).repartition(key).sortWithinPartitions(key)
    kinds = dict(zip(_X, ("long", "integer", None, "long", "integer")))
    schema = T.StructType()
    for name in (*_X, *_E):
        kind = kinds[name.removeprefix("e_")]
        schema = schema.add(name, entries.schema["doc_id"].dataType if kind is None else kind)
    return map_arrow(dealt, _candidates(threshold, paired), schema.add("apart", "integer").add("more", "long"))


def _of_sets(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The ``rows`` of some sets, a written table of names; only rows that a Bloom filter lets through are shuffled."""
    names = staged(sets.select("h1").distinct(), "set_names")
    return bloom.members(rows, names, "h1").select(*rows.columns).join(sets.select("h1", "h2"), ["h1", "h2"], "left_semi")


def _filter_of(hashes: DataFrame, name: str, rows: int) -> np.ndarray:
    """A Bloom filter of a column of hashes, 32 MB at most."""
    bits = bloom.size_for(rows)
    block, own = _probes(F.col(name), bits)
    positions = hashes.select(block.alias("block"), F.explode(F.array(*own)).alias("bit"))
    found = positions.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect()
    out = np.zeros((bits // bloom.BLOCK_BITS, bloom.BLOCK_BITS // 8), np.uint8)
    for row in found:
        out[row["block"]] = np.frombuffer(row["bitmap"], np.uint8)
    return out


def _probes(place: Column, bits: int) -> tuple[Column, list[Column]]:
    """Block and bits of a column that is a hash itself."""
    block = F.shiftrightunsigned(place, 34) % F.lit(max(1, bits // bloom.BLOCK_BITS))
    return block, [F.shiftright(place, 15 * i).bitwiseAND(F.lit(bloom.BLOCK_BITS - 1)) for i in range(bloom.PROBES)]


def _among(place: np.ndarray, bitmaps: np.ndarray) -> np.ndarray:
    block = ((place.view(np.uint64) >> np.uint64(34)) % np.uint64(len(bitmaps))).astype(np.int64)
    found = np.ones(len(place), bool)
    for i in range(bloom.PROBES):
        bit = (place >> (15 * i)) & (bloom.BLOCK_BITS - 1)
        found &= (bitmaps[block, bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)
    return found


def _words_at(docs: DataFrame, id_col: str, text_col: str, deliveries: DataFrame) -> DataFrame | None:
    """Positions (place, doc_id, row, line) and words of the lines that may be wanted, each once a task."""
    n = deliveries.count()
    if not n:
        return None
    docs = _keyed(docs, id_col, text_col)
    share = docs.sparkSession.sparkContext.broadcast
    bitmaps, of_rows = share(_filter_of(deliveries, "place", n)), share(_filter_of(deliveries, "row", n))
    schema = T.StructType([docs.schema["doc_id"], *T.DataType.fromDDL("row long, line int, place long, words array<long>")])

    def wanted(rows: np.ndarray):
        return lambda text, number: _among(_place(rows[text], number), bitmaps.value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in slices(batches, 2):
            batch = batch.filter(pa.array(_among(batch.column(1).to_numpy(), of_rows.value)))
            rows = batch.column(1).to_numpy()
            found = Sets(_texts(batch, 2), wanted=wanted(rows))
            rows = rows[found.text]
            place = _place(rows, found.number)
            if len(sent) > _REMEMBERED:
                sent.clear()
            chosen = [i for i, own in enumerate(place.tolist()) if own not in sent]
            sent.update(place[chosen].tolist())
            if not chosen:
                continue
            lists = [found.words_of(i) for i in chosen]
            ends = np.concatenate(([0], np.cumsum([len(own) for own in lists])))
            words = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(lists).view(np.int64)))
            at = np.array(chosen)
            columns = [
                batch.column(0).take(pa.array(found.text[at])), pa.array(rows[at]), pa.array(found.number[at].astype(np.int32)),
                pa.array(place[at]), words,
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return map_arrow(docs, run, schema)


def _places(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the hashes of both positions."""
    schema = T.StructType([*pairs.schema]).add("place", "long").add("e_place", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            made = [pa.array(_place(columns[f"{p}row"].to_numpy(), columns[f"{p}line"].to_numpy())) for p in ("", "e_")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], schema.names)

    return map_arrow(pairs, run, schema)


_GROUP = ["e_h1", "e_h2", "shard"]


def _compare(threshold: float):
    """Names of the sets that are similar to their group's candidate. A group's rows follow its candidate's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, np.zeros(0, np.int64)
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            candidate, words = batch.column(3).to_pylist(), batch.column(6)
            flat, ends = words.values.to_numpy(), words.offsets.to_numpy()
            similar = []
            for i, key in enumerate(keys):
                these = flat[ends[i] : ends[i + 1]]
                if candidate[i]:
                    group, own = key, np.sort(these)
                elif key == group and len(own):
                    at = np.minimum(np.searchsorted(own, these), len(own) - 1)
                    common = int((own[at] == these).sum())
                    if common >= threshold * (len(these) + len(own) - common) - 1e-9:
                        similar.append(i)
            at = pa.array(similar, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(4).take(at), batch.column(5).take(at)], ["h1", "h2"])

    return run


def _similar(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """h1, h2 of the later sets of ``pairs`` that are similar enough, a written table."""
    pairs = staged(_places(pairs.select(*_X, *_E)), "pairs")
    # A candidate that many sets have is sent to one group for each SHARD of them.
    crowds = pairs.groupBy("e_h1", "e_h2").agg(F.min(position("e_")).alias("at"), F.min("e_place").alias("e_place"), F.count(F.lit(1)).alias("n"))
    crowds = crowds.withColumn("shards", F.ceil(F.col("n") / SHARD).cast("int"))
    crowds = staged(crowds.select("e_h1", "e_h2", "at", "e_place", "shards"), "pair_groups")
    crowded = crowds.filter("shards > 1").select("e_h1", "e_h2", "shards")
    later = left_lookup(pairs, crowded, ["e_h1", "e_h2"], unique=True)
    shard = F.when(F.col("shards").isNull(), 0).otherwise(F.pmod(F.xxhash64("h1", "h2"), "shards")).cast("int")
    later = later.select("e_h1", "e_h2", shard.alias("shard"), F.lit(False).alias("candidate"), "h1", "h2", "doc_id", "row", "line", "place")
    first = crowds.select(
        "e_h1", "e_h2", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.lit(True).alias("candidate"),
        F.col("e_h1").alias("h1"), F.col("e_h2").alias("h2"), "at.doc_id", "at.row", "at.line", F.col("e_place").alias("place"),
    )
    deliveries = staged(later.unionByName(first), "deliveries")
    words = _words_at(docs, id_col, text_col, deliveries.select("place", "row"))
    if words is None:
        return staged(deliveries.select("h1", "h2"), "similar")
    found = words.withColumnsRenamed({"doc_id": "w_id", "row": "w_row", "line": "w_line"})
    same = F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("row") == F.col("w_row")) & (F.col("line") == F.col("w_line"))
    sent = found.join(deliveries, "place").filter(same).select(*_GROUP, "candidate", "h1", "h2", "words")
    sent = sent.repartition(*_GROUP).sortWithinPartitions(*_GROUP, F.desc("candidate"))
    return staged(map_arrow(sent, _compare(threshold), _SET).distinct(), "similar")


def removed_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    tile: int = TILE, paired: int = PAIRED,
) -> DataFrame:
    """doc_id, row (hash of id and text) and the numbers of the lines that go, for documents that lose lines."""
    counts = docs.sparkSession.sparkContext.broadcast(sketch(docs, text_col))
    lines = staged(lines_of(docs, id_col, text_col, threshold, counts, tile), "lines")
    entries = _entries(lines, "words").withColumn("tile", F.lit(0).cast("long"))
    entries = entries.unionByName(_dealt(_entries(lines, "often"), tile))
    met = staged(candidates(entries, threshold, paired), "candidates")
    first = met.groupBy("h1", "h2").agg(F.min(position()).alias("at"), F.min(F.struct("apart", *_position_first("e_"))).alias("e"))
    first = first.select("h1", "h2", "at.doc_id", "at.row", "at.line", *[F.col(f"e.{name}").alias(f"e_{name}") for name in _X])
    first = staged(first, "first_candidates")
    found = _similar(first, docs, id_col, text_col, threshold)
    left = staged(first.select("h1", "h2").join(found, ["h1", "h2"], "left_anti"), "open_sets")
    # Sets that are still open meet the others of the candidates found.
    others = staged(_of_sets(met, left), "other_candidates")
    rest = others.select(*_X, *_E).distinct().join(first.select("h1", "h2", "e_h1", "e_h2"), ["h1", "h2", "e_h1", "e_h2"], "left_anti")
    second = _similar(rest.select(*_X, *_E), docs, id_col, text_col, threshold)
    # Then all of the lists that had more.
    crowded = others.filter("more is not null").join(second, ["h1", "h2"], "left_anti").select("h1", "h2", "more")
    crowded = staged(crowded, "crowded_sets")
    found = found.unionByName(second)
    if not crowded.isEmpty():
        words = staged(crowded.select(F.col("more").alias("word")).distinct(), "crowded_lists")
        opened = staged(crowded.select("h1", "h2", F.lit(True).alias("open")).distinct(), "opened_sets")
        again = _entries_under(lines, words).withColumn("h2", F.shiftright("h2_size", 32).cast("int"))
        again = left_lookup(again, opened, ["h1", "h2"], unique=True)
        settled = F.when(F.col("open").isNull(), F.col("h2_size").bitwiseOR(F.lit(_SETTLED))).otherwise(F.col("h2_size"))
        # Written once: dealing reads them three times, and they come from a scan of all lines.
        again = staged(again.withColumn("h2_size", settled).select("word", *_ENTRY), "crowded_entries")
        third = candidates(_dealt(again, tile), threshold, None).select(*_X, *_E).distinct()
        found = found.unionByName(_similar(third, docs, id_col, text_col, threshold))
    return _gone(lines.select("doc_id", "row", "line", "h1", "h2"), found.distinct())


def _position_first(prefix: str) -> list[Column]:
    """A set by its position, then its name: structs of these are in order of position."""
    names = ["doc_id", "row", "line", "h1", "h2"]
    return [F.col(f"{prefix}doc_id").isNull().alias("no_id"), *[F.col(f"{prefix}{n}").alias(n) for n in names]]


def _gone(lines: DataFrame, similar: DataFrame) -> DataFrame:
    """The lines of sets that are similar to an earlier one, and all but the first line of the others."""
    marks = similar.withColumn("similar", F.lit(True))
    sets = lines.groupBy("h1", "h2").agg(F.min(position()).alias("first"), F.count(F.lit(1)).alias("n"))
    sets = left_lookup(sets, marks, ["h1", "h2"], unique=True).filter("similar or n > 1")
    sets = staged(sets.select("h1", "h2", "first", "similar"), "line_sets")
    marked = left_lookup(lines, sets, ["h1", "h2"], unique=True)
    gone = marked.filter(F.col("similar").isNotNull() | (position() != F.col("first")))
    return gone.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set("line")).alias("removed"))


def _with_removed(rows: DataFrame, found: DataFrame, id_name: str, row: str, gone: str) -> DataFrame:
    """``rows`` with the numbers of the lines that go, by id and row hash."""
    no_id, own = fresh([*rows.columns, gone], "no_id"), fresh([*rows.columns, gone], "own_id")
    rows = rows.withColumns({no_id: col(id_name).isNull(), own: F.coalesce(col(id_name).cast("string"), F.lit(""))})
    found = found.select(
        F.col("row").alias(row), F.col("doc_id").isNull().alias(no_id),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(own), F.col("removed").alias(gone),
    )
    return left_lookup(rows, found, [row, no_id, own], unique=True)


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the text of each without the lines that go; other columns as they are."""
    row, gone = fresh(docs.columns, "row"), fresh(docs.columns, "removed")
    found = removed_lines(docs, id_col, text_col, **options)
    joined = _with_removed(docs.withColumn(row, row_key(id_col, text_col)), found, id_col, row, gone)
    ship_package(docs.sparkSession)

    @F.udf("string")
    def without(text, numbers):
        # Spark may call this for rows that lose nothing, too.
        dropped = set(numbers or ())
        if text is None:
            return None
        return "\n".join(line for i, line in enumerate(text.split("\n")) if i not in dropped)

    text = F.when(col(gone).isNull(), col(text_col)).otherwise(without(col(text_col), col(gone)))
    return joined.select(*[text.alias(name) if name == text_col else col(name) for name in docs.columns])


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", row_key("doc_id", "text").alias("row"), F.size(F.split("text", "\n", -1)).alias("n"))
    rows = _with_removed(rows, removed_lines(docs), "doc_id", "row", "removed")
    return rows.select(
        "doc_id",
        F.when(F.col("n") < 0, 0).otherwise(F.col("n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"),
    )
