import random
import re

import pyarrow as pa

from foulee.llm import line_dedup

SCHEMA = "doc_id long, text string"


def slow(rows, threshold=0.8):
    """Line numbers that go, for each id; by comparing every line with all earlier ones."""
    seen, out = [], {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        gone = []
        for i, line in enumerate((text or "").split("\n")):
            lowered = re.sub("[A-Z]", lambda m: m[0].lower(), line)
            words = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered))
            if words:
                if any(len(words & other) >= threshold * len(words | other) - 1e-9 for other in seen):
                    gone.append(i)
                seen.append(words)
        out[doc_id] = gone
    return out


def got(df, **options):
    keyed = df.select("doc_id", line_dedup.row_key("doc_id", "text").alias("row"))
    joined = keyed.join(line_dedup.removed_lines(df, **options), "row", "left").collect()
    return {r.doc_id: list(r.removed or []) for r in joined}


def corpus(rng, n):
    """Documents whose lines are edits of each other, in chains too, with frequent words and short lines."""
    words = [f"w{i}" for i in range(40)]
    lines = [[rng.choice(words) for _ in range(rng.choice([1, 2, 3, 5, 9, 20, 40]))] for _ in range(30)]
    out = []
    for i in range(n):
        own = []
        for _ in range(rng.randint(1, 5)):
            line = list(rng.choice(lines))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice([*words, f"new{rng.random()}"])
            own.append(" ".join(line))
            lines.append(line)
        out.append((i, "\n".join(own)))
    return out


def test_against_brute_force(spark):
    rows = corpus(random.Random(4), 150)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = slow(rows)
    assert got(df) == want
    assert got(df, tile=7) == want
    assert got(df, paired=2) == want
    assert got(df, tile=11, paired=3) == want


def test_cases(spark):
    rows = [(3, None), (1, "A b, c!\n\n--\nA b c"), (2, "a B c\nx y z"), (2, "a B c\nx y z"), (None, "x y z\nnew"), (4, ""), (5, "long " * 20000 + "\nlong")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == {3: [], 1: [3], 2: [0], None: [0], 4: [], 5: [1]}
    extra = df.selectExpr("*", "'r' as row", "'x' as removed")
    kept = {(r.doc_id, r.text, r.row, r.removed) for r in line_dedup.drop_lines(extra).collect()}
    assert (1, "A b, c!\n\n--", "r", "x") in kept and (2, "x y z", "r", "x") in kept and (None, "new", "r", "x") in kept
    assert (3, None, "r", "x") in kept and len(kept) == 6
    assert line_dedup.removed_lines(df.limit(0)).collect() == []


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    want, texts = slow(rows), dict(rows)
    found = line_dedup.op10_line_dedup(spark, path).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.removed_lines == ",".join(map(str, want[r.doc_id])) and r.n_removed == len(want[r.doc_id])
        assert r.n_lines == len(texts[r.doc_id].split("\n"))


def chained(rng, n):
    """Rows of lines in chains of neighbours, similar to the next but not to the one after, with exact repeats."""
    chains = [[{f"c{c}w{i}" for i in range(k, k + 18)} for k in range(0, 12, 2)] for c in range(6)]
    lines = [" ".join(sorted(line)) for chain in chains for line in chain]
    return [(i, "\n".join(rng.choice(lines) for _ in range(rng.choice([1, 1, 2])))) for i in range(n)]


def test_tasks_that_read_ids_in_any_order(spark):
    first, middle, last = (" ".join(f"w{i}" for i in range(k, k + 18)) for k in (0, 2, 4))
    rows = [(100, middle), (50, last), (5, middle), (1, first), (None, first)]
    assert slow(rows) == {1: [], 5: [0], 50: [0], 100: [0], None: [0]}
    assert got(spark.createDataFrame(rows, SCHEMA).coalesce(1)) == slow(rows)
    rng = random.Random(1)
    rows = chained(rng, 40)
    want = slow(rows)
    assert got(spark.createDataFrame(sorted(rows, reverse=True), SCHEMA).coalesce(2)) == want
    rng.shuffle(rows)
    assert got(spark.createDataFrame(rows, SCHEMA).coalesce(2), paired=2) == want


def test_entries_of_a_list_in_any_order():
    names = ["word", "tile", *line_dedup._ENTRY]
    # Sets 1 and 2 of ten words under two words, met by several tasks; the last has no document id. Word 7 ^ 3 is a tile of 7.
    rows = [(5, 0, 1, 10, 0, 0, 30, 1, 0), (5, 0, 1, 10, 0, 0, 9, 1, 0), (5, 0, 2, 10, 0, 0, 20, 1, 0), (5, 0, 2, 10, 0, 0, None, 1, 0)]
    rows += [(7, 3, 1, 10, 0, 0, None, 1, 0), (7, 3, 2, 10, 0, 0, None, 1, 1 << 32), (7, 0, 1, 10, 0, 0, 1, 1, 0)]
    rng = random.Random(2)
    for _ in range(10):
        rng.shuffle(rows)
        own = sorted(rows, key=lambda row: row[0] ^ row[1])
        batch = pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*own)], names)
        found = [tuple(row.values()) for made in line_dedup._candidates(0.8, 4)([batch]) for row in made.to_pylist()]
        assert sorted(found, key=str) == [
            (2, 0, 20, 1, 0, 1, 0, 9, 1, 0, 0, None), (2, 0, None, 1, 1, 1, 0, None, 1, 0, 0, None),
        ]


def test_only_words_of_long_lists_are_dealt(spark):
    df = spark.createDataFrame([(i, f"common rare{i // 2}") for i in range(20)], SCHEMA).repartition(4)
    counts = spark.sparkContext.broadcast(line_dedup.sketch(df, "text"))
    lines = line_dedup.lines_of(df, "doc_id", "text", 0.1, counts, 10)
    entries = {name: line_dedup._entries(lines, name) for name in ("words", "often")}
    assert {r.line_place & 0xFFFFFFFF for r in entries["words"].collect()} == {0}
    assert {r.line_place & 0xFFFFFFFF for r in entries["often"].collect()} == {1}
    assert entries["words"].select("word").distinct().count() == 10 and entries["often"].select("word").distinct().count() == 1
    words = entries["often"].select("word").distinct().localCheckpoint()
    assert sorted(line_dedup._entries_under(lines, words).collect()) == sorted(entries["often"].collect())
