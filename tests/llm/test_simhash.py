import random

import numpy as np
import xxhash

from foulee.llm import simhash

SCHEMA = "doc_id long, text string"


def slow_fingerprint(text, words=3):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    width = min(words, len(tokens))
    hashes = [xxhash.xxh64_intdigest(b" ".join(tokens[i : i + width]), 42) for i in range(len(tokens) - width + 1)]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def slow_components(fps, radius):
    parent = {i: i for i in range(len(fps))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(fps))]


def near(rng, centres, n):
    """Fingerprints around a few centres, so that chains and large buckets occur."""
    out = []
    for _ in range(n):
        value = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            value ^= 1 << rng.randrange(64)
        out.append(value - (1 << 64) if value >> 63 else value)
    return out


def test_fingerprint_by_definition():
    for text in [None, "", " \t", "One", "a b", "a b c", "a  b\x0bc d a b c", "É é ß x y z w", "w " * 70000 + "end"]:
        raw = None if text is None else text.encode()
        assert simhash.fingerprint(raw) == slow_fingerprint(text), text


def test_local_roots_against_brute_force():
    rng = random.Random(3)
    for radius in (0, 1, 2, 3, 5):
        fps = near(rng, [rng.getrandbits(64) for _ in range(9)], 300)
        ends = np.array([150] * 150 + [151] + [300] * 149)
        got = simhash.local_roots(np.array(fps, np.int64).view(np.uint64), ends, radius)
        for low, high in ((0, 150), (150, 151), (151, 300)):
            assert [x - low for x in got[low:high]] == slow_components(fps[low:high], radius)


def test_components_against_brute_force(spark):
    rng = random.Random(5)
    fps = near(rng, [rng.getrandbits(64) for _ in range(40)], 600)
    want = slow_components(fps, 2)
    marks = spark.createDataFrame(list(enumerate(fps)), "doc_id long, fp long")
    for tile in (simhash.TILE, 5):
        got = {r.doc_id: r.component for r in simhash.label(marks, "doc_id", tile=tile).collect()}
        assert [got[i] for i in range(len(fps))] == want


def test_whole_table(spark):
    df = simhash.op2_simhash(spark, "/root/testdata/sf0.001")
    rows = {r.doc_id: r for r in df.collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = sorted(texts)
    fps = [slow_fingerprint(texts[i]) for i in ids]
    assert [rows[i].fingerprint for i in ids] == [f"{f & (2**64 - 1):016x}" for f in fps]
    assert [rows[i].component_id for i in ids] == [ids[r] for r in slow_components(fps, 2)]


def test_nulls_empty_repeats_and_keep_first(spark):
    rows = [
        (5, None, "x"), (4, "", "y"), (None, " ", "z"), (7, "one two three four", "a"), (7, "one two three four", "a"),
        (8, "One two three FOUR", "b"), (9, "other words entirely here", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = sorted(map(tuple, simhash.keep_first(df).collect()))
    assert kept == [(4, "", "y"), (7, "one two three four", "a"), (9, "other words entirely here", None)]
    assert simhash.keep_first(df.limit(0)).collect() == []


def test_keep_first_against_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    base = [[rng.choice(words) for _ in range(80)] for _ in range(12)]
    rows = []
    for i in range(150):
        text = list(rng.choice(base))
        if rng.random() < 0.5:
            text[rng.randrange(80)] = rng.choice(words)
        rows.append((None if i % 40 == 0 else rng.randrange(100), " ".join(text), i % 3, "m", True))
    rows += rows[:30]
    df = spark.createDataFrame(rows, "doc_id long, text string, row_hash int, maybe string, stays boolean").repartition(4)
    component = slow_components([slow_fingerprint(r[1]) for r in rows], 2)
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    found = kept.collect()
    root = {r[1]: c for r, c in zip(rows, component)}
    assert sorted(root[r.text] for r in found) == sorted(set(component))
    for r in found:
        own = [x[0] for x, c in zip(rows, component) if c == root[r.text]]
        assert r.doc_id == min((x for x in own if x is not None), default=None) and tuple(r) in rows
