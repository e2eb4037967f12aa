import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from foulee.llm import spelling
from foulee.llm.catalogue import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def _counts(rows, misspell=None, min_length=6, min_count=5):
    """Slow counts, run by run."""
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if misspell and h % misspell == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_length and n >= min_count}


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def _variants(counts, ratio=5):
    """Every two words compared (those of too different lengths apart), forms followed one by one."""
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and _distance(w, v) == 1] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] is not None else None))
    return out


def _found(df):
    rows = [tuple(r) for r in df.collect()]
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"] and len(rows) == len(set(rows))
    return set(rows)


def _table(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


@pytest.fixture(scope="module")
def random_words():
    rng = random.Random(3)
    syllables = ["an", "er", "th", "ou", "ti", "re", "st", "ét", "Éa"]
    words = Counter()
    for _ in range(500):
        word = "".join(rng.choice(syllables) for _ in range(rng.randint(3, 4)))
        words[word] = rng.choice([5, 30, 200, 200, 1000])
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(word) + 1)
            other = rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice("aeté") + word[k:], word[:k] + "o" + word[k + 1 :]])
            words.setdefault(other, rng.choice([5, 6, 40]))
    words["a" * 80] = 7
    words["a" * 81] = 70
    words["a" * 40 + "b" + "a" * 40] = 400
    words["aaaa"], words["aaab"], words["baaa"], words["aaaaa"] = 1, 5, 25, 6
    return dict(words)


@pytest.mark.parametrize("tile", [spelling.TILE, 8])
def test_variants_against_brute_force(spark, random_words, tile):
    df = _table(spark, random_words).repartition(3)
    assert _found(spelling.variants(df, tile=tile)) == _variants(random_words)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    counts = _counts([tuple(r) for r in docs], 199)
    found = QUERIES["op11_spelling"](spark, SF_DIR)
    assert dict(found.dtypes) == {
        "word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"
    }
    assert len(counts) > 500 and _found(found) == _variants(counts)


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_WINDOW", 50)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["Hello", "Étés", "×÷zz", "a1b", "café-x", "中文q", "w" * 70]) for _ in range(60))) for i in range(12)]
    rows += [(None, "Hello hello"), (3, None), (4, ""), (4, ""), (5, "!!"), rows[0], (6, "z" * 300)]
    for misspell in (None, 3):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        found = spelling.word_counts(df, min_length=1, min_count=1, misspell=misspell)
        assert {r.word: r.n for r in found.collect()} == _counts(rows, misspell, 1, 1)


def test_counts_are_passed_on_when_many_are_held(spark, monkeypatch):
    rows = [(i, " ".join(f"w{chr(97 + j % 26) * (1 + j // 26)}" for j in range(90))) for i in range(5)]
    words = spelling.Words(None)
    for i, text in rows:
        words.add([b"%d" % i], [text.encode()])
    assert sum(batch.num_rows for batch in words.rows(1)) == 90 and not words.known


def test_checksums_are_linear():
    start = np.array([zlib.crc32(b"17:"), 0, 0xFFFFFFFF], np.uint32)
    table = spelling._zeros_after(start, 20)
    for a, row in zip(start.tolist(), table):
        for word in (b"", b"a", b"hello", b"x" * 20):
            assert zlib.crc32(word) ^ int(row[len(word)]) == zlib.crc32(word, a)


def test_pivots_are_disjoint_and_cheapest():
    rng = np.random.default_rng(0)
    cost = rng.integers(1, 9, 300)
    order = np.argsort(np.argsort(cost, kind="stable"))
    rank, sizes = rng.integers(0, 300, (200, 12)), rng.integers(4, 14, 200)
    prefix, pivot, last = spelling.prefix_and_pivots(order[rank], cost[rank], sizes)
    for i in range(200):
        own = order[rank[i, : sizes[i] - 1]]
        assert last[i] == sorted(own)[2] and prefix[i].nonzero()[0].tolist() == [k for k, r in enumerate(own) if r <= last[i]]
        first, second = pivot[i].nonzero()[0]
        places = prefix[i].nonzero()[0]
        price = cost[rank[i]]
        assert second - first >= 2 and price[first] + price[second] == min(price[a] + price[b] for a in places for b in places if b - a >= 2)


def test_one_edit():
    assert spelling.one_edit("abcd", "abxd") and spelling.one_edit("abcd", "abd") and spelling.one_edit("abcd", "abcde")
    assert not any(spelling.one_edit(*p) for p in [("abcd", "abcd"), ("abcd", "bacd"), ("abcd", "ab"), ("abcd", "bcde")])


def test_chains_ties_and_repeats(spark):
    counts = {"aaaaaa": 1, "aaaaab": 5, "aaaabb": 25, "aaabbb": 125, "zaaaaa": 5, "qqqqqq": 9}
    found = _found(spelling.variants(_table(spark, counts)))
    assert ("aaaaaa", "aaaaab", "aaabbb", 1, 2, 5) in found and found == _variants(counts)


def test_empty_and_short(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert _found(spelling.variants(spelling.word_counts(docs))) == set()
    with pytest.raises(Exception, match="need 4 code points"):
        spelling.variants(_table(spark, {"abc": 1})).collect()


def test_odd_names(spark):
    docs = spark.createDataFrame([(1, "words words", 5), (2, "wordsy", 6)], "`a.b` long, word string, n long")
    found = spelling.word_counts(docs, "a.b", "word", min_count=1, min_length=5)
    assert {tuple(r) for r in found.collect()} == {("words", 2), ("wordsy", 1)}
