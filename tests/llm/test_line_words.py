import random
import re

import numpy as np
import pytest
import xxhash

from foulee.llm import line_words


def _slow(texts):
    lines = [line for text in texts for line in (text or b"").split(b"\n")]
    return [(i, word) for i, line in enumerate(lines) for word in re.findall(rb"[0-9a-z\x80-\xff]+", line.lower())]


@pytest.mark.parametrize("window", [4, 16, 64, line_words._WINDOW])
def test_words_of_lines(monkeypatch, window):
    monkeypatch.setattr(line_words, "_WINDOW", window)
    monkeypatch.setattr(line_words, "_SPAN", 2 * window)
    rng, names = random.Random(window), {}
    for _ in range(60):
        texts = [bytes(rng.choice(b"aB1 \n,\xc3\xa9z") for _ in range(rng.choice([0, 3, 50, 200]))) for _ in range(5)]
        texts += [None, b"", b"a" * 3000 + b" " + b"A" * 3000, b"\n\n"]
        hashes, line, first = line_words.tokens(texts)
        want = _slow(texts)
        assert line.tolist() == [i for i, _ in want]
        assert first.tolist() == np.cumsum([0, *((t or b"").count(b"\n") + 1 for t in texts)]).tolist()
        assert all(names.setdefault(word, h) == h for (_, word), h in zip(want, hashes.tolist()))
        often = np.array([len(word) % 3 for _, word in want], np.int64)
        found, own, counts = line_words.by_line(hashes, line, often)
        rows = sorted({(i, len(word) % 3, names[word] >> 40, names[word]) for i, word in want})
        assert list(zip(own.tolist(), counts.tolist(), found.tolist())) == [(i, n, h) for i, n, _, h in rows]
    assert len(set(names.values())) == len(names)
    assert names[b"a" * 3000] == xxhash.xxh64_intdigest(b"a" * 3000)


def test_words_that_agree_in_the_sorted_bits():
    line = np.array([0, 0, 0, 1], np.int64)
    hashes = np.array([(5 << 40) + 2, (5 << 40) + 1, (5 << 40) + 2, 9], np.uint64)
    found, own, _ = line_words.by_line(hashes, line, np.ones(4, np.int64))
    assert found.tolist() == [(5 << 40) + 1, (5 << 40) + 2, 9] and own.tolist() == [0, 0, 1]


def test_more_lines_than_a_key_holds():
    n = (1 << 20) + 5
    line = np.concatenate([np.arange(n), [n - 1]])
    found, own, _ = line_words.by_line(np.ones(n + 1, np.uint64), line, np.ones(n + 1, np.int64))
    assert len(found) == n and own.tolist() == list(range(n))
