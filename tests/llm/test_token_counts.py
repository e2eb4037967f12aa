import random

import numpy as np
from tokenizers import Tokenizer

import public_tokenizers
from foulee.llm import token_counts


def slow(text, tokenizer):
    """Sections and tokens by the other library's offsets, byte by byte."""
    raw = (text or "").encode()
    sections, start = [], 0
    for line in (text or "").split("\n"):
        end = start + len(line) + 1
        sections.append([start, min(end, len(text or "")), 0])
        start = end
    owner = [i for i, line in enumerate(raw.split(b"\n")) for _ in range(len(line) + 1)][: len(raw)]
    at = 0
    for token in tokenizer.encode(text or "", add_special_tokens=False).tokens:
        size = len(token)  # in this vocabulary a character stands for a byte
        held = owner[at : at + size]
        best = max(sorted(set(held)), key=held.count)
        sections[best][2] += 1
        at += size
    assert at == len(raw)
    return [(i, *s) for i, s in enumerate(sections)]


TEXTS = [None, "", "\n", "\n\n\n", "one line", "a\nb", "é ü\n日本\n\n\n  x", "end\n", " \n \n ", "<|endoftext|>\nx", "😀\n" * 50, "w " * 20000 + "\nlast"]


def other():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def test_against_another_encoder(spark):
    tokenizer = other()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*TEXTS, TEXTS[5]])], "doc_id long, text string, sections string")
    got = token_counts.count(df, "text", ["doc_id"]).collect()
    assert len(got) == len(TEXTS) + 1
    for row in got:
        text = TEXTS[row.doc_id] if row.doc_id < len(TEXTS) else TEXTS[5]
        assert [tuple(s) for s in row.sections] == slow(text, tokenizer), text
    assert token_counts.count(df.limit(0), "text", ["doc_id"]).collect() == []


def test_attribution_rule():
    bounds = np.array([0, 4, 4, 10])
    assert token_counts.attribute(np.array([3, 5, 9, 10]), bounds).tolist() == [2, 0, 2]  # 3-5 is a tie
    assert token_counts.attribute(np.array([3, 6, 10]), bounds).tolist() == [1, 0, 2]
    rng = random.Random(1)
    for _ in range(100):
        ends = np.cumsum([rng.randint(1, 5) for _ in range(rng.randint(1, 20))])
        cuts = sorted(rng.randint(0, ends[-1]) for _ in range(rng.randint(0, 6)))
        got = token_counts.attribute(ends, np.array([0, *cuts, ends[-1]]))
        assert got.sum() == len(ends) and len(got) == len(cuts) + 1


def test_whole_table(spark):
    path, tokenizer = "/root/testdata/sf0.001", other()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    found = {}
    for r in token_counts.op6_token_counts(spark, path).collect():
        found.setdefault(r.doc_id, []).append((r.section, r.start, r.end, r.n_tokens))
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        assert sorted(found[doc_id]) == slow(text, tokenizer)
