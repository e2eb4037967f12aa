import hashlib
import json
import random

import pytest

from foulee.llm import chat
from foulee.llm.catalogue import QUERIES
from foulee.llm.word_bpe import WordEncoder

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _expected(rows):
    """Digests straight from the rows: what no formatting may change."""
    out, ids = {}, {r[0] for r in rows}
    for i in ids:
        own = [(r[2] or "", r[3] or "", r[1]) for r in rows if r[0] == i]
        own.sort(key=lambda r: (r[2] is None, r[2] or 0, r[0], chat.escape(r[1])))
        spoken = "".join(text for role, text, _ in own if role == "assistant")
        said = "".join(f"{role}\n{text}\n" for role, text, _ in own)
        out[i] = (len(own), _sha(said), len(spoken), _sha(spoken))
    return out


def _found(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    found = QUERIES["op12_chat"](spark, SF_DIR)
    assert dict(found.dtypes) == {
        "conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string", "loss_chars": "bigint", "loss_sha256": "string",
        "formatted_chars": "bigint",
    }
    assert _found(found) == _expected(rows)
    # The formatted conversations themselves: their lengths, and texts under the mask.
    whole = chat.conversations(chat.format_messages(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: len(r.formatted) for r in whole} == {r.conv_id: r.formatted_chars for r in found.collect()}
    for r in whole:
        own = sorted((r2 for r2 in rows if r2[0] == r.conv_id), key=lambda r2: r2[1])
        assert list(chat.read_back(r.formatted)) == [(x[2], x[3] or "") for x in own]
        spoken = "".join(chat.unescape(r.formatted[s.start : s.end]) for s in r.loss)
        assert spoken == "".join(x[3] or "" for x in own if x[2] == "assistant")


BITS = ["\\", "<", ">", "</turn>", "<turn user>\n", "<image 0>", "</document>", "turn", "\n", " ", "a", "é𝄞", "<audio", "### Assistant:", "\\<", "</", ""]


@pytest.mark.parametrize("seed", range(300))
def test_any_role_and_text_comes_back(seed):
    rng = random.Random(seed)
    turns = [tuple("".join(rng.choices(BITS, k=rng.randint(0, 12))) for _ in range(2)) for _ in range(rng.randint(1, 4))]
    messages = [chat.flatten(role, text, None) for role, text in turns]
    assert list(chat.read_back("".join("".join(m.out) for m in messages))) == turns
    for m, (role, text) in zip(messages, turns):
        piece = "".join(m.out)
        assert [chat.unescape(piece[s["start"] : s["end"]]) for s in m.spans] == ([text] if role == "assistant" and text else [])


PARTS = [
    {"type": "text", "text": "See <image 0> and "},
    {"type": "image", "ref": "s3://b/1.png", "width": 29, "height": 14},
    {"type": "document", "ref": "d.pdf", "parts": [
        {"type": "text", "text": "page "}, {"type": "audio", "ref": "a.wav", "seconds": 1.5}, {"type": "text", "text": "one"},
    ]},
    {"type": "document", "ref": "e.pdf", "pages": 3},
    {"type": "video", "ref": "v"},
    "plain",
    7,
]


def test_parts_are_flattened_in_order():
    message = chat.flatten("assistant", "ignored", json.dumps(PARTS))
    piece = "".join(message.out)
    assert piece == (
        "<turn assistant>\nSee \\<image 0> and <image 0><document 1>page <audio 2>one</document><document 3></document>"
        '{"ref": "v", "type": "video"}plain7</turn>\n'
    )
    assert [(a["number"], a["kind"], a["ref"], a["tokens"]) for a in message.attachments] == [
        (0, "image", "s3://b/1.png", 3), (1, "document", "d.pdf", 0), (2, "audio", "a.wav", 38), (3, "document", "e.pdf", 768)
    ]
    spoken = [chat.unescape(piece[s["start"] : s["end"]]) for s in message.spans]
    assert spoken == ["See <image 0> and ", "page ", "one", '{"ref": "v", "type": "video"}', "plain", "7"]
    assert list(chat.read_back(piece)) == [("assistant", "".join(spoken))]


def test_odd_parts():
    for parts in ("", "not json", '{"type": "text"}', "null", "[]", "[null]", '["\\ud800"]', '[{"type":"image","width":"x","height":1e99,"ref":5}]'):
        message = chat.flatten("user", "text", parts)
        "".join(message.out).encode()
        assert message.spans == [] and len(list(chat.read_back("".join(message.out)))) == 1
    deep = '[{"type":"document","parts":' * 3000 + "[]" + "}]" * 3000
    assert list(chat.read_back("".join(chat.flatten("user", None, deep).out))) == [("user", deep)]


def test_token_counts(spark):
    rows = [(1, 0, "user", json.dumps(PARTS[:3])), (1, 1, "assistant", None), (2, 0, None, json.dumps([]))]
    df = spark.createDataFrame([(c, t, r, "hello there, friend", p) for c, t, r, p in rows], f"{SCHEMA}, parts string")
    found = chat.format_messages(df, parts_col="parts").orderBy("conv_id", "turn").collect()
    ids = lambda *texts: sum(len(one) // 4 for one in WordEncoder(chat.tokenizer_path()).encode(list(texts)))
    assert [r.text_tokens for r in found] == [ids("See <image 0> and ", "page ", "one"), ids("hello there, friend"), 0]
    assert [r.expanded_tokens - r.text_tokens for r in found] == [41, 0, 0]
    assert found[0].attachments[0].ref == "s3://b/1.png" and found[2].piece == "<turn >\n</turn>\n"
    total = chat.digest(chat.format_messages(df, parts_col="parts")).orderBy("conv_id").collect()
    assert [(r.n_attachments, r.expanded_tokens - r.text_tokens) for r in total] == [(3, 41), (0, 0)]


def test_nulls_ties_repeats_and_long_texts(spark):
    rows = [
        (1, 0, "user", None), (1, None, "assistant", "last"), (1, 1, None, "b"), (1, 1, None, "a"), (1, 1, "assistant", "c"),
        (1, 1, None, "a"), (None, 2, "assistant", "x"), (None, None, None, None), (2, 0, "assistant", "</turn>\\" * 200_000),
        (3, 0, "", ""),
    ]
    for parts in (1, 5):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        assert _found(chat.digest(chat.format_messages(df))) == _expected(rows)


def test_many_conversations_in_a_task(spark):
    rows = [(i, 0, "assistant", str(i)) for i in range(25_000)]
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert chat.digest(chat.format_messages(df)).coalesce(1).count() == 25_000


def test_empty_and_odd_names(spark):
    assert chat.digest(chat.format_messages(spark.createDataFrame([], SCHEMA))).collect() == []
    df = spark.createDataFrame([("x", 1, "assistant", "t", 9)], "`a.b` string, piece long, `message` string, text string, loss int")
    found = chat.digest(chat.format_messages(df, "a.b", "piece", "message")).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in found] == [("x", 1, 1)]
