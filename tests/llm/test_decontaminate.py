import hashlib
import re

from foulee.llm import decontaminate

ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"), (10, "Éa öb"), (3, ""), (4, None),
         (2, "Short item"), (5, "x " * 9 + "x"), (None, "nobody owns this")]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(text, items, width=10):
    tokens, hit, owners = slow_words(text), set(), set()
    for item, body in items:
        own = slow_words(body)
        length = min(width, len(own))
        windows = {tuple(own[i : i + length]) for i in range(len(own) - length + 1)} if length else set()
        for i in range(len(tokens) - length + 1):
            if tuple(tokens[i : i + length]) in windows:
                hit |= set(range(i, i + length))
                owners |= {str(item)} if item is not None else set()
    return len(tokens), sorted(hit), sorted(owners)


TEXTS = [
    None, "", "...", "clean words only", "a one two three four five six seven eight nine ten eleven b", "SHORT,item! short item",
    "xx éA--öb", "Éa öb", "one two three four five six seven eight nine", "nobody owns this", "x " * 5000, "short " * 30000 + "item",
    "one two three four five six seven eight nine ten eleven twelve one two three four five six seven eight nine ten",
]


def test_against_brute_force_with_any_number_of_blocks(spark):
    docs = spark.createDataFrame([(i, t, "row") for i, t in enumerate(TEXTS)] + [(0, None, "row")], "doc_id long, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for size in (decontaminate.BLOCK_BYTES, 40):
        got = decontaminate.mark(docs.select("doc_id", "text"), "text", ["doc_id"], items, block_bytes=size).collect()
        assert len(got) == len(TEXTS) + 1
        for row in got:
            assert (row.n_words, row.hits, row.items) == slow(TEXTS[row.doc_id], ITEMS)


def test_remove_documents_and_spans(spark):
    docs = spark.createDataFrame([(i, t, "row") for i, t in enumerate(TEXTS)], "doc_id long, text string, hits string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontaminate.remove(docs, items).collect()
    assert {r.doc_id for r in kept} == {i for i, t in enumerate(TEXTS) if not slow(t, ITEMS)[1]}
    assert kept[0].asDict().keys() == {"doc_id", "text", "hits"} and {r.hits for r in kept} == {"row"}
    cut = {r.doc_id: r.text for r in decontaminate.remove(docs, items, what="spans").collect()}
    assert len(cut) == len(TEXTS) and cut[0] is None and cut[3] == TEXTS[3]
    assert cut[4] == "a  b" and cut[5] == "" and cut[6] == TEXTS[6] and cut[9] == ""


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.mark(docs, "text", ["doc_id"], none).collect()[0].hits == []
    assert decontaminate.mark(docs.limit(0), "text", ["doc_id"], none).collect() == []


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = decontaminate.op5_decontaminate(spark, path).collect()
    assert len(rows) == len(texts)
    for row in rows:
        n, hits, owners = slow(texts[row.doc_id], items)
        digest = hashlib.sha256(",".join(owners).encode()).hexdigest()
        assert (row.n_words, row.n_hit, row.n_items, row.items_sha256) == (n, len(hits), len(owners), digest)
        assert row.contaminated == bool(hits)
