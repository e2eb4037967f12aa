import hashlib
import re
import time

from pyspark.sql import functions as F

from foulee.llm import pii

#: The base patterns as they are given.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def slow(text):
    out = {}
    for kind, pattern in BASE.items():
        spans = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                spans.append(f"{kind}:{m.start()}:{m.end()}")
        out[kind] = spans
    return out


TEXTS = [
    None, "", "é a.b+c@x-y.example.com, ü", "a@b.c_d@e.f @x.y z@w", "a@b a@b. a@.c x@y.com.z@w.org", "-@-.-.-",
    "1.2.3.4.5.6.7.8.9 300.1.2.3.4 001.002.003.255 1.2.3 256.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111",
    "4111111111111111", "4111111111111112 x 12345678901234567890123", "5  4111111111111111-9", "é 6 4111 1111 1111 1111",
    "+1 (988) 555-2485 +1 +12 +123456789012345678 ++33 6 12 34 56 78", "😀 +41 44 668 18 00 mail me@x.io",
    "IBAN GB82 WEST 1234 5698 7654 32 and DE89370400440532013000, GB82 WEST 1234 5698 7654 33", "SSN 123-45-6789 but 123-45-6789",
    "0" * 3000, "a." * 1000 + "@b" + ".c" * 1000, "+" + "1(" * 1000, "1." * 3000, " 9" * 2000, "x@y.z " * 1000, "-" * 3000,
]


def test_against_the_given_patterns(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(2, TEXTS[2])], "doc_id long, text string")
    found = pii.find(df, "text", ["doc_id"]).collect()
    assert len(found) == len(TEXTS) + 1
    for row in found:
        want = slow(TEXTS[row.doc_id])
        for kind in BASE:
            assert [f"{s.kind}:{s.start}:{s.end}" for s in row[kind]] == want[kind], (row.doc_id, kind)
            assert all(s.value == TEXTS[row.doc_id][s.start : s.end] for s in row[kind])


def test_added_kinds_and_scores(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(df, "text", ["doc_id"]).collect()}
    assert [s.value for s in found[14].iban] == ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    assert [s.start for s in found[15].ssn] == [4]  # the second one has no such word next to it
    lone = spark.createDataFrame([(1, "order 123-45-6789 of cloth")], "doc_id long, text string")
    assert pii.find(lone, "text", ["doc_id"]).first().ssn == []
    assert found[13].email[0].score == 1.0 and found[2].email[0].score == 0.9


def test_long_texts(spark):
    """Texts on which the patterns as they are given take quadratic time."""
    texts = ["0" * 200000, "a." * 100000 + "@b" + ".c" * 100000, "+" + "1(" * 100000, "1.2.3.4 " * 20000, " 9" * 100000, "-" * 200000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [len(r[kind]) for kind in BASE] for r in pii.find(df, "text", ["doc_id"]).collect()}
    assert got == {0: [0, 0, 0, 0], 1: [1, 0, 0, 0], 2: [0, 0, 0, 0], 3: [0, 20000, 0, 0], 4: [0, 0, 0, 0], 5: [0, 0, 0, 0]}


def test_redact(spark):
    df = spark.createDataFrame([("é a@b.c und +41 44 668 18 00!",), ("nothing",)], "text string")
    spans = F.array_sort(F.concat("email", "phone"), lambda a, b: (a["start"] - b["start"]).cast("int"))
    rows = pii.find(df, "text", ["text"]).select(pii.redact(F.col("text"), spans).alias("x")).collect()
    assert [r.x for r in rows] == ["é [email] und [phone]!", "nothing"]


def test_whole_table_and_plan(spark):
    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    df = pii.op1_pii(spark, path)
    rows = df.collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 0
    for r in rows:
        want = slow(texts[r.doc_id])
        base = [span for kind in BASE for span in want[kind]]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert r.spans.split(",")[: len(base)] == (base or [""][: len(base)])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string"), "text", ["doc_id"]).collect() == []


def test_time_grows_with_the_number_of_matches(spark):
    """A text twice as long takes about twice the time: no list is made anew for each of its parts."""
    seconds = []
    for n in (500, 20_000, 40_000):
        df = spark.createDataFrame([(1, " ".join(f"a{i}@b.example" for i in range(n)))], "doc_id long, text string")
        start = time.perf_counter()
        assert pii.find(df, "text", ["doc_id"]).select(F.size("email")).first()[0] == n
        seconds.append(time.perf_counter() - start)
    assert seconds[2] < 2.5 * seconds[1] + 2


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([("x", "a@b.c", 1)], "email string, text string, ip long")
    found = pii.find(df, "text", ["email", "ip"])
    assert len({name.lower() for name in found.columns}) == len(found.columns) == 2 + len(pii.KINDS)
    assert found.first()[0] == "x" and found.first()["email_"][0].value == "a@b.c"
