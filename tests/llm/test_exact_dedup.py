import hashlib
import re

from foulee.llm import exact_dedup

SCHEMA = "doc_id long, text string"


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((i, t or ""))
    out = []
    for key, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        sha = hashlib.sha256(key.encode()).hexdigest()
        out += [(i, keep[0], len(members), sha) for i, _ in members]
    return sorted(out, key=str)


def run(df, **kw):
    rows = exact_dedup.fingerprinted(df, "doc_id", "text", carry=False)
    return exact_dedup.mark_copies(rows, df.count(), **kw).collect()


def check(df, rows, **kw):
    got = run(df, **kw)
    assert sorted([(r.id, r.keep_id, r.group_size, r.digest) for r in got], key=str) == brute(rows)
    kept = {}
    for r in got:
        kept[r.digest] = kept.get(r.digest, 0) + r.kept
        assert not r.kept or r.id == r.keep_id
    assert set(kept.values()) <= {1}


def test_groups_ties_nulls(frame):
    rows = [
        (1, "a b"), (2, "ab"), (3, "a\tb\n"), (4, None), (5, ""), (6, " \x0b"), (7, "x"), (7, "x"), (None, "x"),
        (8, "A b"), (9, "a b"), (None, None), (10, "long " * 20000), (11, "long" * 20000),
    ]
    check(frame(rows, SCHEMA), rows)


def test_a_full_filter_loses_nothing(frame):
    rows = [(i, f"text {i % 700}") for i in range(3000)]
    check(frame(rows, SCHEMA), rows, max_filter_bits=1)


def test_empty(frame):
    assert run(frame([], SCHEMA)) == []


def test_drop_copies_keeps_columns(spark):
    df = spark.createDataFrame(
        [(1, "a b", 5, "p"), (2, "ab", 6, "q"), (3, "c", 7, None)], "doc_id long, text string, block long, digest string"
    )
    assert sorted(map(tuple, exact_dedup.drop_copies(df).collect())) == [(1, "a b", 5, "p"), (3, "c", 7, None)]


def test_unique_rows_are_not_shuffled(frame):
    df = frame([(1, "a"), (2, "b")], SCHEMA)
    rows = exact_dedup.fingerprinted(df, "doc_id", "text", carry=True)
    plan = exact_dedup.mark_copies(rows, 2)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("Union") :].split("+-")
    assert "BroadcastHashJoin" in plan and not any("Python" in x or "Arrow" in x for x in first)
