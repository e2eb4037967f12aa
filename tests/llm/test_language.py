import zlib

import numpy as np
from pyspark.sql import functions as F

from foulee.llm import language


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def slow_grams(text):
    """All n-grams of words with marked ends, as strings."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    return [w[i : i + n] for n in language.SIZES for w in (f"^{w}^" for w in words) for i in range(len(w) - n + 1)]


def test_grams_by_definition():
    for text in ["", "...", "Ab", "a", "Éa, bß 12 c", "x" * 300000, "日本 語"]:
        hashes = [h for part in language.grams(text.encode()) for h in part.tolist()]
        slow = slow_grams(text)
        # Equal n-grams get equal hashes and others do not; a mark that two words share counts once.
        assert len(set(hashes)) == len(set(slow)) and len(hashes) == len(slow), text[:20]


def test_filters_contain_what_was_learned():
    rng = np.random.default_rng(1)
    found = {f"l{i}": rng.integers(0, 2**63, 500).astype(np.uint64) for i in range(11)}
    filters = language.Filters(found)
    for i, name in enumerate(filters.languages):
        masks = np.full((500, filters.table.shape[1]), 255, np.uint8)
        for slot in filters._slots(found[name]):
            masks &= filters.table[slot]
        assert (masks[:, i // 8] >> (i % 8) & 1).all()
    assert (filters.false < 0.2).all()


def test_cases(spark):
    en, fr = "the thing with those there", "nous étions déjà à l'école"
    rows = [(i, en if i % 2 else fr, "en" if i % 2 else "fr") for i in range(200)]
    rows += [(500, None, "en"), (501, "", None), (502, "12 !?", "fr"), (None, en, None), (7, en, "en")]
    df = docs_of(spark, rows)
    got = language.predict(df, language.learn(df), "text", ["doc_id", "lang"]).collect()
    for r in got:
        if r.doc_id in (500, 501, 502):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred == (r.lang or "en") and 0 < r.score <= 1
    extra = df.selectExpr("*", "'x' as lang_pred", "1 as Score")
    kept = language.identified(extra)
    assert kept.columns == extra.columns and kept.count() == len(rows) - 3
    none = docs_of(spark, [(1, en, None)])
    assert language.predict(none, language.learn(none), "text", ["doc_id"]).collect()[0].lang_pred == "und"
    assert language.identified(none.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = language.op3_language(spark, path).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_are_not_learned_from(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    df = docs_of(spark, [(i, "only held out words", "xx") for i in held] + [(1000, "other text", "en")])
    assert "xx" not in language.learn(df).languages


def test_a_language_of_any_size_is_learned_from():
    for count in (4001, 10**6, 5 * 10**9, 10**15, 10**25):
        limit = language.sample_limit(count, 4000)
        assert 1 <= limit <= language.DRAWS and (count > 10**20 or abs(limit * count / language.DRAWS - 4000) < 1)


def test_the_draw_is_even(spark):
    df = spark.range(200_000).select(language._draw(F.xxhash64("id")).alias("place"))
    assert df.filter((F.col("place") < 0) | (F.col("place") >= language.DRAWS)).count() == 0
    assert abs(df.filter(F.col("place") < language.sample_limit(200_000, 4000)).count() - 4000) < 400


def _plain_sets(filters, found):
    """Slots of each language as plain sets, without any bit operation on whole tables."""
    out = {}
    for name in filters.languages:
        out[name] = {int(s) for slot in filters._slots(found[name]) for s in slot}
    return out


def test_predictions_against_plain_sets(spark):
    """Every n-gram is looked up in each language's own set of slots; shares are corrected one by one."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    filters = language.learn(docs)
    # What was learned, by counting over the documents it may be learned from.
    rows = [r for r in docs.collect() if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    found = {}
    for name in {r.lang for r in rows}:
        own = [r for r in rows if r.lang == name]
        counts = {}
        for r in own:
            for gram in {int(h) for part in language.grams((r.text or "").encode()) for h in part}:
                counts[gram] = counts.get(gram, 0) + 1
        found[name] = np.array([g for g, n in counts.items() if n >= language.MIN_SHARE * len(own)], np.uint64)
    plain = language.Filters(found)
    assert plain.languages == filters.languages and (plain.table == filters.table).all()
    sets = _plain_sets(plain, found)
    for r in docs.collect():
        hashes = np.array([int(h) for part in language.grams((r.text or "").encode()) for h in part], np.uint64)
        slots = [slot.tolist() for slot in plain._slots(hashes)]
        shares = []
        for name in plain.languages:
            hits = sum(all(slot[i] in sets[name] for slot in slots) for i in range(len(hashes)))
            false = (len(sets[name]) / len(plain.table)) ** language.PROBES
            shares.append(min(1, max(0, (hits / max(1, len(hashes)) - false) / (1 - false))))
        lang, score = filters.predict((r.text or "").encode())
        if not len(hashes):
            assert (lang, score) == ("und", 0.0)
        else:
            best = max(range(len(shares)), key=lambda i: (shares[i], -i))
            assert lang == plain.languages[best] and abs(score - shares[best]) < 1e-12
