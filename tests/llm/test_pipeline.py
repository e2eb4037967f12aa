"""The pipeline against brute force, stage by stage, on whole tables with planted cases."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
import test_decontaminate  # noqa: E402
import test_packing  # noqa: E402
import test_simhash  # noqa: E402
from foulee.llm import language  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    long = "the and of thing that with those there are " * 40
    planted = [
        (900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "12 34 !!", None, None, None), (903, "the  thing", None, "s", 10),
        (904, "the thing\n", "en", "s", 10), (904, "the thing\n", "en", "s", 10), (None, "the thing", "en", "s", 9),
        (905, long + "end", "en", "s", 1), (906, long + "fin", "en", "s", 1),
        (907, "and " + spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text + " the", "en", "s", 1),
    ]
    docs.unionByName(spark.createDataFrame(planted, docs.schema)).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept, results = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, folder)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        results[name] = (list(map(tuple, kept.collect())), list(map(tuple, spark.read.parquet(str(tmp_path / name)).collect())))
        kept = spark.read.parquet(str(tmp_path / name))
    key = lambda r: tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in r)

    rows, got = results["language"]
    filters = language.learn(docs)
    sure = lambda t: filters.predict(None if t is None else t.encode())[1] >= language.MIN_SCORE
    assert sorted(got, key=key) == sorted((r for r in rows if sure(r[1])), key=key)
    assert {900, 901, 902}.isdisjoint({r[0] for r in got}) and len(got) >= len(rows) - 4

    rows, got = results["exact_dedup"]
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", r[1]), []).append(r)
    best = [min(g, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0)) for g in groups.values()]
    assert sorted(got, key=key) == sorted(best, key=key)

    rows, got = results["simhash"]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    roots = test_simhash.slow_components([test_simhash.slow_fingerprint(r[1]) for r in rows], 2)
    assert sorted(got, key=key) == sorted((rows[i] for i in set(roots)), key=key)

    rows, got = results["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = [r for r in rows if not test_decontaminate.slow(r[1], items)[1]]
    assert sorted(got, key=key) == sorted(clean, key=key) and 907 not in {r[0] for r in got}

    tokenizer = Tokenizer.from_file(test_packing.packing.tokenizer_path())
    tokenizer.encode_special_tokens = True
    test_packing.check_rows(kept.collect(), {r[0]: r[1] for r in got}, tokenizer)
    ran = corpus_pipeline.run(spark, folder)
    assert ran.columns == kept.columns and ran.count() == kept.count()


def test_an_empty_table_goes_through(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
