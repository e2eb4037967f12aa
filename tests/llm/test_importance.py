import math
import random

import numpy as np
from foulee.llm import importance


def slow_weights(texts, good):
    """The definition, with n-grams placed by the operator's own hash."""
    grams = importance.Grams()
    own = [[b for part in grams(None if t is None else t.encode()) for b in part.tolist()] for t in texts]
    counts = np.zeros((2, importance.BUCKETS))
    for buckets, is_good in zip(own, good):
        for b in buckets:
            counts[0][b] += 1
            counts[1][b] += is_good
    if not counts[1].sum():
        return [0.0] * len(texts)
    p = [(c + 1) / (c + 1).sum() for c in counts]
    return [sum(math.log(p[1][b]) - math.log(p[0][b]) for b in buckets) for buckets in own]


def test_grams():
    grams = importance.Grams()
    count = lambda text: sum(len(part) for part in grams(text))
    assert count(None) == count(b"") == count(b" \n") == 0 and count(b"one") == 1 and count(b"a b c") == 5
    assert count(b"w " * 600000) == 2 * 600000 - 1
    assert [p.tolist() for p in grams(b"A b")] == [p.tolist() for p in grams(b"a\tB")]


def test_weights_by_definition(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, "", "a b a b"]
    good = [i % 3 == 0 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(texts, good))], "doc_id long, text string, good boolean")
    raw = importance.counts(df, "text")
    ratio = importance.log_ratio(raw, importance.counts(df.filter("good"), "text"))
    got = {r.doc_id: r.log_weight for r in importance.weigh(df, "text", ["doc_id"], ratio).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], slow_weights(texts, good))
    assert not importance.log_ratio(raw, importance.counts(df.limit(0), "text")).any()
    assert importance.weigh(df.limit(0), "text", ["doc_id"], ratio).collect() == []


def test_kth_largest(spark):
    rng = random.Random(2)
    values = [rng.gauss(0, 1) for _ in range(500)] + [1.0] * 50 + [-1e9, 1e9, 0.1, 0.1 + 2e-17]
    df = spark.createDataFrame([(v,) for v in values], "key double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 40, 100, 300, len(values), len(values) + 5):
        assert importance.kth_largest(df, "key", k) == ordered[min(k, len(values)) - 1]
    assert importance.kth_largest(df.limit(0), "key", 3) is None and importance.kth_largest(df, "key", 0) is None


def test_gumbel_noise_is_gumbel(spark):
    values = [r[0] for r in spark.range(20000).select(importance.gumbel("id")).collect()]
    assert abs(np.mean(values) - 0.5772) < 0.03 and abs(np.var(values) - math.pi**2 / 6) < 0.06


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    good = {r.doc_id for r in spark.read.parquet(f"{path}/labels.parquet").collect() if r.quality == 1}
    rows = {r.doc_id: r for r in importance.op4_importance(spark, path).collect()}
    want = slow_weights([d.text for d in docs], [d.doc_id in good for d in docs])
    assert np.allclose([rows[d.doc_id].log_weight for d in docs], want)
    taken = [r for r in rows.values() if r.selected]
    assert len(taken) == round(len(docs) * importance.SHARE)
    assert min(r.sample_key for r in taken) > max(r.sample_key for r in rows.values() if not r.selected)
