import numpy as np
import pytest
from pyspark.sql import functions as F

from foulee.llm import whitening
from foulee.llm.catalogue import QUERIES
from foulee.llm.spectrum import Spectrum, rank_one

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int"


def _scatter(rows):
    away = rows - rows.mean(axis=0)
    return away.T @ away


@pytest.mark.parametrize("seed", range(40))
def test_a_spectrum_is_the_scatter_of_its_rows(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.integers(1, 12))
    rows = rng.integers(-2, 3, (int(rng.integers(1, 60)), size)) * rng.choice([1.0, 1e6, 1e-6])
    if size > 2:
        rows[:, 1] = rows[:, 0]  # no variance of its own
    cut = int(rng.integers(0, len(rows) + 1))
    parts = Spectrum(size), Spectrum(size)
    for i, row in enumerate(rows):
        parts[i >= cut].add(row)
    parts[0].merge(parts[1])
    found, want = parts[0], _scatter(rows)
    assert found.n == len(rows) and np.allclose(found.mean, rows.mean(axis=0), rtol=1e-12, atol=1e-12 * np.abs(rows).max())
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(size), atol=1e-12)
    rebuilt = found.vectors @ np.diag(found.values) @ found.vectors.T
    assert np.abs(rebuilt - want).max() <= 1e-12 * max(np.abs(want).max(), 1e-300)


def test_close_poles_keep_vectors_orthogonal():
    d = np.array([1.0, 1.0 + 1e-15, 1.0 + 1e-9, 2.0, 2.0])
    v = np.array([1.0, 1e-9, 1.0, 0.0, 1e-30])
    values, q = rank_one(d.copy(), np.eye(5), v, 0.5)
    want = np.linalg.eigvalsh(np.diag(d) + 0.5 * np.outer(v, v))
    assert np.allclose(values, want, rtol=1e-14) and np.allclose(q.T @ q, np.eye(5), atol=1e-14)


def _brute_force(vectors, components=32):
    """deviation and whitened rows from numpy's own eigenvectors, and explained shares."""
    x = np.floor(64 * np.array(vectors, float)).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    away = (n * x - sums) / n
    values, q = np.linalg.eigh(away.T @ away / n)
    values, q = values[::-1][:components], q[:, ::-1][:, :components]
    deviation = [sum(int(o) ** 2 for o in row) for row in n * x - sums]
    return deviation, away @ q / np.sqrt(values), values / np.trace(away.T @ away / n)


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [r for r in rows if r[1] is not None and all(c is not None and np.isfinite(c) for c in r[1])]
    deviation, whitened, explained = _brute_force([r[1] for r in rows])
    found = QUERIES["op13_whitening"](spark, SF_DIR).toPandas()
    assert found.dtypes.astype(str)[["component", "n", "deviation", "whitened"]].tolist() == ["int32", "int64", "int64", "float64"]
    assert len(found) == 32 * len(rows) and set(found.n) == {len(rows)}
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-10
    assert dict(zip(found.vec_id, found.deviation)) == {r[0]: d for r, d in zip(rows, deviation)}
    table = found.pivot(index="vec_id", columns="component", values="whitened").loc[[r[0] for r in rows]].to_numpy()
    sign = np.sign((table * whitened).sum(axis=0))
    assert np.abs(table * sign - whitened).max() < 1e-8
    assert np.allclose(found[found.vec_id == rows[0][0]].sort_values("component").explained, explained, rtol=1e-10)


def test_many_partitions_and_rounds(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(400, 6)) * [5, 4, 3, 2, 1, 0.5]).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(30)
    found = whitening.whiten(df, scale=64, shift=1_000_000).toPandas()
    deviation, whitened, explained = _brute_force(vectors)
    assert set(found.component) == set(range(1, 7))
    table = found.pivot(index="vec_id", columns="component", values="whitened").loc[range(400)].to_numpy()
    assert np.abs(np.abs(table) - np.abs(whitened)).max() < 1e-9
    assert [int(d) for d in found[found.component == 1].sort_values("vec_id").deviation] == deviation


def test_rows_without_a_place(spark):
    good = [(i, [float(i % 3), float(i % 2)], None) for i in range(6)]
    bad = [
        (None, None, 1), (7, [1.0, None], 1), (8, [1.0, float("nan")], 1), (9, [float("inf"), 1.0], 1),
        (10, [1.0], 1), (11, [1.0, 2.0, 3.0], 1), (12, [], 1), (13, [1e30, 0.0], 1),
    ]
    found = whitening.whiten(spark.createDataFrame(good + bad + [(None, [2.0, 1.0], 0)], SCHEMA)).collect()
    assert sorted({(r.vec_id is None, r.vec_id) for r in found}) == [(False, i) for i in range(6)] + [(True, None)]
    assert len(found) == 14 and {r.n for r in found} == {7}


def test_repeated_rows_and_no_variance(spark):
    found = whitening.whiten(spark.createDataFrame([(1, [3.0, float(i % 2)], 0) for i in range(8)], SCHEMA)).collect()
    assert [r.whitened for r in found if r.component == 2] == [None] * 8
    assert sorted(abs(r.whitened) for r in found if r.component == 1) == pytest.approx([1.0] * 8)
    assert {r.explained for r in found} == {0.0, 1.0}
    same = whitening.whiten(spark.createDataFrame([(1, [3.0, 4.0], 0)] * 3, SCHEMA)).collect()
    assert [(r.deviation, r.whitened, r.explained) for r in same] == [(0, None, 0.0)] * 6
    assert {r.identity_error for r in same} == {0.0}


def test_empty(spark):
    for rows in ([], [(1, None, 1)], [(1, [], 1)]):
        found = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert found.collect() == [] and found.columns[:3] == ["vec_id", "component", "n"]


def test_odd_names_and_large_numbers(spark):
    rows = [(1, 2, [float(1 << 33), 0.0]), (2, 2, [-float(1 << 33), 1.0]), (3, 2, [0.0, 5.0])]
    df = spark.createDataFrame(rows, "`a.b` long, x long, whitened array<double>")
    found = whitening.whiten(df, "a.b", "whitened").filter("component = 1").orderBy("vec_id").collect()
    x = [[int(c) for c in r[2]] for r in rows]
    sums = [sum(c) for c in zip(*x)]
    assert [int(r.deviation) for r in found] == [sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    huge = whitening.Whitening(10**8, (5, 0), np.ones(2), np.eye(2))
    exact, beyond = huge.deviations(huge.offsets(np.array([[1 << 34, 3], [1 << 40, 3]]))).to_pylist()
    assert int(exact) == (10**8 * (1 << 34) - 5) ** 2 + (3 * 10**8) ** 2 and beyond is None


def test_fixed_point(spark):
    df = spark.createDataFrame([([0.5, -0.51],), ([None],), (None,)], "v array<float>")
    got = [r.x for r in df.select(whitening.fixed_point(F.col("v"), 64, 1000).alias("x")).collect()]
    assert got == [[1032, 967], None, None]
