import numpy as np
import pytest

from quire.llm import ann

SCHEMA = "vec_id long, embedding array<float>"
hundredth = lambda v: v % 100 == 0


def brute(rows, k=10):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    out = {}
    for i, v in zip(ids, x):
        if i % 100 == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            out[int(i)] = [(float(d[j]), int(ids[j])) for j in np.lexsort((ids, d)) if ids[j] != i][:k]
    return out


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    return {q: [(s, v) for _, s, v in sorted(rows)] for q, rows in out.items()}


@pytest.mark.parametrize("kind", ["uniform", "clusters", "copies"])
def test_recall(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64)) * (1 if kind == "uniform" else 0.3)
    if kind != "uniform":
        x += rng.normal(size=(10, 64))[rng.integers(0, 10, 3000)]
    x *= rng.uniform(0.5, 2, size=(3000, 1))
    if kind == "copies":
        x[::3] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got, want = found(ann.search(frame, hundredth, query_block=7, rerank=150)), brute(rows)  # a twentieth is reranked
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    hits = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.97
    exact = {q: {v: s for s, v in brute(rows, 3000)[q]} for q in list(want)[:5]}
    for q, near in exact.items():
        assert got[q] == sorted(got[q]) and all(s == pytest.approx(near[v], abs=1e-12) for s, v in got[q])


def test_dealing_out_has_no_part(spark):
    rng = np.random.default_rng(8)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(1200, 16)))], SCHEMA)
    one, many = (found(ann.search(frame.repartition(n), hundredth, rerank=15)) for n in (1, 7))
    assert one == many and one != brute([(r.vec_id, r.embedding) for r in frame.collect()])


def test_anisotropic_loss_favours_parallel_residuals():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)

    def parallel(threshold):
        book = ann.fit(x, threshold=threshold)
        codes = book.encode(x)
        decoded = np.concatenate([book.centres[m][codes[:, m]] for m in range(16)], axis=1)
        return np.abs(((x - decoded) * x).sum(1)).mean()

    assert parallel(0.4) < 0.8 * parallel(0.0)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), 1.0, 2.0]) for i in range(0, 900, 50)]
    bad = [(1, None), (2, [None, 1.0, 1.0]), (3, [nan, 1.0, 1.0]), (4, [inf, 1.0, 1.0]), (5, [0.0, 0.0, 0.0]), (6, []), (7, [1.0]), (None, [1.0, 1.0, 1.0]), (300, [300.0, 1.0, 2.0])]
    frame = spark.createDataFrame(good + bad, SCHEMA)
    from pyspark.sql import functions as F

    assert found(ann.search(frame.withColumn("score", F.lit("x")).withColumn("vector", F.lit(1)), hundredth)) == brute(good)
    assert found(ann.search(spark.createDataFrame(good[:3], SCHEMA), hundredth)) == brute(good[:3])
    assert ann.search(frame.limit(0), hundredth).count() == 0
    assert ann.search(spark.createDataFrame(bad[:5], SCHEMA), hundredth).count() == 0
    assert ann.search(spark.createDataFrame(good[1:2], SCHEMA), hundredth).count() == 0
