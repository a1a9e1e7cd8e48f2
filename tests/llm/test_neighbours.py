"""Neighbours against brute force."""

import numpy as np
from pyspark.sql import functions as F

from chargelake.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, asks, count=5):
    rows = {(i, tuple(v)) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, v in rows:
        if not asks(q):
            continue
        a = np.array(v, np.float32).astype(float)
        best = {}
        for i, w in rows:
            b = np.array(w, np.float32).astype(float)
            if i != q and len(a) == len(b):
                score = float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)))
                best[i] = max(best.get(i, -2), score)
        out[q] = sorted(best.items(), key=lambda p: (-round(p[1], 12), p[0]))[:count]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def same(got, want):
    got = {q: hits for q, hits in got.items()}
    want = {q: hits for q, hits in want.items() if hits}
    assert got.keys() == want.keys()
    for q, hits in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in hits]
        assert np.allclose([s for _, s in got[q]], [s for _, s in hits], atol=1e-12)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0], 1), (1, [0.9, 0.1, 0.0], None), (2, None, 1), (3, [0.0, 0.0, 0.0], 1), (4, [nan, 1.0, 0.0], 1), (6, [inf, 1.0, 0.0], 1),
        (7, [None, 1.0, 0.0], 1), (8, [2.0, 0.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0, 0.0], 1),
        (10, [-1.0, 0.0, 0.0], 1), (11, [], 1), (12, [1.0, 1.0], 1), (14, [1.0, 0.5], 1), (16, [0.3], 1), (0, [0.0, 1.0, 0.0], 2),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit(1), "key": F.lit("k"), "rank": F.lit(2)})
    got = result(neighbours.nearest(df, F.col("vec_id") % 2 == 0))
    want = brute_force([r for r in rows if r[0] != 0], lambda q: q % 2 == 0)
    for q in want:
        if q != 0:
            assert [i for i, _ in got.get(q, [])] == [i for i, _ in brute_force(rows, lambda i: i == q)[q]], q
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_hot_vector_and_recall(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(3000, 24)).astype(np.float32)
    vectors[1000:2000] = vectors[1000]
    rows = [(i, v.tolist(), None) for i, v in enumerate(vectors)]
    got = result(neighbours.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    want = brute_force(rows, lambda q: q % 50 == 0)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [i for i, _ in got[1050]] == [1000, 1001, 1002, 1003, 1004]
    assert [i for i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005]


def test_rotation_keeps_lengths():
    rows = np.random.default_rng(1).normal(size=(5, 16))
    assert np.allclose(np.linalg.norm(neighbours.hadamard(rows), axis=1), np.linalg.norm(rows, axis=1))
