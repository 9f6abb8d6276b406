import math

import numpy as np

from weftline.llm import knn_join as K


def brute(rows, k=5, every=50):
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in ints if i % every == 0}:
        asked = {tuple(v) for i, v in ints if i == q}
        cand = sorted((-sum(a * b for a, b in zip(v, w)), i) for v in asked for i, w in ints if i != q)
        per = cand[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(per)}
    return out


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 8)]) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(60)] + [(500 + i, [0.0] * 8) for i in range(20)]
    rows += [(600, None), (601, [None, 1.0]), (602, [float("nan")] * 8), (650, [float("inf")] * 8), (700, [0.5, 0.25]), (None, [1.0] * 8), (750, []), (3, rows[3][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    want = brute(rows)
    assert {tuple(r) for r in K.knn_join(df).collect()} == want
    monkeypatch.setattr(K, "BLOCK", 16)
    assert {tuple(r) for r in K.knn_join(df, pivots=9).collect()} == want
    assert K.knn_join(df.limit(0)).collect() == []
    few = df.where("vec_id IN (0, 1, 2)")
    assert {tuple(r) for r in K.knn_join(few).collect()} == brute([r for r in rows if r[0] in (0, 1, 2)])


def test_huge_components(spark):
    rows = [(0, [1e30, -2.0]), (1, [1e30, 1.0]), (2, [-1e30, 1.0]), (3, [3.0, 1.0])]
    got = K.knn_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got][0] == (1, (1 << 63) - 1) and got[-1]["vec_id"] == 2
