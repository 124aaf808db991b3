import math

import numpy as np

from recordloom.llm import top_k


def _brute(rows, queries, k=5):
    ok = [(i, [math.floor(256 * x) for x in e]) for i, e in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, a in {i: e for i, e in sorted(ok, reverse=True) if i in queries}.items():
        s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(b) == len(a))[:k]
        out += [(q, n + 1, i, -v) for n, (v, i) in enumerate(s)]
    return sorted(out)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(top_k, "CHUNK", 64)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(rng.normal(0, 1, 20) * (3 if i < 30 else 0.2))]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(50)] + [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 20), (None, rows[0][1]), (2150, [1.0, 2.0]), (2151, [3.0, 1.0]), (2200, []), (2250, [1e18] * 20), (7, rows[7][1])]
    df = spark.createDataFrame([(a, b, "x") for a, b in rows], "vec_id long, embedding array<double>, query_id string").repartition(3)
    q = {i for i, _ in rows if i is not None and i % 50 == 0}
    got = sorted(tuple(r) for r in top_k.search(df, df.where("vec_id % 50 = 0"), block=7).collect())
    want = [(a, b, c, max(-(2**63), min(2**63 - 1, s))) for a, b, c, s in _brute(rows, q)]
    assert [g for g in got if g[0] != 2250] == [w for w in want if w[0] != 2250]


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k.search(df, df).collect() == []
