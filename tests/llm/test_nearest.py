import math

import numpy as np
from pyspark.sql import functions as F

from pairloom.llm import nearest


def brute(rows, k=5):
    sound = {(i, tuple(map(float, v))) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in sound:
        if q % 50 == 0:
            near = []
            for i, b in sound:
                if i != q and len(a) == len(b):
                    s = math.fsum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(x * x for x in b))
                    near.append((-round(s, 12), i))
            out += [(q, n + 1, i) for n, (_, i) in enumerate(sorted(near)[:k])]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as h", "3 as v")
    return nearest.search(df, F.col("vec_id") % 50 == 0).collect()


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 64)
    monkeypatch.setattr(nearest, "QUERY_BLOCK", 3)
    monkeypatch.setattr(nearest, "CHUNK_BYTES", 5000)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 8)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, base[0].tolist()) for i in range(60)]
    rows += [(2000, None), (2050, [0.0] * 8), (2100, [float("nan")] * 8), (2150, [float("inf")] + [1.0] * 7), (2200, [None] + [1.0] * 7), (2250, []), (2300, [1.0, 2.0]), (2301, [1.0, 2.5]), (None, base[1].tolist()), rows[5]]
    got = run(spark, rows)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == brute(rows)
    assert all(abs(r.score) <= 1 + 1e-12 for r in got)


def test_few_rows_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0, 0.0])]) == []
    assert [(r.query_id, r.vec_id) for r in run(spark, [(50, [1.0, 0.0]), (1, [-1.0, 0.0])])] == [(50, 1)]


def test_quantisation_error_is_bounded():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(50, 64)), rng.normal(size=(40, 64)) * 1e-6
    (a, sa, na, ea), (b, sb, nb, eb) = nearest.quantised(x), nearest.quantised(y)
    about = (a.astype("f4") @ b.astype("f4").T).astype("f8") * sa[:, None] * sb
    true = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ (y / np.linalg.norm(y, axis=1, keepdims=True)).T
    assert (np.abs(about - true) <= na[:, None] * eb + ea[:, None] * (nb + eb) + nearest.SLACK).all()


def test_extreme_vectors(spark):
    rows = [(50, [1e-200, 0.0]), (1, [1.0, 0.0]), (2, [1e200, 1e200]), (3, [0.0, 5e-324]), (100, [1e300, -1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 6)) for r in nearest.search(df, F.col("vec_id") % 50 == 0).collect()}
    half = round(math.sqrt(0.5), 6)
    assert [got[50, k] for k in (1, 2, 3, 4)] == [(1, 1.0), (2, half), (100, half), (3, 0.0)]
    assert got[100, 1] == (1, half) and got[100, 2] == (50, half)


def test_sums_of_many_components_are_exact():
    """All products have their largest size, so a float32 sum over all components would be rounded."""
    rng = np.random.default_rng(5)
    x = rng.choice([-1.0, 1.0], (40, 5000)) * rng.choice([1.0, 126 / 127], (40, 5000))
    x[:, 0] = 1.0
    best: dict = {}
    nearest._tile([[i] for i in range(40)], x, [[i] for i in range(40)], x, best, 3)
    whole = nearest.exact(np.repeat(x, 40, axis=0), np.tile(x, (40, 1))).reshape(40, 40)
    for i in range(40):
        want = sorted(((s, -j) for j, s in enumerate(whole[i].tolist())), reverse=True)[:4]
        assert sorted(best[i], reverse=True) == want
