import math
import random

import numpy as np
from cdclake.llm.pivots import choose_pivots, nearest, upper_bound


def brute(rows, queries, k=10):
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    table = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and ok(v)]
    out = set()
    for q, v in queries:
        if q is None or not ok(v):
            continue
        v = [math.floor(1024 * x) for x in v]
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in table if i != q and len(w) == len(v))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def check(spark, rows, pick, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = nearest(df, df.where(pick), **options).collect()
    plain = [(i, v) for i, v, _ in rows]
    want = brute(plain, [(i, v) for i, v in plain if i is not None and eval(pick.replace("=", "==").replace("%", "%"), {"vec_id": i})], options.get("k", 10))
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_clusters_and_a_hot_vector(spark):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], 0) for i in range(900)]
    rows += [(900 + i, centres[0], 1) for i in range(450)]
    check(spark, rows, "vec_id % 50 = 0", block_rows=100, sample=64, most_pivots=16)


def test_ties_nulls_short_tables_and_mixed_lengths(spark):
    rows = [(0, [0.5, -0.5], 0), (1, [0.5, -0.5], 0), (2, [0.5, -0.5], 0), (3, None, 0), (4, [], 0), (5, [None, 1.0], 0), (6, [float("nan"), 1.0], 0), (7, [float("inf"), 1.0], 0), (8, [0.0, 0.0], 0),
            (9, [1.0, 2.0, 3.0], 0), (10, [1.0, 2.0, 3.5], 0), (11, [-0.0001, 0.0001], 0), (None, [1.0, 1.0], 0)]
    check(spark, rows, "vec_id % 1 = 0")
    check(spark, rows, "vec_id % 1 = 0", k=1, most_pivots=1)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert nearest(df.limit(0), df).count() == 0 and nearest(df, df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, [1.0], 0), (2, [1.0], 0), (2, [1.0], 0), (1, [1.0], 0)], "vec_id bigint, embedding array<float>, label int")
    assert sorted(map(tuple, nearest(twice, twice).collect())) == [(1, 1, 2, 1048576), (1, 2, 2, 1048576), (2, 1, 1, 1048576), (2, 2, 1, 1048576)]


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q, p = rng.normal(size=(500, 5)), rng.normal(size=5), rng.normal(size=5)
    far, norm = np.sqrt(((x - p) ** 2).sum(1)), np.sqrt((x**2).sum(1))
    gap = float(np.sqrt(((q - p) ** 2).sum()))
    assert (upper_bound(q, float(np.sqrt((q**2).sum())), p, gap, far, far, norm) >= x @ q - 1e-9).all()
    assert len(choose_pivots(np.ones((9, 3)), 4)) == 1 and len(choose_pivots(x, 16)) == 16
