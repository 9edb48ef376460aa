"""Exact top-k against a scan of all rows."""
import math
import random

import numpy as np

from veilset.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score string, grp int"


def brute(rows, k=20):
    ok = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % 20 == 0}):
        raw = min(v for i, v in rows if i == q and v is not None and
                  all(x is not None and math.isfinite(x) for x in v))
        y = [math.floor(64 * float(np.float32(x))) for x in raw]
        found = sorted(((-sum(a * b for a, b in zip(y, v, strict=False)), i)
                        for i, v in ok if i != q))
        out += [(q, r + 1, i, min(max(-s, -2**63), 2**63 - 1))
                for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, p=topk.Params()):
    df = spark.createDataFrame([(i, v, 1, "s", 3) for i, v in rows], SCHEMA)
    return sorted(map(tuple, topk.top_k(df, df.where("vec_id % 20 = 0"), p).collect()))


def test_random_vectors_small_blocks(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, .2) for _ in range(16)]) for i in range(400)]
    assert run(spark, rows, topk.Params(block=8, group=50, chunk=3)) == brute(rows)


def test_ties_repeats_and_common_vector(spark):
    same = [0.5, -0.25, 0.125]
    rows = [(i, same) for i in range(0, 300)] + [(20, same), (7, same), (40, [1.0, 1.0, 1.0])]
    assert run(spark, rows, topk.Params(block=16, group=64, chunk=4)) == brute(rows)


def test_values_that_take_no_part_and_wide_values(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [nan, 1.0]), (80, [inf, 1.0]),
            (None, [1.0, 1.0]), (1, [2.0]), (2, [3.0, 1.0, 9.0]), (3, []), (100, [1e18, -1e18]),
            (4, [1e18, 1e18]), (-20, [1e5, 1e9]), (5, [3e30, 3e30])]
    assert run(spark, rows) == brute(rows)


def test_blocks_below_the_kth_are_not_scored():
    rnd = np.random.default_rng(2)
    vectors = np.floor(rnd.normal(0, 3, (2000, 8)))
    vectors[:40] += 200
    queries = np.ones((5, 8))
    owner, score, ids, scored = topk.search(np.arange(-5, 0), queries, np.arange(2000), vectors,
                                            20, 20)
    assert scored == 5 * 2 and len(owner) == 100 and ids.max() < 40


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_value_that_overflows_when_scaled_takes_no_part(spark):
    rows = [(0, [1.0, 2.0]), (20, [1e307, 1.0]), (1, [3e306, 0.0]), (2, [0.5, 1.0]),
            (3, [-1.7e308, 1.0]), (4, [2.8e306, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 20 = 0")).collect()))
    big = min(64 * math.floor(64 * 2.8e306), 2**63 - 1)
    assert got == [(0, 1, 4, big), (0, 2, 2, 64 * 32 + 128 * 64)]
