"""Operator 5 against brute force."""

import math
import random

from arrivals.llm.topk import top_inner_products


def brute(rows, k=20):
    width = max((len(v) for i, v in rows if i is not None and v is not None), default=0)
    ok = [(i, [math.floor(64 * x) for x in v] + [0] * (width - len(v))) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, qv in {i: v for i, v in ok if i % 20 == 0}.items():
        scores = sorted((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(qv, v)))), i) for i, v in ok if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


def check(spark, rows, kind="float"):
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int")
    got = {tuple(r) for r in top_inner_products(df.repartition(3)).collect()}
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    assert got == want


def test_random_vectors_with_ties_and_bad_rows(spark):
    rnd = random.Random(1)
    rows = [(i, [rnd.gauss(0, 1) * (1 + i % 7) for _ in range(12)]) for i in range(-40, 700)]
    rows += [(1000 + i, [0.5] * 12) for i in range(30)]
    rows += [(2000, None), (2020, [1.0, None] + [0.0] * 10), (2040, [float("nan")] * 12), (2060, [float("inf")] * 12),
             (None, [1.0] * 12), (2080, [2.0] * 5), (2100, [])]
    check(spark, rows)


def test_few_rows_equal_vectors_and_large_numbers(spark):
    check(spark, [(0, [1.0, 2.0]), (1, [0.1, 0.1]), (20, [1.0, 2.0])])
    check(spark, [(i, [1.0, 0.0]) for i in range(60)])
    check(spark, [(0, [1e18, 3.0]), (20, [-1e18, 5.0]), (3, [1.0, 1e300]), (4, [2.5, -7.0])], "double")


def test_empty_table(spark):
    assert top_inner_products(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert top_inner_products(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0
