"""The distributed isotonic fit against plain pooling, and fold moments against one pass."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidbox.operators import isotonic as I
from bidbox.operators import ml as ML


def plain(points):
    """[(x, y, w)] -> fitted value by x."""
    stack = []
    for x, y, w in sorted(points):
        stack.append([[x], w, w * y])
        while len(stack) > 1 and stack[-2][2] / stack[-2][1] >= stack[-1][2] / stack[-1][1]:
            xs, w, s = stack.pop()
            stack[-1] = [stack[-1][0] + xs, stack[-1][1] + w, stack[-1][2] + s]
    return {x: s / w for xs, w, s in stack for x in xs}


def cases():
    rnd = random.Random(4)
    return {
        "noise": [(float(i), i / 300 + rnd.gauss(0, 0.4), rnd.randint(1, 5)) for i in range(300)],
        "falling": [(float(i), -float(i), 1) for i in range(120)],  # one block over all partitions
        "rising": [(float(i), float(i), 1) for i in range(120)],
        "plateaus and ties": [(float(i), float(i // 10 % 3), 1 + i % 2) for i in range(150)],
        "one": [(0.5, 0.25, 3)],
    }


@pytest.mark.parametrize("name", list(cases()))
def test_blocks_equal_plain_pooling(spark, name):
    points = cases()[name]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several partitions though the points are few
    try:
        df = spark.createDataFrame([(x, y, float(w)) for x, y, w in points], "x double, y double, w double").repartition(3)
        blocks = I.isotonic_blocks(df, "x", "y", "w")
        got = {r.x: r.fit for r in I.isotonic_predict(df.select("x"), "x", blocks, "fit").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    want = plain(points)
    assert set(got) == set(want) and all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_between_and_beyond_blocks(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (1.0, 0.2, 1.0), (2.0, 0.8, 1.0)], "x double, y double, w double")
    blocks = I.isotonic_blocks(df, "x", "y", "w")
    ask = spark.createDataFrame([(x,) for x in (-5.0, 0.5, 1.0, 1.5, 9.0)], "x double")
    got = {r.x: round(r.fit, 9) for r in I.isotonic_predict(ask, "x", blocks, "fit").collect()}
    assert got == {-5.0: 0.0, 0.5: 0.1, 1.0: 0.2, 1.5: 0.5, 9.0: 0.8}


def test_recalibrate_keeps_rows_without_a_prediction(spark):
    rows = [(i, i / 50, float(i % 7 < 3)) for i in range(50)] + [(50, None, 1.0), (51, float("nan"), 1.0), (52, 0.5, None)]
    out = ML.isotonic_recalibrate(spark.createDataFrame(rows, "k int, p double, y double"), "p", "y", ["k"])
    got = {r.k: r.calibrated for r in out.collect()}
    assert len(got) == 53 and got[50] is None and got[51] is None and got[52] is not None
    scored = [got[i] for i in range(50)]
    assert scored == sorted(scored) and all(0 <= x <= 1 for x in scored)


def test_fold_moments_merge_to_the_whole(spark):
    rnd = random.Random(2)
    rows = [(i, 1e6 + rnd.random(), rnd.random(), rnd.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, a double, b double, y double")
    parts = ML.fold_moments(df, ["a", "b"], "y", F.col("k") % 3)
    n, mean, co = ML.merged_moments([parts[f] for f in sorted(parts)])
    z = np.array([r[1:] for r in rows])
    assert n == 200 and np.allclose(mean, z.mean(axis=0)) and np.allclose(co, np.cov(z.T, bias=True) * 200, atol=1e-6)


def test_out_of_fold_leaves_the_own_fold_out(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.random(), rnd.random()) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, a double, y double")
    out = ML.out_of_fold_ridge(df, ["a"], "y", ["k"], k=3)
    got = {r.k: (r._fold, r.oof_pred) for r in out.collect()}
    assert {f for f, _ in got.values()} == {0, 1, 2}
    for f in range(3):
        m = ML.ridge_fit(df.where(ML.fold_of(["k"], 3) != f), ["a"], "y")
        assert all(abs(p - (m["intercept"] + m["coef"][0] * rows[k][1])) < 1e-9 for k, (g, p) in got.items() if g == f)
