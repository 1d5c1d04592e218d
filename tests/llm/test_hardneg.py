"""Hard-negative mining against brute force."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from bidbox.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string"


def brute(rows, asks, positives=5, negatives=5):
    one = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        if i not in one or (label, v) < one[i]:
            one[i] = (label, v)
    q = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in one.items()}
    out = []
    for a in filter(asks, q):
        la, va = q[a]
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i) for i, (_, v) in q.items() if i != a and len(v) == len(va))
        same = [(-s, i) for s, i in scored if q[i][0] == la][:positives]
        for p, pid in same:
            near = [(-s, i) for s, i in scored if q[i][0] != la and 80 * p <= 100 * -s <= 100 * p][:negatives]
            out += [(a, pid, k, i, p, s) for k, (s, i) in enumerate(near, 1)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def vectors(n, dim, rnd, labels=4, step=0.05):
    centre = [[rnd.gauss(0, 0.3) for _ in range(dim)] for _ in range(3)]
    return [(i, [round(c + rnd.gauss(0, 0.05), 2) // step * step for c in centre[i % 3]], rnd.randrange(labels), "x") for i in range(n)]


def test_against_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    rows = vectors(400, 6, rnd) + [(1000 + i, [0.3, -0.2], i % 2, None) for i in range(30)]  # many ties, and vectors of another length
    rows += [(5000, None, 1, "n"), (5001, [0.1, None, 0.1, 0.0, 0.0, 0.0], 1, "n"), (5002, [float("nan")] * 6, 1, "n"), (5003, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], 1, "n"), (5004, [0.1] * 6, None, "n"), (None, [0.1] * 6, 1, "n"),
             rows[10], (rows[10][0], [0.9] * 6, 0, "x"), (5010, [], 1, "e"), (5020, [], 1, "e"), (5030, [], 2, "e"), (6000, [-0.5] * 6, 3, "negative scores")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows, lambda i: i % 10 == 0)
    assert want
    monkeypatch.setattr(hardneg, "ROWS", 50)
    monkeypatch.setattr(hardneg, "ANCHORS", 16)
    assert got(hardneg.mine(df, F.col("vec_id") % 10 == 0)) == want
    monkeypatch.setattr(hardneg, "ROWS", 8192)
    assert got(hardneg.mine(df, F.col("vec_id") % 10 == 0)) == want


def test_one_label_with_most_rows_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "ROWS", 64)
    rows = [(i, [0.5, 0.25], 0 if i % 3 else 1, "x") for i in range(300)]
    assert got(hardneg.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0)) == brute(rows, lambda i: i % 50 == 0)


def test_large_components(spark):
    rows = [(i, [1e6 * (i + 1), -1e5], i % 2, "x") for i in range(8)]  # products beyond the exact range of doubles
    assert got(hardneg.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 2)) == brute(rows, lambda i: i == 2) != []
    assert hardneg.scores(np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 3.0], [2.0**40, 0.0]])).tolist() == [[2**60 + 3, 2**63 - 1]]


def test_reader_holds_windows_only():
    """A generator of any length is read once, and a negative of the positive's own score counts though its id is smaller."""
    read = hardneg.mined(2, 80, 100)
    rows = iter([(7, 100, 0, 50), (7, 100, 1, 3), (7, 99, 0, 51), (7, 99, 1, 4), (7, 80, 1, 5), (7, 79, 1, 6), (7, 10, 1, 7)])
    assert list(read(7, rows)) == [(7, 50, 1, 3, 100, 100), (7, 50, 2, 4, 100, 99), (7, 51, 1, 4, 99, 99), (7, 51, 2, 5, 99, 80)]


def test_keys_sort_by_anchor_score_kind_and_id():
    rnd = random.Random(1)
    rows = [(rnd.randrange(-3, 4), rnd.randrange(-5, 6), rnd.randrange(2), rnd.randrange(-9, 9)) for _ in range(500)]
    assert [hardneg.unpack(k) for k in sorted(hardneg.pack(*r) for r in rows)] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))


def test_empty_and_no_anchor(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hardneg.mine(none, F.col("vec_id") == 1).collect() == []
    some = spark.createDataFrame([(1, [0.1], 1, None), (2, [0.1], 2, None)], SCHEMA)
    assert hardneg.mine(some, F.col("vec_id") > 5).collect() == [] == hardneg.mine(some, F.col("vec_id") == 1).collect()
