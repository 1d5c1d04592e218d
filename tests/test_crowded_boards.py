"""Matchpoints by windows and, for crowded boards, by prefix sums: same rows against brute force."""

import random

import pytest

from bidbox.operators import ranking as RK

SCORES = {"s": ("mp", "top", "pct"), "p": ("mp_p", "top_p", "pct_p")}


def expected(rows, score):
    out = []
    for r in rows:
        field = [x[score] for x in rows if r["b"] is not None and x["b"] == r["b"] and x[score] is not None]
        if r["b"] is None or r[score] is None:
            out.append((r["id"], None, None, None))
            continue
        mp = sum(x < r[score] for x in field) + (sum(x == r[score] for x in field) - 1) / 2
        out.append((r["id"], mp, len(field) - 1, mp / (len(field) - 1) if len(field) > 1 else None))
    return sorted(out)


@pytest.mark.parametrize("crowded", [2, 12, 10_000])
def test_matchpoints_of_two_scores(spark, crowded):
    rnd = random.Random(crowded)
    rows = [{"id": i, "b": rnd.choice([None, 1, 2, 2, 3, 3, 3, 3]), "s": rnd.choice([None, -0.0, 0.0, 1.5, 7.0, 9.25]), "p": rnd.choice([None, 1.0, 2.0])} for i in range(60)]
    rows += [{"id": 60, "b": 4, "s": 1.0, "p": None}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "id long, b long, s double, p double")
    got = RK.matchpoints_of(df, ["b"], SCORES, crowded=crowded)
    assert got.columns == ["b", "p", "s", "id", "mp", "top", "pct", "mp_p", "top_p", "pct_p"]
    found = got.collect()
    for score, names in SCORES.items():
        assert sorted((r["id"], *(r[c] for c in names)) for r in found) == expected(rows, score)


def test_boards_are_shuffled_once(spark):
    df = spark.range(200).selectExpr("id % 7 AS b", "CAST(id % 5 AS DOUBLE) AS s", "CAST(id % 3 AS DOUBLE) AS p")
    plan = RK.matchpoints_of(df, ["b"], SCORES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
