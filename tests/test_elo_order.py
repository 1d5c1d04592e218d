"""Elo in session order against a plain sequential loop, with seeds and uneven chains."""

import random
from statistics import fmean, pstdev

from bidbox.operators import rating as RT


def sequential(rows, seed=None, gstd=RT.FALLBACK_GLOBAL_STDEV):
    """rows: (period, session, player, actual, k)."""
    rating, out = dict(seed or {}), {}
    lo, hi = RT.DAMPING_BOUNDS
    for at in sorted({r[:2] for r in rows}):
        field = {r[2]: rating.get(r[2], RT.INITIAL_RATING) for r in rows if r[:2] == at}
        damp = min(hi, max(lo, pstdev(field.values()) / gstd))
        for p, s, who, actual, k in rows:
            if (p, s) == at:
                start = field[who]
                rating[who] = start + RT.BASE_K * damp * k * (actual - 1 / (1 + 10 ** ((fmean(field.values()) - start) / 400)))
                out[p, s, who] = (start, rating[who])
    return out


def close(got, want):
    assert set(got) == set(want)
    assert all(abs(a - b) < 1e-7 for k in want for a, b in zip(got[k], want[k], strict=True))


def games(seed):
    rnd = random.Random(seed)
    # player 0 plays every session, and some sessions of a period share players
    return [(p, s, who, round(rnd.random(), 3), rnd.choice([1.0, 0.7])) for p in range(4) for s in rnd.sample(range(100), 6) for who in [0, *rnd.sample(range(1, 12), rnd.randint(1, 5))]]


def rated(spark, rows, **more):
    df = spark.createDataFrame(rows, "period int, session int, who long, actual double, k_scale double")
    out = RT.elo_in_order(df, ["period", "session"], "who", k_scale_col="k_scale", **more)
    return out, {(r.period, r.session, r.who): (r.Elo_R_EventStart, r.Elo_R_EventEnd) for r in out.collect()}


def test_in_order_equals_a_sequential_loop(spark):
    rows = games(1)
    close(rated(spark, rows)[1], sequential(rows))


def test_crowded_players_and_sessions(spark):
    rows = games(3)
    nobody = [(0, 1, None, 0.5, 1.0), (None, 2, 4, 0.5, 1.0)]  # not rated, and in no field
    for crowded in (0, 7, 10_000):  # all, some kinds and none of the groups are crowded
        close(rated(spark, rows + nobody, crowded=crowded)[1], sequential(rows))


def test_a_round_shuffles_ordinary_rows_twice(spark, monkeypatch):
    import bidbox.session as S

    plans, write = [], S.materialize
    monkeypatch.setattr(S, "materialize", lambda df, tag: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df, tag))
    rated(spark, games(4))
    assert len(plans) > 2 and all(p.count("Exchange hashpartitioning") <= 2 for p in plans[1:])


def test_seed_and_spread_of_a_previous_run(spark):
    rows = games(2)
    early, late = [r for r in rows if r[0] < 2], [r for r in rows if r[0] >= 2]
    first, got = rated(spark, early)
    spread = RT.global_stdev(first)
    assert abs(spread - pstdev([s for s, _ in got.values()])) < 1e-9
    seed = RT.last_ratings(first, "who", ["period", "session"])
    ends = {}
    for key in sorted(got):
        ends[key[2]] = got[key][1]
    assert {r.who: r.rating for r in seed.collect()} == ends
    close(rated(spark, late, seed=seed, global_std=spread)[1], sequential(late, ends, spread))


def test_no_sessions(spark):
    assert rated(spark, [])[1] == {} and RT.global_stdev(rated(spark, [])[0]) is None
    same = spark.createDataFrame([(1.0,), (1.0,), (None,)], "Elo_R_EventStart double")
    assert RT.global_stdev(same) is None  # no spread: the caller's fallback holds
