"""Elo in session order, block by block: uneven blocks, repeated and incomplete rows, and chains of many sessions."""

import random

import pytest

from bidbox.operators import rating as RT

from .test_elo_order import close, games, rated, sequential


def test_blocks_of_any_size(spark):
    rows = games(5)
    nobody = [(0, 1, None, 0.5, 1.0), (None, 2, 4, 0.5, 1.0)]  # not rated, and in no field
    for block_rows in (9, 40):
        close(rated(spark, rows + nobody, block_rows=block_rows)[1], sequential(rows))


def test_repeated_and_incomplete_rows_as_in_rounds(spark):
    rows = games(6)[:40]
    odd = rows + rows[5:20] + [(1, None, 3, 0.4, 1.0), (1, 7, 0, None, 1.0), (2, 8, 2, 0.3, None)]
    kept = lambda df: sorted(map(str, ((r.period, r.session, r.who, r.Elo_R_EventStart and round(r.Elo_R_EventStart, 6), r.Elo_R_EventEnd and round(r.Elo_R_EventEnd, 6)) for r in df.collect())))
    rounds = kept(rated_frame(spark, odd, crowded=0))
    assert len(rounds) == len(odd)
    for more in ({}, {"block_rows": 25}):
        assert kept(rated_frame(spark, odd, **more)) == rounds


def rated_frame(spark, rows, **more):
    df = spark.createDataFrame(rows, "period int, session int, who long, actual double, k_scale double")
    return RT.elo_in_order(df, ["period", "session"], "who", k_scale_col="k_scale", **more)


def test_a_long_chain_takes_no_more_passes(spark, monkeypatch):
    import bidbox.session as S

    rnd, tags, write = random.Random(7), [], S.materialize

    def counted(df, tag):
        tags.append(tag)
        if len(tags) > 12:
            pytest.fail("a pass over all sessions for each few of a chain")
        return write(df, tag)

    monkeypatch.setattr(S, "materialize", counted)
    # two groups far apart, so that changes of a rating move later ones strongly
    rows = [(s // 100, s, who, round(min(1.0, max(0.0, rnd.random() + (0.4 if who < 3 else -0.4))), 3), 1.0) for s in range(600) for who in rnd.sample(range(6), 3)]
    close(rated(spark, rows)[1], sequential(rows))
