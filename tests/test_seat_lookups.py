"""The ratings of a session's seats come in one shuffle of the rows, and unused lookups only repeat rows whose key the table repeats."""

from pyspark.sql import functions as F

from bidbox.plans import bindings, q_rating
from bidbox.plans.registry import Tables

from .conftest import SF_SMALL


def _rows(spark):
    seats = lambda i: [None if (i + k) % 11 == 0 else (i * (k + 3)) % 7 for k in range(4)]
    rows = [(i % 9 if i % 13 else None, i, float(i % 5) / 4 if i % 17 else None, f"2024-{1 + i % 12:02d}-03" if i % 19 else None, *seats(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "session_id long, Board long, Pct_NS double, Date string, " + ", ".join(f"Player_ID_{x} long" for x in "NESW"))
    return df.withColumn("Date", F.to_date("Date")).unionByName(df.withColumn("Date", F.to_date("Date")).where("Board < 20"))


def _sorted(df, cols):
    return sorted((tuple(None if v is None else round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=repr)


def test_one_map_a_session_equals_a_join_a_seat(spark):
    t, rows = Tables(spark, SF_SMALL), _rows(spark)
    cols = ["session_id", "Board", *[f"Elo_R_{x}_EventStart" for x in "NESW"], "Elo_N_NS", "Elo_N_EW"]
    small, large = q_rating.with_board_elo(t, rows, small=True), q_rating.with_board_elo(t, rows, small=False)
    assert sorted(small.columns) == sorted({*rows.columns, *cols})
    got = _sorted(small, cols)
    assert got == _sorted(large, cols) and len(got) == rows.count()
    assert any(r[2] is not None for r in got) and any(r[2] is None for r in got)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = q_rating.with_board_elo(t, rows, small=True)._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.split("Scan parquet")[0].count("SortMergeJoin") <= 2  # two for the rows, whatever the number of seats


def test_actual_scores_repeat_rows_as_the_lookups_do(spark, tmp_path):
    at = str(tmp_path)
    for name in ("lineitem", "orders", "customer", "supplier"):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        key = {"customer": "c_custkey", "supplier": "s_suppkey"}.get(name)
        if key:
            df = df.unionByName(df.where(F.col(key) % 3 == 0)).unionByName(df.where(F.col(key) % 6 == 0)).unionByName(df.limit(2).withColumn(key, F.lit(None).cast("long")))
        df.write.parquet(f"{at}/{name}.parquet")
    t = Tables(spark, at)
    cols = ["session_id", "Board", "l_orderkey", "l_suppkey", "Pair_Number_NS", "Pct_NS"]
    few = bindings.scored_rows(t, actual_only=True)
    assert not {"MasterPoints_N", "Pct_NS_Pred"} & set(few.columns)
    got = _sorted(few, cols)
    assert got == _sorted(bindings.scored_rows(t), cols) and len(got) > t.lineitem.count()


def test_sessions_named_twice_keep_a_join_a_seat(spark, tmp_path):
    from bidbox.plans import q_ml

    at = str(tmp_path)
    for name in ("lineitem", "orders", "customer", "supplier"):
        df = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "lineitem":
            df = df.where("l_orderkey % 10 = 0 AND year(l_shipdate) = 1995")
        if name == "customer":
            df = df.unionByName(df.where("c_custkey % 5 = 0"))
        df.write.parquet(f"{at}/{name}.parquet")
    t = Tables(spark, at)
    rows, small = q_ml._rated_rows(t)
    assert not small and rows.where("Elo_R_N_EventStart IS NOT NULL").count() > 0
