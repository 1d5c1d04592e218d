"""Edge fixtures for the semantic traps (nulls, ties, NaN, malformed text) and known values."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bidbox.functions import contract as CT
from bidbox.functions import handrec as H
from bidbox.functions import keys as K
from bidbox.functions import scoring as S
from bidbox.operators import joins as J
from bidbox.operators import luck as L
from bidbox.operators import ml as ML
from bidbox.operators import ranking as RK
from bidbox.operators import relational as R
from bidbox.operators import sql_surface as Q


def test_matchpoints_ties_and_single_field(spark):
    df = spark.createDataFrame([(1, 100.0), (1, 100.0), (1, 50.0), (1, None), (2, 7.0)], "b int, s double")
    out = {(r.b, r.s): (r.MP, r.MP_Top, r.Pct) for r in RK.matchpoints(df, ["b"], "s").collect()}
    assert out[(1, 100.0)] == (1.5, 2, 0.75)      # beats 50, ties the other 100
    assert out[(1, 50.0)] == (0.0, 2, 0.0)
    assert out[(1, None)] == (None, None, None)   # null score is outside the field
    assert out[(2, 7.0)] == (0.0, 0, None)        # field of one: top 0 -> pct null


def test_average_rank_nulls_and_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,)], "x double")
    out = sorted((r.x, r.p) for r in RK.average_rank(df, "x", "p", divide_by_count=True).collect()
                 if r.x is not None)
    assert out == [(1.0, 0.25), (2.0, 2.5 / 4), (2.0, 2.5 / 4)]   # denominator counts the null row
    nul = [r.p for r in RK.average_rank(df, "x", "p", divide_by_count=True).collect() if r.x is None]
    assert nul == [None]


def test_n_unique_counts_null(spark):
    df = spark.createDataFrame([(1, None), (1, 3), (1, 3), (2, 5)], "g int, v int")
    got = dict(df.groupBy("g").agg(R.n_unique("v").alias("n")).collect())
    assert got == {1: 2, 2: 1}


@pytest.mark.parametrize("raw,decl,contract,lvl,suit,dbl", [
    ("3 NT", "N", "3NN", 3, "N", ""), ("4sx", "E", "4SXE", 4, "S", "X"), ("1NTXX", "W", "1NXXW", 1, "N", "XX"),
    ("PASS", None, "PASS", 0, None, None), ("2 h", None, None, 2, "H", ""),
])
def test_contract_normaliser(spark, raw, decl, contract, lvl, suit, dbl):
    df = spark.createDataFrame([(raw, decl)], "c string, d string")
    r = CT.normalise_contract(df, "c", "d").first()
    assert (r.Contract, r.BidLvl, r.BidSuit, r.Dbl) == (contract, lvl, suit, dbl)


def test_invalid_contracts_dropped(spark):
    df = spark.createDataFrame([("9Z", "N"), (None, "N"), ("PASS", None), ("4S", None)], "c string, d string")
    kept = {r.c for r in CT.normalise_contract(df, "c", "d", drop_invalid=True).collect()}
    assert kept == {"PASS", "4S"}
    kept2 = {r.c for r in CT.drop_invalid_contracts(CT.normalise_contract(df, "c", "d")).collect()}
    assert kept2 == kept


@pytest.mark.parametrize("raw,out", [("10H", "HT"), ("H10", "HT"), ("DK", "DK"), ("K", None), (None, None),
                                     ("KD", "DK"), ("dk", None), ("ZZ", None)])
def test_lead(spark, raw, out):
    assert spark.createDataFrame([(raw,)], "x string").select(CT.normalise_lead("x").alias("y")).first().y == out


@pytest.mark.parametrize("raw,club,tour,nlm", [
    ("MP Limits: 1,500/500", 1500, 500, False), ("None/750", None, 750, False), ("NLM", None, 500, True),
    ("NLM/0-300", None, 300, True), ("0-749", 0, 749, False),  # club: first digit run of the first token (None, None, None, False), ("", None, None, False),
])
def test_strata(spark, raw, club, tour, nlm):
    df = spark.createDataFrame([(raw,)], "x string")
    top, is_nlm = CT.tournament_top_limit("x")
    r = df.select(CT.club_top_limit("x").alias("c"), top.alias("t"), is_nlm.alias("n")).first()
    assert (r.c, r.t, r.n) == (club, tour, nlm)


def test_zfill_never_shortens(spark):
    r = spark.range(1).select(K.zfill(F.lit("123"), 2).alias("a"), K.zfill(F.lit("7"), 2).alias("b")).first()
    assert (r.a, r.b) == ("123", "07")


def test_pair_id_null_modes(spark):
    df = spark.createDataFrame([(5, None), (9, 3)], "a long, b long")
    rows = df.select(K.numeric_pair_id("a", "b", "null").alias("x"), K.numeric_pair_id("a", "b", "skip").alias("y")).collect()
    assert [(r.x, r.y) for r in rows] == [(None, "5-5"), ("3-9", "3-9")]


def test_vulnerability_cycle(spark):
    got = [r.v for r in spark.range(1, 17).select(H.vul_from_board(F.col("id")).alias("v")).collect()]
    assert got == ["None", "NS", "EW", "Both", "NS", "EW", "Both", "None",
                   "EW", "Both", "None", "NS", "Both", "None", "NS", "EW"]


def test_makes_and_par(spark):
    df = spark.createDataFrame([("NS: S4 4C H4/5 4/5D  NT7",)], "t string")
    rows = {(r.seat, r.strain): r.tricks for r in df.select(F.explode(H.parse_makes("t")).alias("m")).select("m.*").collect()}
    assert rows[("N", "S")] == 4 and rows[("S", "C")] == 10 and rows[("N", "H")] == 4 and rows[("S", "H")] == 5
    assert rows[("N", "D")] == 10 and rows[("S", "D")] == 11 and rows[("S", "N")] == 7
    bad = spark.createDataFrame([("NS: S4 4S H4",)], "t string").select(H.parse_makes("t").alias("m")).first().m
    assert bad is None
    par = spark.createDataFrame([("Par: 0 PASS",), ("Par: 420 4S-NS",), ("Par: -300 5D**-EW-2/5C*-EW-2",)], "t string")
    got = [r.p for r in par.select(H.parse_par("t").alias("p")).collect()]
    assert got[0].score == 0 and got[0].contracts[0].level == 0
    assert (got[1].score, got[1].contracts[0].strain, got[1].contracts[0].direction) == (420, "S", "NS")
    c = got[2].contracts
    assert [(x.level, x.strain, x.dbl, x.direction, x.result) for x in c] == [(5, "D", "**", "EW", -2), (5, "C", "*", "EW", -2)]


def test_deal_validation(spark):
    # hands in board-record order N, W, E, S
    good = "SAKQJHAKQDAKQCAKQ" + "S432H432D432C5432" + "ST98HJT98DJT9CJT9" + "S765H765D8765C876"
    bad_rank = good.replace("ST98", "ST9X")
    short = good.replace("SAKQJ", "SAKQ")
    df = spark.createDataFrame([(good,), (bad_rank,), (short,), (good + "SA",)], "b string")
    assert [r.v for r in df.select(H.deal_is_valid("b").alias("v")).collect()] == [True, False, False, False]
    pbn = spark.createDataFrame([(good,)], "b string").select(H.brs_to_pbn("b").alias("p")).first().p
    assert pbn == "N:AKQJ.AKQ.AKQ.AKQ T98.JT98.JT9.JT9 765.765.8765.876 432.432.432.5432"


@pytest.mark.parametrize("lv,st,db,vul,tr,score", [
    (4, "S", "", True, 10, 620), (3, "N", "", False, 9, 400), (1, "N", "X", False, 6, -100),
    (7, "N", "", True, 13, 2220), (2, "H", "XX", False, 8, 640), (1, "C", "X", True, 8, 340),
    (4, "S", "X", False, 6, -800), (3, "N", "", True, 7, -200), (0, "", "", False, 0, 0),
])
def test_contract_score(spark, lv, st, db, vul, tr, score):
    df = spark.createDataFrame([(lv, st, db, vul, tr)], "l int, s string, d string, v boolean, t int")
    assert df.select(S.contract_score("l", "s", "d", "v", "t").alias("x")).first().x == score


def test_luck_zero_sigma_is_ieee(spark):
    df = spark.createDataFrame([("s", 1, 0.5, 0.4, 0.0), ("s", 1, 0.5, 0.4, 0.0)],
                               "session_id string, Pair_Number_NS int, Pct_NS double, Pct_NS_Pred double, Pct_NS_Pred_std double")
    r = L.luck_report(df, mp_cols=None).first()
    assert r.total_sigma == 0.0 and math.isinf(r.z_luck) and r.z_luck > 0


def test_whole_row_anti_nulls_never_match(spark):
    a = spark.createDataFrame([(1, None), (2, 3)], "x int, y int")
    out = J.whole_row_anti(a, a).collect()
    assert [(r.x, r.y) for r in out] == [(1, None)]


def test_sql_guard(spark):
    spark.range(3).createOrReplaceTempView("t")
    for bad in ("DROP TABLE t", "SELECT 1; SELECT 2", "INSERT INTO t SELECT 1", "SELECT * FROM parquet.`/x`", "SELECT * FROM `parquet`.`/x`", "SHOW TABLES", "EXPLAIN SELECT 1",
                "SELECT reflect('java.lang.System', 'nanoTime')", "SELECT TRANSFORM(id) USING 'cat' AS (x) FROM t", "SELECT * FROM t JOIN other ON true",
                "SELECT (SELECT max(x) FROM csv.`/x`) FROM t", "WITH a AS (SELECT * FROM json.`/x`) SELECT * FROM a", "SET a = b", "SELECT", "SELECT * FROM t WHERE id IN (SELECT id FROM csv.`/x`)"):
        with pytest.raises(Q.QueryRejected):
            Q.guard(spark, bad, ["t"])
    for good in ("-- c\nWITH a AS (SELECT 1 AS x) SELECT x FROM a;", "SELECT 'p/*q*/r', 'a--b' FROM t", "SELECT id AS load, id AS `set` FROM T", "FROM t SELECT id", "SELECT * FROM t WHERE id IN (SELECT id FROM t)", "SELECT (SELECT max(id) FROM t), u.id FROM t, LATERAL (SELECT t.id) u",
                 "SELECT * FROM t WHERE EXISTS (SELECT 1 FROM t u WHERE u.id = t.id)", "SELECT explode(sequence(1, 3)) FROM t", "VALUES (1), (2)"):
        assert Q.guard(spark, good, ["t"]) == good
    assert spark.sql(Q.guard(spark, "SELECT 'p/*q*/r' AS x", [])).first().x == "p/*q*/r"


def test_capped_flag(spark):
    df = spark.range(10)
    out = R.capped(df, [F.col("id")], limit=3).collect()
    assert [r.id for r in out] == [0, 1, 2] and all(r.truncated for r in out)


def test_ridge_matches_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = x @ np.array([1.0, -2.0, 0.5]) + 0.3 + rng.normal(scale=0.1, size=200)
    df = spark.createDataFrame([tuple(map(float, row)) + (float(t),) for row, t in zip(x, y)], "a double, b double, c double, y double")
    m = ML.ridge_fit(df, ["a", "b", "c"], "y")
    mu, sd = x.mean(0), x.std(0)
    xs = (x - mu) / sd
    coef_std = np.linalg.solve(xs.T @ xs + 1e-3 * np.eye(3), xs.T @ (y - y.mean()))
    coef = coef_std / sd
    assert np.allclose(m["coef"], coef, atol=1e-9)
    assert abs(m["intercept"] - (y.mean() - mu @ coef)) < 1e-9


def test_skew_safe_row_index_matches_window(spark):
    # one key holds a third of the rows; the distributed row number must equal the window one
    rows = [(0 if i % 3 == 0 else i % 50, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, t int")
    a = {(r.k, r.t): r.n for r in R.experience_count(df, ["k"], ["t"], "n", skew_safe=True, n_partitions=8).collect()}
    b = {(r.k, r.t): r.n for r in R.experience_count(df, ["k"], ["t"], "n").collect()}
    n_hot = sum(1 for k, _ in rows if k == 0)
    assert a == b and max(v for (k, _), v in a.items() if k == 0) == n_hot - 1


def test_exact_quantiles_match_percentile(spark):
    df = spark.createDataFrame([(float(x % 97) if x % 5 else None,) for x in range(2000)], "v double")
    got = RK.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.9, 1.0])
    ref = df.agg(*[F.percentile("v", q).alias(f"p{i}") for i, q in enumerate([0.0, 0.1, 0.5, 0.9, 1.0])]).first()
    assert all(abs(got[q] - ref[f"p{i}"]) < 1e-9 for i, q in enumerate([0.0, 0.1, 0.5, 0.9, 1.0]))


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 1, "b"), (2, 5, "c"), (1, 2, "d")], "k int, t int, v string")
    first = {r.k: r.v for r in R.keep_first(df, ["k"], ["t"]).collect()}
    last = {r.k: r.v for r in R.keep_first(df, ["k"], ["t"], descending=True).collect()}
    assert first == {1: "b", 2: "c"} and last == {1: "a", 2: "c"}


def test_exact_quantiles_nearest_rank(spark):
    # nearest rank = value at round(q*(n-1)), halves away from zero (Polars default)
    vals = [float(v) for v in range(10)] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = RK.exact_quantiles(df, "v", [0.05, 0.25, 0.5, 0.95], method="nearest")
    # n=10: 0.05*9=0.45 -> 0; 0.25*9=2.25 -> 2; 0.5*9=4.5 -> 5; 0.95*9=8.55 -> 9
    assert got == {0.05: 0.0, 0.25: 2.0, 0.5: 5.0, 0.95: 9.0}


def test_makes_duplicate_strain_is_rejected(spark):
    df = spark.createDataFrame([("NS: S4 4S H4 D5 N7",)], "t string")
    assert df.select(H.parse_makes("t").alias("m")).first().m is None


def test_registry_usage_reports_unused(spark):
    from bidbox.operators import schema as SC
    use = SC.registry_usage(["a_1", "a_2", "b"], [(r"a_\d", "g", "int"), (r"b", "g", "int"), (r"c", "g", "int")])
    assert use == {r"a_\d": 2, "b": 1, "c": 0}


def test_discover_limit_and_glob(spark, tmp_path):
    from pyspark.sql import types as T

    from bidbox.sources import files as FS
    root = str(tmp_path / "land")
    spark.range(40).withColumn("g", F.col("id") % 4).write.partitionBy("g").json(root)
    spark.range(5).write.csv(root + "/decoy")
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert FS.discover(spark, root, "*.json", schema).count() == 40
    two = FS.discover(spark, root, "*.json", schema, max_files=2)
    assert len(two.inputFiles()) == 2


def test_hot_key_over_many_tasks(spark):
    # one key holds most rows: its prefix sum runs over several tasks and equals a plain window
    rows = [(0 if i % 10 else i % 20, float(i % 371)) for i in range(4000)] + [(5, None), (5, float("inf")), (6, float("-inf"))]
    df = spark.createDataFrame(rows, "b int, s double")
    w, ties = Window.partitionBy("b").orderBy("s"), Window.partitionBy("b", "s")
    known = df.where("s IS NOT NULL")
    want = {(r.b, r.s, r.mp) for r in known.select("b", "s", (F.rank().over(w) - 1 + (F.count("*").over(ties) - 1) / 2).alias("mp")).collect()}
    assert {(r.b, r.s, r.MP) for r in RK.matchpoints(df, ["b"], "s").collect() if r.s is not None} == want
    whole = Window.orderBy("s")
    want = {(r.s, r.p) for r in known.select("s", (F.rank().over(whole) + (F.count("*").over(Window.partitionBy("s")) - 1) / 2).alias("p")).collect()}
    assert {(r.s, r.p) for r in RK.average_rank(df, "s", "p").collect() if r.s is not None} == want


def test_report_csv_quotes_non_numeric_with_bom(spark, tmp_path):
    import glob

    from bidbox.sources import files as FS
    df = spark.createDataFrame([("b", 2, None), ('a "x", y', 1, 0.5)], "name string, n int, w double")
    out = str(tmp_path / "rep")
    FS.write_report_csv(df, out, order=["n"])
    parts = [open(p, "rb").read().decode("utf-8") for p in sorted(glob.glob(out + "/part-*"))]
    assert all(p.startswith("﻿") for p in parts)  # every file has its header
    lines = [parts[0].lstrip("﻿").splitlines()[0]] + [x for p in parts for x in p.splitlines()[1:]]
    assert lines == ['"name","n","w"', '"a ""x"", y",1,0.5', '"b",2,']


def test_capped_limit_clamp_and_default(spark):
    df = spark.range(300)
    assert R.capped(df, [F.col("id")], limit="abc").count() == 200     # not an integer -> default
    assert R.capped(df, [F.col("id")], limit=0).count() == 1           # clamped to >= 1
    assert R.capped(df, [F.col("id")], limit=10**9).count() == 300     # clamped to 2000, all rows


def test_rounding_of_query_results(spark):
    from bidbox.plans.util import rounded
    r = rounded(spark.createDataFrame([(10.006, -0.0, 1.005e-6)], "a double, b double, c double"), 2).first()
    assert (r.a, r.b, r.c) == (10.01, 0.0, 0.0)


def test_personal_flags_and_filter(spark):
    from bidbox.operators import personal as PE
    rows = [("s", "A", 1, 1, 1, 5, 10, 20, 30, 40, "N", 10), ("s", "A", 2, 1, 1, 6, 10, 21, 30, 41, "E", 21), ("s", "B", 3, 1, 1, 5, 11, 22, 31, 42, None, None),
            ("s", "A", 4, 2, 2, 5, 12, 20, 32, 40, "S", 32)]
    df = spark.createDataFrame(rows, "session_id string, section_name string, Board int, Round int, Pair_Number_NS int, Pair_Number_EW int, Player_ID_N int, Player_ID_E int, "
                                     "Player_ID_S int, Player_ID_W int, Declarer_Direction string, Declarer_ID int")
    asked = spark.createDataFrame([("s", "30"), ("s", "999")], "session_id string, player_id string")
    got = {r.Board: r for r in PE.personalise(df, asked).collect()}
    assert {b: r.Boards_I_Played for b, r in got.items()} == {1: True, 2: True, 3: False, 4: False}
    assert got[1].Boards_Partner_Declared and got[1].Boards_We_Declared and not got[1].Boards_I_Declared
    assert got[2].Boards_Opponent_Declared and got[1].Opponent_Pair_Direction == "EW" and got[4].My_Section and not got[3].My_Section
    assert sorted(r.Board for r in PE.only_my_boards(PE.personalise(df, asked)).collect()) == [1, 2]


def test_few_players_are_found_without_a_row_a_seat(spark, monkeypatch):
    from bidbox.operators import personal as PE
    rows = [(i % 3, "AB"[i % 2], i, 1, i % 4, i % 5, *[(i * k + k) % 11 or None for k in (1, 2, 3, 5)], "NESW"[i % 4], i % 11) for i in range(90)]
    df = spark.createDataFrame(rows, "session_id int, section_name string, Board int, Round int, Pair_Number_NS int, Pair_Number_EW int, Player_ID_N int, Player_ID_E int, "
                                     "Player_ID_S int, Player_ID_W int, Declarer_Direction string, Declarer_ID int")
    asked = spark.createDataFrame([(0, " 3"), (0, "3"), (0, "5"), (1, "99"), (1, None), (2, "7"), (None, "7"), (8, "1")], "session_id int, player_id string")
    me = PE.find_players(df, asked, "session_id", ["Board", "Round"])
    plan = me._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Generate") < plan.index("Join")  # seats are unfolded after the join, and only those asked for
    few = sorted(map(str, PE.personalise(df, asked).collect()))
    monkeypatch.setattr(PE, "FEW", 0)
    assert few and few == sorted(map(str, PE.personalise(df, asked).collect()))
    assert {(r.session_id, r.player_id) for r in me.collect()} == {(0, "3"), (0, "5"), (2, "7")}


def test_parallel_counts(spark):
    from bidbox.operators import schema as SC
    SC.assert_equal_counts({"a": spark.range(3), "b": spark.range(3, 6)})
    with pytest.raises(SC.SchemaError):
        SC.assert_equal_counts({"a": spark.range(3), "b": spark.range(4)})
    assert "s: string" in SC.schema_problems(spark.sql("SELECT 'x' AS s, 'y' AS t").schema, keep_strings=["t"])


def test_no_scratch_folder_off_local_mode(spark, monkeypatch):
    from bidbox import session as SE

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Fake:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})

    with pytest.raises(RuntimeError):
        SE.ensure_checkpoint_dir(Fake())


def test_global_rank_of_stored_and_derived_columns_agree(spark):
    from bidbox.operators import ranking as RK
    df = spark.range(300).select("id", F.when(F.col("id") % 7 > 0, (F.col("id") * 37 % 41 - 20) / 4.0).alias("x"))
    df = df.withColumn("x", F.when(F.col("id") == 8, F.lit(float("nan"))).when(F.col("id") == 9, F.lit(float("inf"))).otherwise(F.col("x")))
    get = lambda d, **kw: sorted(((r.id, r.p) for r in RK.average_rank(d, "x", "p", **kw).collect()))
    assert get(df, stored=True) == get(df) and get(df.limit(0), stored=True) == []
