"""Modelling queries (M1-M8, M10), skill features (C20) and session personalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import handrec as H
from ..operators import joins as J
from ..operators import ml as ML
from ..operators import personal as PE
from ..operators import rating as RT
from ..operators import relational as R
from ..session import discard, materialize
from .bindings import SCORED_ROWS_SQL, SEAT_ROWS_SQL, scored_rows, seat_columns, seat_rows
from .q_rating import BOARD_RESULTS_SQL, CROWDED_SESSION, PLAYER_ELO_SQL, by_quarter, with_board_elo
from .registry import Tables, register
from .util import r, rounded

BASELINE_FEATURES = ["elo_R_seat_diff", "elo_R_seat_avg", "mp_log_diff", "mp_log_avg", "elo_N_diff",
                     "elo_diff_x_vul_NS", "elo_diff_x_vul_EW", "mp_log_diff_x_elo_diff", "Vul_NS", "Vul_EW",
                     "Section_Pairs"]
SKILL_COLS = ["elo_R_seat_NS", "elo_R_seat_EW", "elo_R_seat_diff", "elo_R_seat_avg", "mp_log_NS", "mp_log_EW",
              "mp_log_diff", "mp_log_avg", "elo_N_diff", "elo_diff_x_vul_NS", "elo_diff_x_vul_EW",
              "mp_log_diff_x_elo_diff"]


def _with_roles(t: Tables, rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Seat master points (|c_acctbal| of the seat's customer) and board vulnerability flags; ``keys`` holds the seats of ``rows``."""
    players = t.customer.select("c_custkey", F.abs("c_acctbal").alias("MasterPoints"))
    seats = {x: f"Player_ID_{x}" for x in "NESW"}
    players = J.used_rows(players, "c_custkey", keys, list(seats.values()), ["MasterPoints"])
    if players.count() <= J.BROADCAST_ROWS:
        players = F.broadcast(players)
    out = J.role_joins(rows, players, "c_custkey", seats, ["MasterPoints"])
    vul = H.vul_from_board(F.col("Board") % 16 + 1)
    return (out.withColumn("Vul_NS", vul.isin("NS", "Both").cast("double"))
               .withColumn("Vul_EW", vul.isin("EW", "Both").cast("double")))


_ROLE_SQL = """
SELECT s.*, abs(n.c_acctbal) AS MasterPoints_N, abs(e.c_acctbal) AS MasterPoints_E, abs(so.c_acctbal) AS MasterPoints_S,
  abs(w.c_acctbal) AS MasterPoints_W,
  CAST(['None','NS','EW','Both'][CAST(((s.Board % 16) + floor((s.Board % 16) / 4)) % 4 AS INTEGER) + 1] IN ('NS', 'Both') AS DOUBLE) AS Vul_NS,
  CAST(['None','NS','EW','Both'][CAST(((s.Board % 16) + floor((s.Board % 16) / 4)) % 4 AS INTEGER) + 1] IN ('EW', 'Both') AS DOUBLE) AS Vul_EW
FROM ({src}) s LEFT JOIN customer n ON s.Player_ID_N = n.c_custkey LEFT JOIN customer e ON s.Player_ID_E = e.c_custkey
LEFT JOIN customer so ON s.Player_ID_S = so.c_custkey LEFT JOIN customer w ON s.Player_ID_W = w.c_custkey"""


def _skill_sql(src: str) -> str:
    """``src`` has the roles, the seats' ratings r_n, r_e, r_s, r_w and the pairs' earlier sessions g_ns, g_ew."""
    mp_ns = "ln(1 + (coalesce(MasterPoints_N, 0) + coalesce(MasterPoints_S, 0)) / 2.0)"
    mp_ew = "ln(1 + (coalesce(MasterPoints_E, 0) + coalesce(MasterPoints_W, 0)) / 2.0)"
    elo_ns, elo_ew = "(coalesce(r_n, 0) + coalesce(r_s, 0)) / 2.0", "(coalesce(r_e, 0) + coalesce(r_w, 0)) / 2.0"
    return f"""SELECT *, elo_R_seat_diff * coalesce(Vul_NS, 0) AS elo_diff_x_vul_NS, elo_R_seat_diff * coalesce(Vul_EW, 0) AS elo_diff_x_vul_EW, mp_log_diff * elo_R_seat_diff AS mp_log_diff_x_elo_diff
FROM (SELECT x.*, {elo_ns} AS elo_R_seat_NS, {elo_ew} AS elo_R_seat_EW, {elo_ns} - {elo_ew} AS elo_R_seat_diff, ({elo_ns} + {elo_ew}) / 2.0 AS elo_R_seat_avg,
  {mp_ns} AS mp_log_NS, {mp_ew} AS mp_log_EW, {mp_ns} - {mp_ew} AS mp_log_diff, ({mp_ns} + {mp_ew}) / 2.0 AS mp_log_avg,
  CAST(coalesce(g_ns, 0) - coalesce(g_ew, 0) AS DOUBLE) AS elo_N_diff FROM ({src}) x)"""


_RATED_SQL = """SELECT b.session_id, b.Board, b.Pair_Number_NS AS Round, b.l_orderkey, b.l_partkey, b.l_suppkey, b.Pct_NS, b.n AS Player_ID_N, b.e AS Player_ID_E, b.s AS Player_ID_S, b.w AS Player_ID_W,
  rn.rating AS r_n, re.rating AS r_e, rs.rating AS r_s, rw.rating AS r_w, gn.earlier AS g_ns, ge.earlier AS g_ew FROM board b
""" + "\n".join(f"LEFT JOIN player_starts r{x} ON r{x}.period = b.period AND r{x}.session_id = b.session_id AND r{x}.who = b.{x}" for x in "nesw") + """
LEFT JOIN pair_games gn ON gn.period = b.period AND gn.session_id = b.session_id AND gn.who = b.ns
LEFT JOIN pair_games ge ON ge.period = b.period AND ge.session_id = b.session_id AND ge.who = b.ew"""


@register("c20_skill", sql=f"""
WITH RECURSIVE {BOARD_RESULTS_SQL}, {PLAYER_ELO_SQL}, f AS ({_skill_sql(_ROLE_SQL.format(src=_RATED_SQL))})
SELECT session_id, Board, Round, l_orderkey, {", ".join(f"{r(c)} AS {c}" for c in SKILL_COLS)} FROM f""")
def c20_skill(spark, d):
    """Skill features of every board row, with the ratings of its seats and the earlier sessions of its pairs."""
    t = Tables(spark, d)
    f = ML.skill_features(_rated_rows(t)[0])
    return rounded(f.select("session_id", "Board", F.col("Pair_Number_NS").alias("Round"), "l_orderkey", *SKILL_COLS))


def _rated_rows(t: Tables, sizes: bool = False) -> tuple[DataFrame, bool]:
    """Scored board rows with seats, seat master points, seat ratings and vulnerability, and whether all sessions are of ordinary size; if they are and
    with ``sizes``, also the rows of the session (Section_Pairs).  Each written step goes once the next one is written."""
    spark, boards, scored, quarters, counts = t.customer.sparkSession, [], [], [], []
    s = scored_rows(t, actual_only=True, made=boards).drop("Score_NS", "MP_NS", "MP_Top").withColumns(seat_columns())
    s = materialize(s, "scored-rows", scored)
    discard(spark, boards)
    # a session that the customers name twice has two results of each player, which a map cannot hold
    once = RT.largest(t.customer.where("c_custkey IS NOT NULL"), ["c_custkey"]) <= 1
    if not (once and RT.largest(s, ["session_id"]) <= CROWDED_SESSION):
        return _with_roles(t, with_board_elo(t, s), s), False
    # the board and the seats follow from the part, supplier and order: a third of a row's bytes
    derived = {"Board": F.col("l_partkey"), **seat_columns()}
    s = by_quarter(s.drop(*derived), quarters)
    discard(spark, scored)
    n = None
    if sizes:
        n = materialize(s.where("session_id IS NOT NULL").groupBy("session_id").agg(F.count(F.lit(1)).cast("double").alias("Section_Pairs")), "sizes", counts)
    out = _with_roles(t, with_board_elo(t, s, True, n, derived), s.withColumns(derived))
    discard(spark, quarters + counts)
    return out, True


def _model_rows(t: Tables) -> tuple[DataFrame, bool]:
    """:func:`model_rows`, and whether they follow row by row from written ones."""
    s, small = _rated_rows(t, sizes=True)
    if small:
        return ML.skill_features(s), True
    pairs = s.groupBy("session_id").agg(F.count(F.lit(1)).cast("double").alias("Section_Pairs"))
    return ML.skill_features(s.join(pairs, "session_id", "left")), False


def model_rows(t: Tables) -> DataFrame:
    """Scored board rows + seat master points and ratings + skill features + field size of the session."""
    return _model_rows(t)[0]


def _fold_sql(*key: str, k: int = 2) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(key)}, '42')), 1, 8) AS BIGINT) % {k}"


#: x: the model rows with f1 .. f11 and y (null: 0) and their fold
_MODEL_SQL = f"""{BOARD_RESULTS_SQL}, {PLAYER_ELO_SQL}, f AS ({_skill_sql(_ROLE_SQL.format(src=_RATED_SQL))}),
x AS (SELECT *, {", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS f{i}" for i, c in enumerate(BASELINE_FEATURES, 1))}, coalesce(Pct_NS, 0) AS y, {_fold_sql("l_orderkey", "l_partkey", "l_suppkey", "Board")} AS fold
  FROM (SELECT *, count(*) OVER (PARTITION BY session_id) AS Section_Pairs FROM f))"""


def _ridge_sql(name: str, where: str) -> str:
    """CTE ``name`` (i, b): the coefficients by Gauss-Jordan elimination of the standardised normal equations; i = 0 is the intercept."""
    k = len(BASELINE_FEATURES)
    every = range(1, k + 1)
    std = lambda i: f"CASE WHEN stddev_pop(f{i}) > {ML.STD_FLOOR} THEN stddev_pop(f{i}) ELSE 1 END"
    rows = " UNION ALL ".join(
        f"SELECT {i} AS i, [" + ", ".join(f"n * c{min(i, j)}_{max(i, j)} / (s{i} * s{j})" + (f" + {ML.RIDGE_LAMBDA}" if i == j else "") for j in every) + f", n * cy{i} / s{i}] AS v, s{i} AS s, m{i} AS m FROM {name}_sums" for i in every)
    return f"""{name}_sums AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(y) AS my, {", ".join(f"avg(f{i}) AS m{i}, {std(i)} AS s{i}, covar_pop(f{i}, y) AS cy{i}" for i in every)},
  {", ".join(f"covar_pop(f{i}, f{j}) AS c{i}_{j}" for i in every for j in every if i <= j)} FROM x WHERE {where}),
{name}_steps AS (SELECT 0 AS k, i, v, s, m FROM ({rows}) UNION ALL
  SELECT k + 1, i, list_transform(range(1, {k + 2}), lambda j: CASE WHEN i = k + 1 THEN v[j] / v[k + 1] ELSE v[j] - v[k + 1] / p[k + 1] * p[j] END), s, m
  FROM (SELECT *, first_value(v) OVER (ORDER BY abs(i - k - 1)) AS p FROM {name}_steps WHERE k < {k})),
{name}_coef AS (SELECT i, v[{k + 1}] / s AS b, m FROM {name}_steps WHERE k = {k}),
{name} AS (SELECT i, b FROM {name}_coef UNION ALL SELECT 0, (SELECT my FROM {name}_sums) - (SELECT sum(b * m) FROM {name}_coef))"""


@register("m01_ridge", sql=f"""WITH RECURSIVE {_MODEL_SQL}, {_ridge_sql("fit", "TRUE")}
SELECT CASE i {" ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(BASELINE_FEATURES, 1))} ELSE '(intercept)' END AS feature, {r('b')} AS coefficient FROM fit""")
def m01_ridge(spark, d):
    """Coefficients of the ridge baseline (driver-side k x k solve)."""
    model = ML.ridge_fit(model_rows(Tables(spark, d)), BASELINE_FEATURES, "Pct_NS")
    return rounded(ML.ridge_table(spark, model))


@register("m02_residual", sql=f"""
WITH s AS ({SCORED_ROWS_SQL}), b AS (SELECT Pair_Number_NS, avg(Pct_NS) AS baseline FROM s GROUP BY ALL),
x AS (SELECT s.session_id, s.Board, s.l_orderkey, s.Pair_Number_NS, s.Pct_NS, b.baseline, s.Pct_NS - b.baseline AS y_resid
      FROM s JOIN b USING (Pair_Number_NS)),
m AS (SELECT session_id, avg(y_resid) AS resid_pred FROM x GROUP BY ALL)
SELECT x.session_id, Board, l_orderkey, Pair_Number_NS, {r('y_resid')} AS y_resid, {r('baseline + resid_pred')} AS final_pred
FROM x JOIN m USING (session_id) WHERE Pct_NS IS NOT NULL""")
def m02_residual(spark, d):
    # three branches read the scored rows: these columns are written once
    s = materialize(scored_rows(Tables(spark, d)).select("session_id", "Board", "l_orderkey", "Pair_Number_NS", "Pct_NS"), "scored-rows")
    base = s.groupBy("Pair_Number_NS").agg(F.avg("Pct_NS").alias("baseline"))
    x = ML.residual_target(s.join(base, "Pair_Number_NS"), "Pct_NS", "baseline")
    resid = x.groupBy("session_id").agg(F.avg("y_resid").alias("resid_pred"))
    out = ML.recombine(x.join(resid, "session_id"), "baseline", "resid_pred").where(F.col("Pct_NS").isNotNull())
    return rounded(out.select("session_id", "Board", "l_orderkey", "Pair_Number_NS", "y_resid", "final_pred"))


@register("m03_isotonic", sql=f"""
WITH s AS (SELECT session_id, Board, l_orderkey, Pct_NS, Pct_NS_Pred, {_fold_sql("l_orderkey", "l_partkey", "l_suppkey", "Board")} = 0 AS fit_half FROM ({SCORED_ROWS_SQL})),
p AS (SELECT Pct_NS_Pred AS x, avg(Pct_NS) AS y, count(*) AS w, row_number() OVER (ORDER BY Pct_NS_Pred) AS k FROM s WHERE fit_half AND Pct_NS_Pred IS NOT NULL AND Pct_NS IS NOT NULL GROUP BY 1),
c AS (SELECT k, x, sum(w) OVER (ORDER BY k) AS cw, sum(w * y) OVER (ORDER BY k) AS cs, w, w * y AS wy FROM p),
lowest AS (SELECT b.k, b.x, min((b.cs - a.cs + a.wy) / (b.cw - a.cw + a.w)) OVER (PARTITION BY a.k ORDER BY b.k DESC) AS v FROM c a JOIN c b ON b.k >= a.k),
fit AS (SELECT x, max(v) AS v FROM lowest GROUP BY x),
e AS (SELECT x, v, lead(x) OVER (ORDER BY x) AS nx, lead(v) OVER (ORDER BY x) AS nv FROM fit),
q AS (SELECT DISTINCT Pct_NS_Pred AS x FROM s WHERE Pct_NS_Pred IS NOT NULL),
z AS (SELECT q.x, CASE WHEN e.x IS NULL THEN (SELECT min(v) FROM fit) WHEN nx IS NULL THEN v ELSE v + (nv - v) * (q.x - e.x) / (nx - e.x) END AS calibrated FROM q ASOF LEFT JOIN e ON q.x >= e.x)
SELECT session_id, Board, l_orderkey, {r('Pct_NS')} AS "Pct_NS", {r('Pct_NS_Pred')} AS "Pct_NS_Pred", fit_half, {r('least(1, greatest(0, calibrated))')} AS calibrated
FROM s LEFT JOIN z ON z.x = s.Pct_NS_Pred""")
def m03_isotonic(spark, d):
    """Isotonic recalibration of the predicted pct, fitted on one hash half, for all rows; the SQL takes the fit as max of min of means."""
    s = scored_rows(Tables(spark, d)).select("session_id", "Board", "l_orderkey", "l_partkey", "l_suppkey",
                                            "Pct_NS", "Pct_NS_Pred")
    cal = ML.isotonic_recalibrate(s, "Pct_NS_Pred", "Pct_NS", ["l_orderkey", "l_partkey", "l_suppkey", "Board"])
    return rounded(cal.select("session_id", "Board", "l_orderkey", "Pct_NS", "Pct_NS_Pred", "fit_half", "calibrated"))


@register("m04_ensemble", sql=f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity / 50.0 AS s1, l_discount * 10 AS s2, l_tax * 12.5 AS s3 FROM lineitem),
m AS (SELECT s.*, (s1 + s2 + s3) / 3.0 AS mean FROM s)
SELECT l_orderkey, l_linenumber, l_partkey, {r('mean')} AS ens_mean,
  {r('sqrt(((s1 - mean) * (s1 - mean) + (s2 - mean) * (s2 - mean) + (s3 - mean) * (s3 - mean)) / 3.0)')} AS ens_std FROM m""")
def m04_ensemble(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_quantity") / 50.0).alias("s1"),
                                          (F.col("l_discount") * 10).alias("s2"), (F.col("l_tax") * 12.5).alias("s3"))
    mean, std = ML.ensemble(["s1", "s2", "s3"])
    return rounded(li.select("l_orderkey", "l_linenumber", "l_partkey", mean.alias("ens_mean"), std.alias("ens_std")))


@register("m05_oof", sql=f"""WITH RECURSIVE {_MODEL_SQL}, {_ridge_sql("other0", "fold <> 0")}, {_ridge_sql("other1", "fold <> 1")},
w AS (SELECT 0 AS fold, list(b ORDER BY i) AS b FROM other0 UNION ALL SELECT 1, list(b ORDER BY i) FROM other1)
SELECT session_id, Board, l_orderkey, {r('Pct_NS')} AS "Pct_NS", {r("b[1] + " + " + ".join(f"b[{i + 1}] * f{i}" for i in range(1, len(BASELINE_FEATURES) + 1)))} AS oof_pred FROM x JOIN w USING (fold)""")
def m05_oof(spark, d):
    """2-fold out-of-fold ridge predictions (folds by key hash)."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "Board"]
    rows, stored = _model_rows(Tables(spark, d))
    oof = ML.out_of_fold_ridge(rows.select("session_id", *keys, "Pct_NS", *BASELINE_FEATURES), BASELINE_FEATURES, "Pct_NS", keys, stored=stored)
    return rounded(oof.select("session_id", "Board", "l_orderkey", "Pct_NS", "oof_pred"))


def _doc_frame(t: Tables) -> DataFrame:
    """All documents, with a label where there is one."""
    docs = t.documents.select("doc_id", "n_chars", "lang", "source")
    rows = docs.join(t.labels.select("doc_id", F.col("quality").cast("double").alias("label")), "doc_id", "left")
    return rows.withColumn("log_chars", F.log1p("n_chars")).withColumn("held_out", ML.fold_of(["doc_id"], k=5) == 0)


def _train(df: DataFrame) -> DataFrame:
    return df.where(F.col("label").isNotNull() & ~F.col("held_out"))


@register("m06_classifier")
def m06_classifier(spark, d):
    """Rows-only: logistic regression of document quality, fitted on labelled rows outside the held-out fold, scoring all documents."""
    df = _doc_frame(Tables(spark, d))
    model, _ = ML.fit_classifier(_train(df), ["log_chars"], ["lang", "source"], "label", "logistic")
    return rounded(ML.predictions(model, df, ["doc_id", "label", "held_out"]))


@register("m06_metrics")
def m06_metrics(spark, d):
    """Rows-only: metrics of that classifier on the rows it was fitted on and on the held-out ones."""
    df = _doc_frame(Tables(spark, d))
    model, _ = ML.fit_classifier(_train(df), ["log_chars"], ["lang", "source"], "label", "logistic")
    return rounded(ML.class_metrics(ML.predictions(model, df, ["label", "held_out"]), ["held_out"], "label", "prediction", "p_class"))


_PRICE = "l_extendedprice / 1000.0"


@register("m06_regressor", sql=f"""
WITH x AS (SELECT CAST(l_quantity AS DOUBLE) AS q, {_PRICE} AS y, {_fold_sql("l_orderkey", "l_linenumber", k=5)} = 0 AS held_out FROM lineitem),
m AS (SELECT regr_slope(y, q) AS b, regr_intercept(y, q) AS a FROM x WHERE NOT held_out AND q IS NOT NULL AND y IS NOT NULL),
p AS (SELECT held_out, y, a + b * q AS pred FROM x, m),
g AS (SELECT held_out, count(*) AS n, avg(abs(pred - y)) AS mae, sqrt(avg((pred - y) * (pred - y))) AS rmse, stddev_pop(y) AS std_y, stddev_pop(pred) AS std_pred,
  avg(y) AS mean_y, avg(pred) AS mean_pred FROM p WHERE y IS NOT NULL AND pred IS NOT NULL GROUP BY held_out)
SELECT held_out, n, {", ".join(f"{r(c)} AS {c}" for c in ("mae", "rmse", "std_y", "std_pred", "mean_y", "mean_pred"))}, {r("std_pred / nullif(std_y, 0)")} AS variance_ratio,
  CASE WHEN std_y = 0 THEN 'undefined' WHEN std_pred / std_y < 0.3 THEN 'severe_underfit' WHEN std_pred / std_y < 0.5 THEN 'moderate_underfit' WHEN std_pred / std_y > 1.2 THEN 'overfit' ELSE 'good' END AS verdict FROM g""")
def m06_regressor(spark, d):
    """Least squares of the price in thousands on the quantity, fitted outside the held-out fold; error and spread of either side."""
    x = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("q"), F.expr(_PRICE).cast("double").alias("y"))
    x = x.withColumn("held_out", ML.fold_of(["l_orderkey", "l_linenumber"], k=5) == 0)
    model, _ = ML.fit_regressor(x.where("NOT held_out AND q IS NOT NULL AND y IS NOT NULL"), ["q"], [], "y")
    p = model.transform(x.where("q IS NOT NULL")).select("held_out", "y", "prediction")
    sides = [R.regression_metrics(p.where(F.col("held_out") == side), "y", "prediction").where("n > 0").withColumn("held_out", F.lit(side)) for side in (False, True)]
    return rounded(sides[0].unionByName(sides[1]))


@register("m07_importance_classes")
def m07_importance_classes(spark, d):
    """Rows-only: forest importances for a label of many classes, the order's priority (as its index)."""
    o = Tables(spark, d).orders.select("o_custkey", F.col("o_totalprice").cast("double").alias("total"), F.month("o_orderdate").alias("month"), "o_orderstatus", "o_orderpriority")
    classes = ML.category_index(o, "o_orderpriority").select(F.col("category").alias("o_orderpriority"), F.col("idx").cast("double").alias("label"))
    model, feats = ML.fit_classifier(o.join(classes, "o_orderpriority"), ["total", "month"], ["o_orderstatus"], "label", "forest")
    return rounded(ML.importances(spark, model, feats))


@register("m07_importance")
def m07_importance(spark, d):
    """Rows-only: GBT feature importances for the same task."""
    df = _train(_doc_frame(Tables(spark, d)))
    model, feats = ML.fit_classifier(df, ["log_chars"], ["lang", "source"], "label", "gbt")
    return rounded(ML.importances(spark, model, feats))


@register("m08_scale", sql=f"""
SELECT 'scale' AS kind, 'p_size' AS name, {r('avg(p_size)')} AS a, {r('stddev_samp(p_size)')} AS b FROM part
UNION ALL SELECT 'scale', 'p_retailprice', {r('avg(p_retailprice)')}, {r('stddev_samp(p_retailprice)')} FROM part
UNION ALL SELECT 'index', p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE), CAST(count(*) AS DOUBLE)
  FROM part GROUP BY p_brand""")
def m08_scale(spark, d):
    p = Tables(spark, d).part
    sc = ML.scaling_params(p, ["p_size", "p_retailprice"]).select(
        F.lit("scale").alias("kind"), F.col("feature").alias("name"), F.col("mean").alias("a"), F.col("std").alias("b"))
    counts = p.groupBy("p_brand").agg(F.count(F.lit(1)).cast("double").alias("b"))
    idx = ML.category_index(p, "p_brand").join(counts, F.col("category") == F.col("p_brand")).select(
        F.lit("index").alias("kind"), F.col("category").alias("name"), F.col("idx").cast("double").alias("a"), "b")
    return rounded(sc.unionByName(idx))


@register("m10_leaderboard", sql=f"""
WITH t AS (SELECT p_partkey AS trial_id, p_brand, p_size, {r('sum(l_extendedprice)', 2)} AS metric
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
top AS (SELECT 'top' AS axis, NULL::VARCHAR AS axis_value, trial_id, metric FROM t ORDER BY metric DESC, trial_id LIMIT 10)
SELECT * FROM top
UNION ALL SELECT 'p_brand', p_brand, arg_max(trial_id, (metric, -trial_id)), max(metric) FROM t GROUP BY p_brand
UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), arg_max(trial_id, (metric, -trial_id)), max(metric) FROM t GROUP BY p_size""")
def m10_leaderboard(spark, d):
    t = Tables(spark, d)
    trials = (t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
              .groupBy(F.col("p_partkey").alias("trial_id"), "p_brand", "p_size")
              .agg(F.sum("l_extendedprice").alias("metric")))
    trials = rounded(trials, 2)
    return ML.leaderboard(trials, ["p_brand", "p_size"], "metric", "trial_id")


# --- C23: personalise a session ---------------------------------------------------------------

_PARTNER = {"N": "S", "S": "N", "E": "W", "W": "E"}


@register("c23_personal", sql=f"""
WITH s AS ({SEAT_ROWS_SQL}),
u AS (SELECT session_id, Board, Round, l_orderkey, 'N' AS Seat, Player_ID_N AS Player_ID, Player_ID_S AS Partner_ID FROM s UNION ALL
      SELECT session_id, Board, Round, l_orderkey, 'E', Player_ID_E, Player_ID_W FROM s UNION ALL
      SELECT session_id, Board, Round, l_orderkey, 'S', Player_ID_S, Player_ID_N FROM s UNION ALL
      SELECT session_id, Board, Round, l_orderkey, 'W', Player_ID_W, Player_ID_E FROM s),
v AS (SELECT u.*, CASE WHEN Board % 13 <> 0 THEN substr('NESW', CAST(Board % 4 + 1 AS INTEGER), 1) END AS Declarer,
        ['None','NS','EW','Both'][CAST(((Board % 16) + floor((Board % 16) / 4)) % 4 AS INTEGER) + 1] AS Vul,
        CASE WHEN Seat IN ('N', 'S') THEN 'NS' ELSE 'EW' END AS Pair_Direction FROM u WHERE Player_ID IS NOT NULL)
SELECT session_id, Board, Round, l_orderkey, Seat AS Player_Direction, Player_ID, Partner_ID,
  CASE Seat WHEN 'N' THEN 'S' WHEN 'S' THEN 'N' WHEN 'E' THEN 'W' ELSE 'E' END AS Partner_Direction, Pair_Direction,
  CASE WHEN Pair_Direction = 'NS' THEN 'EW' ELSE 'NS' END AS Opponent_Pair_Direction,
  Seat = 'N' AS is_N, Seat = 'E' AS is_E, Seat = 'S' AS is_S, Seat = 'W' AS is_W,
  Pair_Direction = 'NS' AS is_NS, Pair_Direction = 'EW' AS is_EW,
  coalesce(Declarer = Seat, FALSE) AS i_declared,
  coalesce(Declarer = CASE Seat WHEN 'N' THEN 'S' WHEN 'S' THEN 'N' WHEN 'E' THEN 'W' ELSE 'E' END, FALSE) AS partner_declared,
  coalesce(Declarer IS NOT NULL AND (CASE WHEN Declarer IN ('N', 'S') THEN 'NS' ELSE 'EW' END) <> Pair_Direction, FALSE) AS opponents_declared,
  Round = 7 AS is_passout, Vul = 'Both' OR Vul = Pair_Direction AS my_side_vul FROM v""")
def c23_personal(spark, d):
    s = seat_rows(Tables(spark, d))
    seats = {x: {"Player_ID": f"Player_ID_{x}", "Partner_ID": f"Player_ID_{_PARTNER[x]}"} for x in "NESW"}
    u = R.seat_stack(s, ["session_id", "Board", "Round", "l_orderkey"], seats, "Seat", "Player_ID")
    seat = F.col("Seat")
    partner = F.when(seat == "N", "S").when(seat == "S", "N").when(seat == "E", "W").otherwise("E")
    pair = F.when(seat.isin("N", "S"), "NS").otherwise("EW")
    declarer = F.when(F.col("Board") % 13 != 0, F.substring(F.lit("NESW"), (F.col("Board") % 4 + 1).cast("int"), 1))
    vul = H.vul_from_board(F.col("Board") % 16 + 1)
    decl_side = F.when(declarer.isin("N", "S"), "NS").otherwise("EW")
    return u.select(
        "session_id", "Board", "Round", "l_orderkey", seat.alias("Player_Direction"), "Player_ID", "Partner_ID",
        partner.alias("Partner_Direction"), pair.alias("Pair_Direction"),
        F.when(pair == "NS", "EW").otherwise("NS").alias("Opponent_Pair_Direction"),
        *[(seat == x).alias(f"is_{x}") for x in "NESW"],
        (pair == "NS").alias("is_NS"), (pair == "EW").alias("is_EW"),
        F.coalesce(declarer == seat, F.lit(False)).alias("i_declared"),
        F.coalesce(declarer == partner, F.lit(False)).alias("partner_declared"),
        F.coalesce(declarer.isNotNull() & (decl_side != pair), F.lit(False)).alias("opponents_declared"),
        (F.col("Round") == 7).alias("is_passout"),
        ((vul == "Both") | (vul == pair)).alias("my_side_vul"))


# --- C23 / F15: sections, pairs and boards of a player ----------------------------------------

_VIEW_SQL = f"""
WITH s AS ({SEAT_ROWS_SQL}),
b AS (SELECT s.*, CASE WHEN Board % 2 = 0 THEN 'A' ELSE 'B' END AS section_name, Round AS Pair_Number_NS, l_orderkey % 7 + 1 AS Pair_Number_EW,
        CASE WHEN Board % 13 <> 0 THEN substr('NESW', CAST(Board % 4 + 1 AS INTEGER), 1) END AS Declarer_Direction FROM s),
r AS (SELECT b.*, CASE Declarer_Direction WHEN 'N' THEN Player_ID_N WHEN 'E' THEN Player_ID_E WHEN 'S' THEN Player_ID_S WHEN 'W' THEN Player_ID_W END AS Declarer_ID FROM b),
w AS (SELECT session_id, min(Player_ID_E) AS p FROM r WHERE Player_ID_E IS NOT NULL GROUP BY session_id),
seated AS (SELECT session_id, section_name, Board, Round, l_orderkey, 0 AS rank, 'N' AS seat, Player_ID_N AS pid, Player_ID_S AS partner, Pair_Number_NS AS pair FROM r
  UNION ALL SELECT session_id, section_name, Board, Round, l_orderkey, 1, 'S', Player_ID_S, Player_ID_N, Pair_Number_NS FROM r
  UNION ALL SELECT session_id, section_name, Board, Round, l_orderkey, 2, 'E', Player_ID_E, Player_ID_W, Pair_Number_EW FROM r
  UNION ALL SELECT session_id, section_name, Board, Round, l_orderkey, 3, 'W', Player_ID_W, Player_ID_E, Pair_Number_EW FROM r),
me AS (SELECT * FROM (SELECT seated.*, row_number() OVER (PARTITION BY seated.session_id ORDER BY rank, Board, Round, l_orderkey) AS rn
       FROM seated JOIN w ON seated.session_id = w.session_id AND seated.pid = w.p) WHERE rn = 1),
v AS (SELECT r.*, me.pid, me.seat, me.partner, CASE WHEN me.seat IN ('N', 'S') THEN 'NS' ELSE 'EW' END AS side, r.section_name = me.section_name AS sec,
        coalesce(CASE WHEN me.seat IN ('N', 'S') THEN r.Pair_Number_NS ELSE r.Pair_Number_EW END = me.pair, FALSE) AS same_pair FROM r JOIN me ON r.session_id = me.session_id),
f AS (SELECT v.*, sec AND same_pair AS mine FROM v)
SELECT session_id, Board, Round, l_orderkey, CAST(pid AS VARCHAR) AS player_id, seat AS Player_Direction,
  CASE WHEN side = 'NS' THEN 'EW' ELSE 'NS' END AS Opponent_Pair_Direction, sec AS My_Section, sec AS Our_Section, mine AS My_Pair, mine AS Our_Pair,
  mine AS Boards_I_Played, mine AS Boards_We_Played, mine AS Our_Boards, mine AND coalesce(Declarer_ID = pid, FALSE) AS Boards_I_Declared,
  mine AND coalesce(Declarer_ID = partner, FALSE) AS Boards_Partner_Declared,
  mine AND coalesce((CASE WHEN Declarer_Direction IN ('N', 'S') THEN 'NS' ELSE 'EW' END) <> side AND Declarer_Direction IS NOT NULL, FALSE) AS Boards_Opponent_Declared,
  mine AND (coalesce(Declarer_ID = pid, FALSE) OR coalesce(Declarer_ID = partner, FALSE)) AS Boards_We_Declared FROM f"""


def _session_view(t: Tables) -> DataFrame:
    s = materialize(seat_rows(t).drop("Date"), "session-rows")  # read by the players, their seats and the view
    s = (s.withColumn("section_name", F.when(F.col("Board") % 2 == 0, "A").otherwise("B"))
         .withColumn("Pair_Number_NS", F.col("Round")).withColumn("Pair_Number_EW", F.col("l_orderkey") % 7 + 1)
         .withColumn("Declarer_Direction", F.when(F.col("Board") % 13 != 0, F.substring(F.lit("NESW"), (F.col("Board") % 4 + 1).cast("int"), 1))))
    declarer = F.coalesce(*[F.when(F.col("Declarer_Direction") == x, F.col(f"Player_ID_{x}")) for x in "NESW"])
    s = s.withColumn("Declarer_ID", declarer)
    wanted = s.groupBy("session_id").agg(F.min("Player_ID_E").alias("player_id")).where("player_id IS NOT NULL")
    out = PE.personalise(s, wanted, "session_id", ["Board", "Round", "l_orderkey"])
    return out.select("session_id", "Board", "Round", "l_orderkey", "player_id", "Player_Direction", "Opponent_Pair_Direction", *PE.FLAGS)


@register("c23_session", sql=_VIEW_SQL)
def c23_session(spark, d):
    """Each session seen by one of its players: section, pair and declarer flags."""
    return _session_view(Tables(spark, d))


@register("f15_only_my_boards", sql=f"SELECT * FROM ({_VIEW_SQL}) WHERE Boards_I_Played")
def f15_only_my_boards(spark, d):
    return PE.only_my_boards(_session_view(Tables(spark, d)))
