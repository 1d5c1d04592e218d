"""Flagship: matchpoints -> session x pair aggregate -> luck maths -> skill percentile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.luck import luck_columns, luck_report, report_summary, session_pair_aggregate
from ..operators.ranking import average_rank, matchpoints
from .bindings import BOARD_ROWS_SQL, SCORED_ROWS_SQL, board_rows, scored_rows
from .registry import Tables, register
from .util import r, rounded

GROUP = ["session_id", "Pair_Number_NS"]


def flagship(spark, sf_dir):
    """Session x pair luck report, most lucky first (as the reference writes it)."""
    t = Tables(spark, sf_dir)
    return rounded(luck_report(scored_rows(t), GROUP)).orderBy(F.col("luck_delta").desc_nulls_last(),
                                                               *GROUP)


_SP_SQL = f"""
WITH s AS ({SCORED_ROWS_SQL})
SELECT session_id, Pair_Number_NS, count(*) AS n_boards,
       avg(Pct_NS) AS actual_session_pct, avg(Pct_NS_Pred) AS predicted_session_pct,
       stddev_samp(Pct_NS) AS actual_board_std, stddev_samp(Pct_NS_Pred) AS pred_board_std,
       avg(Pct_NS_Pred_std) AS mean_board_pred_sigma,
       avg((MasterPoints_N + MasterPoints_S) / 2.0) AS pair_mp_avg
FROM s GROUP BY session_id, Pair_Number_NS
"""

_LUCK_SQL = f"""
WITH sp AS ({_SP_SQL}),
l1 AS (SELECT sp.*, actual_session_pct - predicted_session_pct AS luck_delta,
              actual_board_std / sqrt(n_boards) AS sem,
              mean_board_pred_sigma / sqrt(n_boards) AS model_sigma_session FROM sp),
l2 AS (SELECT l1.*, sqrt(sem * sem + model_sigma_session * model_sigma_session) AS total_sigma FROM l1),
l3 AS (SELECT l2.*, actual_session_pct - 1.96 * total_sigma AS ci_lo,
              actual_session_pct + 1.96 * total_sigma AS ci_hi,
              CASE WHEN luck_delta IS NULL OR total_sigma IS NULL THEN NULL
                   WHEN total_sigma <> 0 THEN luck_delta / total_sigma
                   WHEN luck_delta > 0 THEN 'inf'::DOUBLE WHEN luck_delta < 0 THEN '-inf'::DOUBLE
                   ELSE 'nan'::DOUBLE END AS z_luck FROM l2),
l4 AS (SELECT l3.*, abs(z_luck) > 1.96 AS is_lucky_significant,
              CASE WHEN mp_key IS NOT NULL THEN
                (rank() OVER (ORDER BY mp_key ASC NULLS LAST)
                 + (count(*) OVER (PARTITION BY mp_key) - 1) / 2.0) / count(*) OVER () END AS skill_pct
       FROM (SELECT l3.*, ROUND(pair_mp_avg * 1e9) / 1e9 AS mp_key FROM l3) l3)
"""

_REPORT_COLS = ["session_id", "Pair_Number_NS", "n_boards"] + [f"{r(c)} AS {c}" for c in (
    "actual_session_pct", "predicted_session_pct", "actual_board_std", "pred_board_std",
    "mean_board_pred_sigma", "pair_mp_avg", "luck_delta", "sem", "model_sigma_session",
    "total_sigma", "ci_lo", "ci_hi", "z_luck")] + ["is_lucky_significant", f"{r('skill_pct')} AS skill_pct"]


register("c21_luck", sql=_LUCK_SQL + f"SELECT {', '.join(_REPORT_COLS)} FROM l4")(flagship)


@register("w07_matchpoints", sql=f"""
WITH s AS ({SCORED_ROWS_SQL})
SELECT session_id, Board, Pair_Number_NS, Score_NS, {r('MP_NS')} AS MP_NS, MP_Top, {r('Pct_NS')} AS Pct_NS
FROM s""")
def w07_matchpoints(spark, sf_dir):
    rows = board_rows(Tables(spark, sf_dir))
    mp = matchpoints(rows, ["Board"], "Score_NS", "MP_NS", "MP_Top", "Pct_NS")
    return rounded(mp.select("session_id", "Board", "Pair_Number_NS", "Score_NS", "MP_NS", "MP_Top", "Pct_NS"))


@register("a09_session_pair", sql=f"""
WITH sp AS ({_SP_SQL})
SELECT session_id, Pair_Number_NS, n_boards, {r('actual_session_pct')} AS actual_session_pct,
  {r('predicted_session_pct')} AS predicted_session_pct, {r('actual_board_std')} AS actual_board_std,
  {r('pred_board_std')} AS pred_board_std, {r('mean_board_pred_sigma')} AS mean_board_pred_sigma,
  {r('pair_mp_avg')} AS pair_mp_avg FROM sp""")
def a09_session_pair(spark, sf_dir):
    s = scored_rows(Tables(spark, sf_dir))
    return rounded(session_pair_aggregate(s, GROUP, "Pct_NS", "Pct_NS_Pred", "Pct_NS_Pred_std",
                                          ("MasterPoints_N", "MasterPoints_S")))


@register("w04_rank_pct", sql=f"""
WITH br AS ({BOARD_ROWS_SQL})
SELECT session_id, Board, Pair_Number_NS, Pred_Score_NS,
  {r("CASE WHEN Pred_Score_NS IS NOT NULL THEN (rank() OVER (ORDER BY Pred_Score_NS ASC NULLS LAST) + (count(*) OVER (PARTITION BY Pred_Score_NS) - 1) / 2.0) / count(*) OVER () END")} AS rank_pct
FROM br""")
def w04_rank_pct(spark, sf_dir):
    """Global average-tie rank / row count of the quantity column (heavy ties: 50 values)."""
    br = board_rows(Tables(spark, sf_dir)).select("session_id", "Board", "Pair_Number_NS", "Pred_Score_NS")
    return rounded(average_rank(br, "Pred_Score_NS", "rank_pct", divide_by_count=True, stored=True))


@register("a19_report", sql=_LUCK_SQL + f"""
SELECT count(*) AS n_session_pairs_reportable, {r('avg(n_boards)')} AS mean_n_boards,
  {r('avg(luck_delta)')} AS mean_luck_delta, {r('stddev_samp(luck_delta)')} AS std_luck_delta,
  {r("list_sort(list(luck_delta) FILTER (WHERE luck_delta IS NOT NULL))[CAST(round(0.05 * (count(luck_delta) - 1)) AS BIGINT) + 1]")} AS p05_luck_delta,
  {r("list_sort(list(luck_delta) FILTER (WHERE luck_delta IS NOT NULL))[CAST(round(0.95 * (count(luck_delta) - 1)) AS BIGINT) + 1]")} AS p95_luck_delta,
  {r('avg(CAST(is_lucky_significant AS DOUBLE))')} AS pct_significantly_lucky,
  {r('avg(total_sigma)')} AS mean_total_sigma
FROM l4 WHERE n_boards >= 4""")
def a19_report(spark, sf_dir):
    rep = luck_columns(session_pair_aggregate(scored_rows(Tables(spark, sf_dir)), GROUP, "Pct_NS",
                                              "Pct_NS_Pred", "Pct_NS_Pred_std",
                                              ("MasterPoints_N", "MasterPoints_S")), True)
    return rounded(report_summary(rep))
