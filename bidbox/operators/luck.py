"""Session x pair luck-versus-skill report (A9 aggregate, C21 luck maths, W4 skill percentile).

actual / predicted are per-board percentages; the report compares a pair's session mean
against the model's, with a standard error from the board spread and the model's own sigma.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import average_rank, exact_quantiles

# fixed values: two-sided 95% normal quantile (CI and significance) and the minimum number of
# boards for a session-pair to enter the summary (fewer boards give no usable standard error)
Z95 = 1.96
MIN_BOARDS_FOR_REPORT = 4


def safe_ratio(num: Column, den: Column) -> Column:
    """IEEE division: x/0 is +-inf, 0/0 is NaN, null stays null (ANSI would raise)."""
    return (F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
            .when(den != 0, num / den)
            .when(num > 0, F.lit(float("inf")))
            .when(num < 0, F.lit(float("-inf")))
            .otherwise(F.lit(float("nan"))))


def session_pair_aggregate(df: DataFrame, group_keys: Sequence[str], actual: str, predicted: str,
                           sigma: str | None = None,
                           mp_cols: tuple[str, str] | None = None) -> DataFrame:
    """N, mean actual/predicted, sample std of both, mean model sigma, mean pair MP."""
    aggs = [
        F.count(F.lit(1)).alias("n_boards"),
        F.avg(actual).alias("actual_session_pct"),
        F.avg(predicted).alias("predicted_session_pct"),
        F.stddev_samp(actual).alias("actual_board_std"),
        F.stddev_samp(predicted).alias("pred_board_std"),
    ]
    if sigma:
        aggs.append(F.avg(sigma).alias("mean_board_pred_sigma"))
    if mp_cols:
        a, b = mp_cols
        aggs.append(F.avg((F.col(a) + F.col(b)) / F.lit(2.0)).alias("pair_mp_avg"))
    return df.groupBy(*group_keys).agg(*aggs)


def luck_columns(sp: DataFrame, has_sigma: bool) -> DataFrame:
    """luck_delta, sem, model sigma, total sigma, 95% CI, z, significance."""
    n = F.sqrt(F.col("n_boards").cast("double"))
    sp = (sp.withColumn("luck_delta", F.col("actual_session_pct") - F.col("predicted_session_pct"))
            .withColumn("sem", F.col("actual_board_std") / n))
    if has_sigma:
        sp = (sp.withColumn("model_sigma_session", F.col("mean_board_pred_sigma") / n)
                .withColumn("total_sigma", F.sqrt(F.pow("sem", 2) + F.pow("model_sigma_session", 2))))
    else:
        sp = (sp.withColumn("model_sigma_session", F.lit(None).cast("double"))
                .withColumn("total_sigma", F.col("sem")))
    z = safe_ratio(F.col("luck_delta"), F.col("total_sigma"))
    return (sp.withColumn("ci_lo", F.col("actual_session_pct") - Z95 * F.col("total_sigma"))
              .withColumn("ci_hi", F.col("actual_session_pct") + Z95 * F.col("total_sigma"))
              .withColumn("z_luck", z)
              .withColumn("is_lucky_significant", F.abs(F.col("z_luck")) > Z95))


def luck_report(df: DataFrame, group_keys: Sequence[str] = ("session_id", "Pair_Number_NS"),
                actual: str = "Pct_NS", predicted: str = "Pct_NS_Pred",
                sigma: str | None = "Pct_NS_Pred_std",
                mp_cols: tuple[str, str] | None = ("MasterPoints_N", "MasterPoints_S")) -> DataFrame:
    """Full per-session, per-pair report; skill_pct = average rank of pair_mp_avg / rows."""
    sp = session_pair_aggregate(df, group_keys, actual, predicted, sigma, mp_cols)
    sp = luck_columns(sp, has_sigma=sigma is not None)
    if mp_cols:
        # Ties are decided at 1e-9: a mean summed in another order may differ in the last ulp.
        sp = sp.withColumn("_mp_key", F.round(F.col("pair_mp_avg") * 1e9) / 1e9)
        sp = average_rank(sp, "_mp_key", "skill_pct", divide_by_count=True).drop("_mp_key")
    return sp


def report_summary(report: DataFrame, min_boards: int = MIN_BOARDS_FOR_REPORT) -> DataFrame:
    """One-row summary of reportable session-pairs (mean, sample std, p05/p95, shares).

    p05/p95 follow the reference's default quantile rule, *nearest* rank round(q*(n-1)),
    computed exactly by the distributed :func:`exact_quantiles` (no task gathers every value).
    """
    rep = report.where(F.col("n_boards") >= min_boards)
    qs = exact_quantiles(rep, "luck_delta", [0.05, 0.95], method="nearest")
    agg = rep.agg(
        F.count(F.lit(1)).alias("n_session_pairs_reportable"),
        F.avg("n_boards").alias("mean_n_boards"),
        F.avg("luck_delta").alias("mean_luck_delta"),
        F.stddev_samp("luck_delta").alias("std_luck_delta"),
        F.avg(F.col("is_lucky_significant").cast("double")).alias("pct_significantly_lucky"),
        F.avg("total_sigma").alias("mean_total_sigma"),
    )
    return agg.select("n_session_pairs_reportable", "mean_n_boards", "mean_luck_delta", "std_luck_delta",
                      F.lit(qs[0.05]).cast("double").alias("p05_luck_delta"),
                      F.lit(qs[0.95]).cast("double").alias("p95_luck_delta"),
                      "pct_significantly_lucky", "mean_total_sigma")
