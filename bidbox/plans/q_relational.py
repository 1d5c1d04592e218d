"""Aggregates (A*), windows (W*), ordering (O*) and reshaping (U*) bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from .bindings import SCORED_ROWS_SQL, SEAT_ROWS_SQL, scored_rows, seat_rows
from .registry import Tables, register
from .util import r, rounded


# --- A: aggregates -----------------------------------------------------------------

@register("a01_counts", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem
GROUP BY l_returnflag, l_linestatus ORDER BY count DESC""")
def a01_counts(spark, d):
    t = Tables(spark, d)
    return R.value_counts(t.lineitem, ["l_returnflag", "l_linestatus"]).orderBy(F.col("count").desc())


@register("a02_nunique", sql=f"""
WITH s AS ({SEAT_ROWS_SQL})
SELECT Board, count(DISTINCT Player_ID_W) + max(CASE WHEN Player_ID_W IS NULL THEN 1 ELSE 0 END) AS n_unique_w,
       count(DISTINCT Player_ID_W) + max(CASE WHEN Player_ID_W IS NULL THEN 1 ELSE 0 END) = 1 AS is_constant
FROM s GROUP BY Board""")
def a02_nunique(spark, d):
    s = seat_rows(Tables(spark, d))
    return (s.groupBy("Board").agg(R.n_unique("Player_ID_W").alias("n_unique_w"))
             .withColumn("is_constant", F.col("n_unique_w") == 1))


@register("a03_first_last", sql="""
SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority,
       arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS last_priority
FROM orders GROUP BY o_custkey""")
def a03_first_last(spark, d):
    t = Tables(spark, d)
    return R.first_last(t.orders, ["o_custkey"], "o_orderpriority", ["o_orderdate", "o_orderkey"],
                        "first_priority", "last_priority")


@register("a04_latest", sql="""
SELECT user_id, arg_max(value, (ts, event_id)) AS value, arg_max(event_type, (ts, event_id)) AS event_type
FROM events GROUP BY user_id""")
def a04_latest(spark, d):
    return R.latest_value(Tables(spark, d).events, ["user_id"], ["value", "event_type"], ["ts", "event_id"])


_STD_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a06_pop_std", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r(f'stddev_pop({c})')} AS std FROM lineitem WHERE NOT isnan({c})"
    for c in _STD_COLS))
def a06_pop_std(spark, d):
    return rounded(R.pop_std_columns(Tables(spark, d).lineitem, _STD_COLS))


@register("a07_bounds", sql="""
SELECT CAST(min(o_orderdate) AS DATE) AS date_min, CAST(max(o_orderdate) AS DATE) AS date_max FROM orders""")
def a07_bounds(spark, d):
    o = Tables(spark, d).orders.select(F.to_date("o_orderdate").alias("Date"))
    return R.bounds(o, "Date", "date_")


_SPLIT_SQL = "CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END"


@register("a08_split_summary", sql=f"""
WITH s AS (SELECT {_SPLIT_SQL} AS split, CAST(o_orderdate AS DATE) AS Date FROM orders),
p AS (SELECT split, count(*) AS rows, min(Date) AS date_min, max(Date) AS date_max FROM s GROUP BY split)
SELECT split, rows, date_min, date_max, {r('rows / sum(rows) OVER ()')} AS pct FROM p""")
def a08_split_summary(spark, d):
    o = Tables(spark, d).orders
    s = o.select(F.when(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"), "train")
                 .otherwise("test").alias("split"), F.to_date("o_orderdate").alias("Date"))
    return rounded(R.split_summary(s, "split", "Date"))


@register("a10_directory", sql="""
SELECT c_nationkey AS club_id, arg_max(c_name, c_custkey) AS last_name, count(*) AS n_players
FROM customer GROUP BY c_nationkey ORDER BY club_id""")
def a10_directory(spark, d):
    c = Tables(spark, d).customer
    return (c.groupBy(F.col("c_nationkey").alias("club_id"))
             .agg(F.max_by("c_name", "c_custkey").alias("last_name"), F.count(F.lit(1)).alias("n_players"))
             .orderBy("club_id"))


@register("a11_cond_mean", sql=f"""
WITH s AS ({SCORED_ROWS_SQL})
SELECT session_id, {r("avg(CASE WHEN Pair_Number_NS % 2 = 1 THEN Pct_NS ELSE 1 - Pct_NS END)")} AS score, count(*) AS n
FROM s GROUP BY session_id""")
def a11_cond_mean(spark, d):
    s = scored_rows(Tables(spark, d)).withColumn("Pct_EW", 1 - F.col("Pct_NS"))
    return rounded(R.conditional_mean(s, ["session_id"], F.col("Pair_Number_NS") % 2 == 1,
                                      "Pct_NS", "Pct_EW", "score"))


@register("a12_dup_keys", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1 ORDER BY count DESC, l_orderkey, l_linenumber LIMIT 5""")
def a12_dup_keys(spark, d):
    dup = R.duplicate_keys(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])
    return R.top_k(dup, [F.col("count").desc(), F.col("l_orderkey"), F.col("l_linenumber")], 5)


@register("a13_dup_totals", sql="""
WITH p AS (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT sum(c) AS rows, count(*) AS unique_keys, coalesce(sum(CASE WHEN c > 1 THEN c END), 0) AS duplicated_rows FROM p""")
def a13_dup_totals(spark, d):
    return R.duplicate_totals(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


@register("a14_nulls", sql=f"""
WITH s AS ({SEAT_ROWS_SQL}), w AS (
SELECT sum(CASE WHEN Player_ID_N IS NULL THEN 1 ELSE 0 END) AS Player_ID_N,
       sum(CASE WHEN Player_ID_E IS NULL THEN 1 ELSE 0 END) AS Player_ID_E,
       sum(CASE WHEN Player_ID_S IS NULL THEN 1 ELSE 0 END) AS Player_ID_S,
       sum(CASE WHEN Player_ID_W IS NULL THEN 1 ELSE 0 END) AS Player_ID_W,
       sum(CASE WHEN Date IS NULL THEN 1 ELSE 0 END) AS Date FROM s)
SELECT "column", CAST(null_count AS BIGINT) AS null_count FROM (UNPIVOT w ON COLUMNS(*) INTO NAME "column" VALUE null_count)
WHERE null_count > 0""")
def a14_nulls(spark, d):
    s = seat_rows(Tables(spark, d))
    return R.null_counts(s, ["Player_ID_N", "Player_ID_E", "Player_ID_S", "Player_ID_W", "Date"])


@register("a15_bins", sql=f"""
WITH b AS (SELECT l_returnflag, CAST(l_quantity AS INTEGER) % 14 AS tricks FROM lineitem),
c AS (SELECT l_returnflag, tricks, count(*) AS n FROM b GROUP BY ALL),
g AS (SELECT l_returnflag, sum(n) AS total FROM c GROUP BY ALL),
grid AS (SELECT l_returnflag, total, unnest(range(0, 14)) AS tricks FROM g)
SELECT grid.l_returnflag, CAST(grid.tricks AS INTEGER) AS tricks, {r('coalesce(n, 0) / total')} AS p
FROM grid LEFT JOIN c ON grid.l_returnflag = c.l_returnflag AND grid.tricks = c.tricks""")
def a15_bins(spark, d):
    li = Tables(spark, d).lineitem.select("l_returnflag",
                                          (F.col("l_quantity").cast("int") % 14).alias("tricks"))
    return rounded(R.bin_distribution(li, ["l_returnflag"], "tricks"))


@register("a16_class_weights", sql=f"""
WITH c AS (SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY ALL)
SELECT o_orderpriority, count, {r('(1.0 / greatest(count, 1)) / avg(1.0 / greatest(count, 1)) OVER ()')} AS weight FROM c""")
def a16_class_weights(spark, d):
    return rounded(R.class_weights(Tables(spark, d).orders, "o_orderpriority", "inverse"))


@register("a17_reg_metrics", sql=f"""
WITH s AS ({SCORED_ROWS_SQL}), f AS (SELECT * FROM s WHERE Pct_NS IS NOT NULL AND Pct_NS_Pred IS NOT NULL
  AND NOT isnan(Pct_NS) AND NOT isnan(Pct_NS_Pred)),
m AS (SELECT count(*) AS n, avg(abs(Pct_NS_Pred - Pct_NS)) AS mae,
  sqrt(avg((Pct_NS_Pred - Pct_NS) * (Pct_NS_Pred - Pct_NS))) AS rmse, stddev_pop(Pct_NS) AS std_y,
  stddev_pop(Pct_NS_Pred) AS std_pred, avg(Pct_NS) AS mean_y, avg(Pct_NS_Pred) AS mean_pred FROM f),
v AS (SELECT m.*, CASE WHEN std_y <> 0 THEN std_pred / std_y END AS variance_ratio FROM m)
SELECT n, {r('mae')} AS mae, {r('rmse')} AS rmse, {r('std_y')} AS std_y, {r('std_pred')} AS std_pred,
  {r('mean_y')} AS mean_y, {r('mean_pred')} AS mean_pred, {r('variance_ratio')} AS variance_ratio,
  CASE WHEN variance_ratio IS NULL THEN 'undefined' WHEN variance_ratio < 0.3 THEN 'severe_underfit'
       WHEN variance_ratio < 0.5 THEN 'moderate_underfit' WHEN variance_ratio > 1.2 THEN 'overfit'
       ELSE 'good' END AS verdict FROM v""")
def a17_reg_metrics(spark, d):
    return rounded(R.regression_metrics(scored_rows(Tables(spark, d)), "Pct_NS", "Pct_NS_Pred"))


_A18_PRED = "CASE WHEN l_discount >= 0.05 THEN 'R' WHEN l_tax >= 0.04 THEN 'A' ELSE 'N' END"


@register("a18_accuracy", sql=f"""
WITH x AS (SELECT l_returnflag AS y, {_A18_PRED} AS pred FROM lineitem),
t AS (SELECT y AS cls, count(*) AS support FROM x GROUP BY ALL),
p AS (SELECT pred AS cls, count(*) AS predicted FROM x GROUP BY ALL),
tp AS (SELECT y AS cls, count(*) AS tp FROM x WHERE y = pred GROUP BY ALL),
c AS (SELECT coalesce(t.cls, p.cls) AS cls, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted
      FROM t FULL JOIN p ON t.cls = p.cls),
c2 AS (SELECT c.*, coalesce(tp.tp, 0) AS tp FROM c LEFT JOIN tp ON c.cls = tp.cls),
f AS (SELECT c2.*, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS prec,
        CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM c2),
g AS (SELECT sum(tp) / sum(support) AS accuracy,
        avg(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) AS macro_f1,
        max(support) / sum(support) AS majority_share FROM f)
SELECT {r('accuracy')} AS accuracy, {r('macro_f1')} AS macro_f1, {r('majority_share')} AS majority_share,
       {r('accuracy - majority_share')} AS lift FROM g""")
def a18_accuracy(spark, d):
    li = Tables(spark, d).lineitem.select(
        F.col("l_returnflag").alias("y"),
        F.when(F.col("l_discount") >= 0.05, "R").when(F.col("l_tax") >= 0.04, "A").otherwise("N").alias("pred"))
    return rounded(R.classification_metrics(li, "y", "pred"))


@register("a20_oob", sql=f"""
WITH s AS ({SCORED_ROWS_SQL})
SELECT 'Pct_NS' AS "column", sum(CASE WHEN Pct_NS < 0 OR Pct_NS > 1 THEN 1 ELSE 0 END) AS out_of_range FROM s
UNION ALL SELECT 'Pct_NS_Pred', sum(CASE WHEN Pct_NS_Pred < 0 OR Pct_NS_Pred > 1 THEN 1 ELSE 0 END) FROM s
UNION ALL SELECT 'discount_x20', sum(CASE WHEN Pct_NS_Pred_std * 20 < 0 OR Pct_NS_Pred_std * 20 > 1 THEN 1 ELSE 0 END) FROM s""")
def a20_oob(spark, d):
    s = scored_rows(Tables(spark, d)).withColumn("discount_x20", F.col("Pct_NS_Pred_std") * 20)
    return R.out_of_range_counts(s, ["Pct_NS", "Pct_NS_Pred", "discount_x20"])


@register("a21_years", sql="""
SELECT DISTINCT year(l_shipdate) AS year FROM lineitem WHERE l_shipdate IS NOT NULL ORDER BY year""")
def a21_years(spark, d):
    li = Tables(spark, d).lineitem
    return li.select(F.year("l_shipdate").alias("year")).where(F.col("year").isNotNull()).distinct().orderBy("year")


@register("a22_overlap", sql="""
WITH k AS (SELECT DISTINCT o_custkey FROM orders), cache AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
SELECT (SELECT count(*) FROM k) AS unique_keys,
       (SELECT count(*) FROM k WHERE o_custkey IN (SELECT c_custkey FROM cache)) AS in_cache,
       (SELECT count(*) FROM k WHERE o_custkey NOT IN (SELECT c_custkey FROM cache)) AS novel""")
def a22_overlap(spark, d):
    t = Tables(spark, d)
    keys = t.orders.select("o_custkey").distinct()
    cache = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    tagged = keys.join(cache.withColumn("_hit", F.lit(1)), "o_custkey", "left")
    return tagged.agg(F.count(F.lit(1)).alias("unique_keys"),
                      F.count("_hit").alias("in_cache"),
                      F.count_if(F.col("_hit").isNull()).alias("novel"))


def _nearest_sql(col: str, q: float, table_filter: str = "") -> str:
    return (f"list_sort(list({col}) FILTER (WHERE {col} IS NOT NULL))"
            f"[CAST(round({q} * (count({col}) - 1)) AS BIGINT) + 1]")


@register("a23_describe", sql=f"""
SELECT count(o_totalprice) AS count, count(*) - count(o_totalprice) AS null_count, {r('avg(o_totalprice)')} AS mean,
  {r('stddev_samp(o_totalprice)')} AS std, {r('min(o_totalprice)')} AS min,
  {r(_nearest_sql('o_totalprice', 0.25))} AS p25, {r(_nearest_sql('o_totalprice', 0.5))} AS p50,
  {r(_nearest_sql('o_totalprice', 0.75))} AS p75, {r('max(o_totalprice)')} AS max FROM orders""")
def a23_describe(spark, d):
    """Describe a numeric target like Polars ``describe``: quartiles use the nearest rank."""
    from ..operators.ranking import exact_quantiles
    o = Tables(spark, d).orders
    qs = exact_quantiles(o, "o_totalprice", [0.25, 0.5, 0.75], method="nearest")
    agg = o.agg(F.count("o_totalprice").alias("count"),
                (F.count(F.lit(1)) - F.count("o_totalprice")).alias("null_count"),
                F.avg("o_totalprice").alias("mean"), F.stddev_samp("o_totalprice").alias("std"),
                F.min("o_totalprice").alias("min"), F.max("o_totalprice").alias("max"))
    return rounded(agg.select("count", "null_count", "mean", "std", "min",
                              *[F.lit(qs[q]).cast("double").alias(f"p{int(q * 100)}") for q in (0.25, 0.5, 0.75)],
                              "max"))


@register("a25_confusion", sql="""
SELECT substr(p_type, 1, 2) AS y_coarse, substr(p_name, 1, 2) AS pred_coarse, count(*) AS n
FROM part GROUP BY ALL""")
def a25_confusion(spark, d):
    p = Tables(spark, d).part
    return (p.groupBy(F.substring("p_type", 1, 2).alias("y_coarse"),
                      F.substring("p_name", 1, 2).alias("pred_coarse"))
             .agg(F.count(F.lit(1)).alias("n")))


@register("a26_status_tally", sql="""
SELECT count(*) AS total, count_if(o_orderstatus = 'F') AS F, count_if(o_orderstatus = 'O') AS O,
       count_if(o_orderstatus = 'P') AS P FROM orders""")
def a26_status_tally(spark, d):
    return R.status_tally(Tables(spark, d).orders, "o_orderstatus", ["F", "O", "P"])


# --- W: windows --------------------------------------------------------------------

@register("w01_experience", sql="""
SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS Elo_N FROM events""")
def w01_experience(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", "ts")
    return R.experience_count(e, ["user_id"], ["ts", "event_id"], "Elo_N", skew_safe=True).drop("ts")


@register("w02_keep_first", sql="""
SELECT event_id, user_id, CAST(ts AS DATE) AS day, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) = 1""")
def w02_keep_first(spark, d):
    e = Tables(spark, d).events.select("event_id", "user_id", F.to_date("ts").alias("day"), "value", "ts")
    return R.keep_first(e, ["user_id", "day"], ["ts", "event_id"]).drop("ts")


@register("w03_keep_last", sql="""
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""")
def w03_keep_last(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return R.keep_first(o, ["o_custkey"], ["o_orderkey"], descending=True)


@register("w05_is_dup", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_duplicated
FROM lineitem""")
def w05_is_dup(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return R.is_duplicated(li, ["l_orderkey", "l_linenumber"])


@register("w06_row_index", sql="""
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx
FROM orders""")
def w06_row_index(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return R.row_index(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], skew_safe=True).drop("o_orderdate")


# --- O: ordering -------------------------------------------------------------------

@register("o01_sort", sql="SELECT o_orderkey, o_orderdate, o_custkey FROM orders ORDER BY o_orderdate, o_custkey, o_orderkey")
def o01_sort(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate", "o_custkey")
    return R.sort_present(o, ["o_orderdate", "o_custkey", "Round", "o_orderkey"])


@register("o02_topk", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def o02_topk(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return R.top_k(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@register("o03_capped", sql="""
WITH t AS (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 201),
n AS (SELECT t.*, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn, count(*) OVER () AS c FROM t)
SELECT o_orderkey, o_totalprice, c > 200 AS truncated FROM n WHERE rn <= 200""")
def o03_capped(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return R.capped(o, [F.col("o_totalprice").desc(), F.col("o_orderkey")], limit=None)


@register("o04_tail", sql="""
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100""")
def o04_tail(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return R.top_k(o, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 100)


@register("o05_head", sql="""
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100""")
def o05_head(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return R.top_k(o, [F.col("o_orderdate"), F.col("o_orderkey")], 100)


@register("o06_sample", sql="""
SELECT * FROM lineitem ORDER BY md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, '42')), l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100000""")
def o06_sample(spark, d):
    """Deterministic sample of 100,000 rows, or all rows when fewer (the limit is the feature)."""
    li = Tables(spark, d).lineitem
    return R.sample_rows(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 100_000)


_O7_ID = "CASE WHEN o_orderkey % 7 = 0 THEN 'X' || CAST(o_orderkey AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END"


@register("o07_numeric_sort", sql=f"""
SELECT {_O7_ID} AS id FROM orders ORDER BY TRY_CAST(id AS BIGINT) DESC NULLS LAST, id""")
def o07_numeric_sort(spark, d):
    o = Tables(spark, d).orders
    ids = o.select(F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("X"), F.col("o_orderkey").cast("string")))
                   .otherwise(F.col("o_orderkey").cast("string")).alias("id"))
    return ids.orderBy(R.numeric_desc("id"), "id")


@register("o07_date_sort", sql="""
WITH a AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
  WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') WHEN 3 THEN strftime(o_orderdate, '%Y%m%d%H:%M') ELSE 'n/a' END AS date_text FROM orders)
SELECT o_orderkey, date_text FROM a ORDER BY coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%m/%d/%Y'),
  try_strptime(date_text, '%Y%m%d'), try_strptime(date_text, '%Y%m%d%H:%M')) DESC NULLS LAST, date_text, o_orderkey""")
def o07_date_sort(spark, d):
    """Game dates in mixed formats, newest first (unparsable text sorts last)."""
    from .q_scalar import date_text
    o = Tables(spark, d).orders.select("o_orderkey", date_text().alias("date_text"))
    return o.orderBy(*R.date_desc("date_text"), "o_orderkey")


# --- U: reshaping ------------------------------------------------------------------

_SEATS = {s: {"Player_ID": f"Player_ID_{s}"} for s in "NESW"}


@register("u01_stack", sql=f"""
WITH s AS ({SEAT_ROWS_SQL})
SELECT session_id, Board, Round, Date, Seat, Player_ID FROM (
  SELECT session_id, Board, Round, Date, 'N' AS Seat, Player_ID_N AS Player_ID FROM s UNION ALL
  SELECT session_id, Board, Round, Date, 'E', Player_ID_E FROM s UNION ALL
  SELECT session_id, Board, Round, Date, 'S', Player_ID_S FROM s UNION ALL
  SELECT session_id, Board, Round, Date, 'W', Player_ID_W FROM s) WHERE Player_ID IS NOT NULL""")
def u01_stack(spark, d):
    s = seat_rows(Tables(spark, d))
    return R.seat_stack(s, ["session_id", "Board", "Round", "Date"], _SEATS, "Seat", "Player_ID")


@register("u02_pair_stack", sql=f"""
WITH s AS ({SEAT_ROWS_SQL})
SELECT session_id, Board, Round, 'NS' AS Pair_Direction,
       CAST(least(Player_ID_N, Player_ID_S) AS VARCHAR) || '-' || CAST(greatest(Player_ID_N, Player_ID_S) AS VARCHAR) AS Pair_IDs
FROM s WHERE Player_ID_N IS NOT NULL AND Player_ID_S IS NOT NULL
UNION ALL
SELECT session_id, Board, Round, 'EW',
       CAST(least(Player_ID_E, Player_ID_W) AS VARCHAR) || '-' || CAST(greatest(Player_ID_E, Player_ID_W) AS VARCHAR)
FROM s WHERE Player_ID_E IS NOT NULL AND Player_ID_W IS NOT NULL""")
def u02_pair_stack(spark, d):
    from ..functions.keys import numeric_pair_id
    s = seat_rows(Tables(spark, d))
    s = (s.withColumn("NS", numeric_pair_id("Player_ID_N", "Player_ID_S", null_mode="null"))
          .withColumn("EW", numeric_pair_id("Player_ID_E", "Player_ID_W", null_mode="null")))
    pairs = {"NS": {"Pair_IDs": "NS"}, "EW": {"Pair_IDs": "EW"}}
    return R.seat_stack(s, ["session_id", "Board", "Round"], pairs, "Pair_Direction", "Pair_IDs")


@register("u03_widen", sql="""
SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS k FROM customer
UNION ALL SELECT s_suppkey, s_acctbal FROM supplier""")
def u03_widen(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("k"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("k"))
    return R.union_widen(a, b)


@register("u04_diagonal", sql="""
SELECT c_custkey AS id, c_name AS name, NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier""")
def u04_diagonal(spark, d):
    t = Tables(spark, d)
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return R.union_diagonal([a, b])


@register("u05_colsets", sql="""
SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem""")
def u05_colsets(spark, d):
    """Columns of lineitem that are neither in orders nor numeric, used to project distinct rows."""
    t = Tables(spark, d)
    li, o = t.lineitem, t.orders
    shared = set(li.columns) & set(o.columns)
    only_li = [c for c in li.columns if c not in shared]
    strings = [f.name for f in li.schema.fields if f.dataType.simpleString() == "string"]
    keep = [c for c in only_li if c in strings]
    return li.select(*keep).distinct()


@register("u06_intersect", sql="""
SELECT o_custkey AS custkey FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0""")
def u06_intersect(spark, d):
    t = Tables(spark, d)
    a = t.orders.select(F.col("o_custkey").alias("custkey"))
    b = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("custkey"))
    return a.intersect(b)


@register("u07_distinct", sql="SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def u07_distinct(spark, d):
    return Tables(spark, d).lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@register("u08_sequence", sql="""
SELECT DISTINCT CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey % 10 AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS id
FROM (SELECT o_custkey, o_orderkey, unnest(range(1, CAST(o_orderkey % 3 + 2 AS BIGINT))) AS i FROM orders)""")
def u08_sequence(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", (F.col("o_orderkey") % 10).alias("event"),
                                       (F.col("o_orderkey") % 3 + 1).alias("n_sessions"))
    return R.sequence_ids(o, ["o_custkey", "event"], "n_sessions")
