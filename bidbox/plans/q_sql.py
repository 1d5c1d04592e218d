"""SQL surface (Q1-Q7): ad-hoc SELECTs through the guarded runner, a pandas UDF, named API queries."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import contract as CT
from ..operators import joins as J
from ..operators import relational as R
from ..operators import sql_surface as Q
from .bindings import SEAT_ROWS_SQL, SCORED_ROWS_SQL, scored_rows, seat_rows
from .q_scalar import LEAD_SQL, lead_text
from .registry import TABLES, Tables, register
from .util import r, rounded


def _tables(spark, d, names=TABLES) -> dict[str, DataFrame]:
    t = Tables(spark, d)
    return {n: getattr(t, n) for n in names}


def _mentioned(sql: str) -> list[str]:
    """The test tables a SQL text refers to (only those are registered as views)."""
    import re
    return [t for t in TABLES if re.search(rf"\b{t}\b", sql)]


def _same(sql: str):
    """Register a query whose Spark SQL text runs unchanged in DuckDB (the oracle is the same text)."""
    def deco(name: str):
        def fn(spark, d):
            return Q.session_sql(spark, _tables(spark, d, _mentioned(sql)), sql)
        fn.__name__ = name
        return register(name, sql=sql)(fn)
    return deco


@register("q01_session_sql", sql="""
SELECT c_mktsegment, o_orderpriority, count(*) AS n, FALSE AS truncated FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment, o_orderpriority""")
def q01_session_sql(spark, d):
    return Q.session_sql(spark, _tables(spark, d, ["orders", "customer"]),
                         """SELECT c_mktsegment, o_orderpriority, count(*) AS n FROM orders
                            JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderpriority""",
                         limit=200)


@register("q02_macro_sql", sql=f"""
SELECT session_id, Player_ID_N AS player, count(*) AS boards FROM ({SEAT_ROWS_SQL}) WHERE Round >= 2
GROUP BY session_id, Player_ID_N""")
def q02_macro_sql(spark, d):
    s = seat_rows(Tables(spark, d))
    return Q.self_sql(spark, s, "SELECT session_id, {Player_Direction} AS player, count(*) AS boards "
                                "WHERE Round >= :min_round GROUP BY session_id, {Player_Direction}",
                      macros={"Player_Direction": "Player_ID_N"}, args={"min_round": 2})


@register("q03_guard", sql="SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def q03_guard(spark, d):
    """The guarded runner accepts this query (comments and a trailing ';' allowed)."""
    return Q.session_sql(spark, _tables(spark, d, ["orders"]),
                         "-- status counts\nSELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus;")


#: Statements that look like what the guard refuses, and are queries all the same.
_PROBES = {
    "comment marks in literals": "SELECT o_orderstatus AS a, 'p/*q*/r; a--b' AS b, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "names of commands": "SELECT load AS a, drop_ AS b, count(*) AS n FROM (SELECT o_orderpriority AS load, o_orderstatus AS drop_ FROM orders) x GROUP BY load, drop_",
    "a CTE of a table's name": "WITH customer AS (SELECT o_custkey AS k, o_orderstatus AS s FROM orders) SELECT s AS a, 'INSERT INTO' AS b, count(DISTINCT k) AS n FROM customer GROUP BY s",
    "a correlated subquery": "SELECT o_orderstatus AS a, NULL AS b, count(*) AS n FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0) GROUP BY o_orderstatus",
}


@register("q03_probes", sql=" UNION ALL ".join("SELECT '" + name.replace("'", "''") + f"' AS probe, a, b, n FROM ({q})" for name, q in _PROBES.items()))
def q03_probes(spark, d):
    """Each statement through the guarded runner; tests hold those that it refuses."""
    tables = _tables(spark, d, ["orders", "customer"])
    parts = [Q.session_sql(spark, tables, q).select(F.lit(name).alias("probe"), "a", F.col("b").cast("string").alias("b"), "n") for name, q in _PROBES.items()]
    return reduce(DataFrame.unionByName, parts)


_same("""
(SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'
 INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION
(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' EXCEPT SELECT o_custkey FROM orders)""")("q04a_setops")

_same(f"""
SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g_flag, grouping(l_linestatus) AS g_status,
  count(*) AS n, {r('sum(l_quantity)')} AS qty
FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""")("q04b_grouping_sets")

_same("""
SELECT n_name, c_mktsegment, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY ROLLUP (n_name, c_mktsegment)""")("q04c_rollup")

_same(f"""
SELECT o_orderstatus, o_orderpriority, count(*) AS n, {r('sum(o_totalprice)', 2)} AS total
FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")("q04d_cube")

_same("""
SELECT o_orderkey, o_custkey,
  rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rnk,
  dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS drnk,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
FROM orders""")("q04e_rank_windows")

_same(f"""
SELECT o_orderkey, o_custkey,
  {r('avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)')} AS moving_avg,
  {r('sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 2)} AS running_total,
  count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS neighbours
FROM orders""")("q04f_frame_windows")

_same(f"""
WITH per_cust AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS spend FROM orders GROUP BY o_custkey),
per_nation AS (SELECT c_nationkey, sum(n_orders) AS n_orders, {r('sum(spend)', 2)} AS spend
               FROM per_cust JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)
SELECT n_name, n_orders, spend FROM per_nation JOIN nation ON c_nationkey = n_nationkey""")("q04g_cte")

_same("""
SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE o.o_totalprice > (SELECT avg(o2.o_totalprice) FROM orders o2 WHERE o2.o_custkey = o.o_custkey)
  AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""")("q04h_correlated")


@register("q04i_pivot", sql="""
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY o_orderpriority""")
def q04i_pivot(spark, d):
    return Q.session_sql(spark, _tables(spark, d, ["orders"]), """
        SELECT * FROM (SELECT o_orderpriority, o_orderstatus FROM orders)
        PIVOT (count(*) FOR o_orderstatus IN ('F' AS F, 'O' AS O, 'P' AS P))""")


@register("q04j_range_join", sql="""
SELECT a.event_id, count(c.event_id) AS n_next_hour FROM events a
LEFT JOIN events c ON a.user_id = c.user_id AND c.ts > a.ts AND c.ts <= a.ts + INTERVAL 1 HOUR
GROUP BY a.event_id""")
def q04j_range_join(spark, d):
    """Events of the same user in the next hour: a count over a RANGE frame, no pair is built."""
    return Q.session_sql(spark, _tables(spark, d, ["events"]), """
        SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY unix_micros(CAST(ts AS TIMESTAMP))
                                        RANGE BETWEEN 1L FOLLOWING AND 3600000000L FOLLOWING) AS n_next_hour FROM events""")


@register("q04k_asof", sql="""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS view_id, user_id, ts AS view_ts FROM events WHERE event_type = 'view')
SELECT p.event_id, v.view_id, v.view_ts FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts""")
def q04k_asof(spark, d):
    """As-of join: the latest view at or before each purchase of the same user (the skew-safe operator)."""
    e = _tables(spark, d, ["events"])["events"]
    bought = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    seen = e.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", "ts", F.col("ts").alias("view_ts"))
    return J.asof_join(bought, seen, ["user_id"], "ts", ["view_id", "view_ts"], tie="view_id").select("event_id", "view_id", "view_ts")


# --- Q5: vectorised UDF --------------------------------------------------------------

@F.pandas_udf(T.StringType())
def lead_udf(s: pd.Series) -> pd.Series:
    """Q5: the opening-lead normaliser as an Arrow-batched pandas UDF (same rule as C2)."""
    x = s.str.replace("10", "T", regex=False)
    x = x.where(x.str.len() == 2)
    x = x.where(x.str[0].isin(list(CT.SUITS)), x.str[1] + x.str[0])
    return x.where(x.str[0].isin(list(CT.SUITS)) & x.str[1].isin(list(CT.RANKS)))


@register("q05_udf", sql=f"""
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, {LEAD_SQL} AS raw FROM lineitem),
b AS (SELECT a.*, replace(raw, '10', 'T') AS x FROM a),
c AS (SELECT b.*, CASE WHEN position(substr(x, 1, 1) IN 'CDHS') = 0 THEN substr(x, 2, 1) || substr(x, 1, 1) ELSE x END AS sw FROM b)
SELECT l_orderkey, l_linenumber, l_partkey, raw,
  CASE WHEN x IS NOT NULL AND length(x) = 2 AND position(substr(sw, 1, 1) IN 'CDHS') > 0
            AND position(substr(sw, 2, 1) IN 'AKQJT98765432') > 0 THEN sw END AS OpeningLead FROM c""")
def q05_udf(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", lead_text().alias("raw"))
    return li.withColumn("OpeningLead", lead_udf("raw"))


# --- Q6: table-function hook -----------------------------------------------------------

def _feature_engineer(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    def add(df: DataFrame) -> DataFrame:
        return (df.withColumn("log_price", F.log1p("o_totalprice"))
                  .withColumn("priority_rank", F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(1)).cast("int")))
    return add(train), add(test)


def apply_hook(train: DataFrame, test: DataFrame, fn=None) -> DataFrame:
    """Q6: run a user ``fn(train, test) -> (train, test)`` and return both tagged by split."""
    tr, te = (fn or (lambda a, b: (a, b)))(train, test)
    return tr.withColumn("split", F.lit("train")).unionByName(te.withColumn("split", F.lit("test")))


@register("q06_transform", sql=f"""
SELECT o_orderkey, o_totalprice, o_orderpriority, {r('ln(1 + o_totalprice)')} AS log_price,
  CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_rank,
  CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM orders""")
def q06_transform(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderdate")
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    out = apply_hook(o.where(F.col("o_orderdate") < cut), o.where(F.col("o_orderdate") >= cut), _feature_engineer)
    return rounded(out.drop("o_orderdate"))


# --- Q7: named API queries --------------------------------------------------------------

@register("q07_directory", sql="""
SELECT c_nationkey AS club_id, n_name AS club_name, count(*) AS n_players, arg_max(c_name, c_custkey) AS last_name
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey, n_name""")
def q07_directory(spark, d):
    t = Tables(spark, d)
    per = (t.customer.groupBy(F.col("c_nationkey").alias("club_id"))
           .agg(F.count(F.lit(1)).alias("n_players"), F.max_by("c_name", "c_custkey").alias("last_name")))
    n = t.nation.select(F.col("n_nationkey").alias("club_id"), F.col("n_name").alias("club_name"))
    return per.join(F.broadcast(n), "club_id").orderBy("club_id")


@register("q07_games", sql="""
SELECT c_nationkey AS club_id, CAST(o_orderdate AS DATE) AS game_date, count(*) AS n_games, count(DISTINCT o_custkey) AS n_players
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def q07_games(spark, d):
    t = Tables(spark, d)
    j = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return (j.groupBy(F.col("c_nationkey").alias("club_id"), F.to_date("o_orderdate").alias("game_date"))
             .agg(F.count(F.lit(1)).alias("n_games"), F.count_distinct("o_custkey").alias("n_players")))


@register("q07_history", sql=f"""
WITH s AS ({SCORED_ROWS_SQL})
SELECT session_id AS player_id, l_orderkey AS game_id, min(Date) AS game_date, count(*) AS boards,
  {r('avg(CASE WHEN Pair_Number_NS % 2 = 1 THEN Pct_NS ELSE 1 - Pct_NS END)')} AS score
FROM s GROUP BY session_id, l_orderkey""")
def q07_history(spark, d):
    s = scored_rows(Tables(spark, d), actual_only=True)
    score = F.when(F.col("Pair_Number_NS") % 2 == 1, F.col("Pct_NS")).otherwise(1 - F.col("Pct_NS"))
    h = (s.groupBy(F.col("session_id").alias("player_id"), F.col("l_orderkey").alias("game_id"))
         .agg(F.min("Date").alias("game_date"), F.count(F.lit(1)).alias("boards"), F.avg(score).alias("score")))
    return rounded(h.orderBy(F.col("game_date").desc(), "game_id"))


@register("q07_lookup", sql="""
SELECT c_custkey, c_name, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_game,
  CAST(max(o_orderdate) AS DATE) AS last_date, count(o_orderkey) AS n_games
FROM customer LEFT JOIN orders ON o_custkey = c_custkey
WHERE coalesce(contains(lower(c_name), '#0000001'), FALSE) GROUP BY c_custkey, c_name""")
def q07_lookup(spark, d):
    from ..operators import filters as FL
    t = Tables(spark, d)
    c = t.customer.where(FL.contains_ci(["c_name"], "#0000001")).select("c_custkey", "c_name")
    latest = R.latest_value(t.orders, ["o_custkey"], ["o_orderkey"], ["o_orderdate", "o_orderkey"])
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_games"),
                                               F.to_date(F.max("o_orderdate")).alias("last_date"))
    j = (c.join(latest, c.c_custkey == latest.o_custkey, "left").drop("o_custkey")
          .join(counts, c.c_custkey == counts.o_custkey, "left").drop("o_custkey"))
    return j.select("c_custkey", "c_name", F.col("o_orderkey").alias("last_game"), "last_date",
                    F.coalesce("n_games", F.lit(0)).alias("n_games"))
