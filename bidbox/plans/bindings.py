"""Bindings of the domain roles onto the driver's star-schema test tables.

The domain is duplicate-bridge results; the test data is TPC-H-like.  Each view below
maps a role (board, session, seat, score, ...) onto test columns with fixed rules so
that every registered query runs the real operator over whole tables.  The SQL
fragments in :data:`SQL` are the DuckDB equivalents used by the oracle strings.

Fixed role rules (must be the same in Spark and in the oracle SQL):

* board = ``l_partkey``; session = ``o_custkey``; pair (NS) = ``l_linenumber``;
  score NS = ``l_extendedprice``; date = ``date(l_shipdate)``.
* seats N,E,S,W = ``l_suppkey``, ``l_partkey % 100``, ``(l_suppkey*7 + l_partkey) % 100``,
  ``(l_partkey*3 + l_orderkey) % 100``; a seat value of 0 means "no player" (null).
* predicted pct = matchpoint pct of ``l_quantity`` on the same board; model sigma =
  ``l_discount``; master points N = ``c_acctbal``, S = ``s_acctbal``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import matchpoints_of
from .registry import Tables


def _seat(expr: Column) -> Column:
    return F.when(expr != 0, expr)


def seat_columns() -> dict[str, Column]:
    return {
        "Player_ID_N": _seat(F.col("l_suppkey")),
        "Player_ID_E": _seat(F.col("l_partkey") % 100),
        "Player_ID_S": _seat((F.col("l_suppkey") * 7 + F.col("l_partkey")) % 100),
        "Player_ID_W": _seat((F.col("l_partkey") * 3 + F.col("l_orderkey")) % 100),
    }


def board_rows(t: Tables) -> DataFrame:
    """Board-result rows: lineitem joined to its order (session = customer)."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                           "l_extendedprice", "l_discount", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
              .select(F.col("o_custkey").alias("session_id"),
                      F.col("l_partkey").alias("Board"),
                      F.col("l_linenumber").alias("Pair_Number_NS"),
                      F.col("l_extendedprice").alias("Score_NS"),
                      F.col("l_quantity").alias("Pred_Score_NS"),
                      F.col("l_discount").alias("Pct_NS_Pred_std"),
                      F.to_date("l_shipdate").alias("Date"),
                      "l_orderkey", "l_partkey", "l_suppkey"))


def _repeats(dim: DataFrame, key: str) -> DataFrame:
    """The key of each row of ``dim`` whose key is in other rows too."""
    n = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("_n")).where("_n > 1")
    return n.select(key, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i")).select(key)


def scored_rows(t: Tables, actual_only: bool = False, made: list[str] | None = None) -> DataFrame:
    """Board rows with actual and predicted matchpoint percentages and master points.

    ``actual_only`` leaves out the predictions, their sigma and the master points.  Then a lookup of points matters only for keys that the
    table repeats (it repeats the row): the few there are, if any, are joined.

    The board rows (a fact-to-order join) feed the boards' counts and the ranking, so they are
    materialised once as a silver table, whose folder ``made`` takes.
    """
    from ..operators.joins import BROADCAST_ROWS
    from ..session import materialize

    rows, scores = board_rows(t), {"Score_NS": ("MP_NS", "MP_Top", "Pct_NS"), "Pred_Score_NS": ("MP_NS_Pred", "MP_Top_Pred", "Pct_NS_Pred")}
    if actual_only:
        rows = rows.drop(scores.popitem()[0], "Pct_NS_Pred_std")
    rows = matchpoints_of(materialize(rows, "board-rows", made), ["Board"], scores)
    if actual_only:
        for dim, key, fk in ((t.customer, "c_custkey", "session_id"), (t.supplier, "s_suppkey", "l_suppkey")):
            again = materialize(_repeats(dim, key), "repeats")
            again = F.broadcast(again) if again.count() <= BROADCAST_ROWS else again
            rows = rows.join(again, rows[fk] == again[key], "left").drop(key)
        return rows
    cust = t.customer.select(F.col("c_custkey"), F.col("c_acctbal").alias("MasterPoints_N"))
    supp = t.supplier.select(F.col("s_suppkey"), F.col("s_acctbal").alias("MasterPoints_S"))
    return (rows.join(cust, rows.session_id == cust.c_custkey, "left")
                .join(supp, rows.l_suppkey == supp.s_suppkey, "left")
                .drop("c_custkey", "s_suppkey"))


# --- DuckDB fragments --------------------------------------------------------------

BOARD_ROWS_SQL = """
SELECT o.o_custkey AS session_id, l.l_partkey AS Board, l.l_linenumber AS Pair_Number_NS,
       l.l_extendedprice AS Score_NS, l.l_quantity AS Pred_Score_NS,
       l.l_discount AS Pct_NS_Pred_std, CAST(l.l_shipdate AS DATE) AS Date,
       l.l_orderkey, l.l_partkey, l.l_suppkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

SCORED_ROWS_SQL = f"""
WITH br AS ({BOARD_ROWS_SQL}),
mp AS (
  SELECT br.*,
    (rank() OVER (PARTITION BY Board ORDER BY Score_NS) - 1)
      + (count(*) OVER (PARTITION BY Board, Score_NS) - 1) / 2.0 AS MP_NS,
    count(*) OVER (PARTITION BY Board) - 1 AS MP_Top,
    (rank() OVER (PARTITION BY Board ORDER BY Pred_Score_NS) - 1)
      + (count(*) OVER (PARTITION BY Board, Pred_Score_NS) - 1) / 2.0 AS MP_NS_Pred
  FROM br)
SELECT mp.*, CASE WHEN MP_Top > 0 THEN MP_NS / MP_Top END AS Pct_NS,
       CASE WHEN MP_Top > 0 THEN MP_NS_Pred / MP_Top END AS Pct_NS_Pred,
       c.c_acctbal AS MasterPoints_N, s.s_acctbal AS MasterPoints_S
FROM mp LEFT JOIN customer c ON mp.session_id = c.c_custkey
        LEFT JOIN supplier s ON mp.l_suppkey = s.s_suppkey
"""


def seat_rows(t: Tables) -> DataFrame:
    """Board rows with the four seat player ids (null when the rule yields 0)."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    rows = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return rows.select(F.col("o_custkey").alias("session_id"), F.col("l_partkey").alias("Board"),
                       F.col("l_linenumber").alias("Round"), F.to_date("l_shipdate").alias("Date"),
                       "l_orderkey", *[e.alias(n) for n, e in seat_columns().items()])


def seat_keys(t: Tables) -> DataFrame:
    """The seat player ids of all line items, whether their order is there or not."""
    return t.lineitem.select(*[e.alias(n) for n, e in seat_columns().items()])


SEAT_ROWS_SQL = """
SELECT o.o_custkey AS session_id, l.l_partkey AS Board, l.l_linenumber AS Round,
       CAST(l.l_shipdate AS DATE) AS Date, l.l_orderkey,
       CASE WHEN l.l_suppkey <> 0 THEN l.l_suppkey END AS Player_ID_N,
       CASE WHEN l.l_partkey % 100 <> 0 THEN l.l_partkey % 100 END AS Player_ID_E,
       CASE WHEN (l.l_suppkey * 7 + l.l_partkey) % 100 <> 0 THEN (l.l_suppkey * 7 + l.l_partkey) % 100 END AS Player_ID_S,
       CASE WHEN (l.l_partkey * 3 + l.l_orderkey) % 100 <> 0 THEN (l.l_partkey * 3 + l.l_orderkey) % 100 END AS Player_ID_W
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""
