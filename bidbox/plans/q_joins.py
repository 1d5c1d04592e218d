"""Join queries (J*) over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import relational as R
from .bindings import SEAT_ROWS_SQL, seat_keys, seat_rows
from .registry import Tables, register
from .util import r, rounded


@register("j01_left", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey, c.c_nationkey, n.n_name, rg.r_name
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region rg ON n.n_regionkey = rg.r_regionkey""")
def j01_left(spark, d):
    t = Tables(spark, d)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    rg = t.region.select("r_regionkey", "r_name")
    out = J.lookup_chain(li, [(o, [("l_orderkey", "o_orderkey")]), (c, [("o_custkey", "c_custkey")]),
                              (n, [("c_nationkey", "n_nationkey")]), (rg, [("n_regionkey", "r_regionkey")])])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "c_nationkey", "n_name", "r_name")


@register("j02_composite", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, r.ret_price
FROM lineitem l LEFT JOIN (SELECT l_orderkey AS ok, l_linenumber AS ln, l_extendedprice AS ret_price
                           FROM lineitem WHERE l_returnflag = 'R') r
  ON l.l_orderkey = r.ok AND l.l_linenumber = r.ln""")
def j02_composite(spark, d):
    """Left join on two keys with different names; the right side is pre-filtered (returns only)."""
    li = Tables(spark, d).lineitem
    left = li.select("l_orderkey", "l_linenumber", "l_partkey")
    right = (li.where(F.col("l_returnflag") == "R")
             .select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"),
                     F.col("l_extendedprice").alias("ret_price")))
    out = left.join(right, (left.l_orderkey == right.ok) & (left.l_linenumber == right.ln), "left")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "ret_price")


@register("j03_keyed_concat", sql="""
SELECT o.o_orderkey, o.o_custkey, a.n_lines, a.qty FROM orders o LEFT JOIN
 (SELECT l_orderkey AS o_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) a
 USING (o_orderkey)""")
def j03_keyed_concat(spark, d):
    t = Tables(spark, d)
    per = (t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
           .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")))
    return J.keyed_concat(t.orders.select("o_orderkey", "o_custkey"), per, ["o_orderkey"])


@register("j04_self", sql=f"""
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(*) AS n, sum(value) AS v
           FROM events WHERE event_type IN ('view', 'purchase') GROUP BY ALL)
SELECT a.user_id, a.day, a.n AS n_view, {r('a.v')} AS v_view, b.n AS n_purchase, {r('b.v')} AS v_purchase
FROM e a JOIN e b ON a.user_id = b.user_id AND a.day = b.day
WHERE a.event_type = 'view' AND b.event_type = 'purchase'""")
def j04_self(spark, d):
    e = Tables(spark, d).events.where(F.col("event_type").isin("view", "purchase"))
    agg = (e.groupBy("user_id", F.to_date("ts").alias("day"), "event_type")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v")))
    return rounded(J.orientation_self_join(agg, "event_type", "view", "purchase", ["user_id", "day"], ["n", "v"]))


@register("j05_inner", sql="""
WITH a AS (SELECT l_orderkey, l_partkey, l_suppkey, count(*) AS n_same FROM lineitem GROUP BY ALL)
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, a.n_same
FROM lineitem l JOIN a USING (l_orderkey, l_partkey, l_suppkey)""")
def j05_inner(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    a = li.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n_same"))
    return li.join(a, on=["l_orderkey", "l_partkey", "l_suppkey"], how="inner")


@register("j06_chain", sql="""
SELECT DISTINCT c.c_custkey, o.o_orderkey, CAST(o.o_orderdate AS DATE) AS Date, n.n_name, rg.r_name
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region rg ON n.n_regionkey = rg.r_regionkey""")
def j06_chain(spark, d):
    """Player -> games -> boards -> club -> region chain for every player, deduped by (player, game)."""
    t = Tables(spark, d)
    c = t.customer.select("c_custkey", "c_nationkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    li = t.lineitem.select("l_orderkey")
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    rg = t.region.select("r_regionkey", "r_name")
    games = li.join(o, li.l_orderkey == o.o_orderkey).drop("l_orderkey").dropDuplicates(["o_orderkey"])
    out = (c.join(games, c.c_custkey == games.o_custkey)
            .join(n, c.c_nationkey == n.n_nationkey).join(rg, n.n_regionkey == rg.r_regionkey))
    return out.select("c_custkey", "o_orderkey", F.to_date("o_orderdate").alias("Date"), "n_name", "r_name")


@register("j07_anti_row", sql=f"""
WITH s AS (SELECT Board, Player_ID_N, Player_ID_E, Player_ID_S, Player_ID_W FROM ({SEAT_ROWS_SQL})),
rr AS (SELECT Board, Player_ID_N, Player_ID_E, Player_ID_S, Player_ID_W FROM ({SEAT_ROWS_SQL}) WHERE Round = 1)
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM rr WHERE rr.Board = s.Board AND rr.Player_ID_N = s.Player_ID_N
  AND rr.Player_ID_E = s.Player_ID_E AND rr.Player_ID_S = s.Player_ID_S AND rr.Player_ID_W = s.Player_ID_W)""")
def j07_anti_row(spark, d):
    s = seat_rows(Tables(spark, d))
    cols = ["Board", "Player_ID_N", "Player_ID_E", "Player_ID_S", "Player_ID_W"]
    return J.whole_row_anti(s.select(*cols), s.where(F.col("Round") == 1).select(*cols))


@register("j08_anti", sql="""
SELECT o_orderkey, o_custkey FROM orders o WHERE NOT EXISTS
 (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal > 0)""")
def j08_anti(spark, d):
    t = Tables(spark, d)
    pos = t.customer.where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(pos, "o_custkey", "left_anti")


@register("j09_broadcast", sql="""
SELECT c.c_custkey, n.n_name, rg.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region rg ON n.n_regionkey = rg.r_regionkey""")
def j09_broadcast(spark, d):
    t = Tables(spark, d)
    n = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    rg = t.region.select("r_regionkey", "r_name")
    c = t.customer.select("c_custkey", "c_nationkey")
    return (c.join(n, c.c_nationkey == n.n_nationkey).join(rg, n.n_regionkey == rg.r_regionkey)
             .select("c_custkey", "n_name", "r_name"))


@register("j10_roles", sql=f"""
WITH s AS ({SEAT_ROWS_SQL})
SELECT s.session_id, s.Board, s.Round, s.l_orderkey, n.c_name AS Player_Name_N, e.c_name AS Player_Name_E,
       so.c_name AS Player_Name_S, w.c_name AS Player_Name_W, n.c_acctbal AS MasterPoints_N,
       e.c_acctbal AS MasterPoints_E, so.c_acctbal AS MasterPoints_S, w.c_acctbal AS MasterPoints_W
FROM s LEFT JOIN customer n ON s.Player_ID_N = n.c_custkey LEFT JOIN customer e ON s.Player_ID_E = e.c_custkey
LEFT JOIN customer so ON s.Player_ID_S = so.c_custkey LEFT JOIN customer w ON s.Player_ID_W = w.c_custkey""")
def j10_roles(spark, d):
    t = Tables(spark, d)
    s = seat_rows(t)
    players = t.customer.select(F.col("c_custkey"), F.col("c_name").alias("Player_Name"),
                                F.col("c_acctbal").alias("MasterPoints"))
    out = J.role_lookup(s, players, "c_custkey", {x: f"Player_ID_{x}" for x in "NESW"}, ["Player_Name", "MasterPoints"], used=seat_keys(t))
    return out.select("session_id", "Board", "Round", "l_orderkey",
                      *[f"Player_Name_{x}" for x in "NESW"], *[f"MasterPoints_{x}" for x in "NESW"])


@register("j11_latest_lookup", sql=f"""
WITH s AS ({SEAT_ROWS_SQL}),
lv AS (SELECT user_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY user_id)
SELECT s.session_id, s.Board, s.Round, s.l_orderkey, n.value AS Latest_N, e.value AS Latest_E,
       so.value AS Latest_S, w.value AS Latest_W
FROM s LEFT JOIN lv n ON s.Player_ID_N = n.user_id LEFT JOIN lv e ON s.Player_ID_E = e.user_id
LEFT JOIN lv so ON s.Player_ID_S = so.user_id LEFT JOIN lv w ON s.Player_ID_W = w.user_id""")
def j11_latest_lookup(spark, d):
    t = Tables(spark, d)
    latest = R.latest_value(t.events, ["user_id"], ["value"], ["ts", "event_id"]).withColumnRenamed("value", "Latest")
    out = J.role_lookup(seat_rows(t), latest, "user_id", {x: f"Player_ID_{x}" for x in "NESW"}, ["Latest"], used=seat_keys(t))
    return out.select("session_id", "Board", "Round", "l_orderkey", *[f"Latest_{x}" for x in "NESW"])


@register("j12_derive_back", sql="""
SELECT o_orderkey, o_orderpriority, CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS priority_rank,
       lower(split_part(o_orderpriority, '-', 2)) AS priority_label FROM orders""")
def j12_derive_back(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderpriority")
    return J.derive_on_distinct(o, "o_orderpriority", {
        "priority_rank": F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(1)).cast("int"),
        "priority_label": F.lower(F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(2))),
    })


@register("j13_reduce_join", sql="""
SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_o_orderkey,
       arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_o_orderkey,
       arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_o_totalprice,
       arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_o_totalprice FROM orders GROUP BY o_custkey""")
def j13_reduce_join(spark, d):
    o = Tables(spark, d).orders
    return J.first_last_rows(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@register("j14_standings", sql=f"""
SELECT n.n_nationkey, n.n_name, a.n_customers, {r('a.avg_balance')} AS avg_balance, a.top_customer
FROM nation n LEFT JOIN (SELECT c_nationkey AS n_nationkey, count(*) AS n_customers, avg(c_acctbal) AS avg_balance,
  arg_max(c_custkey, (c_acctbal, c_custkey)) AS top_customer FROM customer GROUP BY c_nationkey) a USING (n_nationkey)""")
def j14_standings(spark, d):
    t = Tables(spark, d)
    out = J.standings(t.nation.select("n_nationkey", "n_name"), t.customer, "n_nationkey", "c_nationkey",
                      [F.count(F.lit(1)).alias("n_customers"), F.avg("c_acctbal").alias("avg_balance"),
                       F.max_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("top_customer")])
    return rounded(out)


@register("j16_semi_chain", sql="""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (
 SELECT o_orderkey FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer WHERE c_nationkey IN (
   SELECT n_nationkey FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name <> 'ASIA'))))""")
def j16_semi_chain(spark, d):
    t = Tables(spark, d)
    root = t.region.where(F.col("r_name") != "ASIA")
    out = J.semi_chain([(t.nation, "n_regionkey", "r_regionkey"),
                        (t.customer.withColumnRenamed("c_nationkey", "n_nationkey"), "n_nationkey", "n_nationkey"),
                        (t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", "c_custkey"),
                        (t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "o_orderkey")],
                       root)
    return out.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "l_partkey")


@register("j17_pred_join", sql=f"""
WITH a AS (SELECT o_orderkey, o_totalprice / 1000 AS pred_a FROM orders),
b AS (SELECT l_orderkey AS o_orderkey, sum(l_extendedprice) / 1000 AS pred_b FROM lineitem GROUP BY l_orderkey)
SELECT a.o_orderkey, {r('pred_a')} AS pred_a, {r('pred_b')} AS pred_b FROM a LEFT JOIN b USING (o_orderkey)""")
def j17_pred_join(spark, d):
    t = Tables(spark, d)
    a = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("pred_a"))
    b = (t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
         .agg((F.sum("l_extendedprice") / 1000).alias("pred_b")))
    return rounded(a.join(b, "o_orderkey", "left"))


@register("j18_cache_split", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, 'cached' AS source FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 25)
UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, 'novel' FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)""")
def j18_cache_split(spark, d):
    t = Tables(spark, d)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    cache = t.part.where(F.col("p_size") < 25).select(F.col("p_partkey").alias("l_partkey"))
    hit, novel = J.cache_split(rows, cache, ["l_partkey"])
    return hit.withColumn("source", F.lit("cached")).unionByName(novel.withColumn("source", F.lit("novel")))


@register("j19_precedence", sql=f"""
WITH fresh AS (SELECT o_orderkey, o_totalprice * 1.1 AS price, 'fresh' AS origin FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'),
hist AS (SELECT o_orderkey, o_totalprice AS price, 'history' AS origin FROM orders),
u AS (SELECT *, 0 AS prec FROM fresh UNION ALL SELECT *, 1 FROM hist)
SELECT o_orderkey, {r('price')} AS price, origin FROM u QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY prec) = 1""")
def j19_precedence(spark, d):
    o = Tables(spark, d).orders
    fresh = (o.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
             .select("o_orderkey", (F.col("o_totalprice") * 1.1).alias("price"), F.lit("fresh").alias("origin")))
    hist = o.select("o_orderkey", F.col("o_totalprice").alias("price"), F.lit("history").alias("origin"))
    return rounded(J.precedence_merge([fresh, hist], ["o_orderkey"]))


@register("j05_bucketed", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_custkey, o.o_orderdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def j05_bucketed(spark, d):
    """J5 with co-located inputs: facts and orders bucketed on the order key join shuffle-free."""
    import uuid

    from ..session import scratch_path
    from ..sources.files import bucketed_table
    t = Tables(spark, d)
    tag = uuid.uuid4().hex[:8]
    li = bucketed_table(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), f"bidbox_li_{tag}",
                        scratch_path(spark, "bucket-li"), 16, ["l_orderkey"])
    o = bucketed_table(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), f"bidbox_o_{tag}",
                       scratch_path(spark, "bucket-o"), 16, ["o_orderkey"])
    return li.join(o, li.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "l_quantity",
                                                              "o_custkey", "o_orderdate")


@register("j20_asof", sql="""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id AS view_id, user_id, ts AS view_ts FROM events WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.ts, v.view_id, v.view_ts FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.view_ts""")
def j20_asof(spark, d):
    """Latest view at or before each purchase of the same user, with the skew-safe as-of operator."""
    e = Tables(spark, d).events
    p = e.where(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    v = (e.where(F.col("event_type") == "view")
         .select("user_id", "ts", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts")))
    return J.asof_join(p, v, ["user_id"], "ts", ["view_id", "view_ts"], tie="view_id").select(
        "event_id", "user_id", "ts", "view_id", "view_ts")
