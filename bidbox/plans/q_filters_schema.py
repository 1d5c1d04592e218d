"""Filters (F*), projection/schema (P*) and data-quality (V*) queries over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import filters as FL
from ..operators import schema as SC
from ..operators.ranking import matchpoints
from .bindings import BOARD_ROWS_SQL, SEAT_ROWS_SQL, board_rows, seat_rows
from .q_scalar import _CIN, coerce_input
from .registry import TABLES, Tables, register
from .util import r, rounded


# --- F: filters ---------------------------------------------------------------------

@register("f01_required", sql=f"SELECT * FROM ({SEAT_ROWS_SQL}) WHERE Player_ID_N IS NOT NULL AND Player_ID_S IS NOT NULL")
def f01_required(spark, d):
    return FL.required(seat_rows(Tables(spark, d)), ["Player_ID_N", "Player_ID_S"])


@register("f02_null_or_in", sql=f"SELECT * FROM ({SEAT_ROWS_SQL}) WHERE Player_ID_E IS NULL OR Player_ID_E IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)")
def f02_null_or_in(spark, d):
    return seat_rows(Tables(spark, d)).where(FL.null_or_in("Player_ID_E", [1, 2, 3, 5, 8, 13, 21, 34, 55, 89]))


@register("f03_regex", sql=f"SELECT c_custkey, raw FROM (SELECT c_custkey, {_CIN} AS raw FROM customer) WHERE regexp_matches(raw, '^\\d+$')")
def f03_regex(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", coerce_input().alias("raw"))
    return c.where(FL.digits_only("raw"))


@register("f04_window", sql="""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'""")
def f04_window(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    return o.where(FL.half_open("o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz"),
                                F.lit("1997-01-01").cast("timestamp_ntz")))


@register("f05_strdate", sql="""
SELECT o_orderkey, game_date FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS game_date FROM orders)
WHERE game_date >= '1998-06-01'""")
def f05_strdate(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("game_date"))
    return o.where(FL.iso_string_at_least("game_date", "1998-06-01"))


@register("f06_or", sql="""
SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount <> 0 OR l_tax <> 0""")
def f06_or(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return li.where(FL.any_not_equal(["l_discount", "l_tax"], 0))


@register("f07_adjust", sql=f"""
WITH s AS (SELECT br.*, (rank() OVER (PARTITION BY Board ORDER BY Score_NS) - 1)
      + (count(*) OVER (PARTITION BY Board, Score_NS) - 1) / 2.0 AS MP_NS,
    count(*) OVER (PARTITION BY Board) - 1 AS MP_Top FROM ({BOARD_ROWS_SQL}) br),
m AS (SELECT session_id, Board, Pair_Number_NS, l_orderkey, MP_NS, MP_Top - MP_NS AS MP_EW FROM s)
SELECT session_id, Board, Pair_Number_NS, l_orderkey, {r('MP_NS')} AS MP_NS, {r('MP_EW')} AS MP_EW FROM m
WHERE NOT (MP_NS < 0 OR MP_EW < 0) AND NOT (MP_NS + MP_EW = 0)""")
def f07_adjust(spark, d):
    rows = matchpoints(board_rows(Tables(spark, d)), ["Board"], "Score_NS", "MP_NS", "MP_Top", "Pct_NS")
    m = rows.select("session_id", "Board", "Pair_Number_NS", "l_orderkey", "MP_NS",
                    (F.col("MP_Top") - F.col("MP_NS")).alias("MP_EW"))
    return rounded(m.where(FL.not_adjusted("MP_NS", "MP_EW")))


@register("f09_year", sql="""
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE year(l_shipdate) = 1998""")
def f09_year(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    return li.where(FL.in_year("l_shipdate", 1998))


@register("f10_in", sql="""
SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_custkey AS VARCHAR) IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def f10_in(spark, d):
    t = Tables(spark, d)
    keys = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return FL.in_keys(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", keys)


@register("f11_substring", sql="""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE coalesce(contains(lower(c_name), '00001'), FALSE) OR coalesce(contains(lower(c_mktsegment), 'uild'), FALSE)""")
def f11_substring(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", "c_name", "c_mktsegment")
    return c.where(FL.contains_ci(["c_name", "c_mktsegment"], "00001") | FL.contains_ci(["c_mktsegment"], "uild"))


@register("f12_row_search", sql="""
SELECT p_partkey, p_name, p_brand, p_type FROM part
WHERE coalesce(contains(lower(p_name), 'ring'), FALSE) OR coalesce(contains(lower(p_brand), 'ring'), FALSE)
   OR coalesce(contains(lower(p_type), 'ring'), FALSE)""")
def f12_row_search(spark, d):
    p = Tables(spark, d).part.select("p_partkey", "p_name", "p_brand", "p_type")
    return p.where(FL.row_contains(["p_name", "p_brand", "p_type"], "RING"))


@register("f14_null_fk", sql=f"""
SELECT s.session_id, s.Board, s.l_orderkey, c.c_name AS Player_Name_N
FROM ({SEAT_ROWS_SQL}) s LEFT JOIN customer c ON s.Player_ID_N = c.c_custkey WHERE c.c_name IS NOT NULL""")
def f14_null_fk(spark, d):
    t = Tables(spark, d)
    s = seat_rows(t)
    c = t.customer.select("c_custkey", F.col("c_name").alias("Player_Name_N"))
    j = s.join(c, s.Player_ID_N == c.c_custkey, "left").select("session_id", "Board", "l_orderkey", "Player_Name_N")
    return FL.required(j, ["Player_Name_N"])


# --- P: projection and schema -------------------------------------------------------

_RENAMES = {"l_orderkey": "session_id", "l_partkey": "Board", "l_linenumber": "Round",
            "l_extendedprice": "Score_NS", "not_there": "ignored"}


@register("p01_rename", sql="""
SELECT l_orderkey AS session_id, l_partkey AS Board, l_linenumber AS Round, l_extendedprice AS Score_NS FROM lineitem""")
def p01_rename(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return SC.rename(li, {k: v for k, v in _RENAMES.items() if k != "not_there"})


@register("p02_rename_if", sql="""
SELECT o_orderkey AS event_id, o_custkey AS club_id, o_orderdate FROM orders""")
def p02_rename_if(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return SC.rename(o, {"o_orderkey": "event_id", "o_custkey": "club_id", "game_date": "Date"})


@register("p03_drop", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def p03_drop(spark, d):
    o = Tables(spark, d).orders
    return SC.drop_strict(o, ["o_totalprice", "o_orderpriority"]).drop("not_a_column")


@register("p04_drop_regex", sql="SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate FROM lineitem")
def p04_drop_regex(spark, d):
    li = Tables(spark, d).lineitem
    return SC.drop_by_regex(li, [r"l_return", r"l_line(status|flag)", r"l_ship"], only_strings=True)


@register("p05_by_dtype", sql="SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def p05_by_dtype(spark, d):
    li = Tables(spark, d).lineitem
    return SC.by_dtype(li, [T.StringType, T.TimestampNTZType, T.TimestampType, T.ArrayType, T.StructType], exclude=True)


@register("p06_downcast", sql=f"SELECT o_orderkey, {r('CAST(o_totalprice AS FLOAT)')} AS o_totalprice FROM orders")
def p06_downcast(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice")
    return rounded(SC.downcast_doubles(o))


_TARGET = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()),
                        T.StructField("Round", T.IntegerType()), T.StructField("is_virtual_game", T.BooleanType()),
                        T.StructField("club_name", T.StringType()), T.StructField("o_custkey", T.LongType())])


@register("p07_align", sql=f"""
SELECT o_orderkey, {r('o_totalprice')} AS o_totalprice, 0 AS Round, FALSE AS is_virtual_game, NULL::VARCHAR AS club_name, o_custkey FROM orders""")
def p07_align(spark, d):
    return rounded(SC.align(Tables(spark, d).orders, _TARGET))


@register("p08_flags", sql="""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS Date, o_orderdate < TIMESTAMP '2000-01-01' AS is_train,
  o_orderdate >= TIMESTAMP '2000-01-01' AS is_test, 'club' AS source FROM orders""")
def p08_flags(spark, d):
    o = Tables(spark, d).orders
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("Date"), (F.col("o_orderdate") < cut).alias("is_train"),
                    (F.col("o_orderdate") >= cut).alias("is_test"), F.lit("club").alias("source"))


# fixed values: a small feature registry for the lineitem-as-board-results view
REGISTRY = [
    (r"l_(orderkey|partkey|suppkey|linenumber)", "keys", "bigint"),
    (r"l_(quantity|extendedprice)", "result", "float"),
    (r"l_(discount|tax)", "pre_deal", "float"),
    (r"l_(returnflag|linestatus)", "post_play", "string"),
    (r"l_shipdate", "pre_deal", "timestamp_ntz"),
]


@register("p09_registry", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity,
  CAST(l_extendedprice AS FLOAT) AS l_extendedprice, CAST(l_discount AS FLOAT) AS l_discount, CAST(l_tax AS FLOAT) AS l_tax,
  l_returnflag, l_linestatus, l_shipdate FROM lineitem""")
def p09_registry(spark, d):
    li = Tables(spark, d).lineitem
    classes = SC.classify_columns(li.columns, REGISTRY)
    return SC.apply_registry(li, classes)


@register("p10_by_state", sql="SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_shipdate FROM lineitem")
def p10_by_state(spark, d):
    li = Tables(spark, d).lineitem
    classes = SC.classify_columns(li.columns, REGISTRY)
    return SC.apply_registry(li, classes, groups=["keys", "pre_deal"], deny=["l_discount", "l_tax"])


@register("p11_projection", sql="SELECT o_orderkey, o_totalprice, 'Round,is_virtual_game' AS missing_columns FROM orders")
def p11_projection(spark, d):
    o = Tables(spark, d).orders
    out, missing = SC.project(o, ["o_orderkey", "o_totalprice", "Round", "is_virtual_game"], strict=False)
    return out.withColumn("missing_columns", F.lit(",".join(missing)))


@register("p12_leakage", sql="SELECT l_quantity, l_discount, l_tax, l_returnflag, l_shipdate FROM lineitem")
def p12_leakage(spark, d):
    li = Tables(spark, d).lineitem.drop("l_linestatus")
    return SC.leakage_guard(li, "l_quantity", ["l_quantity", "l_extendedprice"], [r".*key$", r"l_linenumber"])


@register("p13_add_missing", sql="SELECT o_orderkey, o_orderstatus, FALSE AS is_virtual_game FROM orders")
def p13_add_missing(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus")
    o = SC.add_if_missing(o, "o_orderstatus", None, "string")
    return SC.add_if_missing(o, "is_virtual_game", False, "boolean")


@register("p15_tables", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows, "
    f"(SELECT count(*) FROM (DESCRIBE {t})) AS columns" for t in TABLES))
def p15_tables(spark, d):
    t = Tables(spark, d)
    frames = []
    for name in TABLES:
        df = getattr(t, name)
        frames.append(df.agg(F.count(F.lit(1)).alias("rows"))
                      .select(F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).cast("long").alias("columns")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- V: data quality ----------------------------------------------------------------

@register("v01_rules", sql=f"""
WITH s AS ({SEAT_ROWS_SQL})
SELECT 'board_positive' AS rule, sum(CASE WHEN coalesce(Board >= 1, FALSE) THEN 0 ELSE 1 END) AS violations FROM s
UNION ALL SELECT 'north_present', sum(CASE WHEN coalesce(Player_ID_N IS NOT NULL, FALSE) THEN 0 ELSE 1 END) FROM s
UNION ALL SELECT 'west_in_range', sum(CASE WHEN coalesce(Player_ID_W BETWEEN 1 AND 99, FALSE) THEN 0 ELSE 1 END) FROM s
UNION ALL SELECT 'round_range', sum(CASE WHEN coalesce(Round BETWEEN 1 AND 7, FALSE) THEN 0 ELSE 1 END) FROM s""")
def v01_rules(spark, d):
    s = seat_rows(Tables(spark, d))
    rules = {"board_positive": F.col("Board") >= 1, "north_present": F.col("Player_ID_N").isNotNull(),
             "west_in_range": F.col("Player_ID_W").between(1, 99), "round_range": F.col("Round").between(1, 7)}
    return SC.rule_violations(s, rules)


@register("v02_constraints", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def v02_constraints(spark, d):
    return SC.key_violations(Tables(spark, d).lineitem, ["l_orderkey", "l_linenumber"])


_LANDED_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN '+00' || CAST(o_orderkey + 1 AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS order_no,
  CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(o_custkey % 500 AS VARCHAR) END AS ref, o_orderpriority FROM orders"""
_INT_SQL = "CASE WHEN regexp_full_match({0}, '[+-]?\\d+') THEN CAST(CAST({0} AS BIGINT) AS VARCHAR) ELSE nullif({0}, '') END"


@register("v02_preflight", sql=f"""
WITH landed AS ({_LANDED_SQL}), c AS (SELECT o_orderkey, {_INT_SQL.format("order_no")} AS no, {_INT_SQL.format("ref")} AS ref, coalesce(o_orderpriority, '') AS priority FROM landed),
k AS (SELECT 'PRIMARY KEY' AS "constraint", coalesce(no, '') AS key, o_orderkey FROM c UNION ALL SELECT 'UNIQUE ref', ref, o_orderkey FROM c
  UNION ALL SELECT 'UNIQUE ref NOT NULL', coalesce(ref, ''), o_orderkey FROM c UNION ALL SELECT 'UNIQUE ref, priority', ref || chr(31) || priority, o_orderkey FROM c),
n AS (SELECT "constraint", key, count(*) AS n, list(o_orderkey ORDER BY o_orderkey)[1:3] AS rows FROM k WHERE key IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
SELECT "constraint", key, n, rows FROM n QUALIFY row_number() OVER (PARTITION BY "constraint" ORDER BY n DESC, key) <= 5""")
def v02_preflight(spark, d):
    """All-string rows whose order numbers collide only once they are integers, under four constraints."""
    o = Tables(spark, d).orders
    number = F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("+00"), (F.col("o_orderkey") + 1).cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    ref = F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).when(F.col("o_orderkey") % 9 == 1, F.lit("")).otherwise((F.col("o_custkey") % 500).cast("string"))
    landed = o.select("o_orderkey", number.alias("order_no"), ref.alias("ref"), "o_orderpriority")
    return SC.key_preflight(landed, {
        "PRIMARY KEY": [("order_no", "INTEGER", False)], "UNIQUE ref": [("ref", "INTEGER", False)], "UNIQUE ref NOT NULL": [("ref", "INTEGER", True)],
        "UNIQUE ref, priority": [("ref", "INTEGER", False), ("o_orderpriority", "TEXT", True)]}, "o_orderkey")


@register("v04_key_unique", sql="""
SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_distinct, count(*) = count(DISTINCT o_orderkey) AS is_unique FROM orders""")
def v04_key_unique(spark, d):
    per = Tables(spark, d).orders.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("c"))
    out = per.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_distinct"))
    return out.withColumn("is_unique", F.col("n") == F.col("n_distinct"))


@register("v07_parallel", sql=f"""
WITH s AS ({SEAT_ROWS_SQL}),
c AS (SELECT 'N' AS reduction, count(DISTINCT Board) AS n FROM s WHERE Player_ID_N IS NOT NULL
      UNION ALL SELECT 'S', count(DISTINCT Board) FROM s WHERE Player_ID_S IS NOT NULL
      UNION ALL SELECT 'E', count(DISTINCT Board) FROM s WHERE Player_ID_E IS NOT NULL
      UNION ALL SELECT 'W', count(DISTINCT Board) FROM s WHERE Player_ID_W IS NOT NULL)
SELECT reduction, n, (SELECT min(n) = max(n) FROM c) AS equal FROM c""")
def v07_parallel(spark, d):
    """One row a board from each seat's players: do the four reductions have equal counts?"""
    s = seat_rows(Tables(spark, d))
    return SC.parallel_counts({x: s.where(F.col(f"Player_ID_{x}").isNotNull()).select("Board").distinct() for x in "NSEW"})


@register("v05_retention", sql=f"""
WITH c AS (SELECT (SELECT count(*) FROM lineitem) AS rows_before,
  (SELECT count(*) FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 25) AS rows_after)
SELECT rows_before, rows_after, {r('rows_after / rows_before')} AS ratio, rows_after / rows_before >= 0.5 AS ok FROM c""")
def v05_retention(spark, d):
    t = Tables(spark, d)
    before = t.lineitem.select("l_partkey")
    after = before.join(t.part.where(F.col("p_size") < 25).select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    return rounded(SC.retention(before, after))


@register("v08_diff", sql="""
WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders),
b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
             CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 19 <> 0),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderstatus AS a1, b.o_orderstatus AS b1,
             a.o_orderpriority AS a2, b.o_orderpriority AS b2 FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT o_orderkey, 'o_orderstatus' AS "column", a1 AS "left", b1 AS "right" FROM j WHERE a1 IS DISTINCT FROM b1
UNION ALL SELECT o_orderkey, 'o_orderpriority', a2, b2 FROM j WHERE a2 IS DISTINCT FROM b2""")
def v08_diff(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    b = o.where(F.col("o_orderkey") % 19 != 0).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 13 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 17 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return SC.cell_diff(o, b, ["o_orderkey"], ["o_orderstatus", "o_orderpriority"])


# --- schema operations that drive a data projection (S3, P14, V3) --------------------------

@register("s03_schema", sql="SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def s03_schema(spark, d):
    """Validate a requested projection against the footer schema (no rows read), then run it."""
    from ..sources.files import schema_only

    path = f"{d.rstrip('/')}/lineitem.parquet"
    schema = schema_only(spark, path)
    wanted = ["l_orderkey", "l_partkey", "l_quantity", "Board_not_in_file"]
    present = [c for c in wanted if c in schema.fieldNames()]
    return Tables(spark, d).lineitem.select(*present)


@register("p14_schema_search", sql="SELECT l_extendedprice, l_quantity FROM lineitem")
def p14_schema_search(spark, d):
    """Case-insensitive column search (capped, with total) selects the columns to read."""
    li = Tables(spark, d).lineitem
    hits, total = SC.search_columns(li, r"PRICE|quant", limit=200)
    assert total == len(hits)
    return li.select(*[name for name, _ in hits])


@register("v03_schema", sql="""
SELECT o_orderkey, CAST(o_totalprice AS FLOAT) AS o_totalprice, o_orderstatus FROM orders""")
def v03_schema(spark, d):
    """Schema assertions on the model table: doubles are downcast, reported columns (left-over strings, a join suffix) go, then nothing may be reported."""
    keep = ["o_orderstatus"]
    o = Tables(spark, d).orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate", "o_orderpriority", F.col("o_custkey").alias("o_custkey_right"))
    out = SC.downcast_doubles(o)
    out = out.drop(*SC.column_problems(out.schema, keep))
    problems = SC.schema_problems(out.schema, keep)
    # V6: the yearly batches the table is written in must have the same columns
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    problems += SC.same_columns([out.where(F.col("o_orderdate") < cut), out.where(F.col("o_orderdate") >= cut)])
    if problems:
        raise SC.SchemaError(f"schema problems: {problems}")
    return out.drop("o_orderdate")
