"""Scalar/domain expressions (C*) over text generated from the test tables by fixed rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import coerce as CO
from ..functions import contract as CT
from ..functions import keys as K
from .bindings import SEAT_ROWS_SQL, seat_rows
from .registry import Tables, register
from .util import r

# --- generated contract text (C1, F16) ----------------------------------------------

_STRAIN_LIST = "['C','D','H','S','NT']"


def contract_text() -> Column:
    lvl = (F.lit(1) + F.col("l_linenumber") % 7).cast("string")
    suit = F.element_at(F.array(*[F.lit(s) for s in ("C", "D", "H", "S", "NT")]),
                        (F.col("l_suppkey") % 5 + 1).cast("int"))
    x = F.repeat(F.lit("X"), (F.col("l_quantity").cast("int") % 3).cast("int"))
    style = F.col("l_orderkey") % 4
    text = (F.when(style == 0, F.lower(F.concat(lvl, F.lit(" "), suit, x)))
            .when(style == 1, F.concat(lvl, suit, x))
            .when(style == 2, F.concat(lvl, F.lit(" "), suit, F.lower(x)))
            .when(F.col("l_partkey") % 9 == 0, F.lit("9Z"))
            .otherwise(F.concat(lvl, suit, x)))
    return F.when(F.col("l_linenumber") == 7, F.lit("PASS")).otherwise(text)


def declarer_text() -> Column:
    return F.when(F.col("l_partkey") % 13 != 0, F.substring(F.lit("NESW"), (F.col("l_partkey") % 4 + 1).cast("int"), 1))


CONTRACT_SQL = f"""
CASE WHEN l_linenumber = 7 THEN 'PASS' ELSE (
  CASE WHEN l_orderkey % 4 = 0 THEN lower(CAST(1 + l_linenumber % 7 AS VARCHAR) || ' ' || {_STRAIN_LIST}[l_suppkey % 5 + 1] || repeat('X', CAST(l_quantity AS INTEGER) % 3))
       WHEN l_orderkey % 4 = 1 THEN CAST(1 + l_linenumber % 7 AS VARCHAR) || {_STRAIN_LIST}[l_suppkey % 5 + 1] || repeat('X', CAST(l_quantity AS INTEGER) % 3)
       WHEN l_orderkey % 4 = 2 THEN CAST(1 + l_linenumber % 7 AS VARCHAR) || ' ' || {_STRAIN_LIST}[l_suppkey % 5 + 1] || lower(repeat('X', CAST(l_quantity AS INTEGER) % 3))
       WHEN l_partkey % 9 = 0 THEN '9Z'
       ELSE CAST(1 + l_linenumber % 7 AS VARCHAR) || {_STRAIN_LIST}[l_suppkey % 5 + 1] || repeat('X', CAST(l_quantity AS INTEGER) % 3) END) END"""
DECLARER_SQL = "CASE WHEN l_partkey % 13 <> 0 THEN substr('NESW', CAST(l_partkey % 4 + 1 AS INTEGER), 1) END"


def _first_replace_sql(s: str, old: str, new: str) -> str:
    return (f"(CASE WHEN position('{old}' IN {s}) > 0 THEN substr({s}, 1, position('{old}' IN {s}) - 1) || '{new}' || "
            f"substr({s}, position('{old}' IN {s}) + {len(old)}) ELSE {s} END)")


_C0 = _first_replace_sql(f"upper({_first_replace_sql('raw', ' ', '')})", "NT", "N")


@register("c01_contract", sql=f"""
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, {CONTRACT_SQL} AS raw, {DECLARER_SQL} AS Declarer FROM lineitem),
c AS (SELECT b.*, {_C0} AS c FROM b),
p AS (SELECT c.*, CASE WHEN regexp_matches(c, '^\\d') THEN regexp_extract(c, '^(\\d)', 1) END AS lvl,
        CASE WHEN regexp_matches(c, '^\\d[CDHSN]') THEN regexp_extract(c, '^\\d([CDHSN])', 1) END AS BidSuit,
        CASE WHEN regexp_matches(c, '^\\d[CDHSN]') THEN regexp_extract(c, '^\\d[CDHSN](X*)', 1) END AS Dbl FROM c),
q AS (SELECT l_orderkey, l_linenumber, l_partkey, raw,
        CASE WHEN c = 'PASS' THEN c ELSE lvl || BidSuit || Dbl || Declarer END AS Contract,
        coalesce(CAST(lvl AS INTEGER), 0) AS BidLvl, BidSuit, Dbl FROM p)
SELECT * FROM q WHERE NOT (Contract <> 'PASS' AND BidSuit IS NULL)""")
def c01_contract(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", contract_text().alias("raw"),
                   declarer_text().alias("Declarer"))
    return CT.normalise_contract(li, "raw", "Declarer", drop_invalid=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "raw", "Contract", "BidLvl", "BidSuit", "Dbl")


# --- lead (C2) ----------------------------------------------------------------------

_RANK_LIST = ["A", "K", "Q", "J", "10", "9", "8", "7", "6", "5", "4", "3", "2"]


def lead_text() -> Column:
    rank = F.element_at(F.array(*[F.lit(x) for x in _RANK_LIST]), (F.col("l_partkey") % 13 + 1).cast("int"))
    suit = F.substring(F.lit("CDHS"), (F.col("l_suppkey") % 4 + 1).cast("int"), 1)
    form = F.col("l_orderkey") % 5
    return (F.when(form == 0, F.concat(suit, rank)).when(form == 1, F.concat(rank, suit))
            .when(form == 2, rank).when(form == 3, F.lit(None).cast("string"))
            .otherwise(F.lower(F.concat(suit, rank))))


_RANKS_SQL = "[" + ",".join(f"'{x}'" for x in _RANK_LIST) + "]"
LEAD_SQL = f"""CASE l_orderkey % 5 WHEN 0 THEN substr('CDHS', CAST(l_suppkey % 4 + 1 AS INTEGER), 1) || {_RANKS_SQL}[l_partkey % 13 + 1]
  WHEN 1 THEN {_RANKS_SQL}[l_partkey % 13 + 1] || substr('CDHS', CAST(l_suppkey % 4 + 1 AS INTEGER), 1)
  WHEN 2 THEN {_RANKS_SQL}[l_partkey % 13 + 1] WHEN 3 THEN NULL
  ELSE lower(substr('CDHS', CAST(l_suppkey % 4 + 1 AS INTEGER), 1) || {_RANKS_SQL}[l_partkey % 13 + 1]) END"""


@register("c02_lead", sql=f"""
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, {LEAD_SQL} AS raw FROM lineitem),
b AS (SELECT a.*, replace(raw, '10', 'T') AS x FROM a),
c AS (SELECT b.*, CASE WHEN position(substr(x, 1, 1) IN 'CDHS') = 0 THEN substr(x, 2, 1) || substr(x, 1, 1) ELSE x END AS sw FROM b)
SELECT l_orderkey, l_linenumber, l_partkey, raw,
  CASE WHEN x IS NOT NULL AND length(x) = 2 AND position(substr(sw, 1, 1) IN 'CDHS') > 0
            AND position(substr(sw, 2, 1) IN 'AKQJT98765432') > 0 THEN sw END AS OpeningLead FROM c""")
def c02_lead(spark, d):
    li = Tables(spark, d).lineitem
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", lead_text().alias("raw"))
    return li.withColumn("OpeningLead", CT.normalise_lead("raw"))


# --- strict map (C3) and enum (C27) -------------------------------------------------

# fixed values: priority text -> dealer direction (test binding)
_DEALER_MAP = {"1-URGENT": "N", "2-HIGH": "E", "3-MEDIUM": "S", "4-NOT SPECIFIED": "W", "5-LOW": "N"}


@register("c03_strict_map", sql="""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'N' WHEN '2-HIGH' THEN 'E' WHEN '3-MEDIUM' THEN 'S'
  WHEN '4-NOT SPECIFIED' THEN 'W' WHEN '5-LOW' THEN 'N' END AS Dealer FROM orders""")
def c03_strict_map(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", CT.strict_map("o_orderpriority", _DEALER_MAP, "dealer").alias("Dealer"))


@register("c27_enum", sql="""
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status_code
FROM orders""")
def c27_enum(spark, d):
    o = Tables(spark, d).orders
    code = CT.strict_map("o_orderstatus", {"F": "0", "O": "1", "P": "2"}, "status").cast("int")
    return o.select("o_orderkey", "o_orderstatus", code.alias("status_code"))


# --- keys and labels (C10, C11, C14, C15, C24, C25) ---------------------------------

@register("c10_key", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_orderkey AS VARCHAR) || '_' ||
  CASE WHEN length(CAST(l_partkey % 200 AS VARCHAR)) >= 2 THEN CAST(l_partkey % 200 AS VARCHAR)
       ELSE lpad(CAST(l_partkey % 200 AS VARCHAR), 2, '0') END AS HandRecordBoard FROM lineitem""")
def c10_key(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return li.withColumn("HandRecordBoard", K.board_key("l_orderkey", F.col("l_partkey") % 200, 2))


@register("c26_label", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, chr(CAST(65 + l_suppkey % 26 AS INTEGER)) || CASE WHEN l_partkey % 120 < 10 THEN '0' ELSE '' END || CAST(l_partkey % 120 AS VARCHAR) AS label FROM lineitem""")
def c26_label(spark, d):
    """Section letter and pair number, padded to two digits."""
    li = Tables(spark, d).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", K.section_pair_label(F.char((65 + F.col("l_suppkey") % 26).cast("long")), F.col("l_partkey") % 120).alias("label"))


@register("c11_prefix", sql="""
WITH a AS (SELECT CAST(o_custkey AS VARCHAR) || '-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
    || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS board_result_id,
  l_partkey % 36 + 1 AS board_number FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
b AS (SELECT board_result_id, board_number, array_to_string(string_split(board_result_id, '-')[1:4], '-') AS section_id,
  array_to_string(string_split(board_result_id, '-')[1:3], '-') AS session_id FROM a)
SELECT board_result_id, section_id, session_id, array_to_string(string_split(session_id, '-')[1:2], '-') AS event_id,
  session_id || '-' || CAST(board_number - 1 AS VARCHAR) AS hand_record_id FROM b""")
def c11_prefix(spark, d):
    """Composite ids: section = first 4 dash parts of the result id, event = first 2 parts of the
    session id, hand record = session-(board-1)."""
    t = Tables(spark, d)
    li, o = t.lineitem, t.orders.select("o_orderkey", "o_custkey")
    a = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.concat_ws("-", "o_custkey", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("board_result_id"),
        (F.col("l_partkey") % 36 + 1).alias("board_number"))
    b = a.select("board_result_id", "board_number", K.dash_prefix("board_result_id", 4).alias("section_id"),
                 K.dash_prefix("board_result_id", 3).alias("session_id"))
    return b.select("board_result_id", "section_id", "session_id", K.dash_prefix("session_id", 2).alias("event_id"),
                    F.concat("session_id", F.lit("-"), (F.col("board_number") - 1).cast("string")).alias("hand_record_id"))


@register("c14_pair_id", sql=f"""
WITH s AS ({SEAT_ROWS_SQL})
SELECT session_id, Board, Round, l_orderkey,
  CASE WHEN Player_ID_N IS NOT NULL AND Player_ID_S IS NOT NULL THEN
    CAST(least(Player_ID_N, Player_ID_S) AS VARCHAR) || '-' || CAST(greatest(Player_ID_N, Player_ID_S) AS VARCHAR) END AS Pair_IDs_NS_elo,
  CAST(least(Player_ID_E, Player_ID_W) AS VARCHAR) || '-' || CAST(greatest(Player_ID_E, Player_ID_W) AS VARCHAR) AS Pair_IDs_EW_pred
FROM s""")
def c14_pair_id(spark, d):
    s = seat_rows(Tables(spark, d))
    return s.select("session_id", "Board", "Round", "l_orderkey",
                    K.numeric_pair_id("Player_ID_N", "Player_ID_S", "null").alias("Pair_IDs_NS_elo"),
                    K.numeric_pair_id("Player_ID_E", "Player_ID_W", "skip").alias("Pair_IDs_EW_pred"))


@register("c15_suffix", sql="""
WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || ' (swap names)' ELSE c_name END AS raw FROM customer)
SELECT c_custkey, raw, regexp_replace(raw, '\\s*\\(swap names\\)$', '') AS name FROM a""")
def c15_suffix(spark, d):
    c = Tables(spark, d).customer
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(" (swap names)"))).otherwise(F.col("c_name"))
    a = c.select("c_custkey", raw.alias("raw"))
    return a.withColumn("name", K.strip_suffix("raw", r"\s*\(swap names\)$"))


@register("c24_format", sql="""
SELECT o_orderkey, printf('%.1f', c_acctbal / 9999.0 * 100) || '%' AS pct_text, substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 10) AS day
FROM orders JOIN customer ON o_custkey = c_custkey""")
def c24_format(spark, d):
    t = Tables(spark, d)
    o, c = t.orders, t.customer
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select("o_orderkey",
                    F.concat(F.format_string("%.1f", F.col("c_acctbal") / 9999.0 * 100), F.lit("%")).alias("pct_text"),
                    K.date_prefix(F.to_date("o_orderdate")).alias("day"))


@register("c25_url", sql="""
SELECT c_custkey, 'https://results.example.org/club/' || CAST(c_nationkey AS VARCHAR) || '/player/' || CAST(c_custkey AS VARCHAR) AS url,
  replace(c_name, '#', ' no. ') AS label FROM customer""")
def c25_url(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", F.concat(F.lit("https://results.example.org/club/"), F.col("c_nationkey").cast("string"),
                                          F.lit("/player/"), F.col("c_custkey").cast("string")).alias("url"),
                    F.replace(F.col("c_name"), F.lit("#"), F.lit(" no. ")).alias("label"))


# --- JSON pair (C12), safe casts (C13) ----------------------------------------------

def pair_json_text() -> Column:
    c, k = F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    n = F.col("o_orderkey") % 4
    txt = (F.when(n == 0, F.lit("[]"))
           .when(n == 1, F.concat(F.lit('["'), c, F.lit('"]')))
           .when(n == 2, F.concat(F.lit('["'), c, F.lit('","'), k, F.lit('"]')))
           .otherwise(F.concat(F.lit('["'), c, F.lit('","'), k, F.lit('","x"]'))))
    return F.when(F.col("o_orderkey") % 11 == 0, F.lit(None).cast("string")).otherwise(txt)


PAIR_JSON_SQL = """CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN '[]'
  WHEN o_orderkey % 4 = 1 THEN '["' || CAST(o_custkey AS VARCHAR) || '"]'
  WHEN o_orderkey % 4 = 2 THEN '["' || CAST(o_custkey AS VARCHAR) || '","' || CAST(o_orderkey AS VARCHAR) || '"]'
  ELSE '["' || CAST(o_custkey AS VARCHAR) || '","' || CAST(o_orderkey AS VARCHAR) || '","x"]' END"""


@register("c12_json_pair", sql=f"""
WITH a AS (SELECT o_orderkey, {PAIR_JSON_SQL} AS pair_ids_json FROM orders),
b AS (SELECT a.*, (coalesce(from_json(pair_ids_json, '["VARCHAR"]'), []::VARCHAR[]) || [NULL::VARCHAR, NULL::VARCHAR])[1:2] AS p FROM a)
SELECT o_orderkey, pair_ids_json, p[1] AS Player_ID_A, p[2] AS Player_ID_B FROM b""")
def c12_json_pair(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", pair_json_text().alias("pair_ids_json"))
    p = CO.pad_to(CO.json_string_array("pair_ids_json"), 2)
    return o.select("o_orderkey", "pair_ids_json", F.get(p, 0).alias("Player_ID_A"), F.get(p, 1).alias("Player_ID_B"))


@register("c13_safe_cast", sql="""
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_linenumber = 7 THEN 'PASS' WHEN l_partkey % 17 = 0 THEN 'n/a'
       ELSE CAST(CAST(trunc(l_extendedprice) AS BIGINT) % 2000 - 1000 AS VARCHAR) END AS score_text,
  CAST(l_discount * 100 AS VARCHAR) AS pct_text FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, score_text,
  CASE WHEN upper(trim(score_text)) = 'PASS' THEN 0 ELSE TRY_CAST(trim(score_text) AS INTEGER) END AS Score,
  CAST(TRY_CAST(pct_text AS DOUBLE) / 100.0 AS FLOAT) AS Pct FROM a""")
def c13_safe_cast(spark, d):
    li = Tables(spark, d).lineitem
    score_text = (F.when(F.col("l_linenumber") == 7, F.lit("PASS")).when(F.col("l_partkey") % 17 == 0, F.lit("n/a"))
                  .otherwise((F.col("l_extendedprice").cast("long") % 2000 - 1000).cast("string")))
    a = li.select("l_orderkey", "l_linenumber", "l_partkey", score_text.alias("score_text"),
                  (F.col("l_discount") * 100).cast("string").alias("pct_text"))
    return a.select("l_orderkey", "l_linenumber", "l_partkey", "score_text",
                    CT.safe_score("score_text").alias("Score"), CT.percent_fraction("pct_text").alias("Pct"))


# --- strata (C16) -------------------------------------------------------------------

def strata_text() -> Column:
    b = F.abs(F.col("c_acctbal")).cast("int")
    k = F.col("c_custkey") % 8
    comma = F.when(b >= 1000, F.concat((b / 1000).cast("int").cast("string"), F.lit(","),
                                       F.lpad((b % 1000).cast("string"), 3, "0"))).otherwise(b.cast("string"))
    return (F.when(k == 0, F.concat(F.lit("MP Limits: "), b.cast("string"), F.lit("/500")))
            .when(k == 1, F.lit("NLM"))
            .when(k == 2, F.concat(F.lit("0-"), (b % 2000).cast("string")))
            .when(k == 3, F.concat(F.lit("None/"), (b % 1000).cast("string")))
            .when(k == 4, F.lit(None).cast("string"))
            .when(k == 5, F.concat(F.lit("NLM/0-"), (b % 800).cast("string")))
            .when(k == 6, comma)
            .otherwise(F.lit("")))


_B = "CAST(trunc(abs(c_acctbal)) AS INTEGER)"
STRATA_SQL = f"""CASE c_custkey % 8 WHEN 0 THEN 'MP Limits: ' || CAST({_B} AS VARCHAR) || '/500' WHEN 1 THEN 'NLM'
  WHEN 2 THEN '0-' || CAST({_B} % 2000 AS VARCHAR) WHEN 3 THEN 'None/' || CAST({_B} % 1000 AS VARCHAR)
  WHEN 4 THEN NULL WHEN 5 THEN 'NLM/0-' || CAST({_B} % 800 AS VARCHAR)
  WHEN 6 THEN CASE WHEN {_B} >= 1000 THEN CAST({_B} // 1000 AS VARCHAR) || ',' || lpad(CAST({_B} % 1000 AS VARCHAR), 3, '0')
              ELSE CAST({_B} AS VARCHAR) END
  ELSE '' END"""


def _parse_int_sql(t: str) -> str:
    return (f"(CASE WHEN trim({t}) IS NULL OR trim({t}) = '' OR lower(trim({t})) = 'none' THEN NULL "
            f"ELSE TRY_CAST(NULLIF(regexp_extract(replace(trim({t}), ',', ''), '(\\d+)', 1), '') AS INTEGER) END)")


def _bucket_sql(top: str, nlm: str) -> str:
    return (f"CASE WHEN {top} IS NULL AND NOT {nlm} THEN 'open' WHEN {nlm} AND ({top} IS NULL OR {top} <= 500) THEN '0-499-nlm' "
            f"WHEN {top} IS NULL THEN 'other-restricted' WHEN {top} <= 300 THEN '0-299' WHEN {top} <= 500 THEN '0-499-nlm' "
            f"WHEN {top} <= 750 THEN '0-749' WHEN {top} <= 1500 THEN '0-1500' ELSE 'other-restricted' END")


_PV = lambda p: f"(CASE WHEN starts_with(upper({p}), '0-') THEN {_parse_int_sql(f'substr({p}, 3)')} ELSE {_parse_int_sql(p)} END)"


@register("c16_strata", sql=f"""
WITH a AS (SELECT c_custkey, {STRATA_SQL} AS mp_limit FROM customer),
b AS (SELECT a.*, trim(regexp_replace(trim(mp_limit), '^MP\\s*Limits:\\s*', '', 'i')) AS ctext, trim(mp_limit) AS ttext FROM a),
c AS (SELECT b.*,
  CASE WHEN mp_limit IS NULL OR ctext = '' THEN NULL ELSE {_parse_int_sql("split_part(ctext, '/', 1)")} END AS club_top,
  CASE WHEN ttext IS NULL OR ttext = '' OR lower(ttext) = 'none' THEN FALSE ELSE starts_with(upper(ttext), 'NLM') END AS is_nlm,
  CASE WHEN ttext IS NULL OR ttext = '' OR lower(ttext) = 'none' THEN NULL
       WHEN position('/' IN ttext) > 0 THEN {_PV("list_filter(list_reverse(string_split(ttext, '/')), lambda p: upper(p) <> 'NLM' AND (starts_with(upper(p), '0-') OR " + _parse_int_sql('p') + " IS NOT NULL))[1]")}
       WHEN upper(ttext) = 'NLM' THEN 500
       WHEN starts_with(upper(ttext), '0-') THEN {_parse_int_sql('substr(ttext, 3)')}
       ELSE {_parse_int_sql('ttext')} END AS tournament_top FROM b)
SELECT c_custkey, mp_limit, club_top, {_bucket_sql('club_top', 'FALSE')} AS club_bucket, tournament_top, is_nlm,
  {_bucket_sql('tournament_top', 'is_nlm')} AS tournament_bucket FROM c""")
def c16_strata(spark, d):
    c = Tables(spark, d).customer.select("c_custkey", strata_text().alias("mp_limit"))
    club_top = CT.club_top_limit("mp_limit")
    t_top, is_nlm = CT.tournament_top_limit("mp_limit")
    return c.select("c_custkey", "mp_limit", club_top.alias("club_top"),
                    CT.strata_bucket(club_top).alias("club_bucket"), t_top.alias("tournament_top"),
                    is_nlm.alias("is_nlm"), CT.strata_bucket(t_top, is_nlm).alias("tournament_bucket"))


# --- dates (C17) and coercion (C18) -------------------------------------------------

def date_text() -> Column:
    k = F.col("o_orderkey") % 5
    return (F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
            .when(k == 1, F.date_format("o_orderdate", "MM/dd/yyyy"))
            .when(k == 2, F.date_format("o_orderdate", "yyyyMMdd"))
            .when(k == 3, F.date_format("o_orderdate", "yyyyMMddHH:mm"))
            .otherwise(F.lit("n/a")))


DATE_TEXT_SQL = """CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
  WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') WHEN 3 THEN strftime(o_orderdate, '%Y%m%d%H:%M') ELSE 'n/a' END"""
PARSE_DATE_SQL = """CAST(coalesce(try_strptime(date_text, '%Y-%m-%d'), try_strptime(date_text, '%m/%d/%Y'),
  try_strptime(date_text, '%Y%m%d'), try_strptime(date_text, '%Y%m%d%H:%M')) AS DATE)"""


@register("c17_dates", sql=f"""
WITH a AS (SELECT o_orderkey, {DATE_TEXT_SQL} AS date_text FROM orders)
SELECT o_orderkey, date_text, {PARSE_DATE_SQL} AS game_date FROM a""")
def c17_dates(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", date_text().alias("date_text"))
    return o.withColumn("game_date", F.to_date(CO.lenient_timestamp("date_text")))


def coerce_input() -> Column:
    k = F.col("c_custkey") % 6
    ck = F.col("c_custkey").cast("string")
    return (F.when(k == 0, ck).when(k == 1, F.concat(F.lit("+"), ck)).when(k == 2, F.lit("true"))
            .when(k == 3, F.lit("")).when(k == 4, F.concat(ck, F.lit("-1"))).otherwise(F.lit(None).cast("string")))


_CIN = """CASE c_custkey % 6 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN '+' || CAST(c_custkey AS VARCHAR) WHEN 2 THEN 'true'
  WHEN 3 THEN '' WHEN 4 THEN CAST(c_custkey AS VARCHAR) || '-1' ELSE NULL END"""


def _int_coerce_sql(s: str, nullable: bool) -> str:
    empty = "NULL" if nullable else "''"
    return (f"CASE WHEN {s} IS NULL OR {s} = '' THEN {empty} WHEN lower({s}) = 'true' THEN '1' WHEN lower({s}) = 'false' THEN '0' "
            f"WHEN regexp_matches({s}, '^[+-]?\\d+$') THEN CAST(TRY_CAST({s} AS BIGINT) AS VARCHAR) ELSE {s} END")


@register("c18_coerce", sql=f"""
WITH a AS (SELECT c_custkey, {_CIN} AS raw, CASE WHEN c_custkey % 5 = 0 THEN 'abc' ELSE CAST(c_acctbal AS VARCHAR) END AS raw_real FROM customer)
SELECT c_custkey, raw, {_int_coerce_sql('raw', True)} AS as_int_nullable, {_int_coerce_sql('raw', False)} AS as_int_not_null,
  CASE WHEN raw_real IS NULL OR raw_real = '' THEN NULL WHEN TRY_CAST(raw_real AS DOUBLE) IS NOT NULL
       THEN CAST(TRY_CAST(raw_real AS DOUBLE) AS VARCHAR) ELSE raw_real END AS as_real,
  coalesce(raw, '') AS as_text_not_null FROM a""")
def c18_coerce(spark, d):
    c = Tables(spark, d).customer
    a = c.select("c_custkey", coerce_input().alias("raw"),
                 F.when(F.col("c_custkey") % 5 == 0, F.lit("abc")).otherwise(F.col("c_acctbal").cast("string")).alias("raw_real"))
    return a.select("c_custkey", "raw", CO.coerce_text("raw", "INTEGER", True).alias("as_int_nullable"),
                    CO.coerce_text("raw", "INTEGER", False).alias("as_int_not_null"),
                    CO.coerce_text("raw_real", "REAL", True).alias("as_real"),
                    CO.coerce_text("raw", "VARCHAR", False).alias("as_text_not_null"))


@register("f13_lenient_dates", sql=f"""
WITH a AS (SELECT o_orderkey, {DATE_TEXT_SQL} AS date_text FROM orders), b AS (SELECT a.*, {PARSE_DATE_SQL} AS dt FROM a)
SELECT o_orderkey, date_text FROM b WHERE dt IS NULL OR (dt >= DATE '1997-01-01' AND dt < DATE '1999-01-01')""")
def f13_lenient_dates(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", date_text().alias("date_text"))
    return o.where(CO.lenient_date_in_range("date_text", "1997-01-01", "1999-01-01"))
