"""Hand-record queries (C4-C9, C29-C31, A24, F8) over deals generated from ``part``.

Deal rule (fixed, same in Spark and SQL): card c = 13*suit + rank (suits S,H,D,C; ranks
A..2) goes to hand ((7*c + p_partkey) mod 52) div 13 (N,E,S,W).  7 is coprime to 52, so every
hand gets 13 cards.  Some parts are corrupted on purpose for the validator: p%10=0 copies
north's clubs to west, p%10=5 appends an illegal 'Z' to north's hearts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import handrec as H
from ..functions import scoring as S
from ..operators import relational as R
from .q_scalar import CONTRACT_SQL, DECLARER_SQL, _C0, contract_text, declarer_text
from ..functions import contract as CT
from ..session import materialize
from .registry import Tables, register
from .util import r, rounded

_RAW_RANKS = ["A", "K", "Q", "J", "10", "9", "8", "7", "6", "5", "4", "3", "2"]
_HAND_IDX = {"north": 0, "east": 1, "south": 2, "west": 3}
_SUIT_IDX = {"spades": 0, "hearts": 1, "diamonds": 2, "clubs": 3}


def _holding(hand: str, suit: str) -> Column:
    h, s = _HAND_IDX[hand], _SUIT_IDX[suit]
    ranks = F.array(*[F.lit(x) for x in _RAW_RANKS])
    p = F.col("p_partkey")
    sel = F.filter(F.sequence(F.lit(0), F.lit(12)),
                   lambda r_: F.floor(((F.lit(7) * (F.lit(13 * s) + r_) + p) % 52) / 13) == h)
    txt = F.array_join(F.transform(sel, lambda r_: F.element_at(ranks, r_ + 1)), " ")
    return F.when(txt == "", F.lit("-")).otherwise(txt)


#: Parts that a task deals: a part is a few bytes in its file and some milliseconds of text work.
TASK_PARTS = 10_000


def raw_hand_records(t: Tables) -> DataFrame:
    """Tournament-style raw hand records: 16 suit columns + board/vul/dealer text per part."""
    p = t.part.select("p_partkey", "p_size")
    n = -(-p.count() // TASK_PARTS)
    if n > 1:  # the file is small, so its scan is few tasks; written, as filters on the dealt text would pass a mere shuffle
        p = materialize(p.repartition(n), "parts")
    cols = {f"{h}_{s}": _holding(h, s) for h in _HAND_IDX for s in _SUIT_IDX}
    out = p.select("p_partkey", "p_size", *[v.alias(k) for k, v in cols.items()])
    k = F.col("p_partkey") % 10
    out = (out.withColumn("west_clubs", F.when(k == 0, F.col("north_clubs")).otherwise(F.col("west_clubs")))
              .withColumn("north_hearts", F.when(k == 5, F.concat(F.col("north_hearts"), F.lit(" Z")))
                          .otherwise(F.col("north_hearts"))))
    board = F.col("p_partkey") % 300 + 1
    vul = F.when(F.col("p_partkey") % 9 == 0, H.vul_from_board(board + 1)).otherwise(H.vul_from_board(board))
    return out.withColumn("Board", board.cast("int")).withColumn("Vul", vul)


def _holding_sql(hand: str, suit: str) -> str:
    h, s = _HAND_IDX[hand], _SUIT_IDX[suit]
    ranks = "[" + ",".join(f"'{x}'" for x in _RAW_RANKS) + "]"
    txt = (f"array_to_string(list_transform(list_filter(range(0, 13), lambda r: ((7 * ({13 * s} + r) + p_partkey) % 52) // 13 = {h}), "
           f"lambda r: {ranks}[r + 1]), ' ')")
    return f"CASE WHEN {txt} = '' THEN '-' ELSE {txt} END"


_VUL_SQL = "['None','NS','EW','Both'][CAST((({b} - 1) + floor(({b} - 1) / 4)) % 4 AS INTEGER) + 1]"


def _vul_sql(b: str) -> str:
    return _VUL_SQL.format(b=b)


_RAW0 = ", ".join(f"{_holding_sql(h, s)} AS {h}_{s}" for h in _HAND_IDX for s in _SUIT_IDX)
RAW_HR_SQL = f"""
SELECT p_partkey, p_size, {", ".join(f"{h}_{s}" for h in _HAND_IDX for s in _SUIT_IDX if (h, s) not in (("west", "clubs"), ("north", "hearts")))},
  CASE WHEN p_partkey % 10 = 0 THEN north_clubs ELSE west_clubs END AS west_clubs,
  CASE WHEN p_partkey % 10 = 5 THEN north_hearts || ' Z' ELSE north_hearts END AS north_hearts,
  CAST(p_partkey % 300 + 1 AS INTEGER) AS Board,
  CASE WHEN p_partkey % 9 = 0 THEN {_vul_sql('(p_partkey % 300 + 2)')} ELSE {_vul_sql('(p_partkey % 300 + 1)')} END AS Vul
FROM (SELECT p_partkey, p_size, {_RAW0} FROM part)"""

_BRS_PARTS = " || ".join(f"'{letter}' || coalesce({h}_{s}, '')" for h in H.BRS_HAND_ORDER
                         for letter, s in zip(H.SUIT_LETTERS, H.SUIT_NAMES))
BRS_SQL = f"replace(regexp_replace({_BRS_PARTS}, '[ \\-]', '', 'g'), '10', 'T')"
_HP = "S([^SHDC]*)H([^SHDC]*)D([^SHDC]*)C([^SHDC]*)"
VALID_SQL = (f"coalesce(regexp_full_match(brs, '^(S[AKQJT2-9]*H[AKQJT2-9]*D[AKQJT2-9]*C[AKQJT2-9]*){{4}}$') "
             f"AND len(regexp_extract_all(brs, 'S[^S]*')) = 4 "
             f"AND list_bool_and(list_transform(regexp_extract_all(brs, 'S[^S]*'), lambda h: length(regexp_replace(h, '[SHDC]', '', 'g')) = 13)) "
             + " ".join(f"AND length(array_to_string(regexp_extract_all(brs, '{_HP}', {i}), '')) = 13 "
                        f"AND len(list_distinct(string_split(array_to_string(regexp_extract_all(brs, '{_HP}', {i}), ''), ''))) = 13"
                        for i in range(1, 5)) + ", FALSE)")


def _pbn_sql() -> str:
    def hand(k: int) -> str:
        return " || '.' || ".join(f"regexp_extract_all(brs, '{_HP}', {i})[{k + 1}]" for i in range(1, 5))
    return f"'N:' || {hand(0)} || ' ' || {hand(2)} || ' ' || {hand(3)} || ' ' || {hand(1)}"


def brs_frame(t: Tables) -> DataFrame:
    hr = raw_hand_records(t)
    cols = {h: {s: f"{h}_{s}" for s in H.SUIT_NAMES} for h in H.BRS_HAND_ORDER}
    return hr.select("p_partkey", "Board", "Vul", H.deal_string(cols).alias("brs"))


@register("c05_deal_string", sql=f"SELECT p_partkey, {BRS_SQL} AS brs FROM ({RAW_HR_SQL})")
def c05_deal_string(spark, d):
    return brs_frame(Tables(spark, d)).select("p_partkey", "brs")


@register("c06_deal_valid", sql=f"""
WITH b AS (SELECT p_partkey, {BRS_SQL} AS brs FROM ({RAW_HR_SQL}))
SELECT p_partkey, brs, {VALID_SQL} AS valid FROM b""")
def c06_deal_valid(spark, d):
    b = brs_frame(Tables(spark, d))
    return b.select("p_partkey", "brs", H.deal_is_valid("brs").alias("valid"))


_PBN_FRAME_SQL = f"""
WITH b AS (SELECT p_partkey, Board, Vul, {BRS_SQL} AS brs FROM ({RAW_HR_SQL}))
SELECT p_partkey, Board, Vul, {_pbn_sql()} AS PBN FROM b WHERE {VALID_SQL}"""


def pbn_frame(t: Tables) -> DataFrame:
    b = brs_frame(t)
    return b.where(H.deal_is_valid("brs")).select("p_partkey", "Board", "Vul", H.brs_to_pbn("brs").alias("PBN"))


@register("c07_pbn", sql=f"SELECT p_partkey, PBN FROM ({_PBN_FRAME_SQL})")
def c07_pbn(spark, d):
    return pbn_frame(Tables(spark, d)).select("p_partkey", "PBN")


def _feat_sql(h: str) -> str:
    of: dict[str, list[str]] = {f: [] for f in H.FEATURES}
    for i in range(4):
        s = f"string_split({h}, '.')[{i + 1}]"
        n = f"length({s})"
        a, k, q = (f"(position('{c}' IN {s}) > 0)" for c in "AKQ")
        hcp = " + ".join(f"{v} * (length({s}) - length(replace({s}, '{c}', '')))" for c, v in zip("AKQJ", (4, 3, 2, 1)))
        of["HCP"].append(f"({hcp})")
        of["SL"].append(n)
        of["DP"].append(f"greatest(0, 3 - {n})")
        of["QT"].append(f"CAST(CASE WHEN {a} AND {k} THEN 2.0 WHEN {a} AND {q} THEN 1.5 WHEN {a} THEN 1.0 "
                        f"WHEN {k} AND {q} THEN 1.0 WHEN {k} AND {n} >= 2 THEN 0.5 ELSE 0.0 END AS DOUBLE)")
        of["LTC"].append(f"(least({n}, 3) - CAST({a} AS INTEGER) - CAST({k} AND {n} >= 2 AS INTEGER) "
                         f"- CAST({q} AND {n} >= 3 AS INTEGER))")
    every = {f: " + ".join(x) for f, x in of.items()} | {f"{f}_{c}": x[i] for f, x in of.items() for i, c in enumerate(H.SUIT_LETTERS)}
    return ", ".join(f"{every[c]} AS {c}" for c in H.FEATURE_COLUMNS)


_PAIR_FEAT_SQL = ", ".join(f"CAST(sum({c}) AS {'DOUBLE' if c.startswith('QT') else 'BIGINT'}) AS {c}" for c in H.FEATURE_COLUMNS)


@register("c29_hand_features", sql=f"""
WITH p AS (SELECT *, row_number() OVER () AS deal FROM ({_PBN_FRAME_SQL})),
h AS (SELECT deal, p_partkey, unnest(['N','E','S','W']) AS Seat, unnest(string_split(substr(PBN, 3), ' ')) AS hand FROM p),
f AS (SELECT deal, p_partkey, Seat, {_feat_sql('hand')} FROM h)
SELECT * EXCLUDE (deal) FROM f
UNION ALL SELECT p_partkey, CASE WHEN Seat IN ('N', 'S') THEN 'NS' ELSE 'EW' END AS Seat, {_PAIR_FEAT_SQL} FROM f GROUP BY deal, p_partkey, 2""")
def c29_hand_features(spark, d):
    """Hand features of every seat and pair, in all and by suit."""
    return pbn_frame(Tables(spark, d)).select("p_partkey", F.inline(H.deal_features("PBN")))


# --- makes (C8) and par (C9) ---------------------------------------------------------

def _makes_text(side: str, mul: int) -> Column:
    p = F.col("p_partkey")
    toks = []
    for i, st in enumerate("CDHSN"):
        ne = (p * mul + i * 3) % 14
        sw = (p * (mul + 6) + i) % 14
        f = (p + i) % 4
        letter = F.when((p + i) % 2 == 0, F.lit("NT")).otherwise(F.lit("N")) if st == "N" else F.lit(st)
        trick = F.concat(letter, ne.cast("string"))
        level = F.when(ne >= 6, F.concat((ne - 6).cast("string"), letter)).otherwise(trick)
        split_t = F.concat(letter, ne.cast("string"), F.lit("/"), sw.cast("string"))
        split_l = F.when((ne >= 6) & (sw >= 6), F.concat((ne - 6).cast("string"), F.lit("/"), (sw - 6).cast("string"), letter)).otherwise(split_t)
        toks.append(F.when(f == 0, trick).when(f == 1, level).when(f == 2, split_t).otherwise(split_l))
    sep = F.when(p % 7 == 0, F.lit("  ")).otherwise(F.lit(" "))
    return F.concat(F.lit(f"{side}:"), F.lit(" "), F.concat_ws(" ", *toks[:2]), sep, F.concat_ws(" ", *toks[2:]))


def _makes_sql(side: str, mul: int) -> str:
    toks = []
    for i, st in enumerate("CDHSN"):
        ne = f"((p_partkey * {mul} + {i * 3}) % 14)"
        sw = f"((p_partkey * {mul + 6} + {i}) % 14)"
        letter = f"(CASE WHEN (p_partkey + {i}) % 2 = 0 THEN 'NT' ELSE 'N' END)" if st == "N" else f"'{st}'"
        trick = f"{letter} || CAST({ne} AS VARCHAR)"
        level = f"(CASE WHEN {ne} >= 6 THEN CAST({ne} - 6 AS VARCHAR) || {letter} ELSE {trick} END)"
        split_t = f"{letter} || CAST({ne} AS VARCHAR) || '/' || CAST({sw} AS VARCHAR)"
        split_l = (f"(CASE WHEN {ne} >= 6 AND {sw} >= 6 THEN CAST({ne} - 6 AS VARCHAR) || '/' || CAST({sw} - 6 AS VARCHAR) || {letter} "
                   f"ELSE {split_t} END)")
        toks.append(f"(CASE (p_partkey + {i}) % 4 WHEN 0 THEN {trick} WHEN 1 THEN {level} WHEN 2 THEN {split_t} ELSE {split_l} END)")
    sep = "(CASE WHEN p_partkey % 7 = 0 THEN '  ' ELSE ' ' END)"
    return f"'{side}: ' || {toks[0]} || ' ' || {toks[1]} || {sep} || {toks[2]} || ' ' || {toks[3]} || ' ' || {toks[4]}"


_MAKES_TOKEN_SQL = """
SELECT p_partkey, side, tok,
  CASE WHEN regexp_full_match(tok, '([CDHSN])(\\d+)') THEN regexp_extract(tok, '^([CDHSN])(\\d+)$', 1)
       WHEN regexp_full_match(tok, '(\\d+)([CDHSN])') THEN regexp_extract(tok, '^(\\d+)([CDHSN])$', 2)
       WHEN regexp_full_match(tok, '([CDHSN])(\\d+)/(\\d+)') THEN regexp_extract(tok, '^([CDHSN])(\\d+)/(\\d+)$', 1)
       ELSE regexp_extract(tok, '^(\\d+)/(\\d+)([CDHSN])$', 3) END AS strain,
  CASE WHEN regexp_full_match(tok, '([CDHSN])(\\d+)') THEN CAST(regexp_extract(tok, '^([CDHSN])(\\d+)$', 2) AS INTEGER)
       WHEN regexp_full_match(tok, '(\\d+)([CDHSN])') THEN CAST(regexp_extract(tok, '^(\\d+)([CDHSN])$', 1) AS INTEGER) + 6
       WHEN regexp_full_match(tok, '([CDHSN])(\\d+)/(\\d+)') THEN CAST(regexp_extract(tok, '^([CDHSN])(\\d+)/(\\d+)$', 2) AS INTEGER)
       ELSE CAST(regexp_extract(tok, '^(\\d+)/(\\d+)([CDHSN])$', 1) AS INTEGER) + 6 END AS t1,
  CASE WHEN regexp_full_match(tok, '([CDHSN])(\\d+)') THEN CAST(regexp_extract(tok, '^([CDHSN])(\\d+)$', 2) AS INTEGER)
       WHEN regexp_full_match(tok, '(\\d+)([CDHSN])') THEN CAST(regexp_extract(tok, '^(\\d+)([CDHSN])$', 1) AS INTEGER) + 6
       WHEN regexp_full_match(tok, '([CDHSN])(\\d+)/(\\d+)') THEN CAST(regexp_extract(tok, '^([CDHSN])(\\d+)/(\\d+)$', 3) AS INTEGER)
       ELSE CAST(regexp_extract(tok, '^(\\d+)/(\\d+)([CDHSN])$', 2) AS INTEGER) + 6 END AS t2
FROM (SELECT p_partkey, side, unnest(string_split(replace(replace(txt, 'NT', 'N'), '  ', ' '), ' ')[2:6]) AS tok FROM m)"""


@register("c08_makes", sql=f"""
WITH m AS (SELECT p_partkey, 'NS' AS side, {_makes_sql('NS', 3)} AS txt FROM part
           UNION ALL SELECT p_partkey, 'EW', {_makes_sql('EW', 5)} FROM part),
t AS ({_MAKES_TOKEN_SQL})
SELECT p_partkey, substr(side, 1, 1) AS seat, strain, t1 AS tricks FROM t
UNION ALL SELECT p_partkey, substr(side, 2, 1), strain, t2 FROM t""")
def c08_makes(spark, d):
    p = Tables(spark, d).part.select("p_partkey")
    texts = p.select("p_partkey", F.explode(F.array(_makes_text("NS", 3), _makes_text("EW", 5))).alias("txt"))
    parsed = texts.select("p_partkey", F.explode(H.parse_makes("txt")).alias("m"))
    return parsed.select("p_partkey", "m.seat", "m.strain", "m.tricks")


def _par_text() -> Column:
    p = F.col("p_partkey")
    score = ((p * 37) % 21 - 10) * 50
    items = []
    for i in range(3):
        q = p + i
        lvl = (1 + q % 7).cast("string")
        strain = F.element_at(F.array(*[F.lit(x) for x in ["C", "D", "H", "S", "NT"]]), (q % 5 + 1).cast("int"))
        stars = F.repeat(F.lit("*"), (q % 3).cast("int"))
        dirn = F.element_at(F.array(*[F.lit(x) for x in ["NS", "EW", "N", "E", "S", "W"]]), (q % 6 + 1).cast("int"))
        res = F.element_at(F.array(F.lit(""), F.lit("-2"), F.lit("+1")), (q % 3 + 1).cast("int"))
        items.append(F.concat(lvl, strain, stars, F.lit("-"), dirn, res))
    n = p % 3 + 1
    contracts = F.when(n == 1, items[0]).when(n == 2, F.concat_ws("/", *items[:2])).otherwise(F.concat_ws("/", *items))
    return F.when(score == 0, F.lit("Par: 0 PASS")).otherwise(
        F.concat(F.lit("Par: "), score.cast("string"), F.lit(" "), contracts))


def _par_sql() -> str:
    items = []
    for i in range(3):
        q = f"(p_partkey + {i})"
        items.append(f"CAST(1 + {q} % 7 AS VARCHAR) || ['C','D','H','S','NT'][{q} % 5 + 1] || repeat('*', CAST({q} % 3 AS INTEGER)) "
                     f"|| '-' || ['NS','EW','N','E','S','W'][{q} % 6 + 1] || ['', '-2', '+1'][{q} % 3 + 1]")
    contracts = (f"CASE p_partkey % 3 WHEN 0 THEN {items[0]} WHEN 1 THEN {items[0]} || '/' || {items[1]} "
                 f"ELSE {items[0]} || '/' || {items[1]} || '/' || {items[2]} END")
    score = "(((p_partkey * 37) % 21 - 10) * 50)"
    return f"CASE WHEN {score} = 0 THEN 'Par: 0 PASS' ELSE 'Par: ' || CAST({score} AS VARCHAR) || ' ' || {contracts} END"


_PAR_PAT = "^(\\d)([CDHSN])(\\**)-(NS|EW|[NSEW])([+\\-]\\d)?"
PAR_ROWS_SQL = f"""
WITH a AS (SELECT p_partkey, {_par_sql()} AS par FROM part),
b AS (SELECT p_partkey, CAST(string_split(par, ' ')[2] AS INTEGER) AS score, string_split(replace(string_split(par, ' ')[3], 'NT', 'N'), '/') AS items FROM a),
c AS (SELECT p_partkey, score, CASE WHEN score = 0 THEN [''] ELSE items END AS items FROM b),
d AS (SELECT p_partkey, score, unnest(items) AS x, unnest(generate_series(1, len(items))) AS idx FROM c)
SELECT p_partkey, score, idx,
  CASE WHEN score = 0 THEN 0 ELSE CAST(regexp_extract(x, '{_PAR_PAT}', 1) AS INTEGER) END AS level,
  CASE WHEN score = 0 THEN '' ELSE regexp_extract(x, '{_PAR_PAT}', 2) END AS strain,
  CASE WHEN score = 0 THEN '' ELSE regexp_extract(x, '{_PAR_PAT}', 3) END AS dbl,
  CASE WHEN score = 0 THEN '' ELSE regexp_extract(x, '{_PAR_PAT}', 4) END AS direction,
  CASE WHEN score = 0 OR regexp_extract(x, '{_PAR_PAT}', 5) = '' THEN 0 ELSE CAST(regexp_extract(x, '{_PAR_PAT}', 5) AS INTEGER) END AS result
FROM d"""


def par_rows(t: Tables) -> DataFrame:
    p = t.part.select("p_partkey", _par_text().alias("par"))
    parsed = p.select("p_partkey", H.parse_par("par").alias("pp"))
    return parsed.select("p_partkey", F.col("pp.score").alias("score"),
                         F.posexplode("pp.contracts").alias("pos", "c")).select(
        "p_partkey", "score", (F.col("pos") + 1).alias("idx"), "c.level", "c.strain", "c.dbl", "c.direction", "c.result")


@register("c09_par", sql=PAR_ROWS_SQL)
def c09_par(spark, d):
    return par_rows(Tables(spark, d))


@register("f08_vul_rule", sql=f"""
SELECT p_partkey, Board, Vul FROM ({RAW_HR_SQL}) WHERE Board <= 255 AND Vul = {_vul_sql('Board')}""")
def f08_vul_rule(spark, d):
    hr = raw_hand_records(Tables(spark, d)).select("p_partkey", "Board", "Vul")
    return hr.where(H.vul_rule_ok("Board", "Vul"))


@register("c04_board_rules", sql=f"""
SELECT p_partkey, Board, {_vul_sql('Board')} AS vul, substr('NESW', (Board - 1) % 4 + 1, 1) AS dealer FROM ({RAW_HR_SQL})""")
def c04_board_rules(spark, d):
    """Vulnerability and dealer that a board's number implies."""
    hr = raw_hand_records(Tables(spark, d))
    return hr.select("p_partkey", "Board", H.vul_from_board("Board").alias("vul"), H.dealer_from_board("Board").alias("dealer"))


# --- scoring (C30, C31, A24) ---------------------------------------------------------

def _score_sql(lv: str, st: str, db: str, vu: str, tr: str) -> str:
    mult = f"(CASE WHEN {db} = 'XX' THEN 4 WHEN {db} = 'X' THEN 2 ELSE 1 END)"
    base = f"((CASE WHEN {st} = 'N' THEN 40 + 30 * ({lv} - 1) ELSE (CASE WHEN {st} IN ('C','D') THEN 20 ELSE 30 END) * {lv} END) * {mult})"
    game = f"(CASE WHEN {base} >= 100 THEN (CASE WHEN {vu} THEN 500 ELSE 300 END) ELSE 50 END)"
    slam = f"(CASE WHEN {lv} = 6 THEN (CASE WHEN {vu} THEN 750 ELSE 500 END) WHEN {lv} = 7 THEN (CASE WHEN {vu} THEN 1500 ELSE 1000 END) ELSE 0 END)"
    insult = f"(CASE WHEN {db} = 'XX' THEN 100 WHEN {db} = 'X' THEN 50 ELSE 0 END)"
    ov = (f"(CASE WHEN {db} = '' THEN (CASE WHEN {st} IN ('C','D') THEN 20 ELSE 30 END) "
          f"ELSE (CASE WHEN {vu} THEN 200 ELSE 100 END) * ({mult} / 2) END)")
    made = f"({base} + {game} + {slam} + {insult} + ({tr} - {lv} - 6) * {ov})"
    u = f"({lv} + 6 - {tr})"
    dnv = f"(CASE WHEN {u} = 1 THEN 100 WHEN {u} = 2 THEN 300 WHEN {u} = 3 THEN 500 ELSE 500 + 300 * ({u} - 3) END)"
    dv = f"(200 + 300 * ({u} - 1))"
    down = f"(CASE WHEN {db} = '' THEN {u} * (CASE WHEN {vu} THEN 100 ELSE 50 END) ELSE (CASE WHEN {vu} THEN {dv} ELSE {dnv} END) * ({mult} / 2) END)"
    return f"CAST(CASE WHEN {lv} = 0 THEN 0 WHEN {tr} >= {lv} + 6 THEN {made} ELSE -{down} END AS INTEGER)"


_VULSIDE_SQL = ("(CASE WHEN Declarer IN ('N','S') THEN vul IN ('NS','Both') ELSE vul IN ('EW','Both') END)")


def _scored_contracts(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", contract_text().alias("raw"),
                   declarer_text().alias("Declarer"), (F.col("l_quantity").cast("int") % 14).alias("Tricks"))
    c = CT.normalise_contract(li, "raw", "Declarer", drop_invalid=True)
    c = c.where(F.col("Declarer").isNotNull())
    vul = H.vul_from_board(F.col("l_partkey") % 16 + 1)
    vul_side = F.when(F.col("Declarer").isin("N", "S"), vul.isin("NS", "Both")).otherwise(vul.isin("EW", "Both"))
    c = c.withColumn("Vul_Declarer", vul_side)
    return c.withColumn("Score", S.contract_score("BidLvl", F.coalesce("BidSuit", F.lit("")),
                                                   F.coalesce("Dbl", F.lit("")), "Vul_Declarer", "Tricks"))


_CONTRACTS_SQL = f"""
WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, {CONTRACT_SQL} AS raw, {DECLARER_SQL} AS Declarer,
                  CAST(l_quantity AS INTEGER) % 14 AS Tricks FROM lineitem),
c AS (SELECT b.*, {_C0} AS c FROM b),
p AS (SELECT c.*, CASE WHEN regexp_matches(c, '^\\d') THEN regexp_extract(c, '^(\\d)', 1) END AS lvl,
        CASE WHEN regexp_matches(c, '^\\d[CDHSN]') THEN regexp_extract(c, '^\\d([CDHSN])', 1) END AS BidSuit,
        CASE WHEN regexp_matches(c, '^\\d[CDHSN]') THEN regexp_extract(c, '^\\d[CDHSN](X*)', 1) END AS Dbl FROM c),
q AS (SELECT p.*, CASE WHEN c = 'PASS' THEN c ELSE lvl || BidSuit || Dbl || Declarer END AS Contract,
        coalesce(CAST(lvl AS INTEGER), 0) AS BidLvl, {_vul_sql('(l_partkey % 16 + 1)')} AS vul FROM p),
s AS (SELECT q.*, {_VULSIDE_SQL} AS Vul_Declarer FROM q WHERE NOT (Contract <> 'PASS' AND BidSuit IS NULL) AND Declarer IS NOT NULL)
SELECT s.*, {_score_sql('BidLvl', "coalesce(BidSuit, '')", "coalesce(Dbl, '')", 'Vul_Declarer', 'Tricks')} AS Score FROM s"""


@register("c30_score", sql=f"""
SELECT l_orderkey, l_linenumber, l_partkey, Contract, Tricks, Vul_Declarer, Score FROM ({_CONTRACTS_SQL})""")
def c30_score(spark, d):
    c = _scored_contracts(Tables(spark, d))
    return c.select("l_orderkey", "l_linenumber", "l_partkey", "Contract", "Tricks", "Vul_Declarer", "Score")


@register("c31_outcome", sql=f"""
WITH s AS ({_CONTRACTS_SQL}), par AS (SELECT p_partkey, any_value(score) AS par_score, list(strain) AS par_strains FROM ({PAR_ROWS_SQL}) GROUP BY p_partkey)
SELECT l_orderkey, l_linenumber, l_partkey, Score, par_score,
  BidLvl > 0 AND Tricks > BidLvl + 6 AS OverTricks, BidLvl > 0 AND Tricks = BidLvl + 6 AS JustMade,
  BidLvl > 0 AND Tricks < BidLvl + 6 AS UnderTricks,
  BidLvl > 0 AND Tricks < BidLvl + 6 AND par_score < 0 AND Score > par_score AS Sacrifice,
  list_contains(par_strains, BidSuit) AS ParStrain
FROM s LEFT JOIN par ON s.l_partkey = par.p_partkey""")
def c31_outcome(spark, d):
    t = Tables(spark, d)
    c = _scored_contracts(t)
    par = (par_rows(t).groupBy("p_partkey")
           .agg(F.first("score").alias("par_score"), F.collect_list("strain").alias("par_strains")))
    j = c.join(par, c.l_partkey == par.p_partkey, "left")
    flags = S.outcome_flags("BidLvl", "Tricks", "Score", "par_score", "BidSuit", "par_strains")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "Score", "par_score",
                    *[v.alias(k) for k, v in flags.items()])


@register("a24_ev", sql=f"""
WITH dist AS (SELECT l_partkey, CAST(l_quantity AS INTEGER) % 14 AS tricks, count(*) AS n FROM lineitem GROUP BY ALL),
tot AS (SELECT l_partkey, sum(n) AS total FROM dist GROUP BY ALL),
pr AS (SELECT dist.l_partkey, tricks, n, total, {_vul_sql('(dist.l_partkey % 16 + 1)')} IN ('NS', 'Both') AS vul
       FROM dist JOIN tot USING (l_partkey)),
grid AS (SELECT pr.*, unnest(range(1, 8)) AS level FROM pr),
grid2 AS (SELECT grid.*, unnest(['C','D','H','S','N']) AS strain FROM grid),
ev AS (SELECT l_partkey, CAST(level AS INTEGER) AS level, strain, any_value(total) AS total,
         sum(n * {_score_sql('level', 'strain', "''", 'vul', 'tricks')}) AS ev_num FROM grid2 GROUP BY l_partkey, level, strain)
SELECT l_partkey, arg_max(CAST(level AS VARCHAR) || strain, (ev_num, -level, strain)) AS best_contract,
  {r('max(ev_num) / any_value(total)')} AS best_ev
FROM ev GROUP BY l_partkey""")
def a24_ev(spark, d):
    """Expected NS score of each of the 35 undoubled contracts under the board's trick distribution.

    The expectation is kept as an exact integer numerator (count x score) so that equal
    expectations (clubs vs diamonds) tie exactly; ties go to the lower level, then the
    higher strain letter.
    """
    tricks = F.col("l_quantity").cast("int") % 14
    li = Tables(spark, d).lineitem.select("l_partkey", tricks.alias("tricks"))
    counts = li.groupBy("l_partkey").agg(F.count("tricks").alias("total"), F.array(*[F.count_if(F.col("tricks") == k) for k in range(14)]).alias("n"))
    # 35 contracts, vulnerable or not, with their score for each number of tricks: 70 rows whatever the data
    cells = (spark.range(2 * 7).select((F.col("id") % 2 == 1).alias("vul"), (F.floor(F.col("id") / 2) + 1).cast("int").alias("level"))
             .withColumn("strain", F.explode(F.array(*[F.lit(x) for x in "CDHSN"])))
             .withColumn("tricks", F.explode(F.sequence(F.lit(0), F.lit(13)))))
    score = S.contract_score("level", "strain", F.lit(""), "vul", "tricks")
    table = cells.groupBy("vul", "level", "strain").agg(F.transform(F.array_sort(F.collect_list(F.struct("tricks", score.alias("s")))), lambda x: x["s"]).alias("scores"))
    vul = H.vul_from_board(F.col("l_partkey") % 16 + 1).isin("NS", "Both")
    ev = counts.withColumn("vul", vul).join(F.broadcast(table), "vul").withColumn(
        "ev_num", F.aggregate(F.zip_with("n", "scores", lambda n, x: n * x), F.lit(0).cast("long"), lambda a, x: a + x))
    best = ev.groupBy("l_partkey").agg(
        F.max_by(F.concat(F.col("level").cast("string"), "strain"),
                 F.struct("ev_num", (-F.col("level")).alias("neg_level"), "strain")).alias("best_contract"),
        (F.max("ev_num") / F.first("total")).alias("best_ev"))
    return rounded(best)
