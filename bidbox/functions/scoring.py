"""Duplicate contract scoring (C30) and outcome flags (C31) as Column expressions.

The table of scores is not stored: the published duplicate scoring rules are a closed
formula of (level, strain, doubling, vulnerability, tricks), so Catalyst evaluates it inline.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def contract_score(level: str | Column, strain: str | Column, dbl: str | Column,
                   vul: str | Column, tricks: str | Column) -> Column:
    """Declarer's score; level 0 (pass-out) scores 0.

    dbl is '', 'X' or 'XX'; vul is a boolean (declarer side vulnerable); strain in CDHSN.
    """
    lv, st, db, vu, tr = _c(level), _c(strain), _c(dbl), _c(vul), _c(tricks)
    mult = F.when(db == "XX", 4).when(db == "X", 2).otherwise(1)
    per_trick = F.when(st.isin("C", "D"), 20).otherwise(30)
    base = F.when(st == "N", 40 + 30 * (lv - 1)).otherwise(per_trick * lv) * mult
    made = tr >= lv + 6
    over = tr - lv - 6
    game = F.when(base >= 100, F.when(vu, 500).otherwise(300)).otherwise(50)
    slam = F.when(lv == 6, F.when(vu, 750).otherwise(500)).when(lv == 7, F.when(vu, 1500).otherwise(1000)).otherwise(0)
    insult = F.when(db == "XX", 100).when(db == "X", 50).otherwise(0)
    over_value = (F.when(db == "", F.when(st.isin("C", "D"), 20).otherwise(30))
                  .otherwise(F.when(vu, 200).otherwise(100) * (mult / 2)))
    made_score = base + game + slam + insult + over * over_value
    under = lv + 6 - tr
    undoubled = under * F.when(vu, 100).otherwise(50)
    # doubled: non-vul 100, 200, 200, then 300 each; vul 200 then 300 each
    dbl_nv = F.when(under == 1, 100).when(under == 2, 300).when(under == 3, 500).otherwise(500 + 300 * (under - 3))
    dbl_v = 200 + 300 * (under - 1)
    doubled = F.when(vu, dbl_v).otherwise(dbl_nv) * (mult / 2)
    down = F.when(db == "", undoubled).otherwise(doubled)
    score = F.when(lv == 0, 0).when(made, made_score).otherwise(-down)
    return score.cast("int")


def outcome_flags(level: str | Column, tricks: str | Column, score: str | Column,
                  par_score: str | Column, strain: str | Column, par_strains: str | Column) -> dict[str, Column]:
    """over/under/just made, sacrifice, and par-strain match flags."""
    lv, tr, sc, par = _c(level), _c(tricks), _c(score), _c(par_score)
    need = lv + 6
    return {
        "OverTricks": (lv > 0) & (tr > need),
        "JustMade": (lv > 0) & (tr == need),
        "UnderTricks": (lv > 0) & (tr < need),
        # went down but the loss is smaller than what the other side's par would score
        "Sacrifice": (lv > 0) & (tr < need) & (par < 0) & (sc > par),
        "ParStrain": F.array_contains(_c(par_strains), _c(strain)),
    }
