"""A player's view of sessions (C23) and the filter to that player's boards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .rating import largest

# fixed values: seats in the order in which a player is looked for, each with its partner
SEATS = {"N": "S", "S": "N", "E": "W", "W": "E"}
#: Players asked for in a session: up to so many are found on the session's rows as they are, more by a row a seat.
FEW = 16
FLAGS = ("My_Section", "Our_Section", "My_Pair", "Our_Pair", "Boards_I_Played", "Boards_We_Played", "Our_Boards",
         "Boards_I_Declared", "Boards_Partner_Declared", "Boards_Opponent_Declared", "Boards_We_Declared")


def _side(seat: Column) -> Column:
    return F.when(seat.isin("N", "S"), "NS").otherwise("EW")


def find_players(rows: DataFrame, wanted: DataFrame, session: str, order: Sequence[str]) -> DataFrame:
    """Where each wanted (session, player_id) sits: the first seat in order N, S, E, W, there the first row.

    Columns: session, player_id, seat, partner_id, section_name, pair_number.  Players who are not in their session are absent.
    """
    at = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(s).alias("seat"), F.col(f"Player_ID_{s}").cast("string").alias("player_id"),
                            F.col(f"Player_ID_{p}").cast("string").alias("partner_id"),
                            F.col("Pair_Number_NS" if s in "NS" else "Pair_Number_EW").alias("pair_number")) for i, (s, p) in enumerate(SEATS.items())])
    asked = materialize(wanted.select(session, F.trim(F.col("player_id").cast("string")).alias("player_id")).distinct(), "asked")
    if largest(asked, [session]) <= FEW:
        names = asked.groupBy(session).agg(F.collect_list("player_id").alias("_asked"))
        mine = F.filter(at, lambda x: F.array_contains("_asked", F.trim(x["player_id"])))
        seated = rows.join(names, session).select(session, "section_name", *order, F.explode(mine).alias("at")).withColumn("player_id", F.trim("at.player_id"))
    else:
        seated = rows.select(session, "section_name", *order, F.explode(at).alias("at")).where(F.col("at.player_id").isNotNull())
        seated = seated.withColumn("player_id", F.trim("at.player_id")).join(asked, [session, "player_id"])
    first = F.struct("at.rank", *order)
    return (seated.groupBy(session, "player_id").agg(F.min_by(F.struct("at.seat", "at.partner_id", "section_name", "at.pair_number"), first).alias("me"))
            .select(session, "player_id", "me.seat", "me.partner_id", F.col("me.section_name").alias("my_section_name"), F.col("me.pair_number").alias("my_pair_number")))


def personalise(rows: DataFrame, wanted: DataFrame, session: str = "session_id", order: Sequence[str] = ("Board", "Round")) -> DataFrame:
    """Every row of the wanted players' sessions with the player's flags and directions.

    ``rows`` holds section_name, Pair_Number_NS/EW, Player_ID_<seat>, Declarer_ID and Declarer_Direction.  A flag whose
    inputs are null is false.
    """
    me = find_players(rows, wanted, session, order)
    out = rows.join(me, session)
    pair = F.when(_side(F.col("seat")) == "NS", F.col("Pair_Number_NS")).otherwise(F.col("Pair_Number_EW"))
    sure = lambda c: F.coalesce(c, F.lit(False))
    section = sure(F.col("section_name") == F.col("my_section_name"))
    mine = section & sure(pair == F.col("my_pair_number"))
    declarer = F.col("Declarer_ID").cast("string")
    i, partner = mine & sure(declarer == F.col("player_id")), mine & sure(declarer == F.col("partner_id"))
    theirs = mine & sure(_side(F.col("Declarer_Direction")) != _side(F.col("seat"))) & F.col("Declarer_Direction").isNotNull()
    values = dict(zip(FLAGS, (section, section, mine, mine, mine, mine, mine, i, partner, theirs, i | partner), strict=True))
    other = F.when(_side(F.col("seat")) == "NS", "EW").otherwise("NS")
    return out.select(*rows.columns, "player_id", F.col("seat").alias("Player_Direction"), other.alias("Opponent_Pair_Direction"), *[v.alias(k) for k, v in values.items()])


def only_my_boards(personal: DataFrame) -> DataFrame:
    """the rows the player played."""
    return personal.where(F.col("Boards_I_Played"))
