"""Nested result documents (S6, S7, Q8, Q9): one JSON document per event.

Documents are event -> sections -> boards -> board_results.  They are read with an
explicit schema (never inferred) and flattened with chained ``explode``; membership tests
inside a document use higher-order ``exists`` without flattening.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT = T.StructType([T.StructField("ns_pair", T.LongType()), T.StructField("ew_pair", T.LongType()),
                       T.StructField("ns_score", T.DoubleType())])
BOARD = T.StructType([T.StructField("board_number", T.IntegerType()),
                      T.StructField("board_results", T.ArrayType(RESULT))])
SECTION = T.StructType([T.StructField("section_name", T.StringType()),
                        T.StructField("boards", T.ArrayType(BOARD))])
EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("club_id", T.LongType()),
                      T.StructField("start_date", T.StringType()),
                      T.StructField("sections", T.ArrayType(SECTION))])


def build_event_docs(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One JSON text per order, nesting its line items; every group is bounded by one order."""
    li = lineitem.select(F.col("l_orderkey").alias("event_id"), F.col("l_returnflag").alias("section_name"),
                         F.col("l_linenumber").alias("board_number"),
                         F.struct(F.col("l_suppkey").alias("ns_pair"), (F.col("l_partkey") % 100).alias("ew_pair"),
                                  F.col("l_extendedprice").alias("ns_score")).alias("r"))
    boards = (li.groupBy("event_id", "section_name", "board_number")
              .agg(F.array_sort(F.collect_list("r")).alias("board_results")))
    sections = (boards.groupBy("event_id", "section_name")
                .agg(F.array_sort(F.collect_list(F.struct("board_number", "board_results"))).alias("boards")))
    events = (sections.groupBy("event_id")
              .agg(F.array_sort(F.collect_list(F.struct("section_name", "boards"))).alias("sections")))
    o = orders.select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("club_id"),
                      F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"))
    doc = o.join(events, "event_id", "left")
    return doc.select(F.to_json(F.struct("event_id", "club_id", "start_date", "sections")).alias("value"))


def read_event_docs(spark: SparkSession, path: str) -> DataFrame:
    """Documents with the explicit nested schema."""
    return spark.read.schema(EVENT).json(path)


def board_results(events: DataFrame) -> DataFrame:
    """Flatten event -> sections -> boards -> board_results into one row per result."""
    s = events.select("event_id", "club_id", "start_date", F.explode("sections").alias("s"))
    b = s.select("event_id", "club_id", "start_date", F.col("s.section_name").alias("section_name"),
                 F.explode("s.boards").alias("b"))
    r = b.select("event_id", "club_id", "start_date", "section_name", F.col("b.board_number").alias("board_number"),
                 F.explode("b.board_results").alias("r"))
    return r.select("event_id", "club_id", "start_date", "section_name", "board_number", "r.*")


def roster(events: DataFrame) -> DataFrame:
    """Q8: distinct (event, section, pair number) seen in any board result of the document."""
    br = board_results(events)
    return br.select("event_id", "section_name", F.col("ns_pair").alias("pair_number")).distinct()


def contains_pair(pair: Column) -> Column:
    """Q9: does the document list ``pair`` as an NS pair anywhere (no flattening)."""
    return F.coalesce(F.exists("sections", lambda s: F.exists(s["boards"], lambda b: F.exists(
        b["board_results"], lambda r: r["ns_pair"] == pair))), F.lit(False))
