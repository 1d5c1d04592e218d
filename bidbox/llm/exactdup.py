"""Exact dedup: groups of equal texts by a 128-bit content hash, with the bytes compared inside each group.

Built-in functions only.

1. One pass reduces the texts by hash, inside every map task before the shuffle: rows, the id that stays, and the smallest and
   largest text in byte order.  The two are equal exactly if all texts of the group are, so a group of any size costs a task one row.
2. Groups whose texts differ (a collision of the hash) are grouped anew by hash and text.
3. Rows, without texts, meet the groups by hash.  Groups with more than a ``1 / HOT`` share of the rows, ``HOT`` at most, are
   broadcast; so no hash has more than that share of the rows in the shuffled join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import materialize

#: A hash with a larger share of the rows than one in so many is joined by broadcast: there are at most so many.
HOT = 1000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else changed; "" for null."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)


def content_hash(text: Column) -> Column:
    """128 bits of the content."""
    return F.unhex(F.md5(text.cast("binary")))


def _groups(rows: DataFrame, by: list[str], keep: str) -> DataFrame:
    stays = F.max("id") if keep == "largest" else F.min("id")
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), stays.alias("keep_id"), F.min("body").alias("lo"), F.max("body").alias("hi"))


def copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest",
           normal: Callable[[Column], Column] = folded, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), a row for each row of ``docs``.

    Texts are equal if ``normal`` gives the same bytes; a null text counts as empty.  Of each group the ``smallest`` (or ``largest``) id
    stays.  A null id stays only if no row of its group has an id (keep_id null).  Rows that repeat an id and a text are rows of
    one group and have the same flags; :func:`without_copies` keeps one of them.  An empty table gives no rows, and other columns are not
    read.  ``text_sha256``: lower-case hex of the normalised text in UTF-8.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep!r}")
    body = docs.select(F.col(doc_id).alias("id"), normal(F.col(text)).alias("body")).withColumn("hash", hashed(F.col("body")))
    groups = materialize(_groups(body, ["hash"], keep).select("hash", "n", "keep_id", (F.col("lo") == F.col("hi")).alias("equal")), "copies")
    light = materialize(body.select("id", "hash", F.sha2(F.col("body").cast("binary"), 256).alias("sha")), "copies")

    total, collided = groups.agg(F.sum("n"), F.count_if(~F.col("equal"))).first()
    same = groups.where("equal AND n > 1")  # a text without copies needs no partner
    hot = F.col("n") * HOT > F.lit(total or 0)
    few = F.broadcast(same.where(hot).select("hash", F.col("n").alias("hot_n"), F.col("keep_id").alias("hot_id")))
    met = light.join(few, "hash", "left")
    rest = met.where("hot_n IS NULL").join(same.where(~hot), "hash", "left").select("id", "sha", "hash", "n", "keep_id")
    met = met.where("hot_n IS NOT NULL").select("id", "sha", "hash", F.col("hot_n").alias("n"), F.col("hot_id").alias("keep_id")).union(rest)
    if collided:
        bad = groups.where("NOT equal").select("hash")
        texts = _groups(body.join(bad, "hash", "left_semi"), ["hash", "body"], keep)
        texts = texts.select("hash", F.sha2(F.col("body").cast("binary"), 256).alias("sha"), "n", "keep_id")
        met = met.join(bad, "hash", "left_anti").unionByName(light.join(bad, "hash", "left_semi").join(texts, ["hash", "sha"]).select(*met.columns))
    size = F.coalesce("n", F.lit(1)).cast("long")
    stays = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return met.select(F.col("id").alias("doc_id"), stays.alias("keep_id"), size.alias("group_size"), F.col("id").eqNullSafe(stays).alias("kept"), F.col("sha").alias("text_sha256"))


def without_copies(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: str = "smallest", normal: Callable[[Column], Column] = folded) -> DataFrame:
    """``docs`` with one row of each group, all columns kept.

    Of several rows that repeat the id that stays, that with the smallest hash over all columns stays; rows alike in every column are one.
    """
    found = copies(docs, doc_id=doc_id, text=text, keep=keep, normal=normal).where("kept").select(F.col("doc_id").alias("id"), "text_sha256").distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col(doc_id).alias("row_id"), F.sha2(normal(F.col(text)).cast("binary"), 256).alias("sha"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("turn"))
    mine = rows.join(found, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("text_sha256")), "left_semi")
    one = mine.groupBy("row_id", "sha").agg(F.min_by("doc", "turn").alias("doc"))
    return one.select("doc.*")
