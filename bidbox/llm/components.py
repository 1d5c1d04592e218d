"""Connected components of a distributed edge list (alternating large-star and small-star).

Every round is a few aggregations and equi-joins, written to the shared folder, so a lost executor
repeats one round at most and no links reach the driver: it sees a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import in_tasks, materialize

#: Links that a task writes, about.
LINKS = 10_000


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Rows (id, component) of every id that is not itself the smallest of its component.

    ``edges`` may repeat links, give them in either direction and hold loops; links with a null end are
    ignored.  Ids that are absent from the result are their own component.
    """
    n = edges.count()
    now = materialize(in_tasks(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), n, LINKS), "cc")
    seen = None
    for _ in range(max_rounds):
        n, mark, stars = _state(now)
        if n == 0 or stars or (n, mark) == seen:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        seen = (n, mark)
        now = materialize(in_tasks(_small_star(_large_star(now)), n, LINKS), "cc")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(edges: DataFrame) -> tuple[int, int, bool]:
    """Rows, checksum, and whether every edge already joins a leaf to a root."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.xxhash64("u", "v").alias("h")),
                   F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(0).cast("long").alias("h")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("parents"), F.bit_xor("h").alias("h"), F.min("up").alias("least"))
    row = nodes.agg(F.sum("parents"), F.bit_xor("h"),
                    F.max(F.when((F.col("parents") > 1) | ((F.col("parents") > 0) & (F.col("least") == 0)), 1).otherwise(0))).first()
    return int(row[0] or 0), int(row[1] or 0), row[2] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or itself); rows may repeat."""
    edges = edges.where("u IS NOT NULL AND v IS NOT NULL")  # said here, the joins below read one shuffle for both of their sides
    back = F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    least = edges.select(F.inline(F.array(F.struct("u", "v"), back))).groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    edges = edges.repartition("u").distinct()  # dealt by node once, for the aggregation and the join
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).distinct()
