"""M3: isotonic regression as a distributed job.

Distinct predictions, with their weight and mean label, are range-partitioned.  Every partition pools its adjacent violators into
blocks.  Then neighbouring partitions whose blocks at the border are in the wrong order are pooled pairwise, until no border is: a
pooled block that spans a border moves to the left partition, so no partition ever holds more blocks than it had points.
The driver sees the first and last block of each partition.  Scoring is an as-of join with the blocks.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .joins import asof_join

_BLOCK = "part int, lo double, hi double, w double, s double"


def _pool(blocks: pd.DataFrame) -> pd.DataFrame:
    blocks = blocks.sort_values("lo")
    stack: list[list[float]] = []
    for part, lo, hi, w, s in blocks[["part", "lo", "hi", "w", "s"]].itertuples(index=False):
        stack.append([part, lo, hi, w, s])
        while len(stack) > 1 and stack[-2][4] * stack[-1][3] >= stack[-1][4] * stack[-2][3]:  # mean before >= mean after
            _, _, hi, w, s = stack.pop()
            stack[-1][2:] = [hi, stack[-1][3] + w, stack[-1][4] + s]
    out = pd.DataFrame(stack, columns=["part", "lo", "hi", "w", "s"])
    return out.astype({"part": "int32"})


def isotonic_blocks(points: DataFrame, x: str, y: str, weight: str) -> DataFrame:
    """(lo, hi, value): the blocks of the non-decreasing fit, of distinct finite ``x`` with mean ``y`` and positive ``weight``."""
    pool = lambda df: _pool(df)
    cut = points.select(F.col(x).cast("double").alias("lo"), F.col(weight).cast("double").alias("w"), (F.col(y) * F.col(weight)).cast("double").alias("s")).repartitionByRange("lo")
    cut = materialize(cut.select(F.spark_partition_id().alias("part"), "lo", F.col("lo").alias("hi"), "w", "s"), "isotonic")
    blocks = materialize(cut.groupBy("part").applyInPandas(pool, _BLOCK), "isotonic")
    while True:
        mean = F.col("s") / F.col("w")
        ends = sorted(tuple(r) for r in blocks.groupBy("part").agg(F.min_by(mean, "lo"), F.max_by(mean, "lo")).collect())  # one row a partition
        pairs, at = [], 0
        while at + 1 < len(ends):
            wrong = ends[at][2] >= ends[at + 1][1]
            pairs += [(ends[at][0], at), (ends[at + 1][0], at)] if wrong else []
            at += 2 if wrong else 1
        if not pairs:
            return blocks.select("lo", "hi", mean.alias("value"))
        meet = F.broadcast(blocks.sparkSession.createDataFrame(pairs, "part int, pair int"))
        pooled = blocks.join(meet, "part").groupBy("pair").applyInPandas(pool, _BLOCK)
        blocks = materialize(blocks.join(meet, "part", "left_anti").unionByName(pooled), "isotonic")


def isotonic_predict(values: DataFrame, x: str, blocks: DataFrame, out: str) -> DataFrame:
    """``values`` (distinct ``x``) with the fit at x: a block's value inside it, on the straight line between two blocks, the end blocks' beyond them."""
    one = F.lit(1).alias("_g")
    right = blocks.select(one, F.col("lo").alias("_x"), "lo", "hi", "value")
    left = values.select(one, F.col(x).cast("double").alias("_x"), F.col(x).alias("_of"))
    back = asof_join(left, right, ["_g"], "_x", ["lo", "hi", "value"]).select("_of", (-F.col("_x")).alias("_x"), "_g", F.col("hi").alias("_hi"), F.col("value").alias("_v"))
    ahead = right.withColumn("_x", -F.col("_x"))
    both = asof_join(back, ahead, ["_g"], "_x", ["lo", "value"]).withColumn("_x", -F.col("_x"))
    line = F.col("_v") + (F.col("value") - F.col("_v")) * (F.col("_x") - F.col("_hi")) / (F.col("lo") - F.col("_hi"))
    fit = F.when(F.col("_v").isNull(), F.col("value")).when((F.col("_x") <= F.col("_hi")) | F.col("value").isNull(), F.col("_v")).otherwise(line)
    return both.select(F.col("_of").alias(x), fit.alias(out))
