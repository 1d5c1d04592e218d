"""Rank-style operators: matchpoints per board (W7), average-tie rank.

Both are written so that a hot key never lands whole in one task:

* Matchpoints go by windows over a board's rows, shuffled once for all scores; a crowded board
  (:data:`CROWDED`) is first collapsed to one row per (board, score) with a map-side partial
  aggregate.  The running "beaten" counts over that reduced frame are an exact distributed prefix
  sum (:func:`below_counts`).  The join back is an equi-join on (board, score) that AQE may
  broadcast or skew-split.
* A global rank (no partition key) is an exact distributed prefix sum: distinct
  values are range-bucketed by approximate quantiles (bounded number of buckets),
  per-bucket counts get a running offset over the small bucket table, and the rank
  inside a bucket is a window over that bucket's distinct values only.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def below_counts(d: DataFrame, keys: Sequence[str], value: str, count_col: str = "_n_eq") -> DataFrame:
    """Add ``_n_lt`` (sum of ``count_col`` over smaller values of the same key) and ``_n_field``
    (sum over the key) to a table of distinct (key, value) rows.

    An exact distributed prefix sum: the rows are range-partitioned on (key, value), which cuts a
    hot key into runs of several tasks.  Each (key, run) is summed by its own window, and a run's
    offset is the key's total in earlier runs (a table of one row per key and run).  The
    partitioned rows are written once, so every branch sees the same runs.
    """
    from ..session import materialize

    keys = list(keys)
    runs = materialize(d.repartitionByRange(*keys, value).withColumn("_run", F.spark_partition_id()), "runs")
    per_run = runs.groupBy(*keys, "_run").agg(F.sum(count_col).alias("_c"))
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per_run.withColumn("_off", F.coalesce(F.sum("_c").over(earlier), F.lit(0)))
               .withColumn("_n_field", F.sum("_c").over(by_key)).drop("_c"))
    inside = Window.partitionBy(*keys, "_run").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (runs.withColumn("_loc", F.coalesce(F.sum(count_col).over(inside), F.lit(0)))
            .join(offsets, [*keys, "_run"])
            .withColumn("_n_lt", F.col("_off") + F.col("_loc")).drop("_run", "_loc", "_off"))


#: A board is crowded if it has more results than this and than 1/1000 of all, so at most 1,000 boards are.
CROWDED = 200_000
#: Rows that a task of the windows takes: each is held by several sorts at once, some 700 bytes in all.
TASK_ROWS = 400_000


def matchpoints(df: DataFrame, board_cols: Sequence[str], score_col: str,
                mp_col: str = "MP", top_col: str = "MP_Top", pct_col: str = "Pct", crowded: int = CROWDED) -> DataFrame:
    """Matchpoints of each result against its board field.

    MP = results with a lower score + half of the other results with an equal score;
    top = field size - 1; pct = MP / top, null when the field has one result.
    Rows with a null score are not part of the field and get null MP/top/pct.
    """
    return matchpoints_of(df, board_cols, {score_col: (mp_col, top_col, pct_col)}, crowded)


def matchpoints_of(df: DataFrame, board_cols: Sequence[str], scores: Mapping[str, tuple[str, str, str]], crowded: int = CROWDED) -> DataFrame:
    """Matchpoints by several scores of the same boards: score -> (MP, top, pct) columns.

    Rows go to their board once, whatever the number of scores, and are ranked there by windows.  Crowded boards
    (known from a count a board) go by the distributed prefix sums instead, and rows without a board stay where they are.
    ``df`` is read for the count and again for each of these three kinds of rows that there are.
    """
    board_cols = list(board_cols)
    known = F.lit(True)
    for c in board_cols:
        known = known & F.col(c).isNotNull()
    sizes = df.groupBy(*board_cols).agg(F.count(F.lit(1)).alias("_c"))
    seen = sizes.agg(F.max(F.when(known, F.col("_c"))).alias("most"), F.sum("_c").alias("rows"), F.count_if(~known).alias("unknown")).first()
    limit = max(crowded, (seen["rows"] or 0) // 1000)
    rows, rest = df, []
    if seen["unknown"]:
        rows, rest = rows.where(known), [_ordered(df.where(~known), board_cols, {s: (F.lit(None).cast("double"), F.lit(None).cast("long")) for s in scores}, scores)]
    if (seen["most"] or 0) > limit:
        heavy = F.broadcast(sizes.where(known & (F.col("_c") > limit)).select(*board_cols))
        rest.append(_matchpoints_spread(rows.join(heavy, board_cols, "left_semi"), board_cols, scores))
        rows = rows.join(heavy, board_cols, "left_anti")
    tasks = -(-(seen["rows"] or 0) // TASK_ROWS)
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):  # else AQE finds their number
        rows = rows.repartition(tasks, *board_cols)
    out = _matchpoints_in_windows(rows, board_cols, scores)
    for some in rest:
        out = out.unionByName(some)
    return out


def _ordered(df: DataFrame, board_cols: list[str], values: Mapping[str, tuple[Column, Column]], scores: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    """Add (MP, top, pct) for the (MP, top) of each score; board and score columns come first, the last score's foremost."""
    names = df.columns
    keep = [c for c in names if not c.startswith("_mp_")]
    out = df
    for score, (mp_col, top_col, pct_col) in scores.items():
        mp, top = values[score]
        out = out.withColumns({mp_col: mp.cast("double"), top_col: top, pct_col: F.when(top > 0, mp / top)})
        keep = [*board_cols, score, *(c for c in keep if c not in (*board_cols, score, mp_col, top_col, pct_col)), mp_col, top_col, pct_col]
    return out.select(*keep)


def _matchpoints_in_windows(df: DataFrame, board_cols: list[str], scores: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    board = Window.partitionBy(*board_cols)
    out, values = df.withColumn("_mp_rows", F.count(F.lit(1)).over(board)), {}
    for i, score in enumerate(scores):
        below, equal, field = f"_mp_below{i}", f"_mp_equal{i}", f"_mp_field{i}"
        # nulls rank first and are taken off again: this order is the one by which equal scores are counted too
        out = out.withColumn(below, F.rank().over(board.orderBy(score)))
        out = out.withColumn(equal, F.count(F.lit(1)).over(Window.partitionBy(*board_cols, score))).withColumn(field, F.count(score).over(board))
        n_lt = F.col(below).cast("long") - 1 - (F.col("_mp_rows") - F.col(field))
        ranked = F.col(score).isNotNull()
        values[score] = F.when(ranked, n_lt + (F.col(equal) - 1) / F.lit(2.0)), F.when(ranked, F.col(field) - 1)
    return _ordered(out, board_cols, values, scores)


def _matchpoints_spread(df: DataFrame, board_cols: list[str], scores: Mapping[str, tuple[str, str, str]]) -> DataFrame:
    out, values = df, {}
    for i, score in enumerate(scores):
        field = (df.where(F.col(score).isNotNull())
                 .groupBy(*board_cols, score)
                 .agg(F.count(F.lit(1)).alias("_n_eq")))
        field = below_counts(field, board_cols, score).select(*board_cols, score, F.col("_n_lt").alias(f"_mp_below{i}"), F.col("_n_eq").alias(f"_mp_equal{i}"), F.col("_n_field").alias(f"_mp_field{i}"))
        out = out.join(field, on=[*board_cols, score], how="left")
        values[score] = F.col(f"_mp_below{i}") + (F.col(f"_mp_equal{i}") - 1) / F.lit(2.0), F.col(f"_mp_field{i}") - 1
    return _ordered(out, board_cols, values, scores)


def _rank_within(df: DataFrame, partition_cols: Sequence[str], col: str) -> DataFrame:
    """(partition.., value, n_eq, n_lt) over distinct values (see below_counts)."""
    d = (df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col)))
         .groupBy(*partition_cols, col).agg(F.count(F.lit(1)).alias("_n_eq")))
    return below_counts(d, partition_cols, col).drop("_n_field")


def average_rank(df: DataFrame, col: str, out_col: str,
                 partition_cols: Sequence[str] = (), divide_by_count: bool = False,
                 n_buckets: int = 512, stored: bool = False) -> DataFrame:
    """Average-tie rank (1-based) of ``col``; null/NaN stays null.

    With ``divide_by_count`` the rank is divided by the number of rows in the partition,
    nulls included (a ``rank / len()`` percentile).  Without partition columns the rank is
    global and computed by the bucketed prefix sum described in the module docstring.
    ``stored`` says that ``col`` is read from files (or follows row by row from such columns), so that every reading sees the
    same bits: then the rows themselves are not written for the global rank, only its distinct values.
    """
    partition_cols = list(partition_cols)
    x = F.col(col)
    if partition_cols:
        ranks = _rank_within(df, partition_cols, col)
        totals = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("_n_all"))
        out = (df.join(ranks, on=[*partition_cols, col], how="left")
                 .join(totals, on=partition_cols, how="left"))
    else:
        out = _global_rank(df, col, n_buckets, stored)
    avg_rank = F.col("_n_lt") + (F.col("_n_eq") + 1) / F.lit(2.0)
    val = avg_rank / F.col("_n_all") if divide_by_count else avg_rank
    return (out.withColumn(out_col, F.when(x.isNotNull() & ~F.isnan(x), val))
               .drop("_n_eq", "_n_lt", "_n_all"))


def _global_rank(df: DataFrame, col: str, n_buckets: int, stored: bool) -> DataFrame:
    from pyspark.ml.feature import Bucketizer

    # The rank is joined back on the value itself, so every branch must see the same bits:
    # an upstream float aggregate recomputed per branch may differ in the last ulp.
    # A reliable checkpoint (shared checkpoint dir) pins such an input once.
    from ..session import ensure_checkpoint_dir, materialize

    if not stored:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    counts = materialize(df.groupBy(col).agg(F.count(F.lit(1)).alias("_n_eq")), "rank-values")

    # Bucket bounds (a bounded list of approximate quantiles of the distinct values, which fill the buckets) and the row count
    # come back in one small aggregate; both are O(n_buckets) on the driver.
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = counts.agg(F.percentile_approx(F.when(~F.isnan(F.col(col)), F.col(col).cast("double")), probs, 10000).alias("b"),
                     F.sum("_n_eq").alias("n")).first()
    total = int(row["n"] or 0)
    bounds = sorted({float(b) for b in (row["b"] or []) if math.isfinite(b)})
    splits = [float("-inf"), *bounds, float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    distinct = counts.where(F.col(col).isNotNull() & ~F.isnan(col))
    distinct = distinct.withColumn("_xd", F.col(col).cast("double"))
    bucketed = Bucketizer(splits=splits, inputCol="_xd", outputCol="_bucket",
                          handleInvalid="keep").transform(distinct).drop("_xd")
    per_bucket = bucketed.groupBy("_bucket").agg(F.sum("_n_eq").alias("_n_b"))
    wb = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # per_bucket has at most n_buckets+1 rows: the single-partition window is bounded.
    offsets = per_bucket.withColumn("_off", F.coalesce(F.sum("_n_b").over(wb), F.lit(0)))
    inner = Window.partitionBy("_bucket").orderBy(col).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (bucketed.join(F.broadcast(offsets.select("_bucket", "_off")), "_bucket")
              .withColumn("_n_lt", F.col("_off") + F.coalesce(F.sum("_n_eq").over(inner), F.lit(0)))
              .select(col, "_n_eq", "_n_lt"))
    return (df.join(ranked, on=col, how="left")
              .withColumn("_n_all", F.lit(total).cast("long")))


def _distinct_counts(df: DataFrame, col: str) -> DataFrame:
    return (df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col)))
            .groupBy(col).agg(F.count(F.lit(1)).alias("_n_eq")))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], n_buckets: int = 512,
                    method: str = "linear") -> dict[float, float | None]:
    """Exact quantiles without gathering all values in one task.

    ``method="linear"``: interpolate between ranks floor/ceil of ``q*(n-1)`` (``percentile`` /
    ``quantile_cont``).  ``method="nearest"``: the value at rank ``round(q*(n-1))`` with halves
    away from zero (the default of Polars ``quantile`` and ``describe``).

    Distinct values with counts are range-bucketed by approximate quantile bounds; the per-bucket
    counts (at most ``n_buckets + 1`` rows) locate the bucket holding each needed rank, and only
    those buckets' distinct values are ordered to read the values at ranks floor/ceil of
    ``q * (n - 1)``.  Nulls and NaN are ignored.  Returns {q: value}.
    """
    from pyspark.ml.feature import Bucketizer

    x = F.col(col).cast("double")
    clean = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    bprobs = [i / n_buckets for i in range(1, n_buckets)]
    row = clean.agg(F.percentile_approx("_x", bprobs, 10000).alias("b"), F.count(F.lit(1)).alias("n")).first()
    n = int(row["n"])
    if n == 0:
        return {q: None for q in probs}
    splits = [float("-inf"), *sorted({float(b) for b in (row["b"] or []) if math.isfinite(b)}), float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    distinct = clean.groupBy("_x").agg(F.count(F.lit(1)).alias("_n"))
    bucketed = Bucketizer(splits=splits, inputCol="_x", outputCol="_b").transform(distinct)
    per_bucket = sorted((r["_b"], r["c"]) for r in bucketed.groupBy("_b").agg(F.sum("_n").alias("c")).collect())
    offsets, acc = [], 0
    for b, c in per_bucket:          # at most n_buckets + 1 rows on the driver
        offsets.append((b, acc, acc + c))
        acc += c
    def ranks(q: float) -> set[int]:
        pos = q * (n - 1)
        if method == "nearest":
            return {int(math.floor(pos + 0.5))}
        return {int(pos // 1), int(-(-pos // 1))}

    wanted = {}
    for q in probs:
        for k in ranks(q):
            wanted[k] = next(b for b, lo, hi in offsets if lo <= k < hi)
    buckets = sorted(set(wanted.values()))
    w = Window.partitionBy("_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    sel = (bucketed.where(F.col("_b").isin(buckets))
           .withColumn("_cum", F.sum("_n").over(w)))
    off = {b: lo for b, lo, _ in offsets}
    # the value at global rank k is the first distinct value whose cumulative count exceeds k
    conds = []
    for k, b in wanted.items():
        local = k - off[b]
        conds.append((F.col("_b") == b) & (F.col("_cum") > local) & (F.col("_cum") - F.col("_n") <= local))
    cond = conds[0]
    for c in conds[1:]:
        cond = cond | c
    hits = sel.where(cond).select("_b", "_x", "_cum", "_n").collect()   # at most len(wanted) rows
    value_at = {}
    for k, b in wanted.items():
        local = k - off[b]
        for h in hits:
            if h["_b"] == b and h["_cum"] > local >= h["_cum"] - h["_n"]:
                value_at[k] = h["_x"]
    out = {}
    for q in probs:
        pos = q * (n - 1)
        if method == "nearest":
            out[q] = value_at[int(math.floor(pos + 0.5))]
            continue
        lo, hi = int(pos // 1), int(-(-pos // 1))
        frac = pos - lo
        out[q] = value_at[lo] + (value_at[hi] - value_at[lo]) * frac if hi != lo else value_at[lo]
    return out
