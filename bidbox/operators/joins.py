"""Join operators (J*): lookups, role-playing joins, anti/semi joins, precedence merges.

No join here is forced: the planner broadcasts a side whose size in bytes is under its threshold, AQE
corrects the choice from run-time sizes and splits skewed partitions of shuffled joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUFFIX_RE = r"_(x|y|left|right)$"  # fixed value: suffixes that signal a join-name collision
#: A dimension's rows in use go to every executor if they are no more than this.
BROADCAST_ROWS = 500_000


def lookup_chain(fact: DataFrame, steps: Sequence[tuple[DataFrame, Sequence[tuple[str, str]]]],
                 how: str = "left") -> DataFrame:
    """Chain of fact->dimension joins; each step is (dim, [(fact_col, dim_col), ...])."""
    out = fact
    for dim, pairs in steps:
        cond = [out[a] == dim[b] for a, b in pairs]
        out = out.join(dim, on=cond, how=how)
    return out


def assert_unique(df: DataFrame, key: Sequence[str], what: str = "join key") -> DataFrame:
    """Fail the job when ``key`` is not unique, else pass ``df`` through.

    The check is an aggregate (partial per task, then merged) that raises inside Spark.
    """
    dup = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") > 1)
    bad = dup.limit(1).count()
    if bad:
        raise ValueError(f"{what} {list(key)} is not unique")
    return df


def keyed_concat(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Horizontal concat by key (not by row position) after proving right keys unique."""
    return left.join(assert_unique(right, key), on=list(key), how="left")


def orientation_self_join(df: DataFrame, orient_col: str, a: str, b: str, keys: Sequence[str],
                          value_cols: Sequence[str]) -> DataFrame:
    """Split one table by orientation into two views and join them on shared keys.

    Value columns of each side are renamed ``<col>_<a>`` / ``<col>_<b>`` so no suffix collides.
    """
    left = df.where(F.col(orient_col) == a).select(*keys, *[F.col(c).alias(f"{c}_{a}") for c in value_cols])
    right = df.where(F.col(orient_col) == b).select(*keys, *[F.col(c).alias(f"{c}_{b}") for c in value_cols])
    return left.join(right, on=list(keys), how="inner")


def whole_row_anti(left: DataFrame, right: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``left`` with no equal row in ``right``; null never equals null.

    Unlike ``EXCEPT`` this keeps duplicates and treats a null cell as unmatched.
    """
    cols = list(cols or left.columns)
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols])
    cond = [left[c] == r[f"_r_{c}"] for c in cols]
    return left.join(r, on=cond, how="left_anti")


def role_joins(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
               dim_cols: Sequence[str]) -> DataFrame:
    """Attach a role-playing dimension once per role (seat): role -> fact key column.

    Output columns are ``<dim col>_<role>``.  One left join per role; the dimension side is
    the same plan each time, so Spark reuses its exchange/broadcast.
    """
    out = fact
    for role, fk in roles.items():
        d = dim.select(F.col(dim_key).alias(f"_k_{role}"), *[F.col(c).alias(f"{c}_{role}") for c in dim_cols])
        out = out.join(d, out[fk] == d[f"_k_{role}"], "left").drop(f"_k_{role}")
    return out


def stacked_role_join(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str],
                      dim_cols: Sequence[str]) -> DataFrame:
    """As :func:`role_joins`, with one join for all roles, for a dimension too large to broadcast.

    The distinct combinations of the roles' keys (reduced in each task) are stacked into one row a filled role and joined with the
    dimension once; the attributes of a combination are put together again and joined back to the fact.  However many roles there are,
    the fact is shuffled by its combinations twice, once with the role keys alone.  Null keys are never shuffled as roles,
    and stay null.  ``dim_key`` must be unique; output columns are ``<dim col>_<role>``.
    """
    spots = [f"_role{i}" for i in range(len(roles))]
    combos = fact.select(*[F.col(fk).alias(s) for s, fk in zip(spots, roles.values())]).distinct().where(F.coalesce(*spots).isNotNull())
    stacked = combos.select(*spots, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(s).alias("k")) for i, s in enumerate(spots)])).alias("_at"))
    stacked = stacked.select(*spots, F.col("_at.i").alias("_i"), F.col("_at.k").alias("_k")).where(F.col("_k").isNotNull())
    found = stacked.join(dim.select(F.col(dim_key).alias("_k"), F.struct(*dim_cols).alias("_d")), "_k")
    whole = found.groupBy(*spots).agg(*[F.first(F.when(F.col("_i") == i, F.col("_d")), ignorenulls=True).alias(f"_d{i}") for i in range(len(roles))])
    out = fact.join(whole, [fact[fk].eqNullSafe(whole[s]) for s, fk in zip(spots, roles.values())], "left")
    return out.select(*[fact[c] for c in fact.columns], *[F.col(f"_d{i}.{c}").alias(f"{c}_{role}") for i, role in enumerate(roles) for c in dim_cols])


def used_rows(dim: DataFrame, dim_key: str, used: DataFrame, fks: Sequence[str], dim_cols: Sequence[str]) -> DataFrame:
    """The rows of ``dim`` (key and ``dim_cols``) whose key is in any of the columns ``fks`` of ``used``, written once.

    The keys are reduced to distinct ones in each task before they are shuffled.
    """
    from ..session import materialize

    keys = used.select(F.explode(F.array(*[F.col(c) for c in fks])).alias(dim_key)).where(F.col(dim_key).isNotNull()).distinct()
    return materialize(dim.select(dim_key, *dim_cols).join(keys, dim_key, "left_semi"), "role-rows")


def role_lookup(fact: DataFrame, dim: DataFrame, dim_key: str, roles: Mapping[str, str], dim_cols: Sequence[str],
                used: DataFrame | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """As :func:`stacked_role_join` (``dim_key`` must be unique; of rows that repeat it one is taken), without shuffling the
    fact if the dimension's rows in use are at most ``most``: these are broadcast, however large the dimension is.

    ``used`` holds the role keys of all fact rows, if they can be read more cheaply than the fact; further keys do no harm.
    """
    few = used_rows(dim, dim_key, fact if used is None else used, list(roles.values()), dim_cols)
    if few.count() > most:
        return stacked_role_join(fact, few, dim_key, roles, dim_cols)
    once = few.groupBy(dim_key).agg(F.first(F.struct(*dim_cols)).alias("_d")).select(dim_key, "_d.*")
    out = role_joins(fact, F.broadcast(once), dim_key, roles, dim_cols)
    return out.select(*fact.columns, *[f"{c}_{role}" for role in roles for c in dim_cols])


def derive_on_distinct(df: DataFrame, key: str, derive: Mapping[str, Column]) -> DataFrame:
    """Compute expressions once per distinct key and join them back."""
    d = df.select(key).distinct()
    for name, expr in derive.items():
        d = d.withColumn(name, expr)
    return df.join(d, on=key, how="left")


def first_last_rows(df: DataFrame, key: Sequence[str], order: Sequence[str],
                    values: Sequence[str]) -> DataFrame:
    """First and last row values per key in one aggregate (no join of two reductions)."""
    o = F.struct(*[F.col(c) for c in order])
    aggs = []
    for v in values:
        aggs += [F.min_by(v, o).alias(f"first_{v}"), F.max_by(v, o).alias(f"last_{v}")]
    return df.groupBy(*key).agg(*aggs)


def standings(parent: DataFrame, children: DataFrame, parent_key: str, child_key: str,
              aggs: Sequence[Column]) -> DataFrame:
    """Parents left-joined to an aggregate of their children (parents without children kept)."""
    per = children.groupBy(F.col(child_key).alias(parent_key)).agg(*aggs)
    return parent.join(per, on=parent_key, how="left")


def semi_chain(frames: Sequence[tuple[DataFrame, str, str]], root: DataFrame) -> DataFrame:
    """Drill down a key cascade with semi joins: each step keeps rows whose key is present.

    ``frames`` is [(df, df_key, parent_key_in_previous), ...]; returns the last frame filtered.
    """
    current = root
    for df, key, parent_key in frames:
        current = df.join(current.select(F.col(parent_key).alias(key)).distinct(), on=key, how="left_semi")
    return current


def cache_split(rows: DataFrame, cache: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in the cache, rows with novel keys).  Null key parts never match."""
    k = cache.select(*key)
    cond = [rows[c] == k[c] for c in key]
    return rows.join(k, cond, "left_semi"), rows.join(k, cond, "left_anti")


def precedence_merge(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Union frames in precedence order; per key keep the row of the first frame holding it.

    The choice is an aggregate (``min_by`` of the row by precedence), so it combines per task
    before the shuffle instead of ranking every row of a key in one window.
    """
    from .relational import keep_first

    tagged = [f.withColumn("_prec", F.lit(i)) for i, f in enumerate(frames)]
    u = tagged[0]
    for f in tagged[1:]:
        u = u.unionByName(f)
    return keep_first(u, key, ["_prec"]).drop("_prec")


def collision_columns(columns: Sequence[str]) -> list[str]:
    """Column names that look like join-suffix collisions."""
    import re

    return [c for c in columns if re.search(SUFFIX_RE, c)]


def asof_join(left: DataFrame, right: DataFrame, key: Sequence[str], ts: str, right_cols: Sequence[str],
              tie: str | None = None, n_partitions: int | None = None) -> DataFrame:
    """As-of join: each left row gets the right row of the same key with the greatest
    ``ts`` <= its own (a right row at the same instant counts; ``tie`` orders equal right times).

    Skew-safe: both sides are unioned and range-partitioned on (key, ts), so one key's rows are
    cut into runs across tasks.  Inside a run, a running ``last(... ignore nulls)`` finds the
    latest right row; a run starting without one takes the key's last right row from earlier
    partitions (a carry table with one row per (partition, key)).  No pairs are formed.
    """
    key = list(key)
    order_tie = F.col(tie) if tie else F.lit(0)
    r_struct = F.struct(*[F.col(c).alias(c) for c in right_cols])
    l_cols = [c for c in left.columns if c not in key and c != ts]
    lside = left.select(*key, ts, F.lit(1).alias("_kind"), F.lit(None).cast("long").alias("_tie"),
                        F.struct(*[F.col(c) for c in l_cols]).alias("_l"),
                        F.lit(None).cast(right.select(r_struct.alias("x")).schema["x"].dataType).alias("_r"))
    rside = right.select(*key, ts, F.lit(0).alias("_kind"), order_tie.cast("long").alias("_tie"),
                         F.lit(None).cast(lside.schema["_l"].dataType).alias("_l"), r_struct.alias("_r"))
    u = lside.unionByName(rside)
    n = n_partitions or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Materialise the runs once: range bounds come from sampling, and branches that re-ran the
    # exchange could sample different bounds, so partition ids must be fixed before reuse.
    from ..session import materialize

    runs = materialize(u.repartitionByRange(n, *key, ts, "_kind", "_tie")
                       .withColumn("_pid", F.spark_partition_id()), "asof-runs")
    order = [F.col(ts), F.col("_kind"), F.col("_tie")]
    local = runs.withColumn("_last", F.last("_r", ignorenulls=True).over(
        Window.partitionBy("_pid", *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    carry = (runs.where(F.col("_r").isNotNull()).groupBy("_pid", *key)
             .agg(F.max_by("_r", F.struct(*order)).alias("_c")))
    # a (partition, key) run without right rows still needs the carry from earlier partitions
    runs_keys = runs.select("_pid", *key).distinct()
    allk = runs_keys.join(carry, ["_pid", *key], "left")
    carry_in = allk.withColumn("_cin", F.last("_c", ignorenulls=True).over(
        Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).drop("_c")
    out = (local.where(F.col("_kind") == 1).join(carry_in, ["_pid", *key], "left")
           .withColumn("_m", F.coalesce("_last", "_cin")))
    return out.select(*key, ts, *[F.col(f"_l.{c}").alias(c) for c in l_cols],
                      *[F.col(f"_m.{c}").alias(c) for c in right_cols])
