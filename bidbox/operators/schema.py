"""Projection, schema and data-quality operators (P*, V*).

Schema work happens on ``df.schema`` (driver metadata, free); data checks are one-pass
aggregates that run on the executors.  A failed check raises with counts and a few samples.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import coerce_text
from ..functions.keys import composite_key

# fixed values: typed defaults used when aligning a frame to a target schema
DEFAULTS = {"int": 0, "bigint": 0, "smallint": 0, "tinyint": 0, "float": 0.0, "double": 0.0,
            "boolean": False}


class SchemaError(ValueError):
    pass


def q(name: str) -> Column:
    return F.col(f"`{name}`")


# --- P: projection -----------------------------------------------------------------

def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names missing from the frame are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def drop_strict(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop, failing when any listed column is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise SchemaError(f"cannot drop missing columns {missing}")
    return df.drop(*cols)


def drop_by_regex(df: DataFrame, patterns: Sequence[str], only_strings: bool = False) -> DataFrame:
    """Drop columns whose name matches any pattern (``re.match``: anchored at the start)."""
    rx = [re.compile(p) for p in patterns]
    drop = [f.name for f in df.schema.fields
            if any(r.match(f.name) for r in rx) and (not only_strings or isinstance(f.dataType, T.StringType))]
    return df.drop(*drop)


def select_regex(df: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Keep columns whose name ``re.match``es any pattern (prefix match); the scan is pruned."""
    rx = [re.compile(p) for p in patterns]
    return df.select(*[q(c) for c in df.columns if any(r.match(c) for r in rx)])


def by_dtype(df: DataFrame, kinds: Sequence[type], exclude: bool = False) -> DataFrame:
    """P5: select (or exclude) columns whose Spark type is one of ``kinds``."""
    keep = [f.name for f in df.schema.fields if isinstance(f.dataType, tuple(kinds)) != exclude]
    return df.select(*[q(c) for c in keep])


def downcast_doubles(df: DataFrame) -> DataFrame:
    """Every double column becomes float (compute in double, store in float)."""
    return df.select(*[q(f.name).cast("float").alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else q(f.name) for f in df.schema.fields])


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Add missing columns with typed defaults (int 0, float 0.0, bool false, else null),
    drop extras, cast and order as ``target``."""
    cols = []
    for f in target.fields:
        t = f.dataType.simpleString()
        if f.name in df.columns:
            cols.append(q(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(DEFAULTS.get(t)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def add_if_missing(df: DataFrame, name: str, default, dtype: str) -> DataFrame:
    """Add a column with a default only when it is absent."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast(dtype))


def project(df: DataFrame, cols: Sequence[str], strict: bool = True) -> tuple[DataFrame, list[str]]:
    """Strict projection raises on missing columns; lenient returns them."""
    missing = [c for c in cols if c not in df.columns]
    if missing and strict:
        raise SchemaError(f"missing columns {missing}")
    return df.select(*[q(c) for c in cols if c in df.columns]), missing


def leakage_guard(df: DataFrame, target: str, all_targets: Sequence[str], id_patterns: Sequence[str]) -> DataFrame:
    """Drop the other targets and raw id columns (time proxies)."""
    others = [t for t in all_targets if t != target and t in df.columns]
    return drop_by_regex(df.drop(*others), id_patterns)


def search_columns(df: DataFrame, pattern: str, limit: int = 200) -> tuple[list[tuple[str, str]], int]:
    """Case-insensitive regex over sorted column names; (capped matches, total matches)."""
    rx = re.compile(pattern, re.IGNORECASE)
    hits = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields if rx.search(f.name))
    return hits[:limit], len(hits)


# --- P9/P10: feature registry --------------------------------------------------------

def classify_columns(columns: Sequence[str], registry: Sequence[tuple[str, str, str]]) -> dict[str, tuple[str, str]]:
    """Map every column to (group, dtype) by full-match regex.

    ``registry`` rows are (regex, group, dtype).  A column matching no regex or more than one
    raises; unused regexes are reported in the error-free result under the key ``None``.
    """
    compiled = [(re.compile(rx), g, t) for rx, g, t in registry]
    out: dict[str, tuple[str, str]] = {}
    bad_zero, bad_many = [], []
    used = set()
    for c in columns:
        hits = [(i, g, t) for i, (rx, g, t) in enumerate(compiled) if rx.fullmatch(c)]
        if not hits:
            bad_zero.append(c)
        elif len(hits) > 1:
            bad_many.append((c, [registry[i][0] for i, _, _ in hits]))
        else:
            i, g, t = hits[0]
            used.add(i)
            out[c] = (g, t)
    if bad_zero or bad_many:
        raise SchemaError(f"unclassified columns {bad_zero[:10]}; ambiguous {bad_many[:10]}")
    return out


def registry_usage(columns: Sequence[str], registry: Sequence[tuple[str, str, str]]) -> dict[str, int]:
    """How many columns each registry regex classifies; a count of 0 marks an unused regex."""
    return {rx: sum(1 for c in columns if re.fullmatch(rx, c)) for rx, _, _ in registry}


def apply_registry(df: DataFrame, classes: Mapping[str, tuple[str, str]], groups: Sequence[str] | None = None,
                   deny: Sequence[str] = ()) -> DataFrame:
    """Project the columns of the wanted groups (minus denied names), cast to registry dtype."""
    keep = [c for c, (g, _) in classes.items() if (groups is None or g in groups) and c not in deny]
    return df.select(*[q(c).cast(classes[c][1]).alias(c) for c in keep])


# --- V: data quality -----------------------------------------------------------------

def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """V1: one pass; a row per rule with the number of rows violating it (null counts as a violation)."""
    agg = df.agg(*[F.sum(F.when(F.coalesce(rule, F.lit(False)), 0).otherwise(1)).alias(name)
                   for name, rule in rules.items()])
    return agg.unpivot([], list(rules), "rule", "violations")


def assert_rules(df: DataFrame, rules: Mapping[str, Column]) -> None:
    bad = [r for r in rule_violations(df, rules).where("violations > 0").collect()]
    if bad:
        raise SchemaError(f"rule violations: {[(r['rule'], r['violations']) for r in bad]}")


def key_violations(df: DataFrame, key: Sequence[str], nullable_unique: bool = False) -> DataFrame:
    """V2: keys occurring more than once; for a nullable UNIQUE constraint null keys are ignored."""
    d = df
    if nullable_unique:
        d = d.dropna(how="any", subset=list(key))
    return d.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def key_preflight(df: DataFrame, constraints: Mapping[str, Sequence[tuple[str, str, bool]]], row_id: str,
                  top: int = 5, samples: int = 3) -> DataFrame:
    """V2: the collisions that a load would meet: (constraint, key, n, rows), the ``top`` most frequent keys of each constraint.

    ``constraints``: label -> (column, declared type, NOT NULL) of each key part; a label that starts with PRIMARY KEY makes its parts NOT NULL.
    Cells are compared as they are after coercion to their type (C18).  A null of a NOT NULL part becomes "" and takes part; a
    row with a null in a nullable part cannot collide.  ``key`` is C19's composite text, ``rows`` the smallest ids of the rows that share it.

    All constraints are counted in one pass with partial aggregation; samples are read for the reported keys only.
    """
    keys = []
    for label, parts in constraints.items():
        texts = [coerce_text(c, kind, nullable=not (required or label.startswith("PRIMARY KEY"))) for c, kind, required in parts]
        whole = functools.reduce(lambda x, y: x & y, [t.isNotNull() for t in texts])
        keys.append(F.when(whole, F.struct(F.lit(label).alias("constraint"), composite_key(*texts).alias("key"))))
    rows = df.select(F.col(row_id).alias("_row"), F.explode(F.filter(F.array(*keys), lambda k: k.isNotNull())).alias("_k")).select("_row", "_k.*")
    counts = rows.groupBy("constraint", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    most = Window.partitionBy("constraint").orderBy(F.col("n").desc(), "key")
    worst = counts.withColumn("_nr", F.row_number().over(most)).where(F.col("_nr") <= top).drop("_nr")
    first = Window.partitionBy("constraint", "key").orderBy("_row")
    some = rows.join(F.broadcast(worst), ["constraint", "key"]).withColumn("_nr", F.row_number().over(first)).where(F.col("_nr") <= samples)
    return some.groupBy("constraint", "key", "n").agg(F.array_sort(F.collect_list("_row")).alias("rows"))


def column_problems(schema: T.StructType, keep_strings: Sequence[str] | None = None) -> dict[str, list[str]]:
    """V3: for each column that has any: double in a float-only table, join-suffix collision, nested type, string outside ``keep_strings`` (if given)."""
    kinds = {
        "double": lambda f: isinstance(f.dataType, T.DoubleType),
        "string": lambda f: keep_strings is not None and isinstance(f.dataType, T.StringType) and f.name not in keep_strings,
        "join suffix": lambda f: re.search(r"_(x|y|left|right)$", f.name),
        "nested": lambda f: isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)),
    }
    found = {f.name: [kind for kind, has in kinds.items() if has(f)] for f in schema.fields}
    return {name: problems for name, problems in found.items() if problems}


def schema_problems(schema: T.StructType, keep_strings: Sequence[str] | None = None) -> list[str]:
    """V3: the problems of :func:`column_problems` as text."""
    return [f"{name}: {kind}" for name, problems in column_problems(schema, keep_strings).items() for kind in problems]


def same_columns(frames) -> list[str]:
    """V6: differences between the column lists (names and types) of several batches; [] if equal."""
    base = [(f.name, f.dataType.simpleString()) for f in frames[0].schema.fields]
    diffs = []
    for i, f in enumerate(frames[1:], start=1):
        cols = [(x.name, x.dataType.simpleString()) for x in f.schema.fields]
        if cols != base:
            diffs.append(f"batch {i}: {sorted(set(cols) ^ set(base))}")
    return diffs


def parallel_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """V7: rows of parallel reductions of one table, and whether all have the same number: (reduction, n, equal)."""
    parts = [f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("reduction"), "n") for name, f in frames.items()]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    same = counts.agg((F.min("n") == F.max("n")).alias("equal"))
    return counts.crossJoin(F.broadcast(same))  # one row against one row a reduction


def assert_equal_counts(frames: Mapping[str, DataFrame]) -> None:
    """V7: raise unless all reductions have the same number of rows."""
    rows = parallel_counts(frames).collect()
    if not all(r["equal"] for r in rows):
        raise SchemaError(f"parallel reductions differ: {[(r['reduction'], r['n']) for r in rows]}")


def retention(before: DataFrame, after: DataFrame, min_ratio: float = 0.5) -> DataFrame:
    """V5: one row (rows before, rows after, ratio, ok): both counts in one aggregate over a union."""
    tagged = (before.select(F.lit(True).alias("_before"))
              .unionByName(after.select(F.lit(False).alias("_before"))))
    counts = tagged.agg(F.count_if(F.col("_before")).alias("rows_before"),
                        F.count_if(~F.col("_before")).alias("rows_after"))
    ratio = F.col("rows_after") / F.col("rows_before")
    return counts.withColumn("ratio", ratio).withColumn("ok", ratio >= min_ratio)


def cell_diff(a: DataFrame, b: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """V8: full outer join on the key; one row per (key, column) whose values differ (null-safe)."""
    ra = a.select(*key, *[q(c).alias(f"_a_{c}") for c in cols])
    rb = b.select(*key, *[q(c).alias(f"_b_{c}") for c in cols])
    j = ra.join(rb, on=list(key), how="full")
    diffs = F.array(*[F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")),
                             F.struct(F.lit(c).alias("column"), F.col(f"_a_{c}").cast("string").alias("left"),
                                      F.col(f"_b_{c}").cast("string").alias("right"))) for c in cols])
    return (j.select(*key, F.explode(F.filter(diffs, lambda x: x.isNotNull())).alias("d"))
             .select(*key, "d.column", "d.left", "d.right"))
