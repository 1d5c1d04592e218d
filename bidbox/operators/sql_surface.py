"""Ad-hoc SQL over registered tables (Q1-Q3): temp views + ``spark.sql`` with a read-only guard.

Catalyst parses, analyses and optimises the statement.  This module registers views, expands identifier
macros, caps rows, and lets a statement through only if everything in it is on an allow list:

* parsed: plan nodes and expressions of a query, one-part relation names, and built-in functions of the allowed groups.  Commands,
  scripts, IDENTIFIER clauses and kinds of statement that later versions bring are on no list;
* analysed: every leaf is a registered view, a CTE of the statement or rows spelled out in it.

The text itself is passed on untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .relational import capped

# fixed values: the plan nodes a parsed query consists of
_PLAN = set("""
    Aggregate CTERelationDef CTERelationRef Distinct Except Filter Generate GlobalLimit Intersect Join LateralJoin LocalLimit LocalRelation Offset
    OneRowRelation Pivot Project Range Sample Sort SubqueryAlias Union UnresolvedHaving UnresolvedInlineTable UnresolvedRelation
    UnresolvedSubqueryColumnAliases UnresolvedTVFAliases UnresolvedTableValuedFunction UnresolvedWith Unpivot Window WithCTE WithWindowDefinition
""".split())
# fixed values: the expressions the parser itself makes; all others come from function names
_EXPRESSIONS = set("""
    Add Alias And AttributeReference BitwiseAnd BitwiseNot BitwiseOr BitwiseXor CaseWhen Cast Concat CreateNamedStruct Cube CurrentDate CurrentRow CurrentTime
    CurrentTimestamp Divide EqualNullSafe EqualTo Exists GreaterThan GreaterThanOrEqual GroupingSets ILike In InSubquery IntegralDivide IsNaN IsNotNull
    IsNotUnknown IsNull IsUnknown LambdaFunction LateralSubquery LessThan LessThanOrEqual Like LikeAll LikeAny ListQuery Literal Multiply
    MultiAlias NamedParameter Not NotLikeAll NotLikeAny Or OuterReference PosParameter RLike Remainder Rollup ScalarSubquery SortOrder
    SpecifiedWindowFrame StringLocate StringTrim StringTrimBoth StringTrimLeft StringTrimRight Subtract Substring TimestampAdd TimestampDiff UnaryMinus
    UnaryPositive UnboundedFollowing UnboundedPreceding UnresolvedAlias UnresolvedAttribute UnresolvedExtractValue UnresolvedFunction
    UnresolvedGenerator UnresolvedNamedLambdaVariable UnresolvedOrdinal UnresolvedRegex UnresolvedStar UnresolvedSubqueryColumnAliases
    UnresolvedWindowExpression UnspecifiedFrame WindowExpression WindowSpecDefinition
""".split())
# fixed values: Spark's groups of built-in functions that only compute on their arguments; the others reach files, the session or the JVM
_FUNCTION_GROUPS = set("""
    agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs csv_funcs datetime_funcs generator_funcs hash_funcs
    json_funcs lambda_funcs map_funcs math_funcs predicate_funcs string_funcs struct_funcs url_funcs variant_funcs window_funcs
""".split())
# fixed values: table functions that make rows of their arguments
_TABLE_FUNCTIONS = {"range", "explode", "explode_outer", "posexplode", "posexplode_outer", "inline", "inline_outer", "stack"}
# fixed values: leaves of an analysed query that hold no stored data
_LEAVES = {"OneRowRelation", "LocalRelation", "Range", "CTERelationRef", "ResolvedInlineTable"}
_STRINGS = re.compile(r"'(?:[^'\\]|\\.)*'")


class QueryRejected(ValueError):
    pass


def _seq(scala_seq) -> Iterator:
    for i in range(scala_seq.size()):
        yield scala_seq.apply(i)


def _kind(node) -> str:
    return node.getClass().getSimpleName().rstrip("$")


def _parse(spark: SparkSession, sql: str):
    try:
        return spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:  # a Py4J error that wraps Spark's ParseException
        if isinstance(e, ParseException) or "ParseException" in str(e):
            raise QueryRejected(f"not one SQL query: {str(e).splitlines()[0][:200]}") from None
        raise


def _check_function(spark: SparkSession, parts: list[str]) -> None:
    name = parts[-1].lower()
    info = None
    if len(parts) == 1:
        jvm = spark._jvm.org.apache.spark.sql.catalyst
        found = spark._jsparkSession.sessionState().functionRegistry().lookupFunction(jvm.FunctionIdentifier(name))
        info = found.get() if found.isDefined() else None
    if info is None or info.getSource() != "built-in" or info.getGroup() not in _FUNCTION_GROUPS:
        raise QueryRejected(f"function {'.'.join(parts)} is not allowed")


def _check_parsed(spark: SparkSession, node, known: set[str], is_plan: bool = True) -> None:
    """Refuse a plan node or expression, or any below it, that is on no list.  ``known``: relation names and the CTEs around the node."""
    kind = _kind(node)
    if kind not in (_PLAN if is_plan else _EXPRESSIONS):
        raise QueryRejected(f"{kind} is not allowed in a query")
    if kind == "UnresolvedWith":
        known = set(known)
        for cte in _seq(node.cteRelations()):
            _check_parsed(spark, cte._2(), known | ({cte._1().lower()} if node.allowRecursion() else set()))
            known.add(cte._1().lower())
        _check_parsed(spark, node.child(), known)
        return
    if kind == "UnresolvedRelation":
        parts = [str(p) for p in _seq(node.multipartIdentifier())]
        if len(parts) != 1 or parts[0].lower() not in known:
            raise QueryRejected(f"unknown relation {'.'.join(parts)}")
        return
    if kind == "UnresolvedTableValuedFunction":
        parts = [str(p) for p in _seq(node.name())]
        if len(parts) != 1 or parts[0].lower() not in _TABLE_FUNCTIONS:
            raise QueryRejected(f"table function {'.'.join(parts)} is not allowed")
    if kind == "UnresolvedFunction":
        _check_function(spark, [str(p) for p in _seq(node.nameParts())])
    if kind == "UnresolvedGenerator":
        _check_function(spark, [node.name().unquotedString()])
    if kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery"):
        _check_parsed(spark, node.plan(), known)
    for child in _seq(node.children()):
        _check_parsed(spark, child, known, is_plan)
    if is_plan:
        for e in _seq(node.expressions().toSeq()):
            _check_parsed(spark, e, known, False)


def guard(spark: SparkSession, sql: str, names: Iterable[str]) -> str:
    """Q3: the text if it is one read-only query over ``names`` (and its own CTEs), else :class:`QueryRejected`.

    Nothing is run and no relation is looked up.
    """
    _check_parsed(spark, _parse(spark, sql), {n.lower() for n in names})
    return sql


def _check_analysed(node, names: set[str]) -> None:
    kind = _kind(node)
    if kind == "View" and node.isTempView() and node.desc().identifier().table().lower() in names:
        return  # what a registered view reads is its owner's choice
    if node.children().isEmpty() and kind not in _LEAVES:
        raise QueryRejected(f"{kind} is not a registered relation")
    for child in _seq(node.children()):
        _check_analysed(child, names)
    for below in _seq(node.subqueries()):
        _check_analysed(below, names)


def guarded(spark: SparkSession, sql: str, names: Iterable[str], args: Mapping | None = None) -> DataFrame:
    """The rows of a query that passes :func:`guard` and reads nothing but the registered views."""
    names = {n.lower() for n in names}
    df = spark.sql(guard(spark, sql, names), args=dict(args or {}))
    _check_analysed(df._jdf.queryExecution().analyzed(), names)
    return df


@contextmanager
def views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> Iterator[list[str]]:
    """Temp views for the length of a statement's analysis; views that they hide come back afterwards."""
    ours = [n.lower() for n in tables]
    hidden = {t.name.lower(): spark.table(t.name) for t in spark.catalog.listTables() if t.isTemporary and t.name.lower() in ours}
    try:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        yield list(tables)
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, df in hidden.items():
            df.createOrReplaceTempView(name)


def session_sql(spark: SparkSession, tables: Mapping[str, DataFrame], sql: str,
                limit: int | None = None, args: Mapping | None = None) -> DataFrame:
    """Q1: register the tables, run one guarded SELECT, return its rows (optionally capped).

    With ``limit`` the result is capped through O3 (clamped to 1..2000 plus a ``truncated``
    flag); the order is all output columns, so the kept rows are deterministic.
    """
    with views(spark, tables) as names:
        df = guarded(spark, sql, names, args)
    if limit is None:
        return df
    return capped(df, [F.col(f"`{c}`") for c in df.columns], limit=limit)


_MACRO = re.compile(r"\{(\w+)\}")
_HAS_FROM = re.compile(r"\bfrom\b", re.IGNORECASE)


def expand_macros(sql: str, macros: Mapping[str, str]) -> str:
    """Q2: replace ``{Name}`` identifier macros; unknown macros are an error."""
    def sub(m: re.Match) -> str:
        if m.group(1) not in macros:
            raise QueryRejected(f"unknown macro {{{m.group(1)}}}")
        value = macros[m.group(1)]
        if not re.fullmatch(r"\w+", value):
            raise QueryRejected(f"macro {m.group(1)} must expand to an identifier")
        return value
    return _MACRO.sub(sub, sql)


def self_sql(spark: SparkSession, df: DataFrame, sql: str, macros: Mapping[str, str] | None = None,
             args: Mapping | None = None, view: str = "self") -> DataFrame:
    """Q2: SQL over one frame exposed as ``self``; ``FROM self`` is put in front when the query
    has no FROM (Spark accepts the FROM-first form ``FROM self SELECT ... WHERE ... GROUP BY``).

    Macros expand identifiers (column names); values go through ``args`` (bound parameters).
    """
    q = expand_macros(sql, macros or {})
    if not _HAS_FROM.search(_STRINGS.sub("''", q)):
        q = f"FROM {view} {q.strip()}"
    with views(spark, {view: df}) as names:
        return guarded(spark, q, names, args)
