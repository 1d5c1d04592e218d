"""Mixing sources to target weights: min-cost flow for overlapping sources.

1. Documents are aggregated by membership pattern (the sorted set of sources that a document belongs to);
   a pattern's capacity is its number of words.
2. A small flow network routes capacity to the sources' quotas.  A pattern gives its words once, twice and so
   on at a rising cost a word (convex repetition costs), so a word is repeated only when no fresh one can serve.
3. Within a pattern documents lie on a seeded order.  Passes over that order are as long as all the pattern's routes
   together; whole documents that end inside this length are taken, then a few short ones fill the rest.

The driver sees one row a pattern and one a source.  Both are counted first and more than ``MAX_PATTERNS`` is an
error, as the flow is solved on the driver.  Documents are never collected: prefix sums run over hash buckets,
so a source that holds a third of all rows is spread over all tasks.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidbox.llm.common import id_key, materialize, row_key, word_count

#: Most membership patterns (and sources) whose flow is solved; beyond it the call raises.
MAX_PATTERNS = 100_000
#: Hash buckets of the seeded order of a pattern: each is sorted by itself, so no task sorts a whole source.
BUCKETS = 4096
#: Cost a word of the first, second, ... use of a document.
REPEAT_COST = (0, 1, 3, 6, 10, 15, 21, 28)


def water_fill(sizes: list[int], weights: list[float], max_repeats: int) -> list[float]:
    """Targets that share the total size by weight, none above ``max_repeats`` times its size.

    The excess of a source that reaches its limit is shared by weight among the rest until none is above.
    """
    targets, free, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if rest * weights[i] / weight > max_repeats * sizes[i]}
        if not over:
            for i in free:
                targets[i] = rest * weights[i] / weight
            break
        for i in over:
            targets[i] = float(max_repeats * sizes[i])
            rest -= targets[i]
        free -= over
    return targets


def route(capacity: dict[tuple, int], quota: dict, max_repeats: int) -> dict[tuple, dict]:
    """Words that each pattern gives to each of its sources: a min-cost flow by successive shortest paths.

    Arcs: start to pattern (one for each repetition, at rising cost), pattern to its sources, source to end.
    Quotas that cannot be met get as much as there is.
    """
    heads: list[int] = []
    room: list[float] = []
    cost: list[int] = []
    arcs: dict[object, list[int]] = defaultdict(list)

    def arc(a: object, b: object, c: float, w: int) -> None:
        for tail, head, space, price in ((a, b, c, w), (b, a, 0.0, -w)):
            arcs[tail].append(len(heads))
            heads.append(head)  # type: ignore[arg-type]
            room.append(space)
            cost.append(price)

    given: dict[int, tuple] = {}
    for p, c in sorted(capacity.items(), key=repr):
        for k in range(max_repeats):
            arc("start", ("p", p), float(c), REPEAT_COST[k] if k < len(REPEAT_COST) else k * k)
        for s in p:
            given[len(heads)] = (p, s)
            arc(("p", p), ("s", s), math.inf, 0)
    for s, q in sorted(quota.items(), key=repr):
        arc(("s", s), "end", float(q), 0)

    tiny = 1e-6
    price: dict[object, int] = defaultdict(int)
    while True:
        best, came = {"start": 0}, {}
        heap: list[tuple[int, int, object]] = [(0, 0, "start")]
        order = 0
        while heap:
            d, _, node = heapq.heappop(heap)
            if d > best[node]:
                continue
            for i in arcs[node]:
                if room[i] > tiny:
                    to = heads[i]
                    reach = d + cost[i] + price[node] - price[to]
                    if reach < best.get(to, math.inf):
                        best[to], came[to] = reach, i
                        order += 1
                        heapq.heappush(heap, (reach, order, to))
        if "end" not in best:
            break
        far = best["end"]
        for node in list(arcs):
            price[node] += min(best.get(node, far), far)
        path, node = [], "end"
        while node != "start":
            i = came[node]
            path.append(i)
            node = heads[i ^ 1]
        flow = min(room[i] for i in path)
        for i in path:
            room[i] -= flow
            room[i ^ 1] += flow
    routed: dict[tuple, dict] = defaultdict(dict)
    for i, (p, s) in given.items():
        if room[i ^ 1] > tiny:
            routed[p][s] = room[i ^ 1]
    return routed


def _pattern(sources: Column) -> Column:
    """A null source is a source of its own; an empty or null set of sources belongs to nothing."""
    return F.array_sort(F.array_distinct(F.transform(sources, lambda s: F.struct(s.isNull().alias("none"), F.coalesce(s, F.lit("")).alias("name")))))


def mix(docs: DataFrame, targets: dict, *, doc_id: str = "doc_id", text: str = "text", sources: Column | None = None,
        max_repeats: int = 3, seed: int = 7, fill_rounds: int = 4) -> DataFrame:
    """Columns (the row's id and ``mix_key``, sizes, ``copies``, ``taken``), one row for each row of ``docs``.

    ``targets`` gives the words wanted from each source (None names the null source); ``sources`` is an array column
    (default: the column ``source`` alone).  ``taken`` = ``copies`` * ``mix_size`` words.  Null and empty texts have size 0 and are not taken.
    Identical rows are told apart by a running number.  The order of documents depends on id, text and seed alone.
    An empty table gives no rows.  Columns of ``docs`` beyond those named are neither read nor returned.
    """
    sources = sources if sources is not None else F.array(F.col("source"))
    slim = materialize(
        docs.select(F.col(doc_id).alias("doc_id"), row_key(text).alias("mix_key"), word_count(F.col(text)).alias("mix_size"), _pattern(sources).alias("pattern"))
        .withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "mix_key"))
        .withColumn("bucket", F.pmod(F.shiftright("h", 20), F.lit(BUCKETS)).cast("int"))
        .withColumn("row", F.monotonically_increasing_id()), "mix")
    by_pattern = slim.groupBy("pattern").agg(F.sum("mix_size").alias("words"))
    rows = by_pattern.limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns: merge rare sources before mixing")
    names = {tuple(None if s["none"] else s["name"] for s in r["pattern"] or ()): (r["pattern"], r["words"]) for r in rows}
    routed = route({p: w for p, (_, w) in names.items() if w and p}, targets, max_repeats)

    spark = docs.sparkSession
    plan = [(names[p][0], int(names[p][1]), float(sum(r.values()))) for p, r in routed.items()]
    kind = slim.schema["pattern"].dataType.simpleString()
    lengths = F.broadcast(spark.createDataFrame(plan, f"pattern {kind}, words long, length double"))  # at most MAX_PATTERNS rows

    w = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (slim.groupBy("pattern", "bucket").agg(F.sum("mix_size").alias("here"))
              .select("pattern", "bucket", F.coalesce(F.sum("here").over(w), F.lit(0)).alias("before")))
    inside = Window.partitionBy("pattern", "bucket").orderBy("h", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = (slim.withColumn("start", F.coalesce(F.sum("mix_size").over(inside), F.lit(0)))
              .join(before, ["pattern", "bucket"]).withColumn("start", F.col("start") + F.col("before"))
              .join(lengths, "pattern", "left"))
    # copy j of a document lies at j * words + start on the pattern's passes; it is taken if it ends inside the length
    copies = F.floor((F.col("length") - F.col("start") - F.col("mix_size")) / F.col("words")) + 1
    placed = placed.withColumn("copies", F.when(F.col("length").isNull() | (F.col("mix_size") == 0), 0).otherwise(F.greatest(F.lit(0), F.least(copies, F.lit(max_repeats)))).cast("long"))
    placed = materialize(placed.select("doc_id", "mix_key", "mix_size", "pattern", "h", "row", "length", "copies"), "mix")
    return _fill(placed, max_repeats, fill_rounds).withColumn("taken", F.col("copies") * F.col("mix_size")).select("doc_id", "mix_key", "mix_size", "pattern", "copies", "taken")


def _fill(placed: DataFrame, max_repeats: int, rounds: int) -> DataFrame:
    """One more copy of the longest document that still fits, a few times; last, of one that overshoots by less than is missing.

    ``more`` keeps at most ``rounds`` + 1 rows a pattern, which are few (see MAX_PATTERNS).
    """
    spark = placed.sparkSession
    sums = placed.groupBy("pattern").agg(F.first("length").alias("length"), F.sum(F.col("copies") * F.col("mix_size")).alias("got")).where("length IS NOT NULL").collect()
    missing = {tuple(map(tuple, r["pattern"])): r["length"] - r["got"] for r in sums}
    extra: dict[tuple, int] = {}
    kind = placed.schema["pattern"].dataType.simpleString()
    free = placed.where((F.col("copies") < max_repeats) & (F.col("mix_size") > 0) & F.col("length").isNotNull())
    for k in range(rounds + 1):
        want = [(list(p), m) for p, m in missing.items() if m >= 1]
        if not want:
            break
        need = F.broadcast(spark.createDataFrame(want, f"pattern {kind}, missing double"))
        taken = spark.createDataFrame([(h, r) for h, r in extra], "h long, row long")
        left = free.join(need, "pattern").join(F.broadcast(taken), ["h", "row"], "left_anti")
        if k < rounds:
            left = left.where("mix_size <= missing")
            pick = F.max(F.struct("mix_size", "h", "row"))
        else:
            left = left.where("mix_size < 2 * missing")
            pick = F.min(F.struct("mix_size", "h", "row"))
        for r in left.groupBy("pattern").agg(pick.alias("d")).collect():
            extra[r["d"]["h"], r["d"]["row"]] = 1
            missing[tuple(map(tuple, r["pattern"]))] -= r["d"]["mix_size"]
    more = F.broadcast(spark.createDataFrame([(h, r, 1) for h, r in extra], "h long, row long, more int"))
    return placed.join(more, ["h", "row"], "left").withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0)))


def source_targets(docs: DataFrame, *, source: str = "source", text: str = "text", weights: tuple = (1, 2, 3), max_repeats: int = 3) -> list[tuple]:
    """(source, its words, target) of each source by code point, null last; weights repeat in that order."""
    rows = docs.groupBy(F.col(source).alias("s")).agg(F.sum(word_count(F.col(text))).alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sources")
    rows = sorted(rows, key=lambda r: (r["s"] is None, r["s"] or ""))
    sizes = [int(r["n"]) for r in rows]
    goals = water_fill(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))], max_repeats)
    return [(r["s"], n, g) for r, n, g in zip(rows, sizes, goals, strict=True)]


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it; rows that it does not take are absent.

    Null and empty texts have no words and so no place in the mix.
    """
    goals = source_targets(docs)
    got = (mix(docs, {s: g for s, _, g in goals}, **options).where("copies > 0")
           .groupBy(id_key().alias("id_key"), "mix_key").agg(F.sum("copies").cast("int").alias("copies")))
    # rows that repeat an id and a text share their key: that with the smallest hash over all columns stands for all of their copies
    same = Window.partitionBy("id_key", "mix_key").orderBy("turn")
    turn = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("turn")
    rows = docs.select(F.struct("*").alias("doc"), id_key().alias("id_key"), row_key().alias("mix_key"), turn).withColumn("nr", F.row_number().over(same)).where("nr = 1")
    out = rows.join(got, ["id_key", "mix_key"])
    return out.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")
