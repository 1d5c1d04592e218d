"""Incremental / streaming queries (I1-I7, I10-I12) bound to the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..streaming import jobs as S
from .registry import Tables, register
from .util import r, rounded

EVENT_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                             T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
                             T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
_CUT = "2024-01-16"


@register("i01_file_stream", sql="SELECT event_id, user_id, ts, event_type, value FROM events")
def i01_file_stream(spark, d):
    """Two landing waves, one checkpoint: the second run processes only the new files."""
    e = Tables(spark, d).events
    landing, sink, ckpt = (scratch_path(spark, x) for x in ("i01-landing", "i01-sink", "i01-ckpt"))
    cut = F.lit(_CUT).cast("timestamp_ntz")
    e.where(F.col("ts") < cut).write.mode("append").parquet(landing)
    S.ingest_new_files(spark, landing, EVENT_SCHEMA, sink, ckpt)
    e.where(F.col("ts") >= cut).write.mode("append").parquet(landing)
    out = S.ingest_new_files(spark, landing, EVENT_SCHEMA, sink, ckpt)
    return out.select("event_id", "user_id", "ts", "event_type", "value")


@register("i07_stream_dedupe", sql="SELECT event_id, user_id, value FROM events")
def i07_stream_dedupe(spark, d):
    """History first, then a second wave of late rows and re-sent copies (every 10th event), merged by key."""
    e = Tables(spark, d).events
    landing, sink, ckpt = (scratch_path(spark, x) for x in ("i07-landing", "i07-sink", "i07-ckpt"))
    e.where(F.col("event_id") % 3 != 0).write.mode("append").parquet(landing)
    S.dedupe_stream(spark, landing, EVENT_SCHEMA, ["event_id"], sink, ckpt)
    e.where((F.col("event_id") % 3 == 0) | (F.col("event_id") % 10 == 0)).write.mode("append").parquet(landing)
    out = S.dedupe_stream(spark, landing, EVENT_SCHEMA, ["event_id"], sink, ckpt)
    return out.select("event_id", "user_id", "value")


_KEY_SCHEMA = T.StructType([T.StructField("l_partkey", T.LongType()), T.StructField("Dealer", T.StringType())])


@register("i05_upsert", sql="""
SELECT DISTINCT l_partkey, CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE substr('NESW', CAST(l_suppkey % 4 + 1 AS INTEGER), 1) END AS Dealer
FROM lineitem""")
def i05_upsert(spark, d):
    li = Tables(spark, d).lineitem
    keys = li.select("l_partkey", F.when(F.col("l_partkey") % 11 == 0, F.lit(None).cast("string"))
                     .otherwise(F.substring(F.lit("NESW"), (F.col("l_suppkey") % 4 + 1).cast("int"), 1)).alias("Dealer"))
    landing, cache, ckpt = (scratch_path(spark, x) for x in ("i05-landing", "i05-cache", "i05-ckpt"))
    keys.write.mode("append").parquet(landing)
    return S.upsert_novel_keys(spark, landing, _KEY_SCHEMA, ["l_partkey", "Dealer"], cache, ckpt)


@register("i11_late", sql="""
WITH w1 AS (SELECT * FROM events WHERE event_id % 7 <> 0), w2 AS (SELECT * FROM events WHERE event_id % 7 = 0),
m AS (SELECT max(ts) AS mx FROM w1)
SELECT event_id, 'on_time' AS status FROM w1
UNION ALL SELECT event_id, CASE WHEN ts < (SELECT mx FROM m) - INTERVAL 1 DAY THEN 'late' ELSE 'on_time' END FROM w2""")
def i11_late(spark, d):
    """Wave 2 (every 7th event) arrives after wave 1; rows behind the watermark go to a side table."""
    e = Tables(spark, d).events
    landing, on_time, late, ckpt = (scratch_path(spark, x) for x in ("i11-landing", "i11-ok", "i11-late", "i11-ckpt"))
    e.where(F.col("event_id") % 7 != 0).write.mode("append").parquet(landing)
    S.split_late(spark, landing, EVENT_SCHEMA, "ts", 86400, on_time, late, ckpt)
    e.where(F.col("event_id") % 7 == 0).write.mode("append").parquet(landing)
    ok, lt = S.split_late(spark, landing, EVENT_SCHEMA, "ts", 86400, on_time, late, ckpt)
    return (ok.select("event_id", F.lit("on_time").alias("status"))
              .unionByName(lt.select("event_id", F.lit("late").alias("status"))))


@register("i02_tumbling", sql=f"""
WITH o AS (SELECT o_totalprice, CAST(o_orderdate AS DATE) AS d FROM orders),
w AS (SELECT o_totalprice, (year(d) * 12 + month(d) - 1) // 3 * 3 AS si FROM o),
mx AS (SELECT max(d) AS m FROM o)
SELECT make_date(CAST(si // 12 AS INTEGER), CAST(si % 12 + 1 AS INTEGER), 1) AS window_start,
  least(CAST(make_date(CAST(si // 12 AS INTEGER), CAST(si % 12 + 1 AS INTEGER), 1) + INTERVAL 3 MONTH AS DATE),
        CAST((SELECT m FROM mx) + INTERVAL 1 DAY AS DATE)) AS window_end,
  count(*) AS n_orders, {r('sum(o_totalprice)', 2)} AS revenue FROM w GROUP BY si""")
def i02_tumbling(spark, d):
    o = Tables(spark, d).orders
    last = o.agg(F.to_date(F.max("o_orderdate")).alias("m")).first()["m"]
    w = S.month_windows(o, "o_orderdate", 3, F.lit(last))
    out = w.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("n_orders"),
                                                       F.sum("o_totalprice").alias("revenue"))
    return rounded(out, 2)


@register("i03_idempotent", sql="SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows FROM orders GROUP BY 1")
def i03_idempotent(spark, d):
    """Write all year partitions, rebuild the recent ones, damage one and repair it: valid
    partitions are skipped, the bad one is rebuilt, and a second pass finds nothing."""
    o = Tables(spark, d).orders.withColumn("year", F.year("o_orderdate"))
    path = scratch_path(spark, "i03")
    S.overwrite_partitions(o, path, ["year"])
    S.overwrite_partitions(o.where(F.col("year") >= 2000), path, ["year"])
    # damage one shard (half its rows), then rebuild only the shards that no longer validate
    S.overwrite_partitions(o.where((F.col("year") == 1998) & (F.col("o_orderkey") % 2 == 0)), path, ["year"])
    rebuilt = S.rebuild_invalid_partitions(o, path, ["year"])
    assert rebuilt == [(1998,)], rebuilt
    assert S.rebuild_invalid_partitions(o, path, ["year"]) == []      # second run: nothing to do
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("rows"))


@register("i04_split", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderdate < TIMESTAMP '1999-07-01' THEN 'train' ELSE 'test' END AS split,
  count(*) AS rows FROM orders GROUP BY ALL""")
def i04_split(spark, d):
    o = Tables(spark, d).orders
    split = F.when(F.col("o_orderdate") < F.lit("1999-07-01").cast("timestamp_ntz"), "train").otherwise("test")
    return (o.select(F.year("o_orderdate").alias("year"), split.alias("split"))
             .groupBy("year", "split").agg(F.count(F.lit(1)).alias("rows")))


@register("i06_retention", sql="""
WITH m AS (SELECT max(o_orderdate) AS mx FROM orders),
c AS (SELECT CASE WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT mx FROM m) AS DATE)) <= 30 THEN 'keep'
                  WHEN date_diff('day', CAST(o_orderdate AS DATE), CAST((SELECT mx FROM m) AS DATE)) <= 45 THEN 'archive'
                  ELSE 'prune' END AS retention FROM orders)
SELECT retention, count(*) AS rows FROM c GROUP BY retention""")
def i06_retention(spark, d):
    o = Tables(spark, d).orders
    newest = o.agg(F.max("o_orderdate").cast("string").alias("m")).first()["m"]   # text: time-zone free
    cls = S.retention_class(F.col("o_orderdate"), F.lit(newest).cast("timestamp_ntz"))
    return o.select(cls.alias("retention")).groupBy("retention").agg(F.count(F.lit(1)).alias("rows"))


@register("i06_retire", sql="""
WITH e AS (SELECT date_diff('day', CAST(ts AS DATE), (SELECT CAST(max(ts) AS DATE) FROM events)) AS age FROM events)
SELECT CASE WHEN age <= 10 THEN 'main' WHEN age <= 20 THEN 'archive' ELSE 'pruned' END AS place, count(*) AS rows FROM e GROUP BY ALL""")
def i06_retire(spark, d):
    """Day partitions kept 10 days, archived up to 20, then deleted; what is found in each place after two runs."""
    e = Tables(spark, d).events.withColumn("day", F.to_date("ts"))
    path, archive, manifest = (scratch_path(spark, x) for x in ("i06-main", "i06-archive", "i06-manifest"))
    S.overwrite_partitions(e, path, ["day"])
    newest = e.agg(F.max("day").cast("string")).first()[0]
    for _ in range(2):
        done = S.retire_partitions(spark, path, archive, manifest, "day", newest, 10, 20)
    here = lambda name, df: df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("place"), "rows")
    gone = done.where("action = 'prune'").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(F.lit("pruned").alias("place"), "rows")
    return here("main", spark.read.parquet(path)).unionByName(here("archive", spark.read.parquet(archive))).unionByName(gone)


@register("i10_phases", sql="""
WITH c AS (SELECT o_custkey, o_orderstatus, sum(o_totalprice) AS total FROM orders GROUP BY ALL), n AS (
SELECT 'clean' AS phase, (SELECT count(*) FROM orders WHERE o_totalprice > 1000) AS r1, (SELECT count(*) FROM orders WHERE o_totalprice > 1000) AS r2, 'run' AS a1, 'skip' AS a2
UNION ALL SELECT 'totals', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_totalprice > 1000), (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 1000)), 'run', 'run'
UNION ALL SELECT 'people', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer), 'run', 'skip'
UNION ALL SELECT 'report', (SELECT count(DISTINCT o_custkey) FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 1000),
  (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 1000)), 'run', 'run'
UNION ALL SELECT 'status', 1, 1, 'run', 'run')
SELECT 1 AS run, phase, a1 AS action, r1 AS rows FROM n UNION ALL SELECT 2, phase, a2, r2 FROM n""")
def i10_phases(spark, d):
    """A job run twice, with another grouping the second time: finished phases are skipped, the changed one and what builds on it run, one always runs."""
    t = Tables(spark, d)
    folder = scratch_path(spark, "i10")

    def job(by: list[str]) -> DataFrame:
        phases = [
            S.Phase("clean", lambda least: t.orders.where(F.col("o_totalprice") > least), {"least": 1000}, inputs=[t.orders]),
            S.Phase("totals", lambda orders, by: orders.groupBy(*by).agg(F.sum("o_totalprice").alias("total")), {"by": by}, after=["clean"]),
            S.Phase("people", lambda: t.customer, inputs=[t.customer]),
            S.Phase("report", lambda totals, people: totals.join(people, F.col("o_custkey") == F.col("c_custkey")), after=["totals", "people"]),
            S.Phase("status", lambda report: report.agg(F.count(F.lit(1)).alias("n")), after=["report"], always=True),
        ]
        actions, outputs = S.run_phases(spark, phases, folder)
        counts = reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("rows")).withColumn("phase", F.lit(n)) for n, df in outputs.items()])
        return actions.join(counts, "phase")

    return reduce(DataFrame.unionByName, [job(by).select(F.lit(i).alias("run"), "phase", "action", "rows") for i, by in ((1, ["o_custkey"]), (2, ["o_custkey", "o_orderstatus"]))])


@register("i10_prefer_latest", sql=f"""
WITH p3 AS (SELECT o_orderkey, o_totalprice * 1.02 AS v FROM orders WHERE o_orderstatus = 'F'),
p2 AS (SELECT o_orderkey, o_totalprice * 1.01 AS v FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
p1 AS (SELECT o_orderkey, o_totalprice AS v FROM orders)
SELECT p1.o_orderkey, {r('coalesce(p3.v, p2.v, p1.v)')} AS prediction,
  CASE WHEN p3.v IS NOT NULL THEN 0 WHEN p2.v IS NOT NULL THEN 1 ELSE 2 END AS source_rank
FROM p1 LEFT JOIN p2 USING (o_orderkey) LEFT JOIN p3 USING (o_orderkey)""")
def i10_prefer_latest(spark, d):
    o = Tables(spark, d).orders
    p3 = o.where(F.col("o_orderstatus") == "F").select("o_orderkey", (F.col("o_totalprice") * 1.02).alias("prediction"))
    p2 = o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", (F.col("o_totalprice") * 1.01).alias("prediction"))
    p1 = o.select("o_orderkey", F.col("o_totalprice").alias("prediction"))
    return rounded(S.prefer_first([p3, p2, p1], ["o_orderkey"], "prediction"))


@register("i12_windows", sql="""
WITH e AS (SELECT event_type, date_trunc('day', ts) AS d0 FROM events),
w AS (SELECT event_type, d0 AS window_start FROM e UNION ALL SELECT event_type, d0 - INTERVAL 1 DAY FROM e)
SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, event_type, count(*) AS n FROM w GROUP BY ALL""")
def i12_windows(spark, d):
    e = Tables(spark, d).events
    w = e.groupBy(F.window("ts", "2 days", "1 day").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n")


@register("i12_session_windows", sql="""
WITH e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
              OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s FROM events),
s AS (SELECT user_id, ts, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, sid""")
def i12_session_windows(spark, d):
    e = Tables(spark, d).events
    w = e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return w.select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n")
