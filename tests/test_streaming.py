"""Idempotence of the incremental jobs and stream == batch for the streaming operators."""

import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidbox.streaming import jobs as S

KEYS = T.StructType([T.StructField("k", T.LongType()), T.StructField("d", T.StringType())])


def _tmp(tag):
    return tempfile.mkdtemp(prefix=f"bidbox-{tag}-")


def test_upsert_is_idempotent_and_unique(spark):
    landing, cache = _tmp("land") + "/l", _tmp("cache") + "/c"
    rows = [(i % 37, None if i % 5 == 0 else "NESW"[i % 4]) for i in range(400)]
    spark.createDataFrame(rows, KEYS).repartition(5).write.parquet(landing)
    first = S.upsert_novel_keys(spark, landing, KEYS, ["k", "d"], cache, _tmp("ck1"))
    n1 = first.count()
    # replay every batch with a lost checkpoint: the anti join keeps the cache unique
    again = S.upsert_novel_keys(spark, landing, KEYS, ["k", "d"], cache, _tmp("ck2"))
    assert again.count() == n1 == len(set(rows))
    assert again.groupBy("k", "d").count().where("count > 1").count() == 0


def test_partition_overwrite_is_idempotent(spark):
    path = _tmp("parts") + "/p"
    df = spark.range(100).withColumn("part", F.col("id") % 4)
    S.overwrite_partitions(df, path, ["part"])
    S.overwrite_partitions(df.where("part = 1"), path, ["part"])
    S.overwrite_partitions(df.where("part = 1"), path, ["part"])
    got = sorted((r.part, r.n) for r in spark.read.parquet(path).groupBy("part").agg(F.count("*").alias("n")).collect())
    assert got == [(0, 25), (1, 25), (2, 25), (3, 25)]


def test_stream_dedupe_equals_batch_distinct(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("v", T.DoubleType())])
    landing = _tmp("dd") + "/l"
    base = spark.range(300).select(F.col("id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id)").alias("ts"),
                                   (F.col("id") * 0.5).alias("v"))
    sink, ckpt = _tmp("dds") + "/s", _tmp("ddc")
    base.where("id >= 20").unionByName(base.where("id % 7 = 0 AND id >= 20")).write.parquet(landing)
    S.dedupe_stream(spark, landing, schema, ["id"], sink, ckpt)
    base.where("id < 20 OR id % 7 = 0").write.mode("append").parquet(landing)  # late rows in a second batch
    assert sorted(r.id for r in S.dedupe_stream(spark, landing, schema, ["id"], sink, ckpt).collect()) == list(range(300))
    again = S.dedupe_stream(spark, landing, schema, ["id"], sink, _tmp("ddc2"))  # a lost checkpoint: everything is replayed
    assert sorted(r.id for r in again.collect()) == list(range(300))


def test_late_router_replay_is_idempotent(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    landing, ok, late = _tmp("lr") + "/l", _tmp("ok") + "/o", _tmp("late") + "/x"
    rows = spark.range(100).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,id,0,0)").alias("ts"))
    rows.where("id >= 50").write.parquet(landing)
    S.split_late(spark, landing, schema, "ts", 3600, ok, late, _tmp("c1"))
    rows.where("id < 50").write.mode("append").parquet(landing)
    a, b = S.split_late(spark, landing, schema, "ts", 3600, ok, late, _tmp("c2"))
    # the second call had a fresh checkpoint: every batch was replayed into the same folders
    assert a.count() + b.count() == 100 and a.select("id").distinct().count() + b.select("id").distinct().count() == 100


def test_results_do_not_depend_on_session_time_zone(spark):
    import __spark_entry__ as E
    q = E.queries()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = {}
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out[tz] = {n: sorted(tuple(r) for r in q[n](spark, "/root/testdata/sf0.001").collect())
                       for n in ("i06_retention", "i11_late")}
        assert out["UTC"] == out["America/New_York"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _late_rows(spark):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType())])
    return schema, spark.range(40).select("id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,id,0,0)").alias("ts"))


def test_late_router_survives_a_lost_checkpoint(spark):
    schema, rows = _late_rows(spark)
    landing, ok, late = _tmp("lc") + "/l", _tmp("ok") + "/o", _tmp("late") + "/x"
    ids = lambda df: sorted(r.id for r in df.collect())
    rows.where("id >= 30").coalesce(1).write.parquet(landing)
    first = S.split_late(spark, landing, schema, "ts", 3600, ok, late, _tmp("c1"))
    assert (ids(first[0]), ids(first[1])) == (list(range(30, 40)), [])
    rows.where("id < 5 OR id = 29 OR id = 38").withColumn("id", F.col("id") + 100).coalesce(1).write.mode("append").parquet(landing)
    ckpt = _tmp("c1b")
    second = S.split_late(spark, landing, schema, "ts", 3600, ok, late, ckpt)  # the first checkpoint is lost: both files come again
    want = ([*range(30, 40), 138], [100, 101, 102, 103, 104, 129])
    assert (ids(second[0]), ids(second[1])) == want
    for again in (_tmp("c3"), ckpt, _tmp("c4")):  # both files in one batch, nothing new, file by file
        got = S.split_late(spark, landing, schema, "ts", 3600, ok, late, again, max_files_per_trigger=1)
        assert (ids(got[0]), ids(got[1])) == want


def test_late_router_ignores_what_a_crash_left(spark):
    """A batch that wrote its rows but not its log entry is routed again and counts once."""
    schema, rows = _late_rows(spark)
    landing, ok, late = _tmp("cr") + "/l", _tmp("ok") + "/o", _tmp("late") + "/x"
    rows.where("id < 20").coalesce(1).write.parquet(landing)
    rows.where("id < 20").write.parquet(f"{ok}/batch_id=files-of-a-crashed-batch")
    a, b = S.split_late(spark, landing, schema, "ts", 3600, ok, late, _tmp("c"))
    assert a.count() == 20 and b.count() == 0


def test_repair_takes_null_partitions_and_many_keys(spark):
    path = _tmp("rep") + "/p"
    df = spark.range(60).select("id", F.when(F.col("id") % 6 < 5, (F.col("id") % 6).cast("int")).alias("a"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("b"))
    S.overwrite_partitions(df.where("id > 5"), path, ["a", "b"])
    assert len(S.rebuild_invalid_partitions(df, path, ["a", "b"])) == 6
    assert S.rebuild_invalid_partitions(df, path, ["a", "b"]) == [] and spark.read.parquet(path).count() == 60
