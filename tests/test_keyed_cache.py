"""The keyed cache: reads follow the batch, replays and crashes add nothing twice, compaction keeps every row."""

import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidbox.streaming import jobs as S
from bidbox.streaming import keyed

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("d", T.StringType()), T.StructField("v", T.DoubleType())])
SIZES = {"rows_per_bucket": 64, "most_buckets": 64}


def _cache():
    return tempfile.mkdtemp(prefix="bidbox-keyed-") + "/c"


def _rows(spark, a, b):
    return spark.range(a, b).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("d"), (F.col("id") * 0.5).alias("v"))


def _keys(spark, cache):
    return sorted(r.k for r in keyed.read(spark, cache, SCHEMA).collect())


def test_batch_reads_only_buckets_that_may_hold_its_keys(spark):
    cache = _cache()
    assert keyed.append_novel(_rows(spark, 0, 100), cache, ["k", "d"], **SIZES) == []
    assert keyed._current(spark, cache) == keyed.Generation(0, 2, 0, 100) and not keyed.compact(spark, cache, SCHEMA, ["k", "d"], **SIZES)
    assert keyed.append_novel(_rows(spark, 0, 3000), cache, ["k", "d"], **SIZES) == [0, 1]
    assert keyed.compact(spark, cache, SCHEMA, ["k", "d"], **SIZES) and not keyed.compact(spark, cache, SCHEMA, ["k", "d"], **SIZES)
    assert keyed._current(spark, cache) == keyed.Generation(1, 64, 3000, 0)
    new = [keyed.append_novel(_rows(spark, a, a + 1), cache, ["k", "d"], **SIZES) for a in (5000, 5001, 5002, 5003)]
    assert sum(map(len, new)) <= 1  # the filter tells new keys, but for a few
    for k in (7, 2999):  # known keys: the one bucket of each
        (b,) = keyed.append_novel(_rows(spark, k, k + 1), cache, ["k", "d"], **SIZES)
        held = spark.read.parquet(f"{cache}/rows/gen=1/cache_bucket={b}")
        assert held.where(f"k = {k}").count() == 1 and held.count() < 150
    assert _keys(spark, cache) == [*range(3000), *range(5000, 5004)]


def test_known_keys_are_found_whatever_the_nulls(spark):
    cache = _cache()
    rows = spark.createDataFrame([(1, None, 1.0), (None, "1", 2.0), (None, None, 3.0), (1, "1", 4.0), (None, None, 5.0)], SCHEMA)
    for _ in range(3):
        keyed.append_novel(rows, cache, ["k", "d"], **SIZES)
    got = keyed.read(spark, cache, SCHEMA)
    assert got.count() == 4 and got.select("k", "d").distinct().count() == 4 and got.columns == SCHEMA.names


def test_crash_between_filter_and_rows_and_between_copy_and_commit(spark):
    cache = _cache()
    keyed.append_novel(_rows(spark, 0, 100), cache, ["k"], **SIZES)
    marked = _rows(spark, 100, 200).withColumn("cache_bucket", keyed._bucket(["k"], 2))
    keyed._append(keyed._filter_pages(marked, ["k"], SIZES["rows_per_bucket"]), f"{cache}/filter/gen=0")  # the batch died here
    assert keyed.append_novel(_rows(spark, 50, 200), cache, ["k"], **SIZES) == [0, 1] and _keys(spark, cache) == list(range(200))
    keyed._append(_rows(spark, 0, 20).withColumn("cache_bucket", F.lit(1)), f"{cache}/rows/gen=1")  # a copy without its commit
    assert _keys(spark, cache) == list(range(200))
    assert keyed.compact(spark, cache, SCHEMA, ["k"], **SIZES) and _keys(spark, cache) == list(range(200))
    assert sorted(x for x in os.listdir(f"{cache}/rows") if "=" in x) == ["gen=1"]


def test_empty_batches_and_caches(spark):
    cache = _cache()
    assert _keys(spark, cache) == [] and not keyed.compact(spark, cache, SCHEMA, ["k"])
    keyed.append_novel(_rows(spark, 0, 0), cache, ["k"], **SIZES)
    assert _keys(spark, cache) == []
    keyed.append_novel(_rows(spark, 0, 5), cache, ["k"], **SIZES)
    keyed.append_novel(_rows(spark, 0, 0), cache, ["k"], **SIZES)
    assert _keys(spark, cache) == list(range(5))


def test_stream_over_many_files_with_compaction_and_lost_checkpoint(spark):
    landing, sink = tempfile.mkdtemp(prefix="bidbox-land-") + "/l", _cache()
    _rows(spark, 0, 900).repartition(3).write.parquet(landing)
    _rows(spark, 600, 1000).coalesce(1).write.mode("append").parquet(landing)
    for _ in range(2):  # the second run has no checkpoint and replays all
        got = S.dedupe_stream(spark, landing, SCHEMA, ["k", "d"], sink, tempfile.mkdtemp(), max_files_per_trigger=1, **SIZES)
        assert got.count() == 1000 and got.select("k").distinct().count() == 1000 and got.agg(F.sum("v")).first()[0] == sum(range(1000)) / 2
    assert keyed._current(spark, sink).number >= 1
