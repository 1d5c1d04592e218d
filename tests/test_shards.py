"""Shards sized by bytes; the manifest tells what was written from what is there."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from bidbox.sources import files as FS


def _rows(spark, n):
    return spark.range(n).select("id", F.when(F.col("id") % 3 > 0, F.repeat(F.lit("é"), 50)).alias("text"), F.array("id").alias("list"), F.create_map(F.lit("k"), "id").alias("m"))


def test_round_trip_by_bytes(spark, tmp_path):
    df, path = _rows(spark, 2000), f"{tmp_path}/s"
    manifest = FS.write_shards(df, path, ["id"], shard_bytes=20_000).collect()
    total = df.agg(F.sum(FS.row_bytes(df.schema))).first()[0]
    assert len(manifest) == -(-total // 20_000) and sum(r.row_bytes for r in manifest) == total and sum(r.rows for r in manifest) == 2000
    assert all(r.row_bytes < 40_000 for r in manifest)
    back = FS.read_shards(spark, path, df.schema)
    assert sorted((r.id, r.text, r.list, r.m) for r in back.collect()) == [(r.id, r.text, r.list, r.m) for r in df.orderBy("id").collect()]
    again = FS.write_shards(df.repartition(3), f"{tmp_path}/t", ["id"], shard_bytes=20_000).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, manifest))


def test_lost_extra_and_changed_shards_raise(spark, tmp_path):
    df = _rows(spark, 300).drop("m")
    FS.write_shards(df, f"{tmp_path}/lost", ["id"], 5_000)
    (lost,) = glob.glob(f"{tmp_path}/lost/data/shard=1/*.parquet")
    os.remove(lost)
    FS.write_shards(df, f"{tmp_path}/extra", ["id"], 5_000)
    df.limit(1).write.parquet(f"{tmp_path}/extra/data/shard=999")
    FS.write_shards(df, f"{tmp_path}/changed", ["id"], 5_000)
    other = df.withColumn("text", F.translate("text", "é", "è")).withColumn("shard", F.lit(0))
    held = spark.read.parquet(f"{tmp_path}/changed/data/shard=0").select("id")
    other.join(held, "id").drop("shard").select(*df.columns).write.mode("overwrite").parquet(f"{tmp_path}/changed/data/shard=0")
    for name in ("lost", "extra", "changed"):
        with pytest.raises(FS.ManifestError):
            FS.read_shards(spark, f"{tmp_path}/{name}", df.schema)


def test_empty_table(spark, tmp_path):
    df = _rows(spark, 0)
    assert FS.write_shards(df, f"{tmp_path}/e", ["id"]).collect() == []
    assert FS.read_shards(spark, f"{tmp_path}/e", df.schema).collect() == []


def test_compaction_is_cut_by_what_a_sort_holds(spark, tmp_path):
    """Rows that compress well, most with one order value: files by the rows' own size, in order, nothing lost."""
    df = spark.range(40_000).select("id", F.when(F.col("id") < 30_000, 7).otherwise(F.col("id")).alias("day"), F.lit("x" * 200).alias("text"))
    df.repartition(10).write.parquet(f"{tmp_path}/shards")
    out = FS.compact(spark, f"{tmp_path}/shards", f"{tmp_path}/merged", "day", task_bytes=1 << 20)
    assert out.columns == ["id", "day", "text"]
    files = sorted((r.lo, r.hi, r.n) for r in out.groupBy("_metadata.file_path").agg(F.min("day").alias("lo"), F.max("day").alias("hi"), F.count("*").alias("n")).collect())
    assert len(files) >= 8 and max(n for _, _, n in files) < 12_000
    assert all(a[1] <= b[0] for a, b in zip(files, files[1:]))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
