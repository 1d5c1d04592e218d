"""A cache unique on a key, in which a micro-batch reads only what may hold its own keys.

Layout below the cache's folder, by generation ``g``:

* ``rows/gen=<g>/cache_bucket=<b>``: the rows, in buckets by the hash of the key;
* ``filter/gen=<g>/cache_bucket=<b>``: Bloom filters of the buckets, as pages of 32,768 bits that batches add to;
* ``log/gen=<g>``: the generation's number of buckets, then the number of rows that each batch added.

A batch tests its keys against the filter pages of the buckets that they fall into, reads the key columns of those buckets in which a key may
exist already, and appends the others.  A batch of new keys therefore reads filter pages only.  The filter is written before the
rows: after a crash between the two it names keys that are not there, which costs a read and loses nothing, and a
retried batch finds the rows that it wrote before.  Keys are compared in full and null-safely; hashes only choose what is read.

``compact`` copies a generation that has doubled into one with more buckets and whole files.  Its first log entry is the commit: a
generation without one does not count and is overwritten by the next try.  Each row is copied a bounded number of times on average.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists

#: Rows that a bucket is planned for.
ROWS_PER_BUCKET = 1 << 16
#: Folders of a generation at most; beyond MOST_BUCKETS * ROWS_PER_BUCKET rows buckets grow instead.
MOST_BUCKETS = 4096
#: Bits of a filter page (that of the ``bitmap_*`` functions), bits a key, and bits set by a key: 2 % false positives.
PAGE_BITS, BITS_PER_ROW, PROBES = 32768, 10, 3
_BUCKET, _LOG = "cache_bucket", "n_buckets int, rows long, gen int"


@dataclass(frozen=True)
class Generation:
    """Where the current rows are, in how many buckets, and how many there were at its start and since."""

    number: int
    buckets: int
    start: int
    added: int


def _append(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).partitionBy(_BUCKET).parquet(path)


def _current(spark: SparkSession, cache: str) -> Generation | None:
    if not path_exists(spark, f"{cache}/log"):
        return None
    log = spark.read.schema(_LOG).parquet(f"{cache}/log").groupBy("gen").agg(
        F.max("n_buckets").alias("n"), F.sum(F.when(F.col("n_buckets").isNotNull(), F.col("rows"))).alias("start"),
        F.sum(F.when(F.col("n_buckets").isNull(), F.col("rows"))).alias("added")).where("n IS NOT NULL")
    row = log.orderBy(F.desc("gen")).first()
    return row and Generation(row.gen, row.n, row.start, row.added or 0)


def _log(spark: SparkSession, cache: str, gen: int, n_buckets: int | None, rows: int) -> None:
    spark.createDataFrame([(n_buckets, rows)], "n_buckets int, rows long").coalesce(1).write.mode("append").parquet(f"{cache}/log/gen={gen}")


def _buckets_for(rows: int, rows_per_bucket: int, most: int) -> int:
    n = 1
    while n < most and n * rows_per_bucket < rows:
        n *= 2
    return n


def _bucket(key: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(n)).cast("int")


def _probes(key: Sequence[str], rows_per_bucket: int) -> Column:
    """The key's positions in its bucket's filter, from 1."""
    bits = PAGE_BITS * max(1, -(-2 * rows_per_bucket * BITS_PER_ROW // PAGE_BITS))
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), *key), F.lit(bits)) + 1 for i in range(PROBES)])


def _filter_pages(rows: DataFrame, key: Sequence[str], rows_per_bucket: int) -> DataFrame:
    at = rows.select(_BUCKET, F.explode(_probes(key, rows_per_bucket)).alias("at"))
    return (at.groupBy(_BUCKET, F.bitmap_bucket_number("at").alias("page"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))


def _may_exist(batch: DataFrame, key: Sequence[str], pages: DataFrame, rows_per_bucket: int) -> DataFrame:
    """The buckets in which some key of the batch has all of its bits set."""
    pages = pages.groupBy(_BUCKET, "page").agg(F.bitmap_or_agg("bits").alias("bits"))
    asked = batch.select(_BUCKET, F.xxhash64(*key).alias("h"), F.explode(_probes(key, rows_per_bucket)).alias("at"))
    asked = asked.select(_BUCKET, "h", F.bitmap_bucket_number("at").alias("page"), F.bitmap_bit_position("at").alias("bit")).distinct()
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = F.coalesce(F.expr("bits IS NOT NULL") & (F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1), F.lit(False))
    return asked.join(pages, [_BUCKET, "page"], "left").groupBy(_BUCKET, "h").agg(F.every(is_set).alias("all")).where("all").select(_BUCKET).distinct()


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])
    return spark.read.schema(full).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], full)


def read(spark: SparkSession, cache: str, schema: T.StructType) -> DataFrame:
    """All rows of the cache."""
    gen = _current(spark, cache)
    return _read(spark, f"{cache}/rows/gen={gen.number}", schema).drop(_BUCKET) if gen else spark.createDataFrame([], schema)


def append_novel(batch: DataFrame, cache: str, key: Sequence[str], *, rows_per_bucket: int = ROWS_PER_BUCKET, most_buckets: int = MOST_BUCKETS) -> list[int]:
    """Append the rows whose key the cache lacks, one a key; returns the buckets that had to be read."""
    spark, key, schema = batch.sparkSession, list(key), batch.schema
    one = batch.dropDuplicates(key).persist()
    gen = _current(spark, cache)
    if gen is None:
        _log(spark, cache, 0, _buckets_for(one.count(), rows_per_bucket, most_buckets), 0)
        gen = _current(spark, cache)
    rows_path, filter_path = f"{cache}/rows/gen={gen.number}", f"{cache}/filter/gen={gen.number}"
    fresh = one.withColumn(_BUCKET, _bucket(key, gen.buckets))
    try:
        pages_schema = T.StructType([T.StructField("page", T.LongType()), T.StructField("bits", T.BinaryType())])
        touched = [r[0] for r in fresh.select(_BUCKET).distinct().collect()]  # at most ``most_buckets`` numbers
        pages = _read(spark, filter_path, pages_schema).where(F.col(_BUCKET).isin(touched))
        hit = sorted(r[0] for r in _may_exist(fresh, key, pages, rows_per_bucket).collect())
        novel = fresh
        if hit:
            known = _read(spark, rows_path, schema).where(F.col(_BUCKET).isin(hit)).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)])
            novel = fresh.join(known, [fresh[c].eqNullSafe(known[f"_k{i}"]) for i, c in enumerate(key)], "left_anti")
        _append(_filter_pages(novel, key, rows_per_bucket), filter_path)  # before the rows
        seen = Observation()
        _append(novel.hint("rebalance", _BUCKET).observe(seen, F.count(F.lit(1)).alias("n")), rows_path)
        _log(spark, cache, gen.number, None, seen.get["n"])
        return hit
    finally:
        one.unpersist()


def compact(spark: SparkSession, cache: str, schema: T.StructType, key: Sequence[str], *, rows_per_bucket: int = ROWS_PER_BUCKET, most_buckets: int = MOST_BUCKETS) -> bool:
    """Copy the rows into a new generation if as many were added as it began with, or was planned for; whether that was done."""
    key, gen = list(key), _current(spark, cache)
    if gen is None or gen.added <= max(gen.start, gen.buckets * rows_per_bucket):
        return False
    new = gen.number + 1
    rows = _read(spark, f"{cache}/rows/gen={gen.number}", schema).drop(_BUCKET)
    total = rows.count()  # from the footers
    n = _buckets_for(total, rows_per_bucket, most_buckets)
    rows = rows.withColumn(_BUCKET, _bucket(key, n))
    _append(_filter_pages(rows, key, rows_per_bucket), f"{cache}/filter/gen={new}", "overwrite")
    _append(rows.hint("rebalance", _BUCKET), f"{cache}/rows/gen={new}", "overwrite")
    _log(spark, cache, new, n, total)  # the commit
    for old in (f"{cache}/log/gen={gen.number}", f"{cache}/filter/gen={gen.number}", f"{cache}/rows/gen={gen.number}"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    spark.catalog.refreshByPath(cache)
    return True
