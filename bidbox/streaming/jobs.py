"""Incremental and streaming jobs (I1-I7, I10-I12) on Structured Streaming and batch windows.

Streams read a landing folder with the file source (each file is processed once; progress is
in the checkpoint), run with ``availableNow`` so a job drains what has landed and stops, and
write to file sinks or ``foreachBatch`` upserts that are idempotent per micro-batch.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists
from . import keyed


def _run(query) -> None:
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")


def ingest_new_files(spark: SparkSession, landing: str, schema: T.StructType, sink: str, checkpoint: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Process only files that have not been processed yet (file source + checkpoint)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(landing).writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q)
    return spark.read.schema(schema).parquet(sink)


def _run_keyed(spark: SparkSession, landing: str, schema: T.StructType, key: Sequence[str], keep: T.StructType, cache: str, checkpoint: str,
               max_files_per_trigger: int | None, sizes: Mapping[str, int]) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        keyed.append_novel(batch.select(*keep.names), cache, key, **sizes)
        keyed.compact(batch.sparkSession, cache, keep, key, **sizes)

    _run(reader.parquet(landing).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return keyed.read(spark, cache, keep)


def dedupe_stream(spark: SparkSession, landing: str, schema: T.StructType, key: Sequence[str], sink: str, checkpoint: str,
                  max_files_per_trigger: int | None = None, **sizes: int) -> DataFrame:
    """Live + history without duplicates, by key and without a time limit: a late row is merged like any other.

    Each micro-batch appends the rows whose key the sink lacks (null-safe); a batch that is retried, or comes again after a lost
    checkpoint, finds its rows there.  The sink is a keyed cache (:mod:`bidbox.streaming.keyed`, also for ``sizes``): a
    batch reads the filters of its keys' buckets and the keys of buckets that may hold one, not the history.
    """
    return _run_keyed(spark, landing, schema, list(key), schema, sink, checkpoint, max_files_per_trigger, sizes)


def upsert_novel_keys(spark: SparkSession, landing: str, schema: T.StructType, key: Sequence[str],
                      cache: str, checkpoint: str, max_files_per_trigger: int | None = None, **sizes: int) -> DataFrame:
    """Incremental cache of keys: each micro-batch appends only keys not in the cache yet.

    As :func:`dedupe_stream`, for the key columns alone.
    """
    key_schema = T.StructType([f for f in schema.fields if f.name in key])
    return _run_keyed(spark, landing, schema, list(key), key_schema, cache, checkpoint, max_files_per_trigger, sizes)


#: Column that names the landed file of a row while a batch is routed.
_FILE = "_landed_file"


def split_late(spark: SparkSession, landing: str, schema: T.StructType, ts_col: str, delay_seconds: int,
               on_time: str, late: str, checkpoint: str,
               max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows later than the watermark (max event time of earlier batches - delay) go to a
    side table instead of being dropped; both outputs together keep every row.

    A batch is known by the files it read, not by the checkpoint's counter.  A log beside the on-time sink takes, as the last step of a
    batch, each of its files with the batch's name (a fingerprint of the files) and its latest on-time event.  Files in the log are not routed
    again, folders of batches that are not in it are not read, and a retried batch rewrites its own folder.  So neither a
    crash between the writes nor a lost checkpoint, which deals the files into other batches, changes the outputs.
    """
    log_path = f"{on_time.rstrip('/')}-log"
    log_schema = f"{_FILE} string, batch_id string, latest {schema[ts_col].dataType.simpleString()}"

    def log(ss: SparkSession) -> DataFrame:
        return ss.read.schema(log_schema).parquet(log_path) if path_exists(ss, log_path) else ss.createDataFrame([], log_schema)

    def read_sink(ss: SparkSession, path: str) -> DataFrame:
        if not path_exists(ss, path):  # no batch written yet
            return ss.createDataFrame([], schema)
        rows = ss.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])).parquet(path)
        return rows.join(log(ss).select("batch_id").distinct(), "batch_id", "left_semi").drop("batch_id")

    def route(batch: DataFrame, batch_id: int) -> None:
        ss = batch.sparkSession
        fresh = batch.join(log(ss).select(_FILE).distinct(), _FILE, "left_anti").persist()
        try:
            # the running maximum crosses the driver as text: a Python datetime literal would be
            # shifted by the session time zone when it meets a timestamp_ntz column
            prev = log(ss).agg(F.max("latest").cast("string")).first()[0]
            files = fresh.select(_FILE).distinct().agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(_FILE)), F.sum(F.crc32(F.col(_FILE).cast("binary")))).first()
            if not files[0]:
                return
            name = "files-" + "-".join(f"{x & 0xFFFFFFFFFFFFFFFF:x}" for x in files)
            is_late = F.lit(False)
            if prev is not None:
                mark = F.lit(prev).cast(schema[ts_col].dataType) - F.expr(f"INTERVAL {int(delay_seconds)} SECONDS")
                is_late = F.coalesce(F.col(ts_col) < mark, F.lit(False))
            tagged = fresh.withColumn("_late", is_late)
            tagged.where("NOT _late").drop("_late", _FILE).write.mode("overwrite").parquet(f"{on_time}/batch_id={name}")
            tagged.where("_late").drop("_late", _FILE).write.mode("overwrite").parquet(f"{late}/batch_id={name}")
            done = tagged.groupBy(_FILE).agg(F.lit(name).alias("batch_id"), F.max(F.when(~F.col("_late"), F.col(ts_col))).alias("latest"))
            done.write.mode("overwrite").parquet(f"{log_path}/of={name}")  # the commit
        finally:
            fresh.unpersist()

    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    q = (reader.parquet(landing).select("*", F.col("_metadata.file_path").alias(_FILE))
         .writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _run(q)
    return read_sink(spark, on_time), read_sink(spark, late)


# --- batch windows and partition maintenance --------------------------------------------

def month_windows(df: DataFrame, date_col: str, k: int, max_date: Column | None = None) -> DataFrame:
    """Calendar windows of k months: window start, end (exclusive) clipped to the data end."""
    d = F.to_date(date_col)
    idx = (F.year(d) * 12 + F.month(d) - 1)
    start_idx = F.floor(idx / k) * k
    start = F.make_date((start_idx / 12).cast("int"), (start_idx % 12 + 1).cast("int"), F.lit(1))
    end = F.add_months(start, k)
    out = df.withColumn("window_start", start).withColumn("window_end", end)
    if max_date is not None:
        out = out.withColumn("window_end", F.least(F.col("window_end"), F.date_add(max_date, 1)))
    return out


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Dynamic partition overwrite: only the partitions present in ``df`` are replaced."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(path))


def rebuild_invalid_partitions(df: DataFrame, path: str, by: Sequence[str]) -> list[tuple]:
    """Rewrite only the partitions whose stored rows differ from the source's in number or content (order-free hashes).

    Expected and stored fingerprints are two aggregates with one row per partition (the partition
    list is the only thing on the driver); valid partitions are left untouched and the bad
    ones are replaced by a dynamic partition overwrite.  Returns the rebuilt partition keys.
    """
    by = list(by)
    values = [c for c in df.columns if c not in by]
    state = F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*values)).alias("x"), F.sum(F.pmod(F.xxhash64(*values), F.lit(1 << 31))).alias("s"))
    expected = df.groupBy(*by).agg(state.alias("_exp"))
    if path_exists(df.sparkSession, path):
        stored = df.sparkSession.read.parquet(path).groupBy(*by).agg(state.alias("_got"))
    else:  # every partition is missing
        stored = expected.select(*by, F.col("_exp").alias("_got")).limit(0)
    # grouped, not joined: null partition values meet as well
    both = expected.withColumn("_got", F.lit(None)).unionByName(stored.select(*[F.col(c).cast(df.schema[c].dataType) for c in by], F.lit(None).alias("_exp"), "_got"))
    cmp = both.groupBy(*by).agg(F.max("_exp").alias("_exp"), F.max("_got").alias("_got")).where(~F.col("_exp").eqNullSafe(F.col("_got"))).select(*by)
    bad = [tuple(r[c] for c in by) for r in cmp.collect()]
    if bad:
        keys = df.sparkSession.createDataFrame(bad, T.StructType([df.schema[c] for c in by])).toDF(*[f"_bad{i}" for i in range(len(by))])
        overwrite_partitions(df.join(F.broadcast(keys), [df[c].eqNullSafe(F.col(f"_bad{i}")) for i, c in enumerate(by)], "left_semi"), path, by)
    return bad


def retention_class(ts: Column, newest: Column, keep_days: int = 30, prune_days: int = 45) -> Column:
    """Keep (last keep_days), archive (up to prune_days), prune (older)."""
    age = F.datediff(F.to_date(newest), F.to_date(ts))
    return F.when(age <= keep_days, "keep").when(age <= prune_days, "archive").otherwise("prune")


def retire_partitions(spark: SparkSession, path: str, archive: str, manifest: str, by: str, newest: str,
                      keep_days: int = 30, prune_days: int = 45) -> DataFrame:
    """Move the date partitions ``by`` past ``keep_days`` to the archive and delete those past ``prune_days``.

    Three steps: copy what is to be archived, commit the manifest, delete.  A partition in the manifest is never copied again, so a run that
    follows a crash anywhere finishes the job: a crash before the commit repeats the copy, one after it repeats the deletion, and a
    half-deleted partition cannot replace its archived copy.  A further run finds nothing to do.  Returns the manifest: (part, action, rows).
    """
    schema = "part string, action string, rows long"
    done = spark.read.schema(schema).parquet(manifest) if path_exists(spark, manifest) else spark.createDataFrame([], schema)
    rows = spark.read.option("recursiveFileLookup", "false").parquet(path)
    part = F.date_format(F.col(by), "yyyy-MM-dd")
    action = retention_class(F.col(by), F.lit(newest).cast("date"), keep_days, prune_days)
    old = rows.withColumn("_part", part).withColumn("_action", action).where("_action != 'keep'").join(done.select(F.col("part").alias("_part")), "_part", "left_anti")
    plan = old.groupBy("_part", "_action").agg(F.count(F.lit(1)).alias("rows")).select(F.col("_part").alias("part"), F.col("_action").alias("action"), "rows")
    plan = [tuple(r) for r in plan.collect()]  # a row a partition
    if plan:
        overwrite_partitions(old.where("_action = 'archive'").drop("_part", "_action"), archive, [by])
        spark.createDataFrame(plan, schema).coalesce(1).write.mode("append").parquet(manifest)  # the commit: one file
    done = spark.read.schema(schema).parquet(manifest) if path_exists(spark, manifest) else done
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for r in done.select("part").collect():
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{by}={r.part}"), True)
    spark.catalog.refreshByPath(path)
    return done


@dataclass
class Phase:
    """A step of a job: ``run`` gets the outputs of the phases named in ``after`` and returns a frame."""

    name: str
    run: Callable[..., DataFrame]
    params: Mapping[str, object] = field(default_factory=dict)
    after: Sequence[str] = ()
    inputs: Sequence[DataFrame] = ()
    always: bool = False


def input_mark(df: DataFrame) -> str:
    """Changes whenever a file that the frame reads does: names, sizes and times of its files, hashed on the executors."""
    files = df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"), F.col("_metadata.file_modification_time").alias("t")).distinct()
    n, mark = files.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("p", "s", "t"))).first()
    return f"{n}:{mark}"


def run_phases(spark: SparkSession, phases: Sequence[Phase], folder: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Run the phases in order, skipping those that are done: ((phase, action), outputs by name).

    A phase's fingerprint covers its parameters, its input files and the fingerprints of the phases before it.  Its output goes to a folder of that
    name, and a ledger entry is written after it; an output without an entry does not count.  An ``always`` phase
    runs every time under a new fingerprint, so what builds on it runs as well.
    """
    marks: dict[str, str] = {}
    outputs: dict[str, DataFrame] = {}
    actions = []
    for p in phases:
        told = [p.name, sorted((k, repr(v)) for k, v in p.params.items()), [input_mark(i) for i in p.inputs], [marks[a] for a in p.after], uuid.uuid4().hex if p.always else ""]
        marks[p.name] = hashlib.sha256(repr(told).encode()).hexdigest()[:24]
        out, entry = f"{folder}/{p.name}/{marks[p.name]}", f"{folder}/ledger/{p.name}-{marks[p.name]}"
        skip = path_exists(spark, f"{entry}/_SUCCESS")
        if not skip:
            p.run(*[outputs[a] for a in p.after], **p.params).write.mode("overwrite").parquet(out)
            spark.createDataFrame([(p.name, marks[p.name])], "phase string, mark string").coalesce(1).write.mode("overwrite").parquet(entry)
        outputs[p.name] = spark.read.parquet(out)
        actions.append((p.name, "skip" if skip else "run"))
    return spark.createDataFrame(actions, "phase string, action string"), outputs


def prefer_first(frames: Sequence[DataFrame], key: Sequence[str], value: str) -> DataFrame:
    """Per key, the value from the most preferred output that has one (coalesce in order)."""
    keys = frames[0].select(*key)
    for f in frames[1:]:
        keys = keys.unionByName(f.select(*key))
    out = keys.distinct()
    cols = []
    for i, f in enumerate(frames):
        out = out.join(f.select(*key, F.col(value).alias(f"_v{i}")), list(key), "left")
        cols.append(F.col(f"_v{i}"))
    src = F.coalesce(*[F.when(c.isNotNull(), F.lit(i)) for i, c in enumerate(cols)])
    return out.select(*key, F.coalesce(*cols).alias(value), src.alias("source_rank"))
