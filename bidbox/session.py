"""SparkSession settings shared by tests, bench and the driver entry points.

Settings that matter at scale:
* AQE on (runtime coalescing, skew-join splitting, runtime broadcast choice).
* ANSI on (Spark 4 default): bad casts raise; lenient paths use ``try_cast``.
* UTC session time zone so dates compare equal to the DuckDB oracle.
* Generated methods beyond 8,000 bytes of bytecode, which HotSpot never compiles, are split into smaller ones: a projection of many
  text expressions otherwise runs interpreted (three times as long for the contract scores).
* A checkpoint directory is only set in local mode, and there only if none is named.  A cluster must name one: a folder of
  one machine would be missed by the others.
"""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Conservative default; the planner still checks estimated size against it.
BROADCAST_THRESHOLD = str(32 * 1024 * 1024)


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "bidbox") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", BROADCAST_THRESHOLD)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BIDBOX_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/ABFS); it is read
    from the session, and an error is raised if it is unset.  In local mode one is made.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="bidbox-ckpt-")
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint dir for sinks and round trips."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/bidbox-{tag}-{uuid.uuid4().hex[:12]}"


def materialize(df, tag: str, made: list[str] | None = None):
    """Write ``df`` once to a fresh folder under the shared checkpoint dir and read it back.

    Used where one derived table feeds several branches of a plan (each branch would otherwise
    recompute its joins): the write cuts lineage, survives executor loss, and the branches scan.
    ``made`` takes the folder, for :func:`discard`.
    """
    path = scratch_path(df.sparkSession, tag)
    if made is not None:
        made.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Delete (and forget) scratch folders that nothing reads any more, and the files of past shuffles with them.

    Spark drops a shuffle's files once the driver's JVM has collected the plan that made them, which it may not do
    for as long as its memory lasts; so it is asked to.
    """
    for folder in folders:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    folders.clear()
    gc.collect()
    spark._jvm.System.gc()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))
