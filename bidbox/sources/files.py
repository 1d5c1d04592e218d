"""File sources and sinks (S1-S17): Parquet/JSON/CSV readers and writers with manifests.

Every writer targets a folder under the cluster's shared checkpoint directory
(:func:`bidbox.session.scratch_path`), never a machine-local temp folder.  Spark's commit
protocol gives write-temp-then-rename (S17) for free.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


SHARD_MANIFEST = "shard long, rows long, row_bytes long, mark long, mark_sum long"


class ManifestError(ValueError):
    pass


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Full Parquet read (column pruning / pushdown happen when the plan is optimised)."""
    return spark.read.parquet(*paths)


def read_columns_matching(spark: SparkSession, path: str, patterns: Sequence[str]) -> DataFrame:
    """Read only columns whose name ``re.match``es a pattern (prefix match, not full)."""
    df = spark.read.parquet(path)
    rx = [re.compile(p) for p in patterns]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if any(r.match(c) for r in rx)])


def schema_only(spark: SparkSession, path: str) -> T.StructType:
    """S3: the schema from the footer only; no rows are read."""
    return spark.read.parquet(path).schema


def with_source_file(df: DataFrame) -> DataFrame:
    """Attach the physical file path (hidden ``_metadata`` column of file sources)."""
    return df.withColumn("_file", F.col("_metadata.file_path"))


def file_manifest(df: DataFrame) -> DataFrame:
    """Per data file: rows and bytes, read from the file source metadata (distributed)."""
    return (df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
              .groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes")))


def validated_scan(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """Read every file under ``root`` and check it against a manifest (file, rows).

    A listed file that is missing, an unlisted extra file, or a row-count difference raises.
    One full outer join of the manifest with the per-file counts, in one pass over the files.
    """
    df = spark.read.parquet(root)
    seen = file_manifest(df).select("file", F.col("rows").alias("rows_seen"))
    m = manifest.select("file", F.col("rows").alias("rows_listed"))
    wrong = m.join(seen, "file", "full_outer").where(~F.col("rows_listed").eqNullSafe(F.col("rows_seen"))).limit(5).collect()
    if wrong:
        raise ManifestError(f"manifest mismatch (file, rows listed, rows seen): {[tuple(r) for r in wrong]}")
    return df


def row_bytes(schema: T.StructType) -> Column:
    """Plain size of a row: the UTF-8 or binary length of texts and bytes (null: 0), their JSON's for nested values, the type's width for others."""
    widths = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4}
    size = F.lit(0).cast("long")
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        else:
            size = size + F.lit(widths.get(f.dataType.typeName(), 8))
    return size


def _shard_state(df: DataFrame, schema: T.StructType) -> DataFrame:
    values = [F.map_entries(f"`{f.name}`") if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in schema.fields]
    mark = F.xxhash64(*values)
    return df.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(schema)).alias("row_bytes"),
                                   F.bit_xor(mark).alias("mark"), F.sum(F.pmod(mark, F.lit(1 << 31))).alias("mark_sum"))


def write_shards(df: DataFrame, path: str, by: Sequence[str], shard_bytes: int = 1 << 30) -> DataFrame:
    """As many shards as ``df`` has ``shard_bytes`` of plain rows, and a manifest (shard, rows, row_bytes, mark, mark_sum).

    A row's shard comes from the md5 of its ``by`` columns, so shards are even if these tell rows apart, and a rerun makes the same ones.
    The manifest is counted from the rows that were to be written, not from the files, and committed after them as JSON lines.
    Maps within arrays or structs cannot be hashed and raise.
    """
    total = df.agg(F.sum(row_bytes(df.schema))).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in by])
    shard = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % n
    out = df.withColumn("shard", shard)
    write_partitioned(out, f"{path}/data", ["shard"])
    _shard_state(out, df.schema).write.mode("overwrite").json(f"{path}/manifest")
    return df.sparkSession.read.schema(SHARD_MANIFEST).json(f"{path}/manifest")


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of :func:`write_shards` (with their ``shard``), checked against its manifest.

    A shard that is missing, not listed, or whose rows differ in number, size or content (order-free hashes) raises; so do shards without manifest.
    """
    listed = spark.read.schema(SHARD_MANIFEST).json(f"{path}/manifest")
    full = T.StructType([*schema.fields, T.StructField("shard", T.LongType())])
    rows = spark.read.schema(full).parquet(f"{path}/data")
    state = lambda df, name: df.select("shard", F.struct("rows", "row_bytes", "mark", "mark_sum").alias(name))
    both = state(listed, "listed").join(state(_shard_state(rows, schema), "seen"), "shard", "full_outer")
    wrong = both.where(~F.col("listed").eqNullSafe(F.col("seen"))).orderBy("shard").limit(5).collect()
    if wrong:
        raise ManifestError(f"shards differ from their manifest (shard, listed, seen): {[tuple(r) for r in wrong]}")
    return rows


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet",
                      compression: str = "zstd", max_records: int = 0) -> None:
    """Partitioned write; AQE's rebalance clusters a partition value's rows and cuts a large value into several tasks."""
    w = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    if fmt == "parquet":
        w = w.option("compression", compression)
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.format(fmt).save(path)


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", block_size: int = 16 * 1024 * 1024,
                  max_records: int = 0, page_size: int = 1024 * 1024, zstd_level: int = 3) -> None:
    """Parquet sink with zstd (level 3), row-group (block) size, page size, optional file row cap."""
    w = (df.write.mode("overwrite").option("compression", compression)
         .option("parquet.compression.codec.zstd.level", str(zstd_level))
         .option("parquet.block.size", str(block_size)).option("parquet.page.size", str(page_size)))
    if max_records:
        w = w.option("maxRecordsPerFile", max_records)
    w.parquet(path)


def bucketed_table(df: DataFrame, name: str, path: str, n_buckets: int, by: Sequence[str]) -> DataFrame:
    """Write ``df`` as an external table bucketed and sorted on ``by`` (files under ``path``).

    Two tables bucketed on the join key with the same bucket count join without a shuffle
    (co-located sort-merge join); aggregations on the key reuse the bucketing too.
    """
    (df.write.mode("overwrite").bucketBy(n_buckets, *by).sortBy(*by)
       .option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)


def compact(spark: SparkSession, src: str, dst: str, order_col: str, file_bytes: int = 128 << 20, task_bytes: int = 256 << 20) -> DataFrame:
    """Merge shard files into range-partitioned files of about ``file_bytes`` (empty shards contribute nothing).

    A file is sorted by one task, so files are smaller where the rows of ``file_bytes`` would take more than about ``task_bytes`` as that
    sort holds them.  Rows of one ``order_col`` value may go to several files.
    """
    df = spark.read.parquet(src)
    held = row_bytes(df.schema) + 8 * len(df.columns) + 32  # a sort holds an eight-byte slot a column, and heads and pointers
    sizes = df.groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("bytes"), F.sum(held).alias("held"))
    total = sizes.agg(F.sum("bytes").alias("bytes"), F.sum("held").alias("held")).first()
    files = max(1, -(-(total["bytes"] or 0) // file_bytes), -(-(total["held"] or 0) // task_bytes))
    ranged = df.withColumn("_at", F.col("_metadata.row_index")).repartitionByRange(files, order_col, "_at").drop("_at")
    ranged.sortWithinPartitions(order_col).write.mode("overwrite").option("compression", "zstd").parquet(dst)
    return spark.read.parquet(dst)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, every field quoted, UTF-8 BOM-free (Spark writes no BOM)."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).csv(path)


def write_report_csv(df: DataFrame, path: str, order: Sequence[str] = (), bom: bool = True) -> None:
    """S12 for report tables: non-numeric fields quoted (inner quotes doubled), numbers bare, nulls empty.

    Rows are sorted by ``order`` across files (range partitions); every file starts with the header
    and, unless ``bom`` is false, a UTF-8 byte-order mark.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}

    def fmt(c: str):
        col = F.col(f"`{c}`")
        if c in numeric:
            return F.coalesce(col.cast("string"), F.lit(""))
        return F.when(col.isNull(), F.lit("")).otherwise(
            F.concat(F.lit('"'), F.replace(col.cast("string"), F.lit('"'), F.lit('""')), F.lit('"')))

    header = ("\ufeff" if bom else "") + ",".join('"' + c.replace('"', '""') + '"' for c in df.columns)
    rows = df.orderBy(*order) if order else df

    def lines(batches):
        import pyarrow as pa

        yield pa.RecordBatch.from_pydict({"value": [header]})
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["value"])

    body = rows.select(F.concat_ws(",", *[fmt(c) for c in df.columns]).alias("value"))
    body.mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def write_json_sidecar(df: DataFrame, path: str) -> None:
    """A one-row aggregate as JSON (a single small file)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def typed_load(spark: SparkSession, landed: Mapping[str, DataFrame], schemas: Mapping[str, T.StructType]
               ) -> dict[str, DataFrame]:
    """Cast landed (string) tables to typed ones; absent columns become null, unknown tables are skipped."""
    out = {}
    for name, df in landed.items():
        if name not in schemas:
            continue
        cols = []
        for f in schemas[name].fields:
            if f.name in df.columns:
                cols.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
            else:
                cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        out[name] = df.select(*cols)
    return out


def discover(spark: SparkSession, root: str, glob: str, schema: T.StructType, fmt: str = "json",
             max_files: int | None = None) -> DataFrame:
    """Recursive discovery of files matching a glob under ``root`` (Spark lists in parallel).

    ``max_files`` keeps the first N matching files in path order (the file list, one path per
    file, is the only thing brought to the driver).
    """
    reader = (spark.read.format(fmt).schema(schema).option("recursiveFileLookup", "true")
              .option("pathGlobFilter", glob))
    df = reader.load(root)
    if max_files is None:
        return df
    files = sorted(df.inputFiles())[:max_files]
    return reader.load(files) if files else df.limit(0)


def read_json_tolerant(spark: SparkSession, path: str, schema: T.StructType,
                       corrupt_col: str = "_corrupt_record") -> DataFrame:
    """JSON lines read in PERMISSIVE mode; malformed lines keep their text in ``corrupt_col``."""
    s = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    return (spark.read.schema(s).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col).json(path))


def corrupt_summary(df: DataFrame, key: str, corrupt_col: str = "_corrupt_record", keep: int = 5) -> DataFrame:
    """Ok / error counts and the first ``keep`` corrupt lines (text order).

    Counts are one aggregate; the samples are a top-k (TakeOrdered: per-task k, then merge),
    so no task ever gathers all corrupt lines.  The two one-row results are merged by a union.
    ``df`` should be the materialised split (see :func:`split_corrupt`): Spark refuses queries
    that read only the corrupt-record column straight from raw JSON.
    """
    bad = F.col(corrupt_col).isNotNull()
    counts = df.agg(F.count_if(~bad).alias("n_ok"), F.count_if(bad).alias("n_err"),
                    F.count(key).alias("n_with_key"), F.lit(None).cast("string").alias("first_errors"))
    samples = (df.where(bad).select(F.col(corrupt_col).alias("t")).orderBy("t").limit(keep)
               .agg(F.array_join(F.array_sort(F.collect_list("t")), "|").alias("first_errors"))
               .select(F.lit(None).cast("long").alias("n_ok"), F.lit(None).cast("long").alias("n_err"),
                       F.lit(None).cast("long").alias("n_with_key"), "first_errors"))
    u = counts.unionByName(samples)
    return u.agg(F.max("n_ok").alias("n_ok"), F.max("n_err").alias("n_err"), F.max("n_with_key").alias("n_with_key"),
                 F.coalesce(F.max("first_errors"), F.lit("")).alias("first_errors"))


def split_corrupt(df: DataFrame, path: str, corrupt_col: str = "_corrupt_record") -> DataFrame:
    """Materialise a tolerant read once (good rows and quarantined lines, flagged) and return it."""
    df.withColumn("is_corrupt", F.col(corrupt_col).isNotNull()).write.mode("overwrite") \
        .partitionBy("is_corrupt").parquet(path)
    return df.sparkSession.read.parquet(path)


def landed_strings(df: DataFrame) -> DataFrame:
    """All-string landing layer: every column cast to string, null stays null."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
