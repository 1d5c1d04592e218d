"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bidbox.session import materialize, scratch_path

__all__ = ["WORD", "arrow_groups", "arrow_map", "fold", "id_key", "in_tasks", "materialize", "read_table", "row_key", "scratch_path", "word_count"]

#: Words of a text: maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(text: str = "text") -> Column:
    """Tells different texts under one id apart; identical rows share it."""
    return F.xxhash64(F.col(text))


def id_key(doc_id: str = "doc_id") -> Column:
    """The id as text, "" for null: a join key that keeps rows without an id."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5: the folds that contracts name (null id: null)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def in_tasks(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df`` in one task for ``each`` of ``rows`` at most, so a small table is not written as a file for every partition of the last shuffle."""
    return df.coalesce(max(1, -(-rows // each)))


_shipped: set[str] = set()
#: Rows of a batch that goes to a Python worker, unless the session sets its own: batches of long texts stay small.
BATCH_ROWS = "2000"
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark: SparkSession) -> None:
    """Give executors this package, once a Spark application (they need not have the driver's folders)."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT and context.getConf().get(_BATCH_KEY) is None:
        spark.conf.set(_BATCH_KEY, BATCH_ROWS)
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        at = tempfile.mkdtemp(prefix="bidbox-code-")  # the driver serves the archive from here while the application runs
        for name in (p.relative_to(root) for p in (root / "bidbox").rglob("*.py")):
            (Path(at) / "x" / name).parent.mkdir(parents=True, exist_ok=True)
            shutil.copyfile(root / name, Path(at) / "x" / name)
        context.addPyFile(shutil.make_archive(f"{at}/bidbox", "zip", f"{at}/x"))
        _shipped.add(context.applicationId)


def give_back() -> None:
    """Return to the system what Arrow and the C library hold unused: Spark keeps a worker for later tasks, whose memory adds to it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with a function of this package."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


#: Rows of a group after which memory is given back; smaller ones hold little.
LARGE_GROUP = 1 << 12


def arrow_groups(df: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """``applyInArrow`` with a function of this package; callers bound the size of a group."""
    ship(df.sparkSession)

    def run(group: pa.Table) -> pa.Table:
        out = fn(group)
        if len(group) >= LARGE_GROUP:
            give_back()
        return out

    return df.groupBy(*keys).applyInArrow(run, schema)
