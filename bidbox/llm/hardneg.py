"""Hard-negative mining by a secondary-sort shuffle.

For each anchor the nearest rows of its own label are its positives; for each positive, the nearest rows of other labels whose score lies
in a window under the positive's score are its hard negatives.

1. Rows and anchors are cut into blocks by a hash of their ids, and each block of anchors meets each block of rows in one task (the stated
   query set against all rows).  A task scores its pairs with one matrix product.
2. A pair's score is packed into one key (anchor, descending score, kind, id).  ``repartitionAndSortWithinPartitions`` deals the keys by anchor and
   sorts them, spilling as it must, and an iterator reads each anchor's rows from the best score down: a positive opens a window, negatives are
   written to all open windows, and a full window closes.  It holds as many counters as there are positives, whatever the anchor's rows.
3. That runs twice: first for the positives, of which a block hands on its own best few at most, then for positives with negatives, of which
   a block hands on the first few in each window.  The first few of all are among the first few of the blocks, so nothing is lost.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_groups, arrow_map, materialize, ship

#: Rows and anchors of a block.
ROWS, ANCHORS = 2048, 1024
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is between so many hundredths of the positive's and the positive's.
LEAST, MOST = 80, 100
SCALE = 256
_BIT = 1 << 63
_KEY = struct.Struct(">QQBQ")
#: Integers of a float64 product are exact below this.
_EXACT = 1 << 53


def pack(anchor: int, score: int, kind: int, other: int) -> bytes:
    """A key that sorts as bytes by anchor, descending score, kind (0 positive, 1 negative) and id."""
    return _KEY.pack(anchor + _BIT, _BIT - 1 - score, kind, other + _BIT)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, other = _KEY.unpack(key)
    return anchor - _BIT, _BIT - 1 - score, kind, other - _BIT


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; a, b: whole numbers as float64, (rows, dim).  Products beyond 64 bits are cut to that range."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < _EXACT:
        return (a @ b.T).astype(np.int64)
    wide = np.array([[int(x) for x in row] for row in a.tolist()], object).reshape(a.shape) @ np.array([[int(x) for x in row] for row in b.tolist()], object).reshape(b.shape).T
    return np.clip(wide, -_BIT + 1, _BIT - 1).astype(np.int64)


def _meet(group: pa.Table) -> Iterator[tuple[pa.Table, pa.Table, np.ndarray]]:
    """(anchors, rows, scores) for each vector length; rows by id."""
    size = group["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(size):
        some = group.filter(pa.array(size == dim))
        sides = [some.filter(pa.array(some["anchor"].to_numpy(zero_copy_only=False) == x)).sort_by("vec_id") for x in (True, False)]
        if all(len(s) for s in sides):
            yield (*sides, scores(*(s["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(s), dim) for s in sides)))


_PAIRS = "key binary"


def _first(positives: int):
    def run(group: pa.Table) -> pa.Table:
        """The block's best rows of each anchor's label."""
        keys = []
        for a, b, score in _meet(group):
            ids, labels = b["vec_id"].to_numpy(), b["label"].to_numpy()
            for anchor, label, s in zip(a["vec_id"].to_pylist(), a["label"].to_pylist(), score, strict=True):
                own = np.flatnonzero((labels == label) & (ids != anchor))
                best = own[np.argsort(-s[own], kind="stable")[:positives]]
                keys += [pack(anchor, x, 0, i) for x, i in zip(s[best].tolist(), ids[best].tolist(), strict=True)]
        return pa.table({"key": pa.array(keys, pa.binary())})

    return run


def _windowed(negatives: int, least: int, most: int):
    def run(group: pa.Table) -> pa.Table:
        """The first of the block's rows of other labels in each window of each anchor."""
        keys = []
        for a, b, score in _meet(group):
            ids, labels = b["vec_id"].to_numpy(), b["label"].to_numpy()
            for anchor, label, tops, s in zip(a["vec_id"].to_pylist(), a["label"].to_pylist(), a["tops"].to_pylist(), score, strict=True):
                other = np.flatnonzero(labels != label)
                other = other[np.argsort(-s[other], kind="stable")]
                down = -s[other]
                picked: set[int] = set()
                for top in set(tops):
                    high, low = most * top // 100, -(-least * top // 100)  # whole scores: floor and ceiling of the bounds
                    at = np.searchsorted(down, -high)
                    picked.update(other[at:min(at + negatives, int(np.searchsorted(down, -low, side="right")))].tolist())
                picked = sorted(picked)
                keys += [pack(anchor, x, 1, i) for x, i in zip(s[picked].tolist(), ids[picked].tolist(), strict=True)]
        return pa.table({"key": pa.array(keys, pa.binary())})

    return run


def by_anchor(key: bytes) -> int:
    return zlib.crc32(key[:8])


def _sorted(pairs: DataFrame, reader, schema: str) -> DataFrame:
    """``reader`` over each anchor's keys in order: the secondary sort."""
    spark = pairs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = pairs.rdd.map(lambda row: (bytes(row[0]), None)).repartitionAndSortWithinPartitions(parts, by_anchor)

    def read(rows: Iterable[tuple[bytes, None]]) -> Iterator[tuple]:
        for anchor, mine in groupby((unpack(k) for k, _ in rows), key=lambda x: x[0]):
            yield from reader(anchor, mine)

    return spark.createDataFrame(keyed.mapPartitions(read), schema)


def _positives(count: int):
    def read(anchor: int, rows: Iterator[tuple[int, int, int, int]]) -> Iterator[tuple]:
        for rank, (_, score, _, other) in enumerate(rows, 1):
            if rank > count:
                break
            yield anchor, other, score, rank

    return read


def mined(count: int, least: int, most: int):
    """The streaming reader: one anchor's (anchor, score, kind, id) from the best score down."""

    def read(anchor: int, rows: Iterator[tuple[int, int, int, int]]) -> Iterator[tuple]:
        windows: list[list[int]] = []  # [positive, its score, negatives written]
        for _, score, kind, other in rows:
            if kind == 0:
                windows.append([other, score, 0])
                continue
            for w in windows:
                if w[2] < count and least * w[1] <= 100 * score <= most * w[1]:
                    w[2] += 1
                    yield anchor, w[0], w[2], other, w[1], score

    return read


def _blocks(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int) -> DataFrame:
    """Each block of anchors with each block of rows; ``anchors`` has a column ``tops`` beside those of ``rows``."""
    down, across = -(-n_anchors // ANCHORS), -(-n_rows // ROWS)
    place = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    cols = ["x", "y", "anchor", "vec_id", "label", "v", "tops"]
    one = anchors.select("*", F.lit(True).alias("anchor"), place(down).alias("x"), spread(across).alias("y"))
    two = rows.select("*", F.lit(None).cast("array<long>").alias("tops"), F.lit(False).alias("anchor"), place(across).alias("y"), spread(down).alias("x"))
    return one.select(*cols).union(two.select(*cols))


def mine(vectors: DataFrame, is_anchor: Column, *, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = SCALE,
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``is_anchor`` picks.

    A component counts as floor(scale * x), a score is the inner product, higher scores come first and ties go by smaller id.  For each
    of the first ``positives`` other rows of an anchor's label, the first ``negatives`` rows of other labels with a score of ``least`` to
    ``most`` hundredths of the positive's (``most`` at most 100).  A positive without such rows gives no row; under a negative score the window is empty.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part.  An id is one row: of rows that repeat
    it, the one with the smallest (label, vector) takes part.  Vectors of different lengths have no score; those without components
    have score 0 among each other.  An empty table gives no rows; other columns are read by ``is_anchor`` only.
    """
    if not 0 <= least <= most <= 100:
        raise ValueError("0 <= least <= most <= 100: negatives are read after their positive")
    spark = vectors.sparkSession
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(sound)
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r"), F.bool_or("asks").alias("asks"))
    whole = F.transform("r.v", lambda x: F.floor(F.lit(float(scale)) * x).cast("double"))
    rows = materialize(rows.select("vec_id", "r.label", whole.alias("v"), "asks"), "hardneg")
    n_rows, n_anchors = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], out)
    plain = rows.drop("asks")
    anchors = rows.where("asks").drop("asks")

    met = _blocks(plain, anchors.withColumn("tops", F.lit(None).cast("array<long>")), n_rows, n_anchors)
    near = _sorted(arrow_groups(met, ["x", "y"], _first(positives), _PAIRS), _positives(positives), "anchor_id long, positive_id long, positive_score long, turn int")
    near = materialize(near, "hardneg")
    tops = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("positive_score").alias("tops"))  # ``positives`` at most
    far = arrow_groups(_blocks(plain, anchors.join(tops, "vec_id"), n_rows, n_anchors), ["x", "y"], _windowed(negatives, least, most), _PAIRS)
    return _sorted(far.union(arrow_map(near, _repacked, _PAIRS)), mined(negatives, least, most), out)


def _repacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array([pack(a, score, 0, p) for a, p, score in rows], pa.binary())], names=["key"])
