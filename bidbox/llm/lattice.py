"""Near-duplicate embeddings by lattice hashing.

Each table projects unit vectors to eight dimensions at random and decodes them to the nearest point of the E8
lattice; that cell is the vector's home, and the next nearest lattice points are probed as well.  Two vectors meet
in a cell if it is the home of one and the home or a probe of the other, and their cosine is then computed.

Equal vectors are one class with a multiplicity.  The cosines of a cell are computed inside its task and only sums and a spanning
forest leave it: links are counted, not listed.  A pair that meets more than once counts in its first meeting,
which both keys tell.  Cells with many members are cut into blocks that are compared pairwise in separate groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_groups, arrow_map, materialize
from bidbox.llm.components import components
from bidbox.llm.textnp import lists, mix, signed

#: Twelve tables with two probes each: a pair at cosine 0.9 meets with probability 0.98 (CELL is in units of a projected unit vector).
TABLES, PROBES, CELL = 12, 2, 1.4
BLOCK = 512
SEED = 5


def _coset(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest and a second near point of D8 (integer points of even sum)."""
    f = np.rint(x)
    e = x - f
    step = np.where(e >= 0, 1.0, -1.0)
    turn = np.argsort(-np.abs(e), axis=1, kind="stable")
    odd = (f.sum(axis=1) % 2) != 0
    rows = np.arange(len(x))
    near, next_ = f.copy(), f.copy()
    near[rows[odd], turn[odd, 0]] += step[rows[odd], turn[odd, 0]]
    next_[rows[odd], turn[odd, 1]] += step[rows[odd], turn[odd, 1]]
    for j in (0, 1):
        next_[rows[~odd], turn[~odd, j]] += step[rows[~odd], turn[~odd, j]]
    return near, next_


def e8_points(x: np.ndarray, n: int) -> np.ndarray:
    """The nearest E8 point of each row and the next best of the decoder's candidates: (rows, n, 8), in halves as integers."""
    points = np.stack([*_coset(x), *(p + 0.5 for p in _coset(x - 0.5))], axis=1)
    far = ((points - x[:, None]) ** 2).sum(axis=2)
    return np.take_along_axis(points * 2, np.argsort(far, axis=1, kind="stable")[:, :n, None], axis=1).astype(np.int64)


def cells(unit: np.ndarray) -> np.ndarray:
    """Cell keys (rows, TABLES, 1 + PROBES); the first of each table is the home."""
    out = np.empty((len(unit), TABLES, 1 + PROBES), np.uint64)
    dim = unit.shape[1]
    for t in range(TABLES):
        plane = np.random.default_rng([SEED, t, dim]).normal(size=(dim, 8)) / CELL
        points = e8_points(unit @ plane, 1 + PROBES).astype(np.uint64)
        key = np.full(points.shape[:2], (t + 1) * 0x9E3779B97F4A7C15 % (1 << 64), np.uint64) + np.uint64(dim)
        for j in range(8):
            key = mix(key ^ points[:, :, j]) + np.uint64(j)
        out[:, t] = key
    return out


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        for dim in np.unique(size):
            some = batch.filter(pa.array(size == dim))
            for at in range(0, some.num_rows, 2048):
                part = some.slice(at, 2048)
                v = part.column(2).flatten().to_numpy().reshape(part.num_rows, dim).astype(np.float64)
                v = v / np.abs(v).max(axis=1, keepdims=True)  # else squares may over- or underflow
                unit = v / np.linalg.norm(v, axis=1, keepdims=True)
                key = signed(cells(unit).reshape(-1))
                n = TABLES * (1 + PROBES)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([u.tobytes() for u in unit], pa.binary()), lists(key, np.full(part.num_rows, n), pa.int64())], names=["rep", "mult", "unit", "cells"])


def _first_meeting(a: np.ndarray, b: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
    """Table and cell in which each pair of rows meets first; a, b: (pairs, TABLES, 1 + PROBES)."""
    table = np.full(len(a), TABLES)
    cell = np.zeros(len(a), np.int64)
    for t in range(upto, -1, -1):
        at_a = (b[:, t] == a[:, t, :1]).any(axis=1)
        at_b = (a[:, t] == b[:, t, :1]).any(axis=1)
        one, two = np.where(at_a, a[:, t, 0], b[:, t, 0]), np.where(at_b, b[:, t, 0], a[:, t, 0])
        met = at_a | at_b
        table[met], cell[met] = t, np.minimum(one, two)[met]
    return table, cell


def _links(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        rep, mult = group["rep"].to_numpy(), group["mult"].to_numpy()
        keys = group["cells"].combine_chunks().flatten().to_numpy().reshape(len(group), TABLES, 1 + PROBES)
        unit = np.frombuffer(b"".join(group["unit"].to_pylist()), np.float64).reshape(len(group), -1)
        table, cell = group["t"][0].as_py(), group["cell"][0].as_py()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        home = group["home"].to_numpy(zero_copy_only=False)
        near = unit[left] @ unit[right].T >= threshold
        # two that are both at home here meet on both sides: take them once
        near &= (rep[left][:, None] != rep[right][None]) & (~home[left][:, None] | (rep[left][:, None] < rep[right][None]))
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        t, c = _first_meeting(keys[i], keys[j], table)
        new = (t == table) & (c == cell)
        n = np.bincount(i[new], weights=mult[j[new]], minlength=len(group)) + np.bincount(j[new], weights=mult[i[new]], minlength=len(group))
        root = np.arange(len(group))

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for a, b in zip(i[new].tolist(), j[new].tolist(), strict=True):
            a, b = top(a), top(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        some = np.unique(np.concatenate([i[new], j[new]]))
        ends = np.array([top(int(x)) for x in some], np.int64) if len(some) else some
        return pa.table({"a": rep[some], "b": rep[ends], "n": n[some].astype(np.int64)})

    return run


def near_duplicates(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; links join vectors of cosine >= threshold in double precision.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of different lengths.  A null
    id links with nothing (component_id null, kept).  Rows that repeat an id and a vector are one vector.  Rows that repeat an id with other
    vectors add their links.  An empty table gives no rows; other columns are not read.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    sound = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    same = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), F.col("v")).alias("k2")]
    good = rows.where("vec_id IS NOT NULL").where(F.coalesce(sound, F.lit(False)))
    classes = good.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("mult"), F.min_by("v", "vec_id").alias("v"))
    hashed = materialize(arrow_map(classes.select("rep", "mult", "v"), _hash, "rep long, mult long, unit binary, cells array<long>"), "e8")
    placed = hashed.select("*", F.posexplode("cells").alias("at", "cell")).withColumn("t", F.floor(F.col("at") / (1 + PROBES)).cast("int")).withColumn("home", F.col("at") % (1 + PROBES) == 0).drop("at")
    # cells that hold one vector, or no home but probes, have no pair
    count = hashed.select(F.posexplode("cells").alias("at", "cell")).groupBy(F.floor(F.col("at") / (1 + PROBES)).cast("int").alias("t"), "cell").agg(F.count("*").alias("n"), F.count_if(F.col("at") % (1 + PROBES) == 0).alias("homes"))
    placed = placed.join(count.where("n > 1 AND homes > 0"), ["t", "cell"])
    rows_, homes = F.ceil(F.col("n") / BLOCK).cast("int"), F.ceil(F.col("homes") / BLOCK).cast("int")
    cols = ["t", "cell", "x", "y", "side", "rep", "mult", "home", "unit", "cells"]
    one = placed.withColumn("x", F.pmod(F.xxhash64(F.lit(1), "rep"), rows_).cast("int")).withColumn("y", F.explode(F.sequence(F.lit(0), homes - 1))).withColumn("side", F.lit(0))
    two = placed.where("home").withColumn("y", F.pmod(F.xxhash64(F.lit(2), "rep"), homes).cast("int")).withColumn("x", F.explode(F.sequence(F.lit(0), rows_ - 1))).withColumn("side", F.lit(1))
    found = materialize(arrow_groups(one.select(*cols).union(two.select(*cols)), ["t", "cell", "x", "y"], _links(threshold), "a long, b long, n long"), "e8")
    comp = components(found.select("a", "b")).withColumnRenamed("id", "rep")
    links = found.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    reps = hashed.select("rep", "mult").join(links, "rep", "left").join(comp, "rep", "left")
    # several classes may have one smallest id only if that id is repeated with other vectors
    reps = reps.groupBy("rep").agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n"), F.min(F.coalesce("component", "rep")).alias("component"))
    member = good.select("vec_id", *same).distinct().join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).join(reps, "rep").groupBy("vec_id").agg(F.sum("n").alias("n_links"), F.min("component").alias("component_id"))
    out = rows.select("vec_id").join(member, "vec_id", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
