"""Constraint preflight, schema problems, retention that acts, phase ledger."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidbox.operators import schema as SC
from bidbox.streaming import jobs as S

DAY0 = dt.date(2024, 3, 1)


def tmp(tag):
    return tempfile.mkdtemp(prefix=f"bidbox-{tag}-")


def test_preflight_compares_coerced_cells(spark):
    rows = [(1, "7", "a", None), (2, "+07", "b", None), (3, "8", "b", ""), (4, "8x", "b", "5"), (5, None, "c", "5"), (6, "", "c", "05"), (7, "true", "d", "9"), (8, "1", "e", "x")]
    df = spark.createDataFrame(rows, "row int, no string, txt string, ref string")
    got = {(r.constraint, r.key): (r.n, r.rows) for r in SC.key_preflight(df, {
        "PRIMARY KEY": [("no", "INTEGER", False)], "UNIQUE no": [("no", "INTEGER", False)], "UNIQUE as text": [("no", "TEXT", False)],
        "UNIQUE ref": [("ref", "INTEGER", False)], "NOT NULL ref": [("ref", "INTEGER", True)], "UNIQUE txt, ref": [("txt", "TEXT", True), ("ref", "INTEGER", False)]}, "row").collect()}
    assert got == {
        ("PRIMARY KEY", "7"): (2, [1, 2]), ("PRIMARY KEY", ""): (2, [5, 6]), ("PRIMARY KEY", "1"): (2, [7, 8]),
        ("UNIQUE no", "7"): (2, [1, 2]), ("UNIQUE no", "1"): (2, [7, 8]),
        ("UNIQUE ref", "5"): (3, [4, 5, 6]), ("NOT NULL ref", "5"): (3, [4, 5, 6]), ("NOT NULL ref", ""): (3, [1, 2, 3]), ("UNIQUE txt, ref", "c\x1f5"): (2, [5, 6])}


def test_preflight_reports_the_most_frequent(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 400, "hot").otherwise((F.col("id") % 100).cast("string")).alias("k"))
    got = SC.key_preflight(df, {"UNIQUE k": [("k", "TEXT", False)]}, "id", top=2, samples=4).collect()
    assert sorted((r.key, r.n, r.rows) for r in got) == [("0", 6, [400, 500, 600, 700]), ("hot", 400, [0, 1, 2, 3])]
    assert SC.key_preflight(df.where("id < 0"), {"UNIQUE k": [("k", "TEXT", False)]}, "id").collect() == []


def test_column_problems():
    schema = T.StructType([T.StructField(n, k) for n, k in (("a", T.DoubleType()), ("b", T.StringType()), ("c_right", T.StringType()), ("d", T.ArrayType(T.IntegerType())), ("e", T.IntegerType()), ("f", T.StringType()))])
    assert SC.column_problems(schema, ["b"]) == {"a": ["double"], "c_right": ["string", "join suffix"], "d": ["nested"], "f": ["string"]}
    assert "f: string" in SC.schema_problems(schema, ["b"]) and SC.schema_problems(schema) == ["a: double", "c_right: join suffix", "d: nested"]


def days(spark, n=10):
    return spark.createDataFrame([(i, DAY0 + dt.timedelta(days=i % n)) for i in range(100)], "id int, day date")


def kept(spark, path):
    return {r.day.day: r["count"] for r in spark.read.parquet(path).groupBy("day").count().collect()}


@pytest.mark.parametrize("crash", [None, "before the commit", "after the commit"])
def test_retention_survives_a_crash(spark, crash):
    path, archive, manifest = (f"{tmp('ret')}/{x}" for x in ("main", "archive", "manifest"))
    S.overwrite_partitions(days(spark), path, ["day"])
    if crash == "before the commit":  # the copy was half done
        S.overwrite_partitions(days(spark).where("day(day) = 6 AND id < 50"), archive, ["day"])
    if crash == "after the commit":  # copied and committed, and half of a partition deleted
        S.overwrite_partitions(days(spark).where("day(day) IN (5, 6, 7)"), archive, ["day"])
        spark.createDataFrame([(f"2024-03-{d:02}", "archive" if d > 4 else "prune", 10) for d in range(1, 8)], "part string, action string, rows long").write.parquet(manifest)
        S.overwrite_partitions(days(spark).where("day(day) = 6 AND id < 50"), path, ["day"])
    for _ in range(2):
        done = S.retire_partitions(spark, path, archive, manifest, "day", "2024-03-10", 2, 5)
        assert kept(spark, path) == {8: 10, 9: 10, 10: 10} and kept(spark, archive) == {5: 10, 6: 10, 7: 10}
        assert sorted((r.part[-2:], r.action, r.rows) for r in done.collect()) == [(f"{d:02}", "archive" if d > 4 else "prune", 10) for d in range(1, 8)]


def test_retention_moves_on_with_time(spark):
    path, archive, manifest = (f"{tmp('ret')}/{x}" for x in ("main", "archive", "manifest"))
    S.overwrite_partitions(days(spark), path, ["day"])
    S.retire_partitions(spark, path, archive, manifest, "day", "2024-03-10", 2, 5)
    S.retire_partitions(spark, path, archive, manifest, "day", "2024-03-11", 2, 5)
    assert set(kept(spark, path)) == {9, 10} and set(kept(spark, archive)) == {5, 6, 7, 8}


def test_phases_run_again_only_if_something_changed(spark):
    src, folder = tmp("src") + "/t", tmp("phases")
    spark.range(10).write.parquet(src)
    calls = []

    def job(factor=2, fail=False):
        def total(doubled):
            calls.append("total")
            if fail:
                raise RuntimeError("lost")
            return doubled.agg(F.sum("x").alias("s"))
        read = spark.read.parquet(src)
        phases = [S.Phase("double", lambda factor: read.select((F.col("id") * factor).alias("x")), {"factor": factor}, inputs=[read]),
                  S.Phase("total", total, after=["double"]), S.Phase("now", lambda: spark.range(1), always=True), S.Phase("after now", lambda now: now, after=["now"])]
        actions, out = S.run_phases(spark, phases, folder)
        return [r.action for r in actions.collect()], out["total"].first().s

    with pytest.raises(RuntimeError):
        job(fail=True)
    assert job() == (["skip", "run", "run", "run"], 90)  # the phase that failed is not done
    assert job() == (["skip", "skip", "run", "run"], 90)
    assert job(factor=3) == (["run", "run", "run", "run"], 135)
    assert job() == (["skip", "skip", "run", "run"], 90)
    spark.range(10, 12).write.mode("append").parquet(src)
    assert job() == (["run", "run", "run", "run"], 132)
    assert len(calls) == 4
