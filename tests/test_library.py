"""Library behaviours on small inline fixtures: malformed documents, constraint checks,
strict/lenient schema operations, manifests, the SQL self view."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidbox.operators import filters as FL
from bidbox.operators import joins as J
from bidbox.operators import schema as SC
from bidbox.operators import sql_surface as Q
from bidbox.sources import documents as D
from bidbox.sources import files as FS


def test_malformed_event_documents(spark, tmp_path):
    docs = [
        '{"event_id": 1, "club_id": 7, "sections": [{"section_name": "A", "boards": [{"board_number": 1, '
        '"board_results": [{"ns_pair": 3, "ew_pair": 4, "ns_score": 420.0}]}]}]}',
        '{"event_id": 2, "club_id": 7}',                                   # missing array
        '{"event_id": 3, "club_id": 7, "sections": []}',                   # empty array
        '{"event_id": 4, "club_id": 7, "sections": [{"section_name": "B", "boards": 5}]}',  # scalar for array
        '{"event_id": 5, "club_id": ',                                     # truncated
        '{"event_id": 1, "club_id": 7, "sections": [{"section_name": "A", "boards": [{"board_number": 2, '
        '"board_results": [{"ns_pair": 5, "ew_pair": 6, "ns_score": -50.0}]}]}]}',   # repeated id
    ]
    path = str(tmp_path / "docs")
    spark.createDataFrame([(x,) for x in docs], "value string").write.text(path)
    ev = D.read_event_docs(spark, path)
    rows = sorted((r.event_id, r.board_number, r.ns_pair) for r in D.board_results(ev).collect())
    assert rows == [(1, 1, 3), (1, 2, 5)]
    assert ev.where(F.col("event_id") == 2).select(D.contains_pair(F.lit(3)).alias("x")).first().x is False


def test_unique_constraints_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], "id int, u string")
    assert SC.key_violations(df, ["u"], nullable_unique=True).collect()[0]["u"] == "a"
    assert SC.key_violations(df, ["u"]).count() == 2           # as a PK, two nulls also collide
    with pytest.raises(ValueError):
        J.assert_unique(df, ["u"])
    assert J.assert_unique(df, ["id"]).count() == 4


def test_strict_and_lenient_schema_ops(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string")
    with pytest.raises(SC.SchemaError):
        SC.drop_strict(df, ["a", "zz"])
    with pytest.raises(SC.SchemaError):
        SC.project(df, ["a", "zz"], strict=True)
    out, missing = SC.project(df, ["a", "zz"], strict=False)
    assert out.columns == ["a"] and missing == ["zz"]
    target = T.StructType([T.StructField("c", T.StringType()), T.StructField("n", T.IntegerType()),
                           T.StructField("f", T.BooleanType()), T.StructField("s", T.StringType())])
    r = SC.align(df, target).first()
    assert (r.c, r.n, r.f, r.s) == ("x", 0, False, None)
    assert SC.downcast_doubles(df).schema["b"].dataType == T.FloatType()
    assert SC.schema_problems(df.schema) == ["b: double"]


def test_in_keys_is_a_semi_join(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    keys = [str(i) for i in range(0, 10_005)]
    assert FL.in_keys(df, "k", keys[:3]).count() == 3
    assert FL.in_keys(df, "k", keys).count() == 50


def test_manifest_mismatch_raises(spark, tmp_path):
    root = str(tmp_path / "shards")
    spark.range(30).withColumn("p", F.col("id") % 3).write.partitionBy("p").parquet(root)
    m = FS.file_manifest(spark.read.parquet(root)).select("file", "rows")
    assert FS.validated_scan(spark, root, m).count() == 30
    bad = m.withColumn("rows", F.col("rows") + 1)
    with pytest.raises(FS.ManifestError):
        FS.validated_scan(spark, root, bad)


def test_self_sql_with_macros_and_args(spark):
    df = spark.createDataFrame([(1, "N"), (2, "S"), (3, "N")], "x int, seat string")
    out = Q.self_sql(spark, df, "SELECT {Col} AS v WHERE seat = :s", macros={"Col": "x"}, args={"s": "N"})
    assert sorted(r.v for r in out.collect()) == [1, 3]
    with pytest.raises(Q.QueryRejected):
        Q.self_sql(spark, df, "SELECT {Col} AS v", macros={"Col": "x; DROP"})


def test_same_columns_and_composite_key(spark):
    from bidbox.functions import keys as K
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, 2.0)], "k int, v double")
    assert SC.same_columns([a, a]) == [] and len(SC.same_columns([a, b])) == 1
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    keys = df.select(K.composite_key("k", "v").alias("ck"))
    assert keys.distinct().count() == 2                      # null is a value inside the key
    assert SC.key_violations(keys, ["ck"]).count() == 1


def test_asof_join_matches_brute_force_with_hot_key(spark):
    import random
    rnd = random.Random(7)
    left = [(0 if i % 3 else rnd.randint(1, 5), rnd.randint(0, 500), i) for i in range(600)]
    right = [(0 if i % 2 else rnd.randint(1, 5), rnd.randint(0, 500), 1000 + i) for i in range(400)]
    L = spark.createDataFrame(left, "k int, t int, lid int")
    Rt = spark.createDataFrame(right, "k int, t int, rid int").withColumn("rt", F.col("t"))
    got = {(r.lid, r.rid) for r in J.asof_join(L, Rt, ["k"], "t", ["rid", "rt"], tie="rid", n_partitions=8).collect()}
    want = set()
    for k, t, lid in left:
        cands = [(rt, rid) for rk, rt, rid in right if rk == k and rt <= t]
        want.add((lid, max(cands)[1] if cands else None))
    assert got == want
