"""One join for all roles equals one left join a role."""

from pyspark.sql import functions as F

from bidbox.operators import joins as J

ROLES = {"N": "n", "E": "e", "S": "s"}


def _plan(df):
    df.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().sparkPlan().toString(), [tuple(r) for r in df.collect()]
    finally:
        df.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_equals_one_join_a_role(spark):
    fact = spark.range(200).select("id", *[F.when(F.col("id") % m > 0, F.col("id") * m % 23).alias(c) for c, m in (("n", 5), ("e", 7), ("s", 3))])
    fact = fact.unionByName(fact.where("id < 20"))  # repeated rows
    dim = spark.range(20).select(F.col("id").alias("p"), F.concat(F.lit("x"), "id").alias("name"), F.when(F.col("id") > 2, F.col("id") * 0.5).alias("mp"))
    want = J.role_joins(fact, dim, "p", ROLES, ["name", "mp"])
    got = J.stacked_role_join(fact, dim, "p", ROLES, ["name", "mp"])
    cols = ["id", "n", "e", "s", *[f"{c}_{r}" for r in ROLES for c in ("name", "mp")]]
    assert got.columns == cols
    plan, rows = _plan(got)
    assert sorted(rows, key=repr) == sorted((tuple(r) for r in want.select(*cols).collect()), key=repr)
    assert plan.count("Join") == 2  # whatever the number of roles


def test_empty_sides_and_null_roles(spark):
    fact = spark.createDataFrame([(1, None, None, None), (2, 4, 4, None)], "id long, n long, e long, s long")
    dim = spark.createDataFrame([(4, "a")], "p long, name string")
    rows = lambda f, d: sorted((tuple(r) for r in J.stacked_role_join(f, d, "p", ROLES, ["name"]).collect()), key=repr)
    assert rows(fact, dim) == [(1, None, None, None, None, None, None), (2, 4, 4, None, "a", "a", None)]
    assert rows(fact, dim.limit(0)) == [(1, None, None, None, None, None, None), (2, 4, 4, None, None, None, None)]
    assert rows(fact.limit(0), dim) == []


def test_lookup_broadcasts_the_rows_in_use(spark):
    fact = spark.range(200).select("id", *[F.when(F.col("id") % m > 0, F.col("id") * m % 23).alias(c) for c, m in (("n", 5), ("e", 7), ("s", 3))])
    dim = spark.range(100_000).select(F.col("id").alias("p"), F.concat(F.lit("x"), "id").alias("name"))
    dim = dim.where("p <> 4").unionByName(spark.createDataFrame([(None, "none")], "p long, name string"))
    want = sorted((tuple(r) for r in J.role_joins(fact, dim, "p", ROLES, ["name"]).collect()), key=repr)
    used = fact.unionByName(fact.withColumn("n", F.lit(77).cast("long")))
    for got, broadcast in ((J.role_lookup(fact, dim, "p", ROLES, ["name"]), True), (J.role_lookup(fact, dim, "p", ROLES, ["name"], used=used), True),
                           (J.role_lookup(fact, dim, "p", ROLES, ["name"], most=3), False)):
        plan, rows = _plan(got)
        assert sorted(rows, key=repr) == want
        assert (plan.count("BroadcastHashJoin") == len(ROLES)) == broadcast


def test_lookup_takes_one_row_of_a_repeated_key(spark):
    fact = spark.createDataFrame([(1, 4, 4, None)], "id long, n long, e long, s long")
    dim = spark.createDataFrame([(4, "a"), (4, "a")], "p long, name string")
    assert [tuple(r) for r in J.role_lookup(fact, dim, "p", ROLES, ["name"]).collect()] == [(1, 4, 4, None, "a", "a", None)]
