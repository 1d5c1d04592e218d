"""Ad-hoc SQL: what is let through, what is refused, and that nothing outside the registered tables can be read."""

import pytest

from bidbox.operators import sql_surface as Q

ACCEPTED = {
    "SELECT 'p/*q*/r' AS a, 'a--b' AS b FROM orders": 100,
    "-- a comment\nSELECT o_orderkey AS `set`, o_custkey AS load FROM orders;": 100,
    "WITH x AS (SELECT * FROM orders) SELECT count(*) FROM x": 1,
    "WITH hidden AS (SELECT 1 AS a) SELECT (SELECT count(*) FROM hidden) FROM orders": 100,
    "SELECT * FROM orders o JOIN cust ON o_custkey = c_custkey WHERE EXISTS (SELECT 1 FROM cust c WHERE c.c_custkey = o.o_custkey)": 100,
    "SELECT *, sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) FROM orders": 100,
    "SELECT transform(array(1, 2), x -> x + 1), CAST('1' AS INT), date'2020-01-01' + INTERVAL 1 DAY, o_custkey BETWEEN 1 AND 2 FROM orders LIMIT 3": 3,
    "SELECT * FROM VALUES (1, 2), (3, 4) AS t(a, b) JOIN orders ON a = o_orderkey": 2,
    "SELECT o_custkey, count(*) FROM orders GROUP BY GROUPING SETS ((o_custkey), ()) HAVING count(*) > 1": 8,
    "SELECT * FROM orders LATERAL VIEW explode(array(1, 2)) t AS z": 200,
    "SELECT * FROM orders PIVOT (count(*) FOR o_custkey IN (1, 2))": 100,
    "SELECT * FROM range(5), orders": 500,
    "(SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM cust) UNION SELECT 1": 1,
}
REFUSED = [
    "SELECT * FROM IDENTIFIER('parquet.`{path}`')", "SELECT * FROM IDENTIFIER('hid' || 'den')", "SELECT IDENTIFIER('reflect')('java.lang.System', 'currentTimeMillis')",
    "SELECT * FROM parquet.`{path}`", "SELECT * FROM `parquet`.`{path}`", "SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM parquet.`{path}`)",
    "SELECT * FROM (WITH hidden AS (SELECT 1 AS a) SELECT * FROM hidden) x, hidden", "SELECT * FROM hidden", "SELECT * FROM default.orders",
    "EXECUTE IMMEDIATE 'SELECT 1'", "EXECUTE IMMEDIATE 'DROP VIEW orders'", "ANALYZE TABLE orders COMPUTE STATISTICS", "REPAIR TABLE orders", "COMMENT ON TABLE orders IS 'x'",
    "SELECT reflect('java.lang.System', 'currentTimeMillis') FROM orders", "SELECT java_method('java.lang.System', 'currentTimeMillis')", "SELECT try_reflect('java.lang.System', 'x')",
    "SELECT input_file_name() FROM orders", "SELECT current_user()", "SELECT raise_error('x') FROM orders", "SELECT xpath_string('<a/>', 'a')", "SELECT mine(1)", "SELECT abs_(1)",
    "SELECT TRANSFORM(o_orderkey) USING 'cat' AS (x) FROM orders", "SELECT 1; SELECT 2", "SET spark.sql.ansi.enabled = false", "RESET", "SHOW TABLES", "DESCRIBE orders", "EXPLAIN SELECT 1", "BEGIN SELECT 1; END",
    "DECLARE VARIABLE x INT", "SELECT * FROM orders VERSION AS OF 1", "DROP TABLE orders", "INSERT INTO orders SELECT 1, 2", "CREATE TEMP VIEW v AS SELECT 1", "CACHE TABLE orders", "REFRESH TABLE orders", "USE default",
    "ADD JAR '/tmp/x.jar'", "CALL a.b()", "TABLE hidden", "", "not sql",
]


@pytest.fixture(scope="module")
def tables(spark):
    return {"orders": spark.range(100).selectExpr("id AS o_orderkey", "id % 7 AS o_custkey"), "cust": spark.range(9).selectExpr("id AS c_custkey")}


@pytest.mark.parametrize("sql", ACCEPTED)
def test_accepted(spark, tables, sql):
    assert Q.session_sql(spark, tables, sql).count() == ACCEPTED[sql]


@pytest.mark.parametrize("sql", REFUSED)
def test_refused(spark, tables, sql, tmp_path):
    path = str(tmp_path / "secret")
    spark.range(3).write.parquet(path)
    spark.range(3).createOrReplaceTempView("hidden")
    spark.udf.register("mine", lambda x: x)
    with pytest.raises(Q.QueryRejected):
        Q.session_sql(spark, tables, sql.replace("{path}", path))
    assert spark.table("hidden").count() == 3


def test_views_are_gone_or_restored_afterwards(spark, tables):
    spark.range(5).createOrReplaceTempView("orders")
    assert Q.session_sql(spark, tables, "SELECT * FROM orders").count() == 100
    assert spark.table("orders").count() == 5 and not spark.catalog.tableExists("cust")
    with pytest.raises(Q.QueryRejected):
        Q.session_sql(spark, {"cust": tables["cust"]}, "SELECT * FROM orders")
    spark.catalog.dropTempView("orders")


def test_self_sql_and_arguments(spark, tables):
    got = Q.self_sql(spark, tables["orders"], "SELECT {Who} AS who, count(*) AS n WHERE o_orderkey >= :least GROUP BY {Who}", macros={"Who": "o_custkey"}, args={"least": 50})
    assert {r.who: r.n for r in got.collect()} == {k: sum(i % 7 == k for i in range(50, 100)) for k in range(7)}
    with pytest.raises(Q.QueryRejected):
        Q.self_sql(spark, tables["orders"], "SELECT 1 FROM cust")
