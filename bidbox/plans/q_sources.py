"""Source/sink queries (S*, Q8, Q9): every sink writes under the shared checkpoint dir and reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources import documents as D
from ..sources import files as FS
from ..sources import html as HT
from .registry import Tables, register, table
from .util import money, r, rounded


def _p(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


@register("s01_scan", sql="SELECT * FROM lineitem")
def s01_scan(spark, d):
    return FS.read_parquet(spark, _p(d, "lineitem"))


@register("s02_regex_scan", sql="SELECT l_orderkey, l_discount, l_shipdate FROM lineitem")
def s02_regex_scan(spark, d):
    return FS.read_columns_matching(spark, _p(d, "lineitem"), [r"l_order", r"l_ship", r"l_disc"])


_YEAR_COUNTS_SQL = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows FROM orders GROUP BY 1"


@register("s04_manifest_scan", sql=_YEAR_COUNTS_SQL)
def s04_manifest_scan(spark, d):
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    root = scratch_path(spark, "s04")
    FS.write_partitioned(o, root, ["year"])
    manifest = FS.file_manifest(spark.read.parquet(root)).select("file", "rows")
    df = FS.validated_scan(spark, root, manifest)
    return df.groupBy("year").agg(F.count(F.lit(1)).alias("rows"))


@register("s05_typed_extract", sql="""
SELECT CAST(o_orderkey AS INTEGER) AS event_id, CAST(o_custkey AS INTEGER) AS club_id,
  CAST(o_totalprice AS FLOAT) AS total, CAST(o_orderdate AS DATE) AS game_date, o_orderpriority AS priority FROM orders""")
def s05_typed_extract(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("bidbox_orders")
    return spark.sql("""SELECT CAST(o_orderkey AS INT) AS event_id, CAST(o_custkey AS INT) AS club_id,
                          CAST(o_totalprice AS FLOAT) AS total, CAST(o_orderdate AS DATE) AS game_date,
                          o_orderpriority AS priority FROM bidbox_orders""")


_DOC_ROWS_SQL = """
SELECT l_orderkey AS event_id, o_custkey AS club_id, strftime(o_orderdate, '%Y-%m-%d') AS start_date, l_returnflag AS section_name,
  l_linenumber AS board_number, l_suppkey AS ns_pair, l_partkey % 100 AS ew_pair, l_extendedprice AS ns_score
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _event_docs(spark, d):
    t = Tables(spark, d)
    path = scratch_path(spark, "docs")
    D.build_event_docs(t.orders, t.lineitem).write.mode("overwrite").text(path)
    return D.read_event_docs(spark, path)


@register("s06_json_tables", sql=_DOC_ROWS_SQL)
def s06_json_tables(spark, d):
    return D.board_results(_event_docs(spark, d))


@register("s07_string_landing", sql="""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""")
def s07_string_landing(spark, d):
    return FS.landed_strings(table(spark, d, "orders"))


@register("s08_partitioned_write", sql="SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY 1")
def s08_partitioned_write(spark, d):
    root = scratch_path(spark, "s08")
    FS.write_partitioned(table(spark, d, "orders"), root, ["o_orderstatus"])
    return spark.read.parquet(root).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"))


@register("s09_sink_roundtrip", sql="""
SELECT l_returnflag, count(*) AS rows, ROUND(sum(l_extendedprice), 2) AS l_extendedprice FROM lineitem GROUP BY 1""")
def s09_sink_roundtrip(spark, d):
    path = scratch_path(spark, "s09")
    FS.write_parquet(table(spark, d, "lineitem"), path, "zstd", 16 * 1024 * 1024, max_records=20_000)
    back = spark.read.parquet(path)
    out = back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_extendedprice").alias("l_extendedprice"))
    return out.select("l_returnflag", "rows", money("l_extendedprice"))


@register("s10_manifest", sql="SELECT count(*) AS total_rows, TRUE AS all_files_nonempty FROM lineitem")
def s10_manifest(spark, d):
    path = scratch_path(spark, "s10")
    FS.write_parquet(table(spark, d, "lineitem"), path, max_records=20_000)
    m = FS.file_manifest(spark.read.parquet(path))
    return m.agg(F.sum("rows").alias("total_rows"), F.bool_and((F.col("rows") > 0) & (F.col("bytes") > 0)).alias("all_files_nonempty"))


_SHARD_BYTES = 1 << 20


@register("s10_shards", sql=f"""
WITH x AS (SELECT l_orderkey, l_linenumber, 8 + 8 + 8 + coalesce(strlen(l_returnflag), 0) + coalesce(strlen(l_linestatus), 0) AS b,
  CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber)), 1, 8) AS BIGINT) AS h FROM lineitem),
n AS (SELECT CAST(greatest(1, ceil(sum(b) / {_SHARD_BYTES}.0)) AS BIGINT) AS n FROM x)
SELECT h % n AS shard, count(*) AS rows, CAST(sum(b) AS BIGINT) AS row_bytes FROM x, n GROUP BY 1""")
def s10_shards(spark, d):
    """Shards of about a megabyte of plain rows, read back against the manifest that was counted before the write."""
    path = scratch_path(spark, "s10-shards")
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("long").alias("l_linenumber"),
                                           F.col("l_extendedprice").cast("double").alias("l_extendedprice"), "l_returnflag", "l_linestatus")
    FS.write_shards(li, path, ["l_orderkey", "l_linenumber"], _SHARD_BYTES)
    back = FS.read_shards(spark, path, li.schema)
    return back.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum(FS.row_bytes(li.schema)).alias("row_bytes"))


@register("s11_compact", sql=_YEAR_COUNTS_SQL)
def s11_compact(spark, d):
    o = table(spark, d, "orders").withColumn("year", F.year("o_orderdate"))
    shards = scratch_path(spark, "s11-shards")
    FS.write_partitioned(o, shards, ["year"], max_records=1_000)
    merged = FS.compact(spark, shards, scratch_path(spark, "s11-merged"), "o_orderdate")
    return merged.groupBy("year").agg(F.count(F.lit(1)).alias("rows"))


@register("s12_csv", sql=f"""
SELECT n_name AS nation, c_mktsegment AS segment, count(*) AS n_customers, {r('avg(c_acctbal)', 2)} AS avg_balance
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def s12_csv(spark, d):
    """A report table (nation x segment) written as report CSV (quoted text, bare numbers, BOM),
    read back as text and parsed."""
    t = Tables(spark, d)
    rep = rounded(t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
                  .groupBy(F.col("n_name").alias("nation"), F.col("c_mktsegment").alias("segment"))
                  .agg(F.count(F.lit(1)).alias("n_customers"), F.avg("c_acctbal").alias("avg_balance")), 2)
    path = scratch_path(spark, "s12")
    FS.write_report_csv(rep, path, order=["nation", "segment"])
    schema = "nation string, segment string, n_customers long, avg_balance double"
    back = spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)
    return back


@register("s13_json_sidecar", sql="""
SELECT count(*) AS n_orders, ROUND(sum(o_totalprice), 2) AS total_price, CAST(min(o_orderdate) AS DATE) AS first_date,
  CAST(max(o_orderdate) AS DATE) AS last_date FROM orders""")
def s13_json_sidecar(spark, d):
    o = table(spark, d, "orders")
    agg = o.agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_price"),
                F.to_date(F.min("o_orderdate")).alias("first_date"), F.to_date(F.max("o_orderdate")).alias("last_date"))
    path = scratch_path(spark, "s13")
    FS.write_json_sidecar(agg, path)
    return spark.read.schema(agg.schema).json(path)


_TYPED_ORDERS = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                              T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderdate", T.DateType()),
                              T.StructField("club_name", T.StringType())])


@register("s14_typed_sink", sql="""
SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, NULL::VARCHAR AS club_name FROM orders""")
def s14_typed_sink(spark, d):
    t = Tables(spark, d)
    landed = {"orders": FS.landed_strings(t.orders), "unknown_table": FS.landed_strings(t.region)}
    typed = FS.typed_load(spark, landed, {"orders": _TYPED_ORDERS})
    path = scratch_path(spark, "s14")
    typed["orders"].write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_S15_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())])


@register("s15_discover", sql="SELECT o_orderstatus, o_orderpriority, count(*) AS rows FROM orders GROUP BY ALL")
def s15_discover(spark, d):
    o = table(spark, d, "orders")
    root = scratch_path(spark, "s15")
    FS.write_partitioned(o.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"), root,
                         ["o_orderstatus", "o_orderpriority"], fmt="json")
    o.limit(10).write.mode("overwrite").csv(f"{root}/decoy_csv")  # must not be picked up
    found = FS.discover(spark, root, "*.json", _S15_SCHEMA)
    path = F.col("_metadata.file_path")
    return (found.select(F.regexp_extract(path, "o_orderstatus=([^/]+)", 1).alias("o_orderstatus"),
                         F.url_decode(F.regexp_extract(path, "o_orderpriority=([^/]+)", 1)).alias("o_orderpriority"))
            .groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("rows")))


_S16_LINE = """'{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_orderstatus":"' || o_orderstatus || '"}'"""


@register("s16_corrupt_split", sql=f"""
WITH l AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN substr({_S16_LINE}, 1, 15) ELSE {_S16_LINE} END AS line FROM orders),
bad AS (SELECT line FROM l WHERE o_orderkey % 50 = 0 ORDER BY line LIMIT 5)
SELECT count(*) FILTER (WHERE o_orderkey % 50 <> 0) AS n_ok, count(*) FILTER (WHERE o_orderkey % 50 = 0) AS n_err,
  count(*) FILTER (WHERE o_orderkey % 50 <> 0) AS n_with_key,
  (SELECT coalesce(string_agg(line, '|' ORDER BY line), '') FROM bad) AS first_errors FROM l""")
def s16_corrupt_split(spark, d):
    o = table(spark, d, "orders")
    line = F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"), F.lit(',"o_orderstatus":"'),
                    F.col("o_orderstatus"), F.lit('"}'))
    text = F.when(F.col("o_orderkey") % 50 == 0, F.substring(line, 1, 15)).otherwise(line)
    path = scratch_path(spark, "s16")
    o.select(text.alias("value")).write.mode("overwrite").text(path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    split = FS.split_corrupt(FS.read_json_tolerant(spark, path, schema), scratch_path(spark, "s16-split"))
    return FS.corrupt_summary(split, "o_orderkey")


@register("s18_html_links", sql="""
WITH a AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hs FROM pages),
b AS (SELECT page_id, unnest(hs) AS href, unnest(range(0, len(hs))) AS pos FROM a)
SELECT page_id, href, CAST(min(pos) AS INTEGER) AS first_pos FROM b GROUP BY page_id, href""")
def s18_html_links(spark, d):
    return HT.links(table(spark, d, "pages"), "page_id", "html")


@register("s19_embedded_json", sql="""
WITH a AS (SELECT page_id, regexp_extract_all(html, 'var\\s+(\\w+)\\s*=\\s*([^;]*);', 1) AS names,
  regexp_extract_all(html, 'var\\s+(\\w+)\\s*=\\s*([^;]*);', 2) AS vals,
  TRY_CAST(NULLIF(regexp_extract(html, 'track\\((\\d+)\\)', 1), '') AS BIGINT) AS track_id FROM pages),
b AS (SELECT page_id, track_id, unnest(names) AS name, unnest(vals) AS raw, unnest(range(0, len(names))) AS pos FROM a)
SELECT page_id, CAST(pos AS INTEGER) AS pos, name, json_extract_string('{"v":' || raw || '}', '$.v') AS value, track_id FROM b""")
def s19_embedded_json(spark, d):
    return HT.script_vars(table(spark, d, "pages"), "page_id", "html")


@register("s20_html_rows", sql="""
WITH a AS (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 1) AS hs,
  regexp_extract_all(html, '<li><a href="([^"]*)">([^<]*)</a></li>', 2) AS ls FROM pages)
SELECT page_id, CAST(unnest(range(0, len(hs))) AS INTEGER) AS pos, unnest(hs) AS href, unnest(ls) AS label FROM a""")
def s20_html_rows(spark, d):
    return HT.list_rows(table(spark, d, "pages"), "page_id", "html")


def _result_pages(spark, d) -> DataFrame:
    """A page for each customer with orders: a results table (header, a row an order) and the same rows as an embedded array."""
    o = Tables(spark, d).orders.select("o_custkey", F.struct("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.format_string("%.2f", "o_totalprice").alias("total")).alias("r"))
    per = o.groupBy("o_custkey").agg(F.array_sort(F.collect_list("r")).alias("rs"))  # the orders of one customer
    join = lambda parts: F.array_join(parts, "")
    row = lambda r: F.concat(F.lit('<tr>\n<td class="d">'), r["day"], F.lit('</td><td><a href="/details/'), r["o_orderkey"].cast("string"), F.lit('">Club &amp; <b>'), r["o_orderstatus"], F.lit("</b></a>\n</td><TD>"), r["total"], F.lit("</TD></tr>"))
    item = lambda r: F.to_json(F.struct(r["o_orderkey"].alias("id"), F.struct(F.concat(r["o_orderstatus"], F.lit("; }];")).alias("note")).alias("more")))
    table_ = F.concat(F.lit("<table><tr><th>Date</th><th>Club</th><th>Score</th></tr>"), join(F.transform("rs", row)), F.lit("</table>"))
    script = F.concat(F.lit("<script>let address = [1, "), F.array_join(F.transform("rs", item), ", "), F.lit("]; var done = \"a;b\";</script>"))
    return per.select(F.col("o_custkey").alias("page_id"), F.concat(F.lit("<html><body>"), table_, script, F.lit("</body></html>")).alias("html"))


@register("s19_embedded_rows", sql="""
SELECT o_custkey AS page_id, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INTEGER) AS element, o_orderkey AS id, o_orderstatus || '; }];' AS note FROM orders""")
def s19_embedded_rows(spark, d):
    """Rows of an embedded array of nested objects whose strings hold brackets and semicolons."""
    rows = HT.embedded_rows(_result_pages(spark, d), "page_id", "html", "address", "id long, more struct<note:string>")
    return rows.select("page_id", "element", "id", "more.note")


@register("s20_table_rows", sql="""
WITH r AS (SELECT o_custkey AS page_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS row, FALSE AS header, strftime(o_orderdate, '%Y-%m-%d') AS c1, 'Club & ' || o_orderstatus AS c2,
  printf('%.2f', o_totalprice) AS c3, '/details/' || CAST(o_orderkey AS VARCHAR) AS link FROM orders
  UNION ALL SELECT DISTINCT o_custkey, 0, TRUE, 'Date', 'Club', 'Score', NULL FROM orders)
SELECT page_id, CAST(row AS INTEGER) AS row, header, c1, c2, c3, link FROM r""")
def s20_table_rows(spark, d):
    """Rows, cells and links of the tables of result pages."""
    rows = HT.table_rows(_result_pages(spark, d), "page_id", "html")
    return rows.select("page_id", "row", "header", *[F.get("cells", F.lit(i)).alias(f"c{i + 1}") for i in range(3)], F.get("links", F.lit(0)).alias("link"))


@register("q08_roster", sql=f"SELECT DISTINCT event_id, section_name, ns_pair AS pair_number FROM ({_DOC_ROWS_SQL})")
def q08_roster(spark, d):
    return D.roster(_event_docs(spark, d))


@register("q09_exists", sql="""
SELECT o_orderkey AS event_id, coalesce(bool_or(l_suppkey = o_custkey % 100), FALSE) AS club_pair_played
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def q09_exists(spark, d):
    ev = _event_docs(spark, d).where(F.size("sections") > 0)
    return ev.select("event_id", D.contains_pair(F.col("club_id") % 100).alias("club_pair_played"))
