"""Registered queries of this subpackage: thin digests of each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidbox.llm import bagminhash, exactdup, hardneg, langmix, lattice, licences, linejoin, mixing, repetition, spelling, spm, toxicity, warc
from bidbox.llm.common import fold, read_table, row_key, scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Operators that SQL can express as a whole; tests/llm holds brute-force versions of the others.
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def oracle(sql: str) -> Callable:
    def put(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        ORACLE[fn.__name__] = sql.strip()
        return fn

    return put


@query
def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    goals = mixing.source_targets(docs)
    got = mixing.mix(docs, {s: g for s, _, g in goals})
    table = F.broadcast(spark.createDataFrame([(s is None, s or "", n, g) for s, n, g in goals], "none boolean, name string, source_size long, target double"))
    one = got.withColumn("none", F.col("pattern")[0]["none"]).withColumn("name", F.col("pattern")[0]["name"])
    return one.join(table, ["none", "name"]).select("doc_id", F.col("mix_size").alias("size"), "source_size", "target", "taken")


@query
def op2_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def _held_out() -> Column:
    """A null id is in no fold."""
    return F.coalesce(fold() == 0, F.lit(False)).alias("held_out")


@query
def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return langmix.identify(docs, langmix.learn(docs)).select("doc_id", _held_out(), "lang_pred", "score", F.size("mixture").alias("n_languages"))


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    found = toxicity.score(docs, toxicity.learn(docs, labels))
    return found.select("doc_id", _held_out(), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))


@query
def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(read_table(spark, sf_dir, "documents")).drop("spans")


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.digest(read_table(spark, sf_dir, "documents"))


@query
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("matches").alias("n_matches"), F.array_join(F.array_sort(F.array_distinct("matches.licence")), " AND ").alias("licences"),
                        F.array_join(F.flatten("matches.sentences"), " ").alias("sentence_ids"))


@query
def op10_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(read_table(spark, sf_dir, "pages"), path)
    found = warc.transactions(warc.read(spark, path))
    meta = lambda k: F.col("metadata.fields")[k].cast("long")
    return found.select(meta("page-id").alias("page_id"), F.coalesce("response.payload_bytes", meta("payload-bytes")).alias("payload_bytes"),
                        F.col("response.digest").alias("payload_digest"), F.col("response.type").alias("record_type"), meta("refers-to-page-id").alias("refers_to"))


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = linejoin.kept_lines(docs).withColumnRenamed("doc_id", "id")
    rows = docs.select("doc_id", row_key().alias("key"))
    return (rows.join(found, rows["doc_id"].eqNullSafe(found["id"]) & (rows["key"] == found["key"]), "left")
            .select("doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0)).alias("n_removed"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "kept"))


@query
@oracle("""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256 FROM d JOIN g USING (body)""")
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.copies(read_table(spark, sf_dir, "documents"), keep="largest")


@query
@oracle("""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, p.id AS negative_id, positive_score, p.score AS negative_score
FROM pos JOIN p USING (anchor_id) WHERE NOT p.same AND 80 * positive_score <= 100 * p.score AND 100 * p.score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY p.score DESC, p.id) QUALIFY row_number() OVER w <= 5""")
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hardneg.mine(rows, F.col("vec_id") % 100 == 0)


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.with_slips(spelling.occurrences(read_table(spark, sf_dir, "documents"))))
