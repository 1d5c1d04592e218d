"""Each pipeline stage on its own input, against brute force where there is one."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from bidbox.llm.common import materialize

from . import helpers

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], SF), "test"))
    start, mild, lines, single, mixed, ids = kept
    assert all(k.columns == columns for k in (mild, lines, single, mixed))

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    gone = start.join(mild, "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 0").count() <= 0.01 * labels.where("toxic = 0").count()
    assert mild.join(labels, "doc_id").where("toxic = 1").count() <= 0.25 * labels.where("toxic = 1").count()

    rows = [(r.doc_id, r.text) for r in mild.collect()]
    want = {}
    stays = helpers.kept_lines(rows)
    for i, t in rows:
        sets = helpers.line_sets(t)
        text = "\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in sets or n in stays.get(i, []))
        if text.strip() or not (t or "").strip():
            want[i] = text
    assert {r.doc_id: r.text for r in lines.collect()} == want
    assert lines.where(F.col("n_chars") != F.char_length("text")).count() == 0

    groups = helpers.near_classes([(r.doc_id, r.text) for r in lines.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted(i for i, c in groups.items() if i == c)
    assert single.exceptAll(lines).count() == 0

    times = mixed.groupBy("doc_id").count()
    assert times.where("count > 3").count() == 0 and mixed.join(single, "doc_id", "left_anti").count() == 0
    assert ids.count() == mixed.count() and ids.where("ids IS NULL").count() == 0


def test_stages_on_nulls_and_extra_columns(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, doc string, key string"
    rows = [(1, None, "en", "a", 0, "x", "y"), (None, "some words that stand alone here", None, None, 5, "x", "y"), (2, "", "en", "a", 0, "x", "y"), (3, "more words that stand alone there too", "en", "b", 5, None, None), (3, "more words that stand alone there too", "en", "b", 5, None, None)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert k == 4 or out.columns == docs.columns
            out.collect()
