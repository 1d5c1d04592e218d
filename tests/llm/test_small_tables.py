"""Small tables in a session of many shuffle partitions: few files are written, and few shuffles a round."""

from __future__ import annotations

import random
import re

import pytest

from bidbox.llm import bagminhash, common, components, linejoin
from bidbox.llm.common import in_tasks, materialize

from . import helpers


@pytest.fixture
def many(spark):
    """64 shuffle partitions that are not joined, as on a large table."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in was.items():
        spark.conf.set(k, v)


def variants(n: int) -> list[tuple[int, str]]:
    r, rows = random.Random(5), []
    base = [["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(60)] for _ in range(4)]
    for i in range(n):
        w = list(base[i % 4])
        w[r.randrange(60)] = f"e{i}"
        rows.append((i, " ".join(w)))
    return rows


def counted(monkeypatch, modules) -> list[int]:
    files: list[int] = []

    def counting(df, tag):
        out = materialize(df, tag)
        files.append(len(out.inputFiles()))
        return out

    for m in modules:
        monkeypatch.setattr(m, "materialize", counting)
    return files


def test_near_duplicates_write_few_files(many, monkeypatch):
    files = counted(monkeypatch, [bagminhash, components])
    rows = variants(200)
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(many.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()}
    assert got == helpers.near_classes(rows)
    assert max(files) <= 4 and sum(files) <= 40


def test_line_dedup_writes_few_files(many, monkeypatch):
    files = counted(monkeypatch, [linejoin])
    rows = variants(200)
    got = {r.doc_id: r.kept for r in linejoin.kept_lines(many.createDataFrame(rows, "doc_id long, text string").coalesce(2)).collect()}
    stays = helpers.kept_lines(rows)
    assert {i: k for i, k in got.items() if k} == {i: sorted(k) for i, k in stays.items() if k}
    assert max(files) <= 4 and sum(files) <= 20


def test_a_round_of_components_has_few_shuffles(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = materialize(spark.createDataFrame([(i + 1, i) for i in range(40)], "u long, v long"), "test")
        plan = components._small_star(components._large_star(links))._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(re.findall(r"[-+] Exchange ", plan)) <= 5  # ReusedExchange is none


def test_a_large_table_keeps_its_tasks(many):
    assert in_tasks(many.range(100).repartition(16), 10_000, 10).rdd.getNumPartitions() == 16
    assert in_tasks(many.range(100).repartition(16), 0, 10).rdd.getNumPartitions() == 1


def test_memory_is_given_back_after_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    monkeypatch.setattr(common, "ship", lambda spark: None)

    class Frame:
        sparkSession = None

        def mapInArrow(self, fn, schema):
            return list(fn(iter([1, 2])))

    assert common.arrow_map(Frame(), lambda batches: (b + 1 for b in batches), "n long") == [2, 3]
    assert calls == [1]
