"""Exact dedup against a plain grouping, with and without collisions of the hash."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from bidbox.llm import exactdup

ROWS = [(1, "Abc  DÉ", "x"), (2, "abc  dÉ", "y"), (3, "abc  dé", "y"), (4, None, None), (5, "", "z"), (6, " ", None), (7, "long " * 50_000, "l"), (9, "LONG " * 50_000, None),
        (8, "abc  dÉ", "y"), (8, "abc  dÉ", "y"), (8, "abc  dÉ", "other columns"), (None, "only here", "n"), (None, "abc  dÉ", "n"), (10, "once", "o"), (11, "İstanbul", "i"), (12, "i̇stanbul", "i")]
SCHEMA = "doc_id long, text string, hash string"  # a column whose name clashes with one used inside


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows, keep):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[fold(t)].append(i)
    out = []
    for i, t, _ in rows:
        g = groups[fold(t)]
        ids = [x for x in g if x is not None]
        stays = (max if keep == "largest" else min)(ids) if ids else None
        out.append((i, stays, len(g), i == stays, hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_copies(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for keep in ("smallest", "largest"):
        assert rows_of(exactdup.copies(docs, keep=keep)) == expected(ROWS, keep)


def test_collisions_are_told_apart_by_bytes(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for bits in (0, 1):  # all texts under one hash, then under two
        hashed = lambda b, bits=bits: F.substring(exactdup.content_hash(b), 1, bits)
        assert rows_of(exactdup.copies(docs, keep="largest", hashed=hashed)) == expected(ROWS, "largest")


def test_a_hot_group_and_rare_ones(spark):
    rows = [(i, "Hot" if i % 3 == 0 else f"t{i // 2}", None) for i in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert rows_of(exactdup.copies(docs)) == expected(rows, "smallest")


def test_without_copies(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = exactdup.without_copies(docs, keep="largest")
    assert got.columns == docs.columns
    kept = {(i, t) for i, t, _ in ROWS for j, stays, _, k, sha in expected(ROWS, "largest") if k and i == j and sha == hashlib.sha256(fold(t).encode()).hexdigest()}
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(kept, key=str)
    assert exactdup.without_copies(docs, keep="largest").collect() == got.collect()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exactdup.copies(docs).collect() == [] and exactdup.without_copies(docs).collect() == []


def test_no_python_in_the_plan(spark):
    plan = exactdup.copies(spark.createDataFrame(ROWS, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
