"""Line dedup of lines of one to four words, against brute force that leaves no line with a word out."""

from __future__ import annotations

from collections import Counter

from bidbox.llm import linejoin
from bidbox.llm.queries import op5_line_dedup

from .helpers import WORD

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


def line_set(line: str, k: int = 5) -> frozenset:
    w = WORD.findall(line)
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def kept_lines(rows: list[tuple[int, str | None]], threshold: float = 0.8) -> dict[int, tuple[int, list[int]]]:
    """(lines with a word, those that match no earlier line) by id."""
    earlier: dict[tuple, list[frozenset]] = {}
    out = {}
    for i, text in sorted(rows):
        n, kept = 0, []
        for number, line in enumerate((text or "").split("\n")):
            s = line_set(line)
            if not s:
                continue
            n += 1
            if not any(len(s & x) >= threshold * len(s | x) - 1e-9 for x in {x for t in s for x in earlier.get(t, ())}):
                kept.append(number)
            for t in s:
                earlier.setdefault(t, []).append(s)
        out[i] = (n, kept)
    return out


def test_equal_short_lines_go(spark):
    rows = [(1, "Les.\n\nTwo words\n  two   words\nTwo words"), (2, "Les.\na b c d\na b c d e"), (3, "Two \t words"), (4, "a b c d e\n\na b c d\na b c\nd"), (5, "d"), (6, " \n"), (7, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: (r.n_lines, r.kept, r.n_links) for r in linejoin.kept_lines(docs).collect()}
    assert got == {1: (4, [0, 2, 3], 0), 2: (3, [1, 2], 0), 3: (1, [], 0), 4: (4, [3, 4], 0), 5: (1, [], 0)}
    texts = {r.doc_id: r.text for r in linejoin.without_repeats(docs).collect()}
    assert texts == {1: "Les.\n\nTwo words\n  two   words", 2: "a b c d\na b c d e", 4: "\na b c\nd", 6: " \n", 7: None}


def test_short_lines_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = kept_lines(rows)
    short = Counter(tuple(WORD.findall(x)) for _, t in rows for x in (t or "").split("\n") if 0 < len(WORD.findall(x)) < 5)
    assert max(short.values()) > 1
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept or []) for r in op5_line_dedup(spark, SF).collect()}
    assert got == {i: (n, n - len(k), k) for i, (n, k) in want.items()}
