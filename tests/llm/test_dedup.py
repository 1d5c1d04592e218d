"""BagMinHash, line join and lattice hashing against brute force, and their edge cases."""

from __future__ import annotations

import random

import numpy as np
import pytest

from bidbox.llm import bagminhash, lattice, linejoin
from bidbox.llm.components import components
from bidbox.llm.queries import op2_bagminhash, op5_line_dedup, op10_lattice_dedup

from . import helpers

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, doc string, key string, kept string, n_chars long"


def words(n: int, seed: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n)]


def family() -> list[tuple[int, str | None]]:
    """Bases, near copies at several distances, exact copies, short, empty, null and very long texts."""
    rows, i, r = [], 0, random.Random(3)
    for base in range(6):
        w = words(120, base)
        for copy in range(8):
            x = list(w)
            for _ in range(copy):
                x[r.randrange(len(x))] = f"edit{i}"
            rows.append((i, " ".join(x)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \n\t"), (i + 3, "one"), (i + 4, "one"), (i + 5, "one two"), (i + 6, "a " * 30_000), (i + 7, "a " * 30_001), (i + 8, " ".join(words(40_000, 99)))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", None, "y", 7) for i, t in rows], SCHEMA)


def test_near_duplicates_against_brute_force(spark):
    rows = family()
    got = {r.doc_id: (r.class_id, r.kept) for r in bagminhash.near_duplicates(frame(spark, rows)).collect()}
    want = helpers.near_classes(rows)
    assert got == {i: (c, c == i) for i, c in want.items()}


def test_near_duplicates_of_a_dense_group(spark):
    """Many variants around one text, most of them no link to each other or to the smallest id."""
    r, w, rows = random.Random(5), words(100, 1), []
    for i in range(150):
        x = list(w)
        for _ in range(r.randrange(0, 8)):
            x[r.randrange(len(x))] = f"e{i}"
        rows.append((i, " ".join(x)))
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == helpers.near_classes(rows)


def test_near_duplicates_of_a_group_just_under_the_threshold(spark, monkeypatch):
    """Variants at some 0.7 of each other share buckets and are no links: few of their pairs reach the exact check."""
    r, w, rows, checked = random.Random(7), words(150, 2), [], []
    for i in range(120):
        x = list(w)
        for at in r.sample(range(150), 3):
            x[at] = f"e{i}"
        rows.append((i, " ".join(x)))
    rows += [(200 + i, " ".join([*rows[i][1].split(), "more", "words"])) for i in range(0, 120, 10)]
    verified = bagminhash.verified

    def counted(pairs, texts, threshold):
        checked.append(pairs.count())
        return verified(pairs, texts, threshold)

    monkeypatch.setattr(bagminhash, "verified", counted)
    got = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(frame(spark, rows)).collect()}
    assert got == helpers.near_classes(rows)
    assert sum(checked) < 24 * len(rows)  # of 8,646 pairs


def test_bins_never_hide_a_link():
    r = np.random.default_rng(2)
    for most in (3, 400):  # counts within a byte and beyond it
        bags = r.integers(0, most, (40, 900)) * (r.random((40, 900)) < 0.9)
        bags[20:] = bags[:20] + (r.random((20, 900)) < 0.05)
        at = r.integers(0, bagminhash.BINS, 900)
        bins = np.array([np.minimum(np.bincount(at, weights=b, minlength=bagminhash.BINS), bagminhash.MOST) for b in bags]).astype(np.uint8)
        size = bags.sum(axis=1)
        for i in range(40):
            both = np.minimum(bags, bags[i]).sum(axis=1)
            link = both >= 0.8 * (size + size[i] - both)
            near = bagminhash._in_reach(bins[i], bins, size[i], size, 0.8)
            assert near[link].all() and (most > 255 or not near.all())


def test_near_duplicates_edges(spark):
    assert bagminhash.near_duplicates(frame(spark, [])).collect() == []
    text = " ".join(words(30, 1))
    rows = [(None, text), (1, text), (1, text), (2, text + " tail")]
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.class_id, r.kept) for r in bagminhash.near_duplicates(frame(spark, rows)).collect())
    assert got == [(False, 0, None, True), (True, 1, 1, True), (True, 1, 1, True), (True, 2, 1, False)]
    left = bagminhash.one_of_each(frame(spark, rows))
    assert left.columns == ["doc_id", "text", "doc", "key", "kept", "n_chars"]
    assert sorted(str(r.doc_id) for r in left.collect()) == ["1", "None"]


def test_op2_on_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {r.doc_id: r.class_id for r in op2_bagminhash(spark, SF).collect()} == helpers.near_classes(rows)


def test_weighted_estimate_is_unbiased():
    """The share of equal registers estimates the weighted Jaccard similarity."""
    r = np.random.default_rng(1)
    shingle = r.integers(1, 1 << 62, 400).astype(np.uint64)
    a, b = r.integers(1, 9, 400), r.integers(1, 9, 400)
    true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    owner = np.repeat([0, 1], 400)
    reg = bagminhash.signatures(2, owner, np.concatenate([shingle, shingle]), np.concatenate([a, b]), 4096)
    assert abs((reg[0] == reg[1]).mean() - true) < 0.03


def test_lines_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = helpers.kept_lines(rows)
    got = {r.doc_id: r.kept or [] for r in op5_line_dedup(spark, SF).collect()}
    assert got == {i: want.get(i, []) for i, _ in rows}


def test_line_links_and_rebuilt_texts(spark):
    long = " ".join(words(60, 4))
    near = long.replace(long.split()[30], "changed")
    rows = [(1, f"{long}\nshort line\n\nshort line"), (2, f"{near}\nown words in this line here"), (3, long), (4, None), (5, ""), (6, "short line"), (7, " ".join(words(30_000, 8)))]
    found = {r.doc_id: r for r in linejoin.kept_lines(frame(spark, rows)).collect()}
    assert found[1].kept == [0, 1] and found[2].kept == [1] and found[3].kept == [] and found[6].kept == []
    assert [found[i].n_links for i in (1, 2, 3)] == [1, 1, 1]
    clean = linejoin.without_repeats(frame(spark, rows))
    assert clean.columns == ["doc_id", "text", "doc", "key", "kept", "n_chars"]
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    first = f"{long}\nshort line\n"  # the second "short line" and that of text 6 repeat an earlier line
    assert texts[1] == (first, len(first)) and texts[2] == ("own words in this line here", 27)
    assert 3 not in texts and 6 not in texts and texts[4] == (None, 7) and texts[5] == ("", 7) and texts[7][0] == rows[6][1]


def test_line_edges(spark):
    assert linejoin.kept_lines(frame(spark, [])).collect() == []
    line = " ".join(words(12, 2))
    rows = [(None, line), (1, line), (1, line), (1, line + " more")]
    got = sorted((str(r.doc_id), r.n_lines, r.kept) for r in linejoin.kept_lines(frame(spark, rows)).collect())
    assert ("None", 1, [0]) in got and ("1", 1, []) in got
    assert sorted(str(r.doc_id) for r in linejoin.without_repeats(frame(spark, rows)).collect()) == ["None"]


def unit(seed: int, n: int, dim: int = 64) -> np.ndarray:
    x = np.random.default_rng(seed).normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_lattice_against_brute_force(spark):
    base = unit(1, 40)
    rows, at = [], 0
    for k, b in enumerate(base):
        for s in np.linspace(0.0, 0.35, 12 if k < 8 else 2):
            v = b + s * unit(100 + at, 1)[0]
            rows.append((at, [float(x) for x in v], 1))
            at += 1
    rows += [(at + i, [float(x) for x in base[0] * 3], 1) for i in range(3)]  # equal vectors
    x = np.array([r[1] for r in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    want = helpers.classes(range(len(rows)), [(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)])
    got = {r.vec_id: r for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rep int")).collect()}
    found = sum(r.n_links for r in got.values())
    assert 0.97 * near.sum() <= found <= near.sum()
    assert all(got[i].n_links <= near[i].sum() for i in got)
    assert np.mean([got[i].component_id == c for i, c in want.items()]) > 0.97


def test_lattice_edges(spark):
    schema = "vec_id long, embedding array<float>, t int, cell int"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1, 1), (2, [2.0, 0.0], 1, 1), (3, [0.0, 0.0], 1, 1), (4, None, 1, 1), (5, [], 1, 1), (6, [nan, 1.0], 1, 1), (7, [inf, 1.0], 1, 1), (8, [None, 1.0], 1, 1),
            (9, [1.0, 0.0, 0.0], 1, 1), (None, [1.0, 0.0], 1, 1), (1, [1.0, 0.0], 1, 1), (10, [1e30, 0.0], 1, 1)]
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, r.component_id, r.kept) for r in lattice.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (10, 2, 1, False), (-1, 0, None, True), *[(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]])
    assert lattice.near_duplicates(spark.createDataFrame([], schema)).collect() == []


def test_op10_on_the_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in op10_lattice_dedup(spark, SF).collect()}
    assert got == {r.vec_id: n for r, n in zip(rows, near.tolist(), strict=True)}


def test_e8_points_are_lattice_points_and_near():
    x = np.random.default_rng(2).normal(size=(500, 8))
    p = lattice.e8_points(x, 3)
    assert ((p % 2 == p[:, :, :1] % 2).all(axis=2)).all()  # all whole or all half
    assert (p.sum(axis=2) % 4 == 0).all()  # even sum
    far = np.sqrt((((p[:, 0] / 2) - x) ** 2).sum(axis=1))
    assert far.max() <= 1.0 + 1e-9  # the covering radius


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 60)], [(i, 59 - i) for i in range(30)], []])
def test_components(spark, links):
    got = {r.id: r.component for r in components(spark.createDataFrame([*links, (5, 5), (None, 3)], "a long, b long")).collect()}
    want = helpers.classes(range(61), links)
    assert got == {i: c for i, c in want.items() if i != c}


def line_variants(seed: int, groups: int, each: int, size: int) -> list[str]:
    """Lines in clusters: each line a copy of its cluster's with some words changed, a few of them in two or more places."""
    rnd = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        base = words(size, 1000 + g)
        for _ in range(each):
            w = list(base)
            for _ in range(int(rnd.integers(0, 4))):
                w[int(rnd.integers(0, size))] = f"v{int(rnd.integers(0, 9))}"
            out.append(" ".join(w))
    return [out[i] for i in rnd.permutation(len(out))]


def test_links_of_line_clusters_against_all_pairs(spark, monkeypatch):
    """Clusters of variants, cut into small blocks, parts and leads, lose no link and count none twice."""
    lines = line_variants(3, 6, 40, 60) + line_variants(4, 2, 30, 400) + line_variants(5, 3, 25, 12)
    rows = [(i, x) for i, x in enumerate(lines)]
    sets = {i: s[0] for i, s in ((i, helpers.line_sets(x)) for i, x in rows)}
    near = lambda a, b: len(a & b) / len(a | b) >= 0.8
    different = set(sets.values())
    degree = {s: sum(t != s and near(s, t) for t in different) for s in different}
    kept = helpers.kept_lines(rows)
    for block, lead, meet, part in ((1024, 32, 16_384, 16), (8, 1, 64, 1)):
        for name, value in (("BLOCK", block), ("LEAD", lead), ("MEET", meet), ("PART", part)):
            monkeypatch.setattr(linejoin, name, value)
        got = {r.doc_id: (r.n_links, r.kept) for r in linejoin.kept_lines(frame(spark, rows)).collect()}
        assert got == {i: (degree[s], kept.get(i, [])) for i, s in sets.items()}
    assert max(degree.values()) > 20


def test_one_of_each_tells_texts_of_one_id_apart(spark):
    a, b = " ".join(words(40, 21)), " ".join(words(40, 22))
    rows = [(1, a), (5, a), (5, b), (6, b + " tail"), (7, None), (7, ""), (7, a + " end"), (None, a)]
    left = bagminhash.one_of_each(frame(spark, rows))
    assert sorted(((str(r.doc_id), r.text) for r in left.collect()), key=str) == sorted([("1", a), ("5", b), ("7", None), ("7", ""), ("None", a)], key=str)


def test_one_of_each_takes_the_same_of_repeated_rows(spark):
    text = " ".join(words(20, 3))
    rows = [(1, text, f"extra {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string")
    got = {bagminhash.one_of_each(df.repartition(n, "extra")).collect()[0].extra for n in (1, 3, 7)}
    assert len(got) == 1
