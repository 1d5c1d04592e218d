"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa

from bidbox.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(p, t):
    if len(p) == len(t):
        return sum(a != b for a, b in zip(p, t)) == 1
    if len(p) > len(t):
        p, t = t, p
    return len(t) == len(p) + 1 and any(t[:i] + t[i + 1:] == p for i in range(len(t)))


def expected(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    form, out = {}, {}
    for w, n in words.items():
        others = [t for t in words if t != w and near(w, t)]
        best = min(others, key=lambda t: (-words[t], t), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        out[w] = [n, len(others), form[w], words.get(form[w])]
    for w in words:
        end = w
        while form[end] is not None:
            end = form[end]
        out[w].append(end)
    return {w: tuple(x) for w, x in out.items()}


def got(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def slipped(docs):
    counts = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            counts[w] += 1
    return counts


def test_search_finds_each_pair_once():
    rnd = random.Random(3)
    for _ in range(40):
        letters = "abcÿ"[:rnd.randint(2, 4)]
        words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(6, 9))) for _ in range(rnd.randint(1, 120))})
        home = [rnd.random() < 0.8 for _ in words]
        count, best = Counter(), {}
        for last in (False, True):
            group = pa.table({"last": [last] * len(words), "word": words, "n": [len(w) * 7 % 11 for w in words], "home": home})
            for r in spelling._shard(group).to_pylist():
                count[r["word"]] += r["n_near"]
                best[r["word"]] = min(best.get(r["word"], (0, "~")), (-r["best_n"], r["best"]))
        for w in words:
            others = [t for t, h in zip(words, home) if h and near(w, t)]
            assert count[w] == len(others)
            assert best.get(w) == min(((-(len(t) * 7 % 11), t) for t in others), default=None)


def test_variants_against_brute_force(spark):
    rnd = random.Random(8)
    stems = ["beginning", "Écoles", "misprint", "abcdef", "aaaaaa", "straße", "preface", "prefaces", "prefixes"]
    tokens = []
    for s in stems:
        w = s
        for level in (200, 39, 7):  # chains of forms
            tokens += [w] * level
            at = rnd.randrange(len(w))
            w = rnd.choice([w[:at] + w[at + 1:], w[:at] + rnd.choice("aeé") + w[at:], w[:at] + rnd.choice("xyz") + w[at + 1:]])
    tokens += ["word×word", "ABCDEF"] * 5 + ["tiny"] * 50 + ["rareword"] * 4
    rnd.shuffle(tokens)
    docs = [(i, " ".join(tokens[i * 20:(i + 1) * 20])) for i in range(len(tokens) // 20 + 1)] + [(None, "beginning " * 300), (7, None), (8, ""), (8, "12 34 !?"), (9, "x" * 100_000 + " " + "x" * 99_999), (3, "preface-preface_preface1preface")]
    df = spark.createDataFrame([(i, t, "w") for i, t in docs], "doc_id long, text string, word string")
    want = expected(slipped(docs))
    assert any(x[4] != (x[2] or w) for w, x in want.items())  # some chain has two links
    for shard in (4096, 3):  # 3: crowded ends lie in several blocks
        assert got(spelling.variants(spelling.with_slips(spelling.occurrences(df)), shard=shard)) == want


def test_blocks_of_a_crowded_end_lie_in_different_shards(spark):
    rnd = random.Random(5)
    words = sorted({"pre" + "".join(rnd.choice("abc") for _ in range(rnd.randint(3, 5))) for _ in range(160)})  # one end holds all words
    counts = Counter({w: rnd.choice([5, 6, 40]) for w in words})
    df = spark.createDataFrame([(w,) for w, n in counts.items() for _ in range(n)], "word string")
    want = expected(counts)
    for shard in (64, 16, 5):
        assert got(spelling.variants(df, shard=shard)) == want


def test_slips_change_words(spark):
    docs = [(i, "correct spelling everywhere") for i in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counts = Counter(r.word for r in spelling.with_slips(spelling.occurrences(df)).collect())
    want = {w: n for w, n in slipped(docs).items()}
    assert counts == want and len(want) > 3


def test_long_words_and_repeats(spark):
    words = ["q" * 3000 + "a"] * 6 + ["q" * 3000 + "b"] * 40 + ["q" * 2999 + "b"] * 5 + ["ababab"] * 5 + ["bababa"] * 5
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "word string")
    assert got(spelling.variants(df)) == expected(Counter(words))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.with_slips(spelling.occurrences(docs))).collect() == []


def test_registered_query_against_brute_force(spark):
    from bidbox.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert got(QUERIES["op13_spelling_variants"](spark, "/root/testdata/sf0.001")) == expected(slipped(docs))
