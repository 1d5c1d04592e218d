"""Mixing, SentencePiece, WARC, language, toxicity, repetition and licences: brute force, round trips, held-out accuracy, edges."""

from __future__ import annotations

import hashlib
import random
import tempfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from bidbox.llm import langmix, licences, mixing, repetition, spm, toxicity, warc
from bidbox.llm.queries import op1_source_mixing, op3_sentencepiece, op4_warc, op6_language_mixture, op7_toxicity, op8_repetition, op9_licences

from .helpers import WORD

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, score int, doc string"
LONG = "word " * 60_000


def edge_docs(spark):
    rows = [(1, None, None, None, 1, "x"), (2, "", "en", "a", 1, "x"), (3, " \n\t ", "en", "a", 1, "x"), (4, "one", None, "a", 1, "x"), (4, "one", None, "a", 1, "x"), (None, "two words", "de", None, 1, "x"), (5, LONG, "en", "b", 1, "x"), (6, "123 456 !!", "en", "b", 1, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


# --- 1: mixing ----------------------------------------------------------------------------------------

def test_mix_against_the_contract(spark):
    docs = documents(spark, SF2)
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    source = {r.doc_id: r.source for r in docs.collect()}
    per = Counter()
    for i, s in source.items():
        per[s] += size[i]
    rows = op1_source_mixing(spark, SF2).collect()
    assert sorted(r.doc_id for r in rows) == sorted(size)
    taken = Counter()
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == per[source[r.doc_id]]
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source[r.doc_id]] += r.taken
    target = {source[r.doc_id]: r.target for r in rows}
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(per))}
    total = sum(per.values())
    assert all(abs(t - total * weights[s] / sum(weights.values())) < 1e-6 for s, t in target.items())  # none reaches 3 times its size here
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] for s in per)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, op1_source_mixing(spark, SF2).collect()))


def test_water_fill():
    assert mixing.water_fill([100, 100, 100], [1, 2, 3], 3) == [50, 100, 150]
    assert mixing.water_fill([10, 100, 190], [3, 1, 1], 3) == [30, 135, 135]
    assert mixing.water_fill([0, 100], [1, 1], 3) == [0, 100]
    assert mixing.water_fill([], [], 3) == []


def test_route_is_a_least_cost_flow():
    """Overlapping sources against all integer flows of a small case."""
    capacity, quota = {("a",): 2, ("a", "b"): 2, ("b",): 1}, {"a": 4, "b": 3}
    got = mixing.route(capacity, quota, 3)
    used = {p: sum(r.values()) for p, r in got.items()}
    assert sum(r.get("a", 0) for r in got.values()) == pytest.approx(4) and sum(r.get("b", 0) for r in got.values()) == pytest.approx(3)

    def cost(p, words):
        return sum(min(max(words - k * capacity[p], 0), capacity[p]) * mixing.REPEAT_COST[k] for k in range(3))

    best = min(cost(("a",), x) + cost(("a", "b"), (4 - x) + (3 - y)) + cost(("b",), y) for x in range(5) for y in range(4) if x <= 6 and 7 - x - y <= 6 and y <= 3)
    assert sum(cost(p, w) for p, w in used.items()) == pytest.approx(best)


def test_mix_edges(spark):
    goals = mixing.source_targets(edge_docs(spark))
    assert [g[0] for g in goals] == ["a", "b", None] and [g[1] for g in goals] == [2, 60_003, 2]
    rows = mixing.mix(edge_docs(spark), {s: t for s, _, t in goals}).collect()
    assert len(rows) == 8 and all(r.copies <= 3 for r in rows)
    assert mixing.mix(edge_docs(spark).limit(0), {}).collect() == []
    out = mixing.mixed_documents(edge_docs(spark))
    assert out.columns == edge_docs(spark).columns
    assert {r.doc_id for r in out.collect()} <= {4, 5, 6, None}


# --- 3: SentencePiece -----------------------------------------------------------------------------------

ODD = ["", "  a  b ", "\n\n x\t\t", "日本語 한국어 😀 ñ", "a" * 2000, "<0x0A> <s> </s> <unk>", "    def f(x):\r\n        return x", "!!!! ----- 00001234", "ab\x00c\x7f", "é" + "é"]


def test_ids_equal_the_library_and_decode_to_the_text():
    sentencepiece = pytest.importorskip("sentencepiece")
    data = spm.read_model()
    library, mine = sentencepiece.SentencePieceProcessor(model_proto=data), spm.Model(data)
    r = random.Random(1)
    texts = ODD + ["".join(r.choice("abcdeinorst  ,.") for _ in range(300)) for _ in range(200)] + [LONG]
    ids = mine.encode(texts)
    assert [list(memoryview(i).cast("i")) for i in ids] == library.encode(texts)
    assert [mine.decode(i) for i in ids] == texts and mine.encode([None]) == [None] and mine.decode(None) is None


def test_unigram_segmentation_has_the_best_score():
    """Viterbi over a shared trie against all segmentations of short words."""
    m = spm.Model(spm.read_model(), unigram=True)
    words = sorted({w for t in ("the theory them then other and android", "in into intone") for w in m.words(t)})

    def best(w):
        top = [0.0]
        for end in range(1, len(w) + 1):
            top.append(max(top[s] + (m.score[m.id[w[s:end]]] if w[s:end] in m.id else m.unknown_score if end - s == 1 else -1e18) for s in range(end)))
        return top[-1]

    for w, codes in zip(words, m.segment_sorted(words), strict=True):
        assert "".join(map(m.spelling, codes)) == w
        assert sum(m.score[c] if c < len(m.pieces) else m.unknown_score for c in codes) == best(w)


def test_spm_frames(spark):
    docs = edge_docs(spark)
    ids = spm.encode(docs)
    assert sorted((str(r.doc_id), r.text) for r in spm.decode(ids).collect() if r.text is not None) == sorted((str(r.doc_id), r.text) for r in docs.collect() if r.text is not None)
    assert ids.where("ids IS NULL").count() == 1 and spm.encode(docs.limit(0)).collect() == []
    rows = op3_sentencepiece(spark, SF)
    assert rows.where("round_trip").count() == documents(spark).count()


# --- 4: WARC ------------------------------------------------------------------------------------------------

def test_op4_on_the_table(spark):
    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    last = defaultdict(int)
    for i, b in pages:
        last[hashlib.sha1(b).hexdigest()] = max(last[hashlib.sha1(b).hexdigest()], i)
    want = sorted((i, len(b), d, *(("response", -1) if len(b) < 1000 or last[d] == i else ("revisit", last[d]))) for i, b in pages for d in [hashlib.sha1(b).hexdigest()])
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in op4_warc(spark, SF).collect())
    assert got == want


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_warc_round_trip_and_revisits(spark, compression):
    tricky = "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 60
    rows = [(1, "http://a.example/x y?q#f", tricky, "r"), (2, None, tricky, "r"), (3, "http://b.example", "s" * 999, "r"), (4, "u\r\nWARC-Type: metadata", "s" * 999, "r"), (5, "http://c", None, "r"), (6, "http://c", "", "r"),
            (7, "http://d", "t" * 1000, "r"), (7, "http://d", "t" * 1000, "r"), (None, "http://e", "t" * 1000, "r"), (8, "http://f", "z" * 2_000_000, "r")]
    path = tempfile.mkdtemp() + "/w"
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string, digest string"), path, compression=compression, file_bytes=4000)
    records = warc.read(spark, path)
    assert records.groupBy("type").count().collect() and records.count() == 3 * len(rows)
    found = warc.transactions(records).collect()
    by = defaultdict(list)
    for r in found:
        by[r.metadata.fields.get("page-id")].append(r)
    kinds = {k: sorted(r.response.type for r in v) for k, v in by.items()}
    assert kinds == {"1": ["revisit"], "2": ["response"], "3": ["response"], "4": ["response"], "5": ["response"], "6": ["response"], "7": ["response", "revisit"], None: ["revisit"], "8": ["response"]}
    assert bytes(by["2"][0].response.payload).decode() == tricky and bytes(by["5"][0].response.payload) == b""
    assert by["1"][0].metadata.fields["refers-to-page-id"] == "2" and by["1"][0].response.refers_to_id == by["2"][0].record_id
    assert all(r.request is not None and r.metadata is not None for r in found) and by["4"][0].uri == "u WARC-Type: metadata"


def test_warc_hot_and_rare_payloads(spark):
    """A third of the rows share one payload, others have two or three copies; rows repeat ids and whole rows."""
    hot, rare = "h" * 1500, lambda i: f"{i:04d}" * 300
    rows = [(i, f"http://a/{i}", hot if i % 3 == 0 else rare(i // 2) if i % 3 == 1 else f"{i}") for i in range(3000)]
    rows += [(2997, "http://a/2997", hot), (2997, "http://b/", hot), (None, None, hot), (1, "http://a/1", rare(0)), (1, "http://a/1", rare(0)), (2, None, None)]
    found = warc.captures(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(((r.page_id, r.payload) for r in found), key=repr) == sorted(((i, t or "") for i, _, t in rows), key=repr)
    last = {}
    for i, _, t in rows:
        if t and len(t) >= 1000:
            last[t] = max(last.get(t, -1), -1 if i is None else i)
    for t, i in last.items():
        same = [r for r in found if r.payload == t]
        whole = [r for r in same if r.type == "response"]
        assert [r.page_id for r in whole] == [i] and all(r.refers_to == i for r in same if r.type == "revisit")
    assert all(r.type == "response" and r.refers_to is None for r in found if r.bytes < 1000)


def test_warc_reader_reads_other_archives(spark):
    import gzip

    def record(kind, body, extra=b""):
        return b"WARC/1.0\r\nwarc-type: %s\r\nWARC-Record-ID: <urn:%s>\r\n%sContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind, kind, extra, len(body), body)

    members = gzip.compress(record(b"warcinfo", b"x: y")) + gzip.compress(record(b"response", b"HTTP/1.1 200 OK\r\n\r\nhello\r\n\r\n"))
    assert [(f["warc-type"], len(b)) for f, b in warc.parse(members)] == [("warcinfo", 4), ("response", 28)]
    with pytest.raises(ValueError):
        list(warc.parse(record(b"response", b"abc")[:-8]))
    empty = tempfile.mkdtemp() + "/w"
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), empty)
    assert warc.transactions(warc.read(spark, empty)).collect() == []


# --- 6: language ------------------------------------------------------------------------------------------------

def test_language_on_the_held_out_fold(spark):
    rows = op6_language_mixture(spark, SF2).join(documents(spark, SF2).select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_mixture_and_edges(spark):
    docs = documents(spark, SF2)
    model = langmix.learn(docs)
    en, fr = (docs.where((F.col("lang") == x) & (F.col("n_chars").between(1500, 3000))).orderBy("doc_id").first().text for x in ("en", "fr"))
    mixed = spark.createDataFrame([(1, en[:1400] + "\n" + fr[:1400])], "doc_id long, text string")
    got = {m.lang: m.share for m in langmix.identify(mixed, model).first().mixture}
    assert set(got) == {"en", "fr"} and min(got.values()) > 0.3
    edges = langmix.identify(edge_docs(spark), model).collect()
    assert len(edges) == 8 and sorted(r.lang_pred for r in edges if r.doc_id in (1, 2, 3, 6)) == ["und"] * 4
    assert all(r.score == 0 for r in edges if r.lang_pred == "und") and all(r.lang_pred != "und" for r in edges if r.doc_id in (4, 5, None))
    none = langmix.learn(docs.limit(0))
    assert none[0] == [] and {r.lang_pred for r in langmix.identify(edge_docs(spark), none).collect()} == {"und"}


def test_em_finds_known_shares():
    r = np.random.default_rng(1)
    like = np.where(r.random((4000, 1)) < 0.7, [[1.0, 0.05]], [[0.05, 1.0]])
    share, _ = langmix._fit(like, np.zeros(4000, int), np.array([[0.5, 0.5]]), 30)
    assert abs(share[0, 0] - 0.7) < 0.03


# --- 7: toxicity -------------------------------------------------------------------------------------------------

def test_toxicity_on_the_held_out_fold(spark):
    sf = "/root/testdata/sf0.1"
    rows = op7_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    bad, fine = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted for r in bad]) > 0.85 and np.mean([r.predicted for r in fine]) < 0.02
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)


def test_toxicity_locates_sentences(spark):
    rows = [(i, f"Ein schöner Satz {i}. " + ("Du bist ein schurkenkopf heute! " if i % 2 else "") + "Noch ein Satz.", "x") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    for r in toxicity.score(docs, model).collect():
        assert (r.score >= 0.5) == (r.doc_id % 2 == 1)
        for s in r.offending:
            assert rows[r.doc_id][1][s.start:s.end] == "Du bist ein schurkenkopf heute"
    clean = toxicity.without_toxic(docs, model)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == list(range(0, 200, 2))
    edges = toxicity.score(edge_docs(spark), model).collect()
    assert len(edges) == 8 and all(r.score == 0 and r.offending == [] for r in edges)
    assert toxicity.without_toxic(edge_docs(spark), model).count() == 8
    assert len(toxicity.learn(docs, labels.where("toxic = 1"))["words"]) == 0


# --- 8: repetition ---------------------------------------------------------------------------------------------

def base_rules(text):
    x = text or ""
    w = WORD.findall(x)
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    hit = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [y for y in x.split("\n") if WORD.search(y)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(hit)


def longest_repeat(w):
    for k in range(len(w) - 1, 4, -1):
        if len({tuple(w[i:i + k]) for i in range(len(w) - k + 1)}) < len(w) - k + 1:
            return k
    return 0


def test_repetition_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in documents(spark).collect()}
    for r in op8_repetition(spark, SF).collect():
        want = base_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and (r.kept is False or not r.base_failed)


def test_longest_repeat_and_spans(spark):
    r = random.Random(2)
    rows = []
    for i in range(40):
        w = [r.choice("abcdefgh") for _ in range(r.randrange(1, 60))]
        if i % 3 == 0:
            w = w + w[:20] + ["x"] + w[:15]
        rows.append((i, " ".join(w), 1))
    got = {x.doc_id: x for x in repetition.repetition(spark.createDataFrame(rows, "doc_id long, text string, covered int")).collect()}
    for i, text, _ in rows:
        w = text.split()
        assert got[i].longest == longest_repeat(w)
        inside = {j for s in got[i].spans for j in range(s.start, s.end)}
        assert len(inside) == got[i].n_repeat_words == base_rules(text)[4]


def test_suffix_array_is_sorted():
    r = np.random.default_rng(3)
    tokens, owner = r.integers(0, 3, 400).astype(np.uint64), np.sort(r.integers(0, 6, 400))
    order = repetition.suffix_array(tokens, owner)
    end = np.searchsorted(owner, owner, side="right")
    keys = [(owner[i], *tokens[i:end[i]].tolist()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(400))


def test_repetition_edges(spark):
    got = sorted((str(r.doc_id), r.n_words, r.base_failed, r.kept) for r in repetition.repetition(edge_docs(spark)).collect())
    assert [g[1] for g in got if g[0] in ("1", "2", "3")] == [0, 0, 0] and all(g[2] and not g[3] for g in got)
    assert len(got) == 8 and repetition.repetition(edge_docs(spark).limit(0)).collect() == []


# --- 9: licences ---------------------------------------------------------------------------------------------

def test_licences_on_the_table(spark):
    notice = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    texts = {r.doc_id: r.text or "" for r in documents(spark, SF2).collect()}
    want = {i: " AND ".join(sorted({v for k, v in notice.items() if k in t.split("\n")})) for i, t in texts.items()}
    assert {r.doc_id: r.licences for r in op9_licences(spark, SF2).collect()} == want


def test_licence_rules(spark):
    s = licences.SENTENCES
    wrapped = s["mit-grant"].replace(" and ", "\n and ") + ":\n\n" + s["mit-notice-kept"] + "."
    rows = [(1, f"MY TOOL\n\n{s['mit-title']}\nCopyright 2020 Somebody.\n{wrapped}", "m"), (2, s["mit-notice-kept"], "m"), (3, f"# {s['apache-notice-defined']};\n# {s['apache-may-not']}.\n# {s['apache-copy']}\n", "m"),
            (4, f"{s['bsd-redistribution']}:\n1. {s['bsd-source']}.\n2. {s['bsd-binary']}.", "m"), (5, f"{s['mit-grant']}. " + "Filler. " * 20 + s["mit-notice-kept"], "m"), (6, "released under the mit license. Licensed under CC BY 4.0!", "m"), (7, LONG + ". Released under the MIT License", "m")]
    got = {r.doc_id: r.matches for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string, matches string")).collect()}
    assert {i: [m.licence for m in x] for i, x in got.items()} == {1: ["MIT"], 2: [], 3: ["Apache-2.0"], 4: ["BSD-2-Clause"], 5: ["MIT"], 6: ["MIT", "CC-BY-4.0"], 7: ["MIT"]}
    assert got[1][0].sentences == ["mit-title", "mit-grant", "mit-notice-kept"] and rows[6][1][got[7][0].start:].strip() == "Released under the MIT License"
    edges = licences.scan(edge_docs(spark)).collect()
    assert len(edges) == 8 and all(r.matches == [] for r in edges)
