"""Toxicity by multiple-instance learning.

A text is a bag of sentences.  A sentence's score is logistic in its features (words and beginnings of words), the
text's score is the noisy-or of its sentences' (1 - prod(1 - p)), and only texts carry labels.  Features that go with the
label more than chance allows are chosen first, their weights are fitted by gradient descent on the likelihood of the
labels, and sentences whose own score reaches one half are then located.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidbox.llm.common import arrow_map, fold, materialize
from bidbox.llm.textnp import SMALL_CHUNK, Chunk, chunks, signed

#: Bound of the training sample: texts of each label, by a hash of the id.
MAX_TRAIN_PER_LABEL = 2_000
#: Lengths in bytes of the word beginnings that are features beside whole words.
PREFIXES = (5, 6, 7, 8)
#: A feature needs so many toxic training texts and this chi-square (1 degree of freedom, p = 0.001).
MIN_TEXTS, MIN_CHI2 = 3, 10.8
STEPS = 250
#: Weights under this size are dropped after fitting; a sentence without a kept feature has score 0.
SMALL = 0.25

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[65:91] = _TOKEN[97:123] = _TOKEN[128:] = True
_TOKEN[39] = True
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".!?\n"]] = True


def sentence_features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(feature hash, its sentence) and of each sentence that has a word (row, first byte, last byte)."""
    low = Chunk(_LOWER[chunk.data], chunk.offsets)
    starts, ends = low.runs(_TOKEN[chunk.data])
    row = chunk.row_of(starts)
    breaks = np.flatnonzero(_BREAK[chunk.data])
    place = np.searchsorted(breaks, starts) + row
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place))[:len(first)] - 1
    sentence = np.cumsum(new) - 1
    found, where = [low.hashes(starts, ends)], [sentence]
    for n in PREFIXES:
        long = np.flatnonzero(ends - starts > n)
        found.append(low.hashes(starts[long], starts[long] + n))
        where.append(sentence[long])
    return np.concatenate(found), np.concatenate(where), row[first], starts[first], ends[last]


def _features(chosen: np.ndarray | None):
    """(row's key, sentence, feature) once each; only ``chosen`` features if given, else without sentences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            for at, chunk in chunks(batch.column(1), SMALL_CHUNK):
                word, sentence, row, _, _ = sentence_features(chunk)
                owner = row[sentence] if len(sentence) else sentence
                if chosen is not None:
                    use = np.isin(word, chosen)
                    word, sentence, owner = word[use], sentence[use], owner[use]
                else:
                    sentence = np.zeros(len(word), np.int64)
                order = np.lexsort((word, sentence, owner))
                word, sentence, owner = word[order], sentence[order], owner[order]
                new = np.ones(len(word), bool)
                new[1:] = (word[1:] != word[:-1]) | (sentence[1:] != sentence[:-1]) | (owner[1:] != owner[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(key[at:][owner[new]]), pa.array(sentence[new]), pa.array(signed(word[new]))], names=["id", "sentence", "feature"])

    return run


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", per_label: int = MAX_TRAIN_PER_LABEL) -> dict:
    """Word hashes and weights.  Learns only from labelled rows outside the held-out fold, at most ``per_label`` ids of each label.

    An id with several labels counts as toxic if one says so; null labels are ignored.  Without both labels the model is empty.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & (fold(doc_id) != 0)).groupBy(F.col(doc_id).alias("id")).agg((F.max(label) > 0).cast("int").alias("toxic"))
    by_hash = known.orderBy(F.xxhash64(F.lit(23), "id"), "id")
    some = by_hash.where("toxic = 1").limit(per_label).union(by_hash.where("toxic = 0").limit(per_label))
    some = some.sparkSession.createDataFrame(some.collect(), "id long, toxic int")  # bounded: 2 * per_label pairs of numbers
    ids = {r["id"]: r["toxic"] for r in some.collect()}
    positives = sum(ids.values())
    empty = {"words": np.zeros(0, np.uint64), "weights": np.zeros(0), "bias": 0.0}
    if positives in (0, len(ids)):
        return empty
    rows = materialize(docs.join(F.broadcast(some), docs[doc_id] == some["id"]).select("id", F.col(text).alias("text"), "toxic"), "mil")
    counts = (arrow_map(rows.select("id", "text"), _features(None), _ROWS).join(F.broadcast(some), "id")
              .groupBy("feature").agg(F.count_distinct(F.when(F.col("toxic") == 1, F.col("id"))).alias("pos"), F.count_distinct(F.when(F.col("toxic") == 0, F.col("id"))).alias("neg")))
    share = positives / len(ids)
    expected = (F.col("pos") + F.col("neg")) * share
    chi2 = (F.col("pos") - expected) ** 2 / (expected * (1 - share))
    chosen = counts.where((F.col("pos") >= MIN_TEXTS) & (F.col("pos") > expected) & (chi2 >= MIN_CHI2)).select("feature").toArrow()
    vocabulary = np.sort(chosen["feature"].to_numpy().view(np.uint64)) if len(chosen) else np.zeros(0, np.uint64)
    if not len(vocabulary):
        return empty
    table = arrow_map(rows.select("id", "text"), _features(vocabulary), _ROWS).distinct().toArrow()
    order = np.array(sorted(ids))
    doc = np.searchsorted(order, table["id"].to_numpy())
    feature = np.searchsorted(vocabulary, table["feature"].to_numpy().view(np.uint64))
    _, sentence = np.unique(np.stack([doc, table["sentence"].to_numpy()]), axis=1, return_inverse=True)
    return fit(feature, sentence, doc, np.array([ids[i] for i in order]), vocabulary)


_ROWS = "id long, sentence long, feature long"


def fit(feature: np.ndarray, sentence: np.ndarray, doc: np.ndarray, y: np.ndarray, vocabulary: np.ndarray) -> dict:
    """Adam on the noisy-or likelihood with an L1 step; entries say that ``sentence`` of ``doc`` has ``feature``.

    Texts without any chosen feature score 0 whatever the weights and so are not needed.
    """
    n = int(sentence.max()) + 1 if len(sentence) else 0
    owner = np.zeros(n, np.int64)
    owner[sentence] = doc
    positive = y[owner] == 1
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))[owner] * len(y)
    w, b = np.zeros(len(vocabulary)), -3.0
    m1, m2 = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, STEPS + 1):
        z = np.bincount(sentence, weights=w[feature], minlength=n) + b
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        s = np.bincount(owner, weights=np.logaddexp(0, z), minlength=len(y))
        miss = np.exp(-s[owner])
        g = weight * np.where(positive, -p * miss / np.maximum(1 - miss, 1e-9), p)
        grad = np.append(np.bincount(feature, weights=g[sentence], minlength=len(w)) + 0.05 * w, g.sum())
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        step = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
        w -= step[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - 0.002, 0)
        b -= step[-1]
    used = np.abs(w) >= SMALL
    order = np.argsort(vocabulary[used])
    return {"words": vocabulary[used][order], "weights": w[used][order], "bias": float(b)}


def _score(model: dict):
    known, weights, bias = model["words"], model["weights"], model["bias"]
    maybe = np.zeros(1 << 16, bool)  # most words are unknown: a small table tells at once
    maybe[(known >> np.uint64(48)).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, chunk in chunks(batch.column(1), SMALL_CHUNK):
                word, sentence, row, first, last = sentence_features(chunk)
                near = np.flatnonzero(maybe[(word >> np.uint64(48)).astype(np.int64)]) if len(known) else np.zeros(0, np.int64)
                spot = np.minimum(np.searchsorted(known, word[near]), max(0, len(known) - 1))
                hit = known[spot] == word[near] if len(near) else np.zeros(0, bool)
                near, spot = near[hit], spot[hit]
                live, part = np.unique(sentence[near], return_inverse=True)
                z = np.bincount(part, weights=weights[spot], minlength=len(live)) + bias
                owner = row[live] if len(live) else np.zeros(0, np.int64)
                total = np.bincount(owner, weights=np.logaddexp(0, z), minlength=chunk.rows)
                bad = z >= 0
                letter = np.zeros(len(chunk.data) + 1, np.int64)
                np.cumsum((chunk.data & 0xC0) != 0x80, out=letter[1:])
                base = letter[chunk.offsets[owner[bad]]]
                spans = pa.StructArray.from_arrays(
                    [pa.array((letter[first[live[bad]]] - base).astype(np.int32)), pa.array((letter[last[live[bad]]] - base).astype(np.int32)),
                     pa.array(1 / (1 + np.exp(-z[bad])))], names=["start", "end", "score"])
                where = np.zeros(chunk.rows + 1, np.int32)
                np.cumsum(np.bincount(owner[bad], minlength=chunk.rows), out=where[1:])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, chunk.rows), pa.array(1 - np.exp(-total)), pa.ListArray.from_arrays(pa.array(where), spans)], names=["key", "score", "offending"])

    return run


def score(docs: DataFrame, model: dict, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, offending) of every row from its whole text alone; offending: spans (in code points) of sentences that score at least 0.5.

    A null or empty text, or one without a known word, scores 0.  Repeated rows and null ids give a row each; an empty table gives none.
    """
    out = arrow_map(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), _score(model), "key long, score double, offending array<struct<start:int,end:int,score:double>>")
    return out.withColumnRenamed("key", "doc_id")


def without_toxic(docs: DataFrame, model: dict, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, all columns as they were."""
    spark_rows = docs.select(F.struct("*").alias("doc"), F.col(text).alias("text"))
    kind = T.StructType([T.StructField("doc", docs.schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _score(model)
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(1)], names=["key", "text"])
            low = np.concatenate([b.column(1).to_numpy() for b in scorer(iter([numbered]))] or [np.zeros(0)]) < threshold
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["doc"]).filter(pa.array(low))

    return arrow_map(spark_rows, run, kind).select("doc.*")
