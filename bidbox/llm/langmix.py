"""Language identification as inference in a mixture of languages.

Learning: smoothed, hashed byte-trigram frequencies of each language over the labelled training texts.
Inference, for each text: every word has a likelihood under each language; expectation-maximisation estimates the
text's language proportions; sets of one, two and more languages (nested, by proportion) are refitted until no text's penalised
likelihood, -2 log L + penalty * (languages - 1) * log(words), falls any more, and each text takes its set with the least.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_map, fold
from bidbox.llm.textnp import Chunk, chunks

#: Trigrams are hashed into so many buckets, so a model has a fixed size a language.
BUCKETS = 1 << 16
#: Bound of the training sample, in texts of each language (expected size; drawn by a hash of the id).
MAX_TRAIN = 10_000
#: Weight of a word's trigram log-likelihood: trigrams overlap and are not independent.
TEMPER = 0.5
PENALTY = 2.0
NONE = "und"

_FOLD = np.full(256, 32, np.uint64)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = _FOLD[65:91] = np.arange(97, 123)


def words_and_grams(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of letter runs, and for each byte the bucket of the trigram around it (blank beyond the text)."""
    b = _FOLD[chunk.data]
    before, after = np.empty_like(b), np.empty_like(b)
    before[1:], after[:-1] = b[:-1], b[1:]
    if len(b):
        starts = chunk.offsets[:-1][chunk.offsets[:-1] < chunk.offsets[1:]]
        ends = chunk.offsets[1:][chunk.offsets[:-1] < chunk.offsets[1:]]
        before[starts], after[ends - 1] = 32, 32
    code = ((before << np.uint64(16)) | (b << np.uint64(8)) | after) * np.uint64(0x9E3779B97F4A7C15)
    starts, ends = chunk.runs(b != 32)
    return starts, ends, (code >> np.uint64(48)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for at, chunk in chunks(batch.column(1)):
            starts, ends, code = words_and_grams(chunk)
            inside = np.zeros(len(chunk.data) + 1, np.int8)
            inside[starts] = 1
            inside[ends] -= 1
            code = code[np.cumsum(inside[:-1]) > 0]
            row = chunk.row_of(np.flatnonzero(np.cumsum(inside[:-1]) > 0))
            here = langs[at:at + chunk.rows]
            for lang in set(here):
                mine = code[(here == lang)[row]]
                seen[lang] = seen.get(lang, 0) + np.bincount(mine, minlength=BUCKETS)
    for lang, n in seen.items():
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bucket", "n"])


def learn(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", max_train: int = MAX_TRAIN) -> tuple[list[str], np.ndarray]:
    """(languages, log-likelihood a trigram bucket and language) from labelled rows outside the held-out fold.

    The sample is bounded by ``max_train`` texts of each language in expectation, so a rare language is learned from all of its texts beside
    any common one; the driver receives a count and at most BUCKETS rows a language.
    """
    rows = docs.where((fold(doc_id) != 0) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(doc_id).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    share = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(max_train)) / F.count(F.lit(1))).alias("share"))
    rows = rows.join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    counted = arrow_map(rows.select("lang", "text"), _count, "lang string, bucket int, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    n = np.zeros((len(langs), BUCKETS))
    place = {name: i for i, name in enumerate(langs)}
    if langs:
        n[[place[x] for x in table["lang"].to_pylist()], table["bucket"].to_numpy()] = table["n"].to_numpy()
    n += 0.01
    return langs, np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32)


def _fit(like: np.ndarray, row: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM over the words of all texts at once: proportions and the words' mixture likelihoods."""
    first = np.flatnonzero(np.diff(row, prepend=-1))
    n = np.diff(np.append(first, len(row)))[:, None]
    own = row[first]
    for _ in range(rounds):
        part = like * share[row]
        part /= part.sum(axis=1, keepdims=True)
        share = share.copy()
        share[own] = np.add.reduceat(part, first, axis=0) / n
    return share, (like * share[row]).sum(axis=1)


def infer(chunk: Chunk, logp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares of the languages in the chosen set, confidence that the largest is right), a row each; no word: all 0."""
    langs = len(logp)
    share = np.zeros((chunk.rows, langs))
    sure = np.zeros(chunk.rows)
    starts, ends, code = words_and_grams(chunk)
    if not len(starts) or not langs:
        return share, sure
    row = chunk.row_of(starts)
    ll = np.empty((len(starts), langs))
    total = np.zeros(len(code) + 1)
    for k in range(langs):
        np.cumsum(logp[k][code], out=total[1:], dtype=np.float64)
        ll[:, k] = (total[ends] - total[starts]) * TEMPER
    top = ll.max(axis=1, keepdims=True)
    like = np.exp(np.maximum(ll - top, -60.0))
    some = np.unique(row)
    words = np.bincount(row, minlength=chunk.rows)

    full = np.zeros_like(share)
    full[some] = 1.0 / langs
    full, _ = _fit(like, row, full, 8)
    order = np.argsort(-full, axis=1, kind="stable")
    best = np.full(chunk.rows, np.inf)
    for k in range(1, langs + 1):
        allowed = np.zeros_like(share)
        np.put_along_axis(allowed, order[:, :k], 1.0, axis=1)
        trial = (full + 1e-9) * allowed
        trial /= np.maximum(trial.sum(axis=1, keepdims=True), 1e-300)
        trial, mixed = _fit(like, row, trial, 0 if k == 1 else 4)
        cost = -2 * np.bincount(row, weights=np.log(np.maximum(mixed, 1e-300)), minlength=chunk.rows) + PENALTY * (k - 1) * np.log(np.maximum(words, 2))
        better = cost < best - 1e-9
        better[words == 0] = False
        if not better.any():
            break
        best[better], share[better] = cost[better], trial[better]
    whole = np.stack([np.bincount(row, weights=(ll - top)[:, k], minlength=chunk.rows) for k in range(langs)], axis=1)
    whole = np.exp(whole - whole.max(axis=1, keepdims=True))
    whole /= whole.sum(axis=1, keepdims=True)
    pick = share.argmax(axis=1)
    rows = np.arange(chunk.rows)
    several = (share > 0).sum(axis=1) > 1
    sure[some] = np.where(several, share[rows, pick], whole[rows, pick])[some]
    share[words == 0] = 0
    return share, np.clip(sure, 0, 1)


def _predict(langs: list[str], logp: np.ndarray):
    names = np.array([*langs, NONE], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lettered = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for at, chunk in chunks(batch.column(2)):
                share, sure = infer(chunk, logp)
                ok = lettered[at:at + chunk.rows] & (share.sum(axis=1) > 0 if len(langs) else False)
                pick = np.where(ok, share.argmax(axis=1) if len(langs) else 0, len(langs))
                mix = [[{"lang": langs[k], "share": float(s[k])} for k in np.argsort(-s, kind="stable") if s[k] > 0] if y else [] for s, y in zip(share, ok, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, chunk.rows), pa.array(names[pick], pa.string()), pa.array(np.where(ok, sure, 0.0)),
                     pa.array(mix, pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))], names=["doc_id", "lang_pred", "score", "mixture"])

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, mixture) of every row, from its whole text alone.

    ``und`` with score 0 and an empty mixture: a null text, one without a letter, or a model that has learned no language.
    Ties go to the language first by name.  Repeated rows and null ids give a row each; an empty table gives none.
    """
    langs, logp = model
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("lettered"), F.col(text).alias("text"))
    return arrow_map(rows, _predict(langs, logp), "doc_id long, lang_pred string, score double, mixture array<struct<lang:string,share:double>>")
