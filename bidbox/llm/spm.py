"""SentencePiece encoding and decoding with a public model file, over whole texts.

Words are marked with U+2581 in place of spaces and cut before each run of marks that follows another character; no
piece of such a model spans that cut (checked when the model is read).  The distinct marked words of a batch are
sorted and walked as a trie, depth first: the forward states of a common prefix are computed once and reused by every word below it.

Forward state of a prefix:
* unigram models: the best score and the last piece of its best segmentation (Viterbi);
* BPE models: the last piece of its BPE segmentation.  A segmentation is the BPE one exactly if all neighbouring
  pieces are stable, i.e. merging their joined text gives the same two pieces, so the state needs one piece as well.

Which of the two holds is read from the model file, so ids equal those of the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_map

#: Public model; a parameter of every call.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Words remembered between batches (and tasks of one Python worker); the memory is emptied beyond it.
MOST_WORDS = 200_000
#: Neighbouring pieces whose stability is remembered.
MOST_PAIRS = 300_000
#: Bytes of text whose distinct words are sorted together.
SLICE = 2 << 20
_CUT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

#: Codes beside ids: no piece before the first, and the first code of a character that is no piece.
_NONE, _CHARACTER = 1 << 23, 1 << 21

#: Fixed values of the file format: model and piece types.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Model:
    """Pieces, scores and types of a model file.  Texts must be normalised as the file says; only the identity is supported."""

    def __init__(self, data: bytes, unigram: bool | None = None):
        from sentencepiece import sentencepiece_model_pb2 as proto

        m = proto.ModelProto.FromString(data)
        spec = m.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not m.trainer_spec.byte_fallback:
            raise ValueError("only models with identity normalisation and byte fallback are supported")
        self.unigram = m.trainer_spec.model_type == UNIGRAM if unigram is None else unigram
        self.dummy = spec.add_dummy_prefix
        self.pieces = [p.piece for p in m.pieces]
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(m.pieces) if p.type == BYTE}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        silent = (UNKNOWN, CONTROL)
        self.text = [bytes([self.byte_of[i]]) if i in self.byte_of else b"" if p.type in silent else p.piece.replace(MARK, " ").encode() for i, p in enumerate(m.pieces)]
        self.id = {p.piece: i for i, p in enumerate(m.pieces) if p.type in (NORMAL, USER_DEFINED)}
        self.score = [p.score for p in m.pieces]
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece holds a mark after another character")
        import ahocorasick

        self.finder = ahocorasick.Automaton()  # all pieces that end at each character, longest first
        for piece, i in self.id.items():
            self.finder.add_word(piece, (i, len(piece)))
        self.finder.make_automaton()
        self.unknown_score = min(self.score[i] for i in self.id.values()) - 10.0
        self.known: dict[str, bytes] = {}
        self._stable: dict[int, bool] = {}

    # words ----------------------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        marked = text.replace(" ", MARK)
        return _CUT.findall(MARK + marked if self.dummy else marked)

    def merge(self, text: str) -> list[str]:
        """Plain BPE of a short text: merge the neighbours that form the best piece, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                p = self.id.get(parts[i] + parts[i + 1])
                if p is not None and (best is None or self.score[p] > best):
                    best, at = self.score[p], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stable(self, key: int) -> bool:
        """Whether BPE leaves the two pieces of a key as they are; without a first piece, whether it makes the second whole."""
        if len(self._stable) > MOST_PAIRS:
            self._stable.clear()
        a, b = key >> 24, key & 0xFFFFFF
        right = self.spelling(b)
        if a == _NONE:
            known = self.merge(right) == [right]
        else:
            left = self.spelling(a)
            known = self.merge(left + right) == [left, right]
        self._stable[key] = known
        return known

    def spelling(self, code: int) -> str:
        return self.pieces[code] if code < _CHARACTER else chr(code - _CHARACTER)

    def segment_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Codes of the pieces of each of the sorted distinct words: an id, or _CHARACTER plus the code point of a character that is no piece.

        ``last`` and ``long`` hold the last piece of each prefix and its length, ``best`` its score; those of the prefix shared with the word before are kept.
        """
        last, long, best = [_NONE], [0], [0.0]
        before = ""
        score, known, stable, found = self.score, self._stable, self.stable, self.finder.iter
        for word in words:
            same = 0
            for a, b in zip(before, word, strict=False):
                if a != b:
                    break
                same += 1
            del last[same + 1:], long[same + 1:], best[same + 1:]
            before = word
            if self.unigram:
                ends: dict[int, list[tuple[int, int]]] = {}
                for at, match in found(word):
                    if at >= same:
                        ends.setdefault(at, []).append(match)
                for at in range(same, len(word)):
                    top, pick, size = best[at] + self.unknown_score, _CHARACTER + ord(word[at]), 1
                    for code, n in ends.get(at, ()):
                        if best[at + 1 - n] + score[code] > top or (n == 1 and pick >= _CHARACTER):
                            top, pick, size = best[at + 1 - n] + score[code], code, n
                    last.append(pick)
                    long.append(size)
                    best.append(top)
            else:
                end = same  # prefixes up to here are done
                for at, (code, n) in found(word):
                    if at < end:
                        continue
                    while end < at:  # no piece ends there: a character by itself
                        last.append(_CHARACTER + ord(word[end]))
                        long.append(1)
                        end += 1
                    key = last[at + 1 - n] << 24 | code
                    fits = known.get(key)
                    if stable(key) if fits is None else fits:
                        last.append(code)
                        long.append(n)
                        end += 1
                for at in range(end, len(word)):
                    last.append(_CHARACTER + ord(word[at]))
                    long.append(1)
            out, end = [], len(word)
            while end:
                out.append(last[end])
                end -= long[end]
            out.reverse()
            yield out

    def ids(self, codes: list[int]) -> bytes:
        """Ids as int32 in memory order; a character that is no piece becomes its bytes' pieces."""
        if codes and max(codes) >= _CHARACTER:
            codes = [i for c in codes for i in ([c] if c < _CHARACTER else [self.bytes[b] for b in chr(c - _CHARACTER).encode()])]
        return array("i", codes).tobytes()

    # texts ----------------------------------------------------------------------------------------------

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of each text, four bytes each."""
        known = self.known
        cut = [None if t is None else self.words(t) for t in texts]
        new = set().union(*[ws for ws in cut if ws]) - known.keys()
        if len(known) + len(new) > MOST_WORDS:
            known.clear()
            new = set().union(*[ws for ws in cut if ws])
        words = sorted(new)
        for w, codes in zip(words, self.segment_sorted(words), strict=True):
            known[w] = self.ids(codes)
        return [None if ws is None else b"".join([known[w] for w in ws]) for ws in cut]

    def decode(self, ids: bytes | None) -> str | None:
        """Text of the ids: byte pieces are joined to UTF-8, marks become spaces, the added first space goes."""
        if ids is None:
            return None
        text = b"".join(map(self.text.__getitem__, memoryview(ids).cast("i"))).decode("utf-8", "replace")
        return text[1:] if self.dummy and text[:1] == " " else text


_models: dict[tuple[bytes, bool | None], Model] = {}


def model_of(data: bytes, unigram: bool | None = None) -> Model:
    """One model a Python worker: its memories serve later tasks."""
    key = hashlib.md5(data).digest(), unigram
    if key not in _models:
        _models[key] = Model(data, unigram)
    return _models[key]


def read_model(path: str = MODEL) -> bytes:
    return Path(path).read_bytes()


def _slices(column: pa.Array) -> Iterator[tuple[int, list]]:
    """Consecutive texts that together hold about SLICE bytes (a longer one comes alone)."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).cumsum()
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + SLICE)))
        yield at, column.slice(at, to - at).to_pylist()
        at = to


def _encode(data: bytes, unigram: bool | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(data, unigram)
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                ids = model.encode(texts)
                sizes = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([0 if i is None else len(i) // 4 for i in ids], out=sizes[1:])
                flat = pa.array(np.frombuffer(b"".join(i for i in ids if i), np.int32))
                lists = pa.ListArray.from_arrays(pa.array(sizes), flat, mask=pa.array([i is None for i in ids]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), lists], names=["doc", "ids"])

    return run


def _decode(data: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(data)
        for batch in batches:
            texts = [model.decode(x.values.to_numpy().astype(np.int32).tobytes() if x.is_valid else None) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc", "text"])

    return run


def encode(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: str = MODEL, unigram: bool | None = None) -> DataFrame:
    """(doc_id, ids) of every row.  A null text gives null, an empty text an empty list; repeated rows and null ids give a row each.

    ``unigram`` overrides the segmentation that the file asks for.  The model file is read on the driver and travels with the tasks (about 0.5 MB).
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    return arrow_map(rows, _encode(read_model(model), unigram), "doc long, ids array<int>").withColumnRenamed("doc", "doc_id")


def decode(encoded: DataFrame, *, doc_id: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """(doc_id, text) of every row of ids; null ids give a null text."""
    rows = encoded.select(F.col(doc_id).cast("long").alias("doc"), F.col(ids).alias("ids"))
    return arrow_map(rows, _decode(read_model(model)), "doc long, text string").withColumnRenamed("doc", "doc_id")


def digest(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(doc_id, n_ids, ids_md5, round_trip) of every row: each text is encoded and decoded again in one pass.

    ``ids_md5`` is that of the ids as little-endian int32; ``round_trip`` says whether decoding gives the text again (it does
    unless the text itself holds U+2581, which stands for a space).  Null texts give nulls.
    """
    data = read_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model_of(data)
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                ids = m.encode(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)), pa.array([None if i is None else len(i) // 4 for i in ids], pa.int64()),
                    pa.array([None if i is None else hashlib.md5(i).hexdigest() for i in ids], pa.string()),
                    pa.array([None if i is None else m.decode(i) == t for i, t in zip(ids, texts, strict=True)], pa.bool_())], names=["doc", "n_ids", "ids_md5", "round_trip"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    return arrow_map(rows, run, "doc long, n_ids long, ids_md5 string, round_trip boolean").withColumnRenamed("doc", "doc_id")
