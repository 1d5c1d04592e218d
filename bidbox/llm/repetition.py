"""Quality rules on repetition inside a text, from the suffix array of its words.

All texts of a chunk are sorted together by prefix doubling (suffixes of different texts never share a rank, and
only suffixes that still share one are sorted again).  The longest common prefix of neighbours in that order gives
each position the longest substring starting there that occurs elsewhere in the text; those that no earlier
position covers are the maximal repeated substrings.  Their spans are united; the share of the words' characters
they cover and the longest of them are limited.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_map
from bidbox.llm.textnp import Chunk, chunks, rolled

#: Fixed values of the contract's base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED_PERCENT = 20

#: Limits of the verdict: share of characters in repeated spans of at least WINDOW words, and the longest repeat in words.
MAX_COVERED = 0.2
MAX_LONGEST = 100

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def suffix_array(tokens: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Positions of all suffixes (each ends with its owner's last token), sorted by owner and then token by token."""
    n = len(tokens)
    end = np.searchsorted(owner, owner, side="right")
    order = np.lexsort((tokens, owner))
    first = np.ones(n, bool)
    first[1:] = (tokens[order[1:]] != tokens[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    rank = np.empty(n, np.int64)
    where = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(first, where, 0))
    last = np.append(first[1:], True)[:n]
    live = where[~(first & last)]
    k = 1
    while len(live):
        at = order[live]
        after = at + k
        second = np.where(after < end[at], rank[np.minimum(after, n - 1)], -1)
        group = rank[at]
        turn = np.lexsort((second, group))
        at, second, group = at[turn], second[turn], group[turn]
        order[live] = at
        first = np.ones(len(at), bool)
        first[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        rank[at] = np.maximum.accumulate(np.where(first, live, 0))
        live = live[~(first & np.append(first[1:], True))]
        k *= 2
    return order


def longest_repeats(tokens: np.ndarray, owner: np.ndarray, least: int = WINDOW) -> np.ndarray:
    """For each position the length of the longest substring from there that occurs at another position of its owner (0 if under ``least``)."""
    n = len(tokens)
    out = np.zeros(n, np.int64)
    if n < least + 1:
        return out
    order = suffix_array(tokens, owner)
    end = np.searchsorted(owner, owner, side="right")
    a, b = order[:-1], order[1:]
    near = np.flatnonzero((owner[a] == owner[b]) & (np.minimum(end[a] - a, end[b] - b) >= least))
    window = rolled(tokens, least)
    near = near[window[a[near]] == window[b[near]]]
    a, b = a[near], b[near]
    common = np.full(len(a), least, np.int64)
    room = np.minimum(end[a] - a, end[b] - b)
    live = np.arange(len(a))
    while len(live):  # compare token by token, sixteen at a time
        for _ in range(16):
            at = common[live]
            live = live[at < room[live]]
            at = common[live]
            live = live[tokens[a[live] + at] == tokens[b[live] + at]]
            common[live] += 1
            if not len(live):
                break
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _dup_lines(chunk: Chunk, word_starts: np.ndarray) -> np.ndarray:
    starts, ends, rows = chunk.lines()
    worded = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    starts, ends, rows = starts[worded], ends[worded], rows[worded]
    h = chunk.hashes(starts, ends)
    order = np.lexsort((h, rows))
    again = (h[order[1:]] == h[order[:-1]]) & (rows[order[1:]] == rows[order[:-1]])
    return np.bincount(rows[order[1:]][again], minlength=chunk.rows)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, chunk in chunks(batch.column(1)):
            starts, ends = chunk.words()
            row = chunk.row_of(starts)
            tokens = chunk.hashes(starts, ends)
            n_words = np.bincount(row, minlength=chunk.rows)
            letter = (chunk.data & 0xC0) != 0x80
            chars = np.zeros(len(chunk.data) + 1, np.int64)
            np.cumsum(letter, out=chars[1:])
            size = chars[ends] - chars[starts]
            word_chars = np.bincount(row, weights=size, minlength=chunk.rows).astype(np.int64)

            reach = longest_repeats(tokens, row)
            at_ = np.flatnonzero(reach)
            before = np.where(at_ > 0, reach[at_ - 1], 0)
            maximal = at_[before <= reach[at_]]  # else the repeat one word earlier covers it
            depth = np.zeros(len(tokens) + 1, np.int64)
            np.add.at(depth, maximal, 1)
            np.add.at(depth, maximal + reach[maximal], -1)
            covered = np.cumsum(depth)[:-1] > 0
            longest = np.zeros(chunk.rows, np.int64)
            np.maximum.at(longest, row[maximal], reach[maximal])
            # united spans, in words from the start of the text
            edge = np.flatnonzero(np.diff(np.concatenate([[0], covered, [0]]).astype(np.int8)))
            split = np.flatnonzero(row[1:] != row[:-1]) + 1  # a span never runs on into the next text
            split = split[covered[split] & covered[split - 1]] if len(split) else split
            edge = np.sort(np.concatenate([edge, split, split]))
            lo, hi = edge[0::2], edge[1::2]
            first = np.searchsorted(row, np.arange(chunk.rows))
            spans = pa.StructArray.from_arrays([pa.array((lo - first[row[lo]]).astype(np.int32)), pa.array((hi - first[row[lo]]).astype(np.int32))], names=["start", "end"])
            where = np.zeros(chunk.rows + 1, np.int32)
            np.cumsum(np.bincount(row[lo], minlength=chunk.rows), out=where[1:])
            cover_chars = np.bincount(row[covered], weights=size[covered], minlength=chunk.rows)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(at, chunk.rows), pa.array(n_words), pa.array(word_chars),
                pa.array(_per_row(_IS_SYMBOL[chunk.data], chunk.offsets)), pa.array(_dup_lines(chunk, starts)),
                pa.array(np.bincount(row[covered], minlength=chunk.rows)), pa.array(cover_chars / np.maximum(word_chars, 1)), pa.array(longest),
                pa.ListArray.from_arrays(pa.array(where), spans)], names=NAMES)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered", "longest", "spans"]
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "covered double, longest long, spans array<struct<start:int,end:int>>")


def repetition(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """One row for each row of ``docs``: counts, united spans of repeated substrings (in words), ``base_failed`` and ``kept``.

    A null, empty or blank text has no words and fails the base rules.  Repeated rows and null ids give a row each.  Texts of any length are read
    whole; a batch of rows is cut into chunks, and a longer text is a chunk of its own.  Other columns are not read.
    """
    rows = arrow_map(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), _measure, SCHEMA)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & _verdict(max_covered, max_longest))


def _verdict(max_covered: float, max_longest: int) -> Column:
    return (F.col("covered") <= max_covered) & (F.col("longest") <= max_longest)
