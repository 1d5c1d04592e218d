"""Spelling variants: words of a corpus that differ by one edit, found with search schemes on an FM-index of the vocabulary.

A word with one edit keeps one of its halves whole.  So two searches find every near word: the first half exactly and then rightwards with
one error, and the second half exactly and then leftwards with one error.  Either reads a rank interval of suffixes over the delimited
words, extended symbol by symbol; the index is bidirectional in that it is built over both reading directions, one for each search.

1. Words are counted by Spark.
2. A word goes to the shards of its first and of its last three code points (each half has as many at least), once to be found
   and once to search.  Words of crowded ends are cut into blocks: a word lies in one block and searches all.
3. A task indexes its shard and runs all its searches in step.  A near word counts in the first search if it begins with the word's first
   half and else in the second, so no pair counts twice, and only a count and the best near word leave the task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_groups, materialize
from bidbox.llm.exactdup import folded
from bidbox.llm.repetition import suffix_array

#: Code points of a word's ends that choose its shards: no half may be shorter, so words have twice as many at least.
END = 3
MIN_LENGTH, MIN_COUNT = 6, 5
#: A near word is a word's form if it occurs so many times as often.
RATIO = 5
#: Words of a shard, about.
SHARD = 4096


# --- the index ---------------------------------------------------------------------------

DELIMITER = 1


@dataclass
class Sequences:
    """Code points of several words end to end, in the order in which they are searched."""

    data: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, words: list[str], backwards: bool) -> Sequences:
        size = np.array([len(w) for w in words], np.int64)
        text = "".join(w[::-1] for w in words) if backwards else "".join(words)
        return cls(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64), np.append(0, np.cumsum(size)))

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.starts)


class FmIndex:
    """Rank intervals of the words' text ``$w$w$...$``, each word laid backwards so that an interval is extended in search order.

    Symbols: 0 ends the text, 1 delimits words, letters follow.
    """

    def __init__(self, words: Sequences):
        sizes = words.sizes
        n = len(words.data) + len(sizes) + 2
        self.letters = np.unique(words.data)
        text = np.full(n, DELIMITER, np.int64)
        text[-1] = 0
        owner = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(words.data)) - words.starts[owner]
        text[words.starts[owner] + owner + sizes[owner] - at] = np.searchsorted(self.letters, words.data) + 2
        self.suffixes = suffix_array(text, np.zeros(n, np.int64))
        before = text[self.suffixes - 1]  # the symbol ahead of each suffix, around the end
        self.n, self.symbols, self.before = n, len(self.letters) + 2, before
        order = np.argsort(before, kind="stable")
        self._keys = before[order] * (n + 1) + order
        self._delimiters = np.flatnonzero(text == DELIMITER)

    def codes(self, data: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 for those that no word has."""
        at = np.searchsorted(self.letters, data)
        known = at < len(self.letters)
        known[known] = self.letters[at[known]] == data[known]
        return np.where(known, at + 2, -1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that begin with ``symbol`` and go on as the given intervals do (empty for an unknown symbol)."""
        place = np.maximum(symbol, 0) * (self.n + 1)
        low, high = np.searchsorted(self._keys, place + low), np.searchsorted(self._keys, place + high)
        return low, np.where(symbol < 0, low, high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, symbol) for each letter by which each interval can be extended: no more of them than letters."""
        narrow = np.flatnonzero(high - low <= self.symbols)
        wide = np.flatnonzero(high - low > self.symbols)
        size = (high - low)[narrow]
        state = np.repeat(narrow, size)
        rank = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + low[state]
        pairs = np.unique(state * self.symbols + self.before[rank])
        every = (wide[:, None] * self.symbols + np.arange(self.symbols)).ravel()
        pairs = np.concatenate([pairs, every])
        state, symbol = pairs // self.symbols, pairs % self.symbols
        return state[symbol > DELIMITER], symbol[symbol > DELIMITER]

    def word_at(self, rank: np.ndarray) -> np.ndarray:
        """The word whose delimited text is the suffix of each rank."""
        return np.searchsorted(self._delimiters, self.suffixes[rank])


def search(index: FmIndex, queries: Sequences, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) of the words that differ from a query by one edit after its first ``exact`` symbols.

    Each pair comes once: an inserted or deleted symbol of a run is taken as the run's last.
    """
    sizes = queries.sizes
    codes = np.append(index.codes(queries.data), 0)
    begin, end = queries.starts[:-1], queries.starts[1:]
    q = np.arange(len(sizes))
    # all queries without an error are at the same symbol; `late` holds those with one
    low, high = index.extend(np.full(len(q), DELIMITER), np.zeros(len(q), np.int64), np.full(len(q), index.n))
    late = [np.zeros(0, np.int64)] * 4
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    at = 0
    while len(q) or len(late[0]):
        new = []
        may = np.flatnonzero(at >= exact[q])
        if len(may):
            here, spot = q[may], begin[q[may]] + at
            inside = spot < end[here]
            own = np.where(inside, codes[spot], 0)
            state, symbol = index.branches(low[may], high[may])
            other = symbol != own[state]
            state, symbol = state[other], symbol[other]
            lo, hi = index.extend(symbol, low[may][state], high[may][state])
            new.append((here[state], np.full(len(state), at), lo, hi))  # the word has one symbol more here
            put = inside[state]
            new.append((here[state][put], np.full(put.sum(), at + 1), lo[put], hi[put]))  # another symbol
            cut = inside & ~_same(queries, spot, end[here])
            new.append((here[cut], np.full(cut.sum(), at + 1), low[may][cut], high[may][cut]))  # one symbol less
        # with an error: on to the next symbol, or to the delimiter and out
        lq, la, lo, hi = late
        spot = begin[lq] + la
        done = spot >= end[lq]
        lo, hi = index.extend(np.where(done, DELIMITER, codes[np.minimum(spot, len(codes) - 1)]), lo, hi)
        hit = done & (lo < hi)
        found.append((lq[hit], index.word_at(lo[hit])))
        go = ~done & (lo < hi)
        late = [lq[go], la[go] + 1, lo[go], hi[go]]
        for some in new:
            live = some[2] < some[3]
            late = [np.concatenate([a, b[live]]) for a, b in zip(late, some, strict=True)]
        # without: a query that is at its end has been branched for the last time
        on = begin[q] + at < end[q]
        q, low, high = q[on], low[on], high[on]
        low, high = index.extend(codes[begin[q] + at], low, high)
        live = low < high
        q, low, high = q[live], low[live], high[live]
        at += 1
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _same(queries: Sequences, spot: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether the code point at each spot is followed by itself within its word."""
    last = len(queries.data) - 1
    return (spot + 1 < end) & (queries.data[np.minimum(spot, last)] == queries.data[np.minimum(spot + 1, last)])


# --- Spark -------------------------------------------------------------------------------

_NEAR = "word string, n_near long, best_n long, best string"


def _shard(group: pa.Table) -> pa.Table:
    """The near words of a shard's words in one search: how many, and the most frequent (ties: smallest)."""
    last = bool(group["last"][0].as_py())
    words, counts = group["word"].to_pylist(), group["n"].to_numpy()
    home = np.flatnonzero(group["home"].to_numpy(zero_copy_only=False))
    sought = Sequences.of(words, last)
    first = sought.sizes // 2
    index = FmIndex(Sequences.of([words[i] for i in home], last))
    query, word = search(index, sought, sought.sizes - first if last else first)
    word = home[word]
    best: dict[int, tuple[int, str]] = {}
    near = np.zeros(len(words), np.int64)
    for q, w in zip(query.tolist(), word.tolist(), strict=True):
        if last and words[w].startswith(words[q][:first[q]]):
            continue  # the first search counts it
        near[q] += 1
        mine = (-int(counts[w]), words[w])
        if q not in best or mine < best[q]:
            best[q] = mine
    some = sorted(best)
    return pa.table({"word": pa.array([words[q] for q in some], pa.string()), "n_near": pa.array(near[some]), "best_n": pa.array([-best[q][0] for q in some], pa.int64()),
                     "best": pa.array([best[q][1] for q in some], pa.string())})


def near_words(vocabulary: DataFrame, *, shard: int = SHARD) -> DataFrame:
    """(word, n_near, best, best_n) for each of the distinct words of ``vocabulary`` (word, n) that has a near word.

    Words need ``2 * END`` code points at least.
    """
    ends = [F.lit(False).alias("last"), F.left("word", F.lit(END)).alias("end")], [F.lit(True).alias("last"), F.right("word", F.lit(END)).alias("end")]
    placed = vocabulary.select("word", "n", *ends[0]).union(vocabulary.select("word", "n", *ends[1]))
    # one row an end, and only of crowded ends: at most 2 / shard of the words' number
    crowded = placed.groupBy("last", "end").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > shard)
    placed = placed.join(F.broadcast(crowded), ["last", "end"], "left").withColumn("blocks", F.ceil(F.coalesce("size", F.lit(1)) / shard).cast("int"))
    placed = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("home", F.col("block") == F.pmod(F.xxhash64("word"), F.col("blocks")))
    shards = max(1, -(-vocabulary.count() // shard))
    # blocks of an end, never more than there are shards, lie in different ones: a word that met two of them in one shard would count its near words twice
    dealt = placed.withColumn("shard", F.pmod(F.pmod(F.xxhash64("end"), F.lit(shards)) + F.col("block"), F.lit(shards)))
    found = arrow_groups(dealt.select("last", "shard", "word", "n", "home"), ["last", "shard"], _shard, _NEAR)
    top = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top).select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the rows (word, form) of a table without cycles: forms are followed to the last, twice as far each round."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spell")
    while True:
        step = now.alias("a").join(now.alias("b"), F.col("a.root") == F.col("b.word"), "left")
        after = materialize(step.select("a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")), "spell")
        if not after.where("moved").limit(1).count():
            return now
        now = after.drop("moved")


def vocabulary(words: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of a column ``word`` with enough code points and occurrences, counted in each task before the shuffle."""
    return words.where(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def variants(words: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, shard: int = SHARD) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of at least ``min_length`` code points and ``min_count`` occurrences.

    ``words``: one row an occurrence, column ``word`` (nulls do not count).  Two words are near if they differ by one inserted, deleted or
    replaced code point.  A word's form is its near word of most occurrences (ties: the first in code-point order) if they are ``ratio`` times
    the word's own at least; its root is the end of the chain of forms, itself if it has no form.  An empty table gives no rows.
    """
    if min_length < 2 * END:
        raise ValueError(f"words have {2 * END} code points at least")
    if ratio < 2:
        raise ValueError("ratio is 2 at least: a chain of forms has an end")
    words = materialize(vocabulary(words, min_length=min_length, min_count=min_count), "spell")
    near = near_words(words, shard=shard)
    good = F.col("best_n") >= ratio * F.col("n")
    rows = materialize(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")), "spell")
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def occurrences(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """``word``: the lower-cased (A-Z) letter runs of whole texts that have ``min_length`` code points at least."""
    runs = F.regexp_extract_all(folded(F.col(text)), F.lit(f"[a-zÀ-ÿ]{{{min_length},}}"), F.lit(0))
    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(runs).alias("word"))


def with_slips(words: DataFrame, one_in: int = 199) -> DataFrame:
    """``words`` (doc_id, word) with one code point deleted where the checksum of id and word says so; a null id counts as ""."""
    checksum = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
    return words.select("word", checksum.alias("h")).select(F.when(F.col("h") % one_in == 0, _without(F.col("word"), F.col("h"))).otherwise(F.col("word")).alias("word"))


def _without(word: Column, h: Column) -> Column:
    at = (h % F.char_length(word)).cast("int")
    return F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2))
