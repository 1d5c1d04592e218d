"""Line dedup across a corpus: an exact set-similarity join of lines.

A line is the set of its five-word shingles; a line of one to four words has one token made of all its words, so it matches the lines of
the same words and no other.  A line without words is never compared and always stays.  Two lines match if their sets' Jaccard similarity
reaches the threshold, and a line goes if it matches an earlier one (by id, text fingerprint, line number).

1. Lines with equal sets are one class; its earliest line stands for it.
2. Shingles are ordered by rarity: by the level of a bounded sketch that holds the buckets frequent within some task, then by hash.  Any
   order gives the same matches; this one keeps shared passages out of the prefixes.
3. Matching sets share a shingle among the first n - ceil(t * n) + 1 of each.  Prefix shingles are shuffled (those of frequent buckets in
   parts) and those of one class only go at once.  Lines of one to four words match equal lines only, so step 1 is all they need.
4. Classes that share a prefix shingle meet in a task, many shingles at a time and crowded ones in blocks, under the length and positional
   filters.  A pair belongs to the first shingle it shares.  Three passes narrow the meetings down: classes with a partner that passes
   the filters, then with a partner that none of their first LEAD shared shingles has shown to belong elsewhere, and last, with
   their sets, the pairs themselves.  Pairs stay inside the task: each pass hands on a row a class and meeting at most, the last one
   a count of links and whether an earlier line matches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bidbox.llm.common import arrow_groups, arrow_map, id_key, in_tasks, materialize, row_key
from bidbox.llm.textnp import SMALL_CHUNK, Chunk, chunks, grouped_order, lists, mix, rolled, signed

WORDS = 5
THRESHOLD = 0.8
#: Buckets of the rarity sketch: it has so many rows at most, whatever the corpus.
BUCKETS = 1 << 20
#: A bucket is reported by a task if it is so many times as full as the task's mean.
HEAVY = 4
#: Rows of a shingle's group that meet as one block.
BLOCK = 1024
#: Shared shingles of a class that are compared before its set is fetched.
LEAD = 32
#: Rows that meet in a task's group, about; pairs or shingles that are looked at in one go.
MEET, AT_ONCE = 16_384, 1 << 18
#: Shingles of buckets with more than 2 ** PART occurrences are dealt in parts of about that size.
PART = 16
#: Lines whose classes, or whose shingles and sets, a task writes, about.
CLASSES, LINES = 50_000, 10_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _short(h: np.ndarray, place: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(token, first word) of every line too short for a shingle: the words together are one."""
    first = np.flatnonzero(np.diff(place, prepend=-1))
    size = np.diff(np.append(first, len(place)))
    tokens, begins = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for n in range(1, words):
        begin = first[size == n]
        one = rolled(h[(begin[:, None] + np.arange(n)).ravel()], n)[::n]
        tokens.append(mix(one + np.uint64(n)))
        begins.append(begin)
    return np.concatenate(tokens), np.concatenate(begins)


def line_sets(chunk: Chunk, words: int = WORDS, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, index of its line) without repeats, ordered by line and hash; of each such line its row, number and size.

    ``short``: with the lines of fewer words, each of one token.
    """
    starts, ends = chunk.words()
    row = chunk.row_of(starts)
    breaks = np.flatnonzero(chunk.data == 10)
    at = np.searchsorted(breaks, starts)
    h = chunk.hashes(starts, ends)
    s = rolled(h, words)
    n = len(s)
    use = np.flatnonzero((row[:n] == row[words - 1:]) & (at[:n] == at[words - 1:])) if n else np.zeros(0, np.int64)
    s = s[use]
    if short:
        token, begin = _short(h, at + row, words)
        s, use = np.append(s, token), np.append(use, begin)
    row, at = row[use], at[use]
    place = at + row  # grows with every line and every text
    order = grouped_order(place - place.min(), s) if len(s) else np.zeros(0, np.int64)
    s, row, at, place = s[order], row[order], at[order], place[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (place[1:] != place[:-1])
    s, row, at, place = s[new], row[new], at[new], place[new]
    first = np.flatnonzero(np.diff(place, prepend=-1))
    size = np.diff(np.append(first, len(s)))
    before = np.searchsorted(breaks, chunk.offsets[:-1])
    return s, np.repeat(np.arange(len(first)), size), row[first], at[first] - before[row[first]], size


def _keys(s: np.ndarray, line: np.ndarray, lines: int) -> tuple[np.ndarray, np.ndarray]:
    """Two fingerprints of each line's set that do not depend on order."""
    first = np.searchsorted(line, np.arange(lines))
    if not lines:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.add.reduceat(mix(s + _GOLD), first), np.add.reduceat(mix(s ^ _GOLD), first)


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(44)).astype(np.int64)


_LINE = "doc_id long, key long, line int, n int, k1 long, k2 long"


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line that has a word; last, with line -1, the task's heavy buckets (n: count, k1: bucket)."""
    load = np.zeros(BUCKETS, np.int64)

    def out(doc, key, line, n, k1, k2) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([doc, key, pa.array(line.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(k1), pa.array(k2)], names=["doc_id", "key", "line", "n", "k1", "k2"])

    for batch in batches:
        for at, chunk in chunks(batch.column(2), SMALL_CHUNK):
            s, line, row, number, size = line_sets(chunk)
            k1, k2 = _keys(s, line, len(size))
            load += np.bincount(_bucket(s), minlength=BUCKETS)
            pick = pa.array(row + at)
            yield out(batch.column(0).take(pick), batch.column(1).take(pick), number, size, signed(k1), signed(k2))
    heavy = np.flatnonzero(load >= max(8.0, HEAVY * load.mean()))
    none = pa.nulls(len(heavy), pa.int64())
    yield out(none, none, np.full(len(heavy), -1), np.minimum(load[heavy], 2**31 - 1), heavy, np.zeros(len(heavy), np.int64))


def _prefixes(levels: np.ndarray, threshold: float, most: int):
    """Rows (token, part, cid, np): the prefix shingles of each line, its class, and n * 2**20 + position; lines alike in a chunk once.

    ``part`` is -1 for shingles that are not dealt in parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, chunk in chunks(batch.column(0), SMALL_CHUNK):
                s, line, _, _, size = line_sets(chunk, short=False)
                k1, k2 = _keys(s, line, len(size))
                _, once = np.unique(k1 ^ mix(k2), return_index=True)
                mine = np.zeros(len(size), bool)
                mine[once] = True
                s, line = s[mine[line]], line[mine[line]]
                order = np.argsort(line * 256 + levels[_bucket(s)], kind="stable")  # the hashes are in order already
                s, line = s[order], line[order]
                position = np.arange(len(line)) - np.searchsorted(line, line)
                n = size[line]
                use = position < n - np.ceil(threshold * n - 1e-9) + 1
                s, cid = s[use], k1[line[use]]
                bits = np.maximum(levels[_bucket(s)].astype(np.int64) - most, 0)
                part = np.where(bits > 0, (cid & ((np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1))).astype(np.int64), -1)
                yield pa.RecordBatch.from_arrays([pa.array(signed(s)), pa.array(part.astype(np.int32)), pa.array(signed(cid)), pa.array(n[use] * (1 << 20) + np.minimum(position[use], (1 << 20) - 1))], names=["token", "part", "cid", "np"])

    return run


def _sets_of(levels: np.ndarray):
    """(cid, k2, its first line, its shingles by rarity) for the lines that each row names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = [{int(w["line"]): w for w in x} for x in batch.column(0).to_pylist()]
            for at, chunk in chunks(batch.column(1), SMALL_CHUNK):
                s, line, row, number, size = line_sets(chunk, short=False)
                found = [wanted[at + r].get(k) for r, k in zip(row.tolist(), number.tolist(), strict=True)]
                use = np.array([w is not None for w in found], bool)
                keep = use[line] if len(line) else np.zeros(0, bool)
                s, line = s[keep], line[keep]
                s = s[np.argsort(line * 256 + levels[_bucket(s)], kind="stable")]
                found = [w for w in found if w]
                yield pa.RecordBatch.from_arrays([pa.array([w["cid"] for w in found], pa.int64()), pa.array([w["k2"] for w in found], pa.int64()), pa.array([w["first"] for w in found], _PLACE),
                                                  lists(signed(s), size[use], pa.int64())], names=["cid", "k2", "first", "tokens"])

    return run


_PLACE = pa.struct([("doc_id", pa.int64()), ("key", pa.int64()), ("line", pa.int32())])


# --- meetings: rows of many (token, x, y), each with a class, its size and the shingle's position in it -----------------

def _spans(size: np.ndarray) -> np.ndarray:
    """0, 1, .. size - 1 for each entry, end to end."""
    return np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _slices(weight: np.ndarray) -> Iterator[slice]:
    """Consecutive entries of about AT_ONCE weight together."""
    if len(weight):
        cut = np.flatnonzero(np.diff(np.cumsum(weight) // AT_ONCE)) + 1
        edges = [0, *cut.tolist(), len(weight)]
        yield from (slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True) if b > a)


class _Meetings:
    def __init__(self, group: pa.Table, threshold: float):
        group = group.sort_by([("token", "ascending"), ("x", "ascending"), ("y", "ascending")])
        self.group, self.threshold = group, threshold
        token, self.x, self.y, self.home = (group[c].to_numpy() for c in ("token", "x", "y", "home"))
        packed = group["np"].to_numpy()
        self.n, self.at = packed >> 20, packed & ((1 << 20) - 1)
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (self.x[1:] != self.x[:-1]) | (self.y[1:] != self.y[:-1])
        run = np.cumsum(new) - 1
        ends = np.append(np.flatnonzero(new)[1:], len(token))
        self._after = ends[run] - np.arange(len(token)) - 1 if len(token) else np.zeros(0, np.int64)

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that meet and pass the length and positional filters."""
        t = self.threshold
        for some in _slices(self._after):
            rows = np.arange(some.start, some.stop)
            i = np.repeat(rows, self._after[some])
            j = i + 1 + _spans(self._after[some])
            na, nb = self.n[i], self.n[j]
            ok = (self.x[i] == self.y[i]) | (self.home[i] != self.home[j])
            ok &= np.minimum(na, nb) >= t * np.maximum(na, nb) - 1e-9
            ok &= np.minimum(na - self.at[i], nb - self.at[j]) >= t / (1 + t) * (na + nb) - 1e-9
            if ok.any():
                yield i[ok], j[ok]

    def rows(self, marked: np.ndarray) -> pa.Table:
        return self.group.filter(pa.array(marked)).select(["token", "x", "y", "home", "cid", "np"])


def _common(values: np.ndarray, begin: np.ndarray, i: np.ndarray, j: np.ndarray, size_i: np.ndarray, size_j: np.ndarray) -> np.ndarray:
    """For each pair of rows, how many of the first ``size`` values of both are equal (a row has no value twice)."""
    out = np.zeros(len(i), np.int64)
    for some in _slices(size_i + size_j):
        a, b = size_i[some], size_j[some]
        at = np.concatenate([np.repeat(begin[i[some]], a) + _spans(a), np.repeat(begin[j[some]], b) + _spans(b)])
        owner = np.concatenate([np.repeat(np.arange(len(a)), a), np.repeat(np.arange(len(b)), b)])
        v = values[at].view(np.uint64)
        order = grouped_order(owner, v)
        v, owner = v[order], owner[order]
        same = (v[1:] == v[:-1]) & (owner[1:] == owner[:-1])
        out[some] = np.bincount(owner[1:][same], minlength=len(a))
    return out


_MEETING = "token long, x int, y int, home int, cid long, np long"


def _partnered(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        """The rows that have a partner."""
        meet = _Meetings(group, threshold)
        marked = np.zeros(len(group), bool)
        for i, j in meet.pairs():
            marked[i] = marked[j] = True
        return meet.rows(marked)

    return run


def _led(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        """The rows with a partner whose first shared shingle may be this one, as far as ``lead`` (earlier shared shingles, by rarity) tells."""
        meet = _Meetings(group, threshold)
        lead = meet.group["lead"].combine_chunks()
        size, values = lead.value_lengths().to_numpy(), lead.flatten().to_numpy()
        begin = np.cumsum(size) - size
        marked = np.zeros(len(group), bool)
        for i, j in meet.pairs():
            first = _common(values, begin, i, j, size[i], size[j]) == 0
            marked[i[first]] = marked[j[first]] = True
        return meet.rows(marked)

    return run


def _verified(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        """For each class its links that belong to the group's shingles, and whether one is to an earlier line."""
        meet = _Meetings(group, threshold)
        sets = meet.group["tokens"].combine_chunks()
        size, values = sets.value_lengths().to_numpy().astype(np.int64), sets.flatten().to_numpy()
        begin = np.cumsum(size) - size
        places = [(p["doc_id"] is not None, p["doc_id"] or 0, p["key"], p["line"]) for p in meet.group["first"].to_pylist()]
        turn = {p: k for k, p in enumerate(sorted(set(places)))}
        turn = np.array([turn[p] for p in places], np.int64)
        degree, goes = np.zeros(len(group), np.int64), np.zeros(len(group), bool)
        for i, j in meet.pairs():
            first = _common(values, begin, i, j, meet.at[i], meet.at[j]) == 0
            i, j = i[first], j[first]
            c = _common(values, begin, i, j, size[i], size[j])
            near = c / (size[i] + size[j] - c) >= threshold
            i, j = i[near], j[near]
            degree += np.bincount(i, minlength=len(group)) + np.bincount(j, minlength=len(group))
            goes[np.where(turn[i] > turn[j], i, j)] = True
        some = pa.array(degree > 0)
        return pa.table({"k1": meet.group["cid"], "k2": meet.group["k2"], "degree": pa.array(degree), "goes": pa.array(goes)}).filter(some)

    return run


def line_classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(lines, classes).

    lines: doc_id, key (text fingerprint), line, n, k1, k2.  classes: k1, k2 (together the class), first (doc_id, key, line), degree (other classes that
    match), goes (one of them has an earlier first line).
    """
    spark = docs.sparkSession
    src = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(text).alias("key"), F.col(text).alias("text"))
    both = materialize(arrow_map(src, _lines, _LINE), "line")
    lines = both.where("line >= 0")
    n = both.count()
    classes = lines.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "key", "line")).alias("first"))
    classes = materialize(in_tasks(classes, n, CLASSES), "line")

    heavy = both.where("line < 0").groupBy("k1").agg(F.sum("n").alias("n")).toArrow()  # at most BUCKETS rows
    levels = np.zeros(BUCKETS, np.uint8)
    levels[heavy["k1"].to_numpy()] = np.log2(np.maximum(heavy["n"].to_numpy(), 1)).astype(np.uint8)
    shared = spark.sparkContext.broadcast(levels)

    prefix = arrow_map(docs.select(F.col(text).alias("text")), _with(shared, _prefixes, threshold, PART), "token long, part int, cid long, np long")
    token = Window.partitionBy("token", "part")  # about 2 ** PART rows at most
    live = prefix.withColumn("lo", F.min("cid").over(token)).withColumn("hi", F.max("cid").over(token)).where("lo < hi OR part >= 0")
    live = materialize(in_tasks(live.select("token", "cid", "np").distinct(), n, LINES), "line")
    crowded = live.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > BLOCK)
    met = live.join(crowded, "token", "left").withColumn("blocks", F.ceil(F.coalesce("size", F.lit(1)) / BLOCK).cast("int"))
    met = met.withColumn("home", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("token", F.least("home", "other").alias("x"), F.greatest("home", "other").alias("y"), "home", "cid", "np")
    groups = max(1, -(-live.count() // MEET))
    dealt = lambda df: df.withColumn("deal", F.pmod(F.xxhash64("token", "x", "y"), F.lit(groups)))
    met = materialize(arrow_groups(dealt(met), ["deal"], _partnered(threshold), _MEETING), "line")

    place = F.col("np").bitwiseAND((1 << 20) - 1)
    one = met.select("cid", "np", "token").distinct()
    leads = one.groupBy("cid").agg(F.slice(F.array_sort(F.collect_list(F.struct(place.alias("at"), "token"))), 1, LEAD).alias("shared"))
    led = met.join(leads, "cid").withColumn("lead", F.transform(F.filter("shared", lambda s: s["at"] < place), lambda s: s["token"])).drop("shared")
    met = materialize(arrow_groups(dealt(led), ["deal"], _led(threshold), _MEETING), "line")

    wanted = met.select("cid").distinct().join(classes.withColumnRenamed("k1", "cid"), "cid")
    wanted = wanted.groupBy(F.coalesce(F.col("first.doc_id").cast("string"), F.lit("")).alias("id_key"), F.col("first.key").alias("key")).agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "cid", "k2", "first")).alias("wanted"))
    texts = docs.select(id_key(doc_id).alias("id_key"), row_key(text).alias("key"), F.col(text).alias("text"))
    sets = arrow_map(wanted.join(texts, ["id_key", "key"]).select("wanted", "text"), _with(shared, _sets_of), "cid long, k2 long, first struct<doc_id:long,key:long,line:int>, tokens array<long>")
    sets = materialize(in_tasks(sets, n, LINES), "line").dropDuplicates(["cid", "k2"])  # a text that is repeated under its id gives its sets twice
    full = met.join(sets, "cid").where(F.size("tokens") == F.shiftright("np", 20))
    found = materialize(arrow_groups(dealt(full), ["deal"], _verified(threshold), "k1 long, k2 long, degree long, goes boolean"), "line")
    found = found.groupBy("k1", "k2").agg(F.sum("degree").alias("degree"), F.bool_or("goes").alias("goes"))
    return lines, classes.join(found, ["k1", "k2"], "left").select("k1", "k2", "first", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("goes", F.lit(False)).alias("goes"))


def _with(shared, make, *more):
    """A function over batches that is made from a broadcast value on the executor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from make(shared.value, *more)(batches)

    return run


def kept_lines(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """A row for each text (doc_id, key) with a comparable line: their number, the numbers of those that stay, and the links of all of them.

    ``n_links`` counts, over its lines, the other distinct lines of the corpus that match without being equal.  Null ids are allowed; a text
    that is repeated under its id counts once and both rows keep the same lines.  Null, empty and blank texts have no row.
    """
    lines, classes = line_classes(docs, doc_id=doc_id, text=text, threshold=threshold)
    classes = materialize(in_tasks(classes, lines.count(), CLASSES), "line")
    kept = classes.where("NOT goes").groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.key").alias("key")).agg(F.array_sort(F.collect_list("first.line")).alias("kept"))
    total = lines.select("doc_id", "key", "line").distinct().groupBy("doc_id", "key").agg(F.count("*").alias("n_lines"))
    some = classes.where("degree > 0").select("k1", "k2", "degree")
    links_of = lines.select("doc_id", "key", "line", "k1", "k2").distinct().join(some, ["k1", "k2"]).groupBy("doc_id", "key").agg(F.sum("degree").alias("n_links"))
    on = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.key") == F.col(f"{b}.key"))
    out = total.alias("t").join(kept.alias("k"), on("t", "k"), "left").join(links_of.alias("l"), on("t", "l"), "left")
    return out.select("t.doc_id", "t.key", "n_lines", F.coalesce("kept", F.array().cast("array<int>")).alias("kept"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = batch.column(2).to_pylist()
        out = []
        for at, chunk in chunks(batch.column(1), SMALL_CHUNK):
            _, _, row, number, _ = line_sets(chunk)
            known: dict[int, set[int]] = {}
            for r, k in zip((row + at).tolist(), number.tolist(), strict=True):
                known.setdefault(r, set()).add(k)
            for r in range(at, at + chunk.rows):
                gone = known.get(r, set()) - set(keep[r] or ())
                text = batch.column(1)[r].as_py()
                if gone:
                    text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
                out.append(text if not gone or text.strip(" \t\n\v\f\r") else None)
        lost = pc.and_(pc.is_null(pa.array(out, pa.string())), pc.is_valid(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc", "clean"]).filter(pc.invert(lost))


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the lines that go taken out of the text (and n_chars brought in line); a row of which nothing is left goes.

    All other rows and columns stay, null and blank texts included.
    """
    kept = kept_lines(docs, doc_id=doc_id, text=text, threshold=threshold).select(id_key().alias("id_key"), F.col("key").alias("text_key"), "kept")
    rows = docs.select(F.struct("*").alias("doc"), id_key(doc_id).alias("id_key"), row_key(text).alias("text_key"), F.col(text).alias("text"))
    rows = rows.join(kept, ["id_key", "text_key"], "left").select("doc", "text", "kept")
    schema = T.StructType([T.StructField("doc", docs.schema), T.StructField("clean", T.StringType())])
    out = arrow_map(rows, _rebuilt, schema)
    fixed = {text: F.col("clean")}
    if "n_chars" in docs.columns:
        fixed["n_chars"] = F.when(F.col("clean").eqNullSafe(F.col("doc")[text]), F.col("doc.n_chars")).otherwise(F.char_length("clean")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[fixed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
