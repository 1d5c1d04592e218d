"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, banding, exact check of the multisets.

A document is the bag of its five-word shingles (the whole text if it has one to four words), and two bags are alike
by sum(min) / sum(max) of their counts.

Signature.  Weights are discretised at the integers.  Every shingle owns Poisson processes on the dyadic weight
intervals [0, 1), [1, 2), [2, 4), [4, 8), ...; a point has a time, a register and a level in its interval, all of
them hashed from the shingle alone.  A document of weight w sees the points whose level is below w, and register j
keeps the earliest time.  Two documents hold the same time in a register with probability equal to their weighted
Jaccard similarity.  Points come in order of time and a process stops once it is later than the latest register,
so a long text costs about one point a shingle.

Candidates.  Documents with the same bag collapse to one representative (the smallest id).  Each band of registers
is a bucket.  Buckets are never expanded into all pairs: every member is first compared with the bucket's smallest
document, and links found there are joined to components.  Members still outside the smallest document's component are then
compared block by block: first with the few of each block whose signatures agree most, and after joining those links with
every member of another component whose signature agrees enough to be a link at all.  Of these pairs only those go to the
exact check whose shingles, counted in bins, leave the threshold in reach: an upper bound of the similarity, so no link is lost by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidbox.llm.common import arrow_groups, arrow_map, in_tasks, materialize, row_key
from bidbox.llm.components import components
from bidbox.llm.textnp import CHUNK_BYTES, Chunk, chunks, grouped_order, lists, mix, rolled, signed

#: 24 bands of 4 registers: a pair at similarity 0.8 shares no band with probability 3e-6.
BANDS, ROWS = 24, 4
#: Registers of a signature; the first BANDS * ROWS make the bands, all of them estimate a pair's similarity.
REGISTERS = 256
#: A pair whose estimate lies this far under the threshold is no link: at 0.8 that is over 5 standard deviations.
SLACK = 0.13
#: Candidates that a document outside the main component names first, in each block.
FIRST = 4
WORDS = 5
#: Bins in which a bag's shingles are counted, one byte each; MOST is a count of that or more.
BINS, MOST = 512, 255
#: Members of a block of a bucket; blocks are compared pairwise in separate groups.
BLOCK = 512
#: Documents, members of buckets or pairs whose texts are compared that a task writes, about.
DOCS, MEMBERS, PAIRS = 2000, 10_000, 2000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def bags(chunk: Chunk, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, count) of every distinct shingle, ordered by row and hash."""
    starts, ends = chunk.words()
    row = chunk.row_of(starts)
    h = chunk.hashes(starts, ends)
    s = rolled(h, words)
    owner = row[:len(s)]
    full = owner == row[words - 1:] if len(s) else np.zeros(0, bool)
    s, owner = s[full], owner[full]
    n = np.bincount(row, minlength=chunk.rows)
    for r in np.flatnonzero((n > 0) & (n < words)):  # too short for a shingle: the words together are one
        at = int(np.searchsorted(row, r))
        one = rolled(h[at:at + n[r]], int(n[r]))
        s, owner = np.append(s, mix(one + np.uint64(n[r]))), np.append(owner, r)
    order = grouped_order(owner, s)
    s, owner = s[order], owner[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return owner[at], s[at], np.diff(np.append(at, len(s)))


def _times_gold(n: int) -> np.uint64:
    return np.uint64(n * int(_GOLD) % (1 << 64))


def _unit(h: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1]."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(rows: int, owner: np.ndarray, shingle: np.ndarray, count: np.ndarray, m: int) -> np.ndarray:
    """Earliest time of each of m registers for each row (infinite for a row without shingles)."""
    reg = np.full((rows, m), np.inf)
    flat = reg.reshape(-1)
    low, k = np.int64(0), 0
    while True:
        high = np.int64(1 if k == 0 else low * 2)
        live = np.flatnonzero(count > low)
        if not len(live):
            break
        rate = float(m) * float(high - low)
        key = mix(shingle[live] + _times_gold(k + 1))
        own, upto, time = owner[live], count[live], np.zeros(len(live))
        step = 0
        latest = reg.max(axis=1)
        while len(own):
            step += 1
            a = mix(key ^ _times_gold(step))
            b = mix(a + _GOLD)
            time = time - np.log(_unit(a)) / rate
            near = time < latest[own]
            if not near.all():
                own, upto, time, key, b = own[near], upto[near], time[near], key[near], b[near]
            level = low + ((b >> np.uint64(32)) * np.uint64(high - low) >> np.uint64(32)).astype(np.int64)
            hit = level < upto
            np.minimum.at(flat, own[hit] * m + (b[hit] & np.uint64(0xFFFFFFFF)).astype(np.int64) % m, time[hit])
            touched = np.unique(own)
            latest[touched] = reg[touched].max(axis=1)
        low, k = high, k + 1
    return reg


def _signed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1)
        for at, chunk in chunks(texts):
            ids = batch.column(0).slice(at, chunk.rows)
            owner, shingle, count = bags(chunk)
            reg = signatures(chunk.rows, owner, shingle, count, REGISTERS)
            size = np.bincount(owner, weights=count, minlength=chunk.rows).astype(np.int64)
            weigh = mix(shingle + _GOLD) * mix(count.astype(np.uint64) + _GOLD)
            bag = np.zeros((2, chunk.rows), np.uint64)
            np.add.at(bag[0], owner, weigh)
            np.add.at(bag[1], owner, mix(weigh ^ _GOLD))
            bits = reg.view(np.uint64)[:, :BANDS * ROWS].reshape(chunk.rows, BANDS, ROWS)
            key = np.zeros((chunk.rows, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
            for j in range(ROWS):
                key = mix(key ^ bits[:, :, j]) * _GOLD
            sig = (mix(reg.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
            counted = np.bincount(owner * BINS + (shingle % np.uint64(BINS)).astype(np.int64), weights=count, minlength=chunk.rows * BINS)
            bins = np.minimum(counted, MOST).astype(np.uint8).reshape(chunk.rows, BINS)
            full = pa.array(size > 0)
            out = pa.RecordBatch.from_arrays(
                [ids, pa.array(size), pa.array(signed(bag[0])), pa.array(signed(bag[1])),
                 lists(signed(key).reshape(-1), np.full(chunk.rows, BANDS), pa.int64()),
                 pa.array([r.tobytes() for r in sig], pa.binary()), pa.array([r.tobytes() for r in bins], pa.binary())],
                names=["doc_id", "size", "bag1", "bag2", "bands", "sig", "bins"])
            yield out.filter(full)


SIGNED = "doc_id long, size long, bag1 long, bag2 long, bands array<long>, sig binary, bins binary"


def signed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each text that has a word: its size in shingles, bag fingerprint, band keys, 8 bits a register and counts in bins."""
    return arrow_map(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), _signed_rows, SIGNED)


def _verify(threshold: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            long = pc.add(pc.binary_length(left), pc.binary_length(right)).to_numpy(zero_copy_only=False).cumsum()
            at = 0
            while at < batch.num_rows:  # pairs whose texts together are about a chunk
                to = max(at + 1, int(np.searchsorted(long, (long[at - 1] if at else 0) + CHUNK_BYTES)))
                n = to - at
                (_, chunk), = chunks(pa.concat_arrays([left.slice(at, n), right.slice(at, n)]), 1 << 62)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(1).slice(at, n)], names=["a", "b"]).filter(pa.array(_similar(chunk, n, threshold)))
                at = to

    return check


def _similar(chunk: Chunk, pairs: int, threshold: float) -> np.ndarray:
    """Whether row i and row pairs + i of the chunk reach the weighted Jaccard threshold."""
    owner, shingle, count = bags(chunk)
    pair = owner % pairs
    order = grouped_order(pair, shingle)
    pair, shingle, count = pair[order], shingle[order], count[order]
    same = np.flatnonzero((pair[1:] == pair[:-1]) & (shingle[1:] == shingle[:-1]))
    both = np.bincount(pair[same], weights=np.minimum(count[same], count[same + 1]), minlength=pairs)
    total = np.bincount(pair, weights=count, minlength=pairs)
    return (both > 0) & (both >= threshold * (total - both) - 1e-9)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold, again for each text that an id repeats; the texts travel by id in two equi-joins."""
    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
    with_b = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
    return arrow_map(with_b.select("a", "b", "text_a", "text_b"), _verify(threshold), "a long, b long")


def _could(a: str, b: str, threshold: float) -> Column:
    """Bags whose sizes differ by more than the threshold cannot reach it."""
    return F.least(F.col(a), F.col(b)) >= threshold * F.greatest(F.col(a), F.col(b))


def _in_reach(bins: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a bag can reach the threshold with each of the others: equal shingles share a bin, so the bins have at least as much in common."""
    both = np.minimum(others, bins)
    most = both.sum(axis=1, dtype=np.int64)
    return (both == MOST).any(axis=1) | (most >= threshold * (size + sizes - most) - 1e-9)


def _block_pairs(threshold: float, first: int | None):
    """Pairs of different components, one block against another, whose signatures agree in enough registers and whose bins leave the threshold in reach; the ``first`` best of each row or all."""
    least = (threshold - SLACK) * REGISTERS

    def pairs(group: pa.Table) -> pa.Table:
        few, all_ = (group.filter(pc.equal(group["side"], side)) for side in (0, 1))
        a, b = (np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint8).reshape(len(t), REGISTERS) for t in (few, all_))
        bins_a, bins_b = (np.frombuffer(b"".join(t["bins"].to_pylist()), np.uint8).reshape(len(t), BINS) for t in (few, all_))
        band = few["band_no"][0].as_py() if len(few) else 0
        keys_a, keys_b = (t["bands"].combine_chunks().flatten().to_numpy().reshape(len(t), BANDS) for t in (few, all_))
        ia, ca, sa, _ = (few[c].to_numpy() for c in ("doc_id", "comp", "size", "minor"))
        ib, cb, sb, minor = (all_[c].to_numpy() for c in ("doc_id", "comp", "size", "minor"))
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in range(len(ia)):
            ok = (cb != ca[i]) & (~minor | (ib > ia[i])) & (np.minimum(sb, sa[i]) >= threshold * np.maximum(sb, sa[i]))
            at = np.flatnonzero(ok)
            agree = (b[at] == a[i]).sum(axis=1)
            at, agree = at[agree >= least], agree[agree >= least]
            here = (keys_b[at] == keys_a[i]).argmax(axis=1) == band  # a pair counts in the first band that it shares
            at, agree = at[here], agree[here]
            near = _in_reach(bins_a[i], bins_b[at], sa[i], sb[at], threshold)
            at, agree = at[near], agree[near]
            if first is not None and len(at) > first:
                at = at[np.argsort(-agree, kind="stable")[:first]]
            out_a.append(np.full(len(at), ia[i]))
            out_b.append(ib[at])
        x, y = np.concatenate(out_a), np.concatenate(out_b)
        return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    return pairs


def _apart(members: DataFrame, reps: DataFrame, comp: DataFrame, threshold: float, first: int | None) -> tuple[DataFrame | None, DataFrame]:
    """Candidate pairs between members of a bucket that are in different components (None if no bucket has any), and the members of such buckets.

    The members outside the component of the bucket's smallest document are compared with all others, in blocks.  Components only grow,
    so buckets that are left out need not be looked at again.
    """
    put = members.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
    hub = put.groupBy("band").agg(F.min(F.struct("doc_id", "comp")).alias("hub"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).where("lo != hi AND n > 2")
    live = put.join(hub.select("band", "n", "hub"), "band").withColumn("is_hub", F.col("doc_id") == F.col("hub.doc_id")).withColumn("minor", ~F.col("is_hub") & (F.col("comp") != F.col("hub.comp")))
    live = live.select("doc_id", "size", "comp", "band", "band_no", "n", "is_hub", "minor")
    live = materialize(in_tasks(live, members.count(), MEMBERS), "bag")
    few = live.where("minor").groupBy("band").agg(F.count("*").alias("few"))
    if not few.limit(1).count():
        return None, live
    wide, deep = F.ceil(F.col("n") / BLOCK).cast("int"), F.ceil(F.col("few") / BLOCK).cast("int")
    rest = live.where("NOT is_hub").join(few, "band").join(reps.select("doc_id", "sig", "bins", "bands"), "doc_id")
    x, y = F.pmod(F.xxhash64(F.lit(1), "doc_id"), deep).cast("int"), F.pmod(F.xxhash64(F.lit(2), "doc_id"), wide).cast("int")
    place = lambda x, y, side: F.struct(x.alias("x"), y.alias("y"), F.lit(side).alias("side"))
    one = F.when(F.col("minor"), F.transform(F.sequence(F.lit(0), wide - 1), lambda i: place(x, i, 0)))
    two = F.transform(F.sequence(F.lit(0), deep - 1), lambda i: place(i, y, 1))
    rest = rest.withColumn("at", F.explode(F.concat(F.coalesce(one, F.array().cast("array<struct<x:int,y:int,side:int>>")), two)))
    rest = rest.select("band", "band_no", "at.*", "doc_id", "size", "comp", "minor", "sig", "bins", "bands")
    return arrow_groups(rest, ["band", "x", "y"], _block_pairs(threshold, first), "a long, b long").distinct(), live


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """(doc_id, class_id, kept) of every row: class_id is the smallest id reachable by links of similarity >= threshold.

    Null, empty and blank texts link with nothing and are their own class; texts with equal bags are always linked.
    A null id links with nothing either (class_id null, kept).  Rows that repeat an id share its class, and ``kept`` holds
    for all of them.  An empty table gives no rows; other columns of ``docs`` are not read.
    """
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL")
    marks = materialize(signed_documents(texts), "bag")
    same = ["bag1", "bag2", "size"]
    n = marks.count()
    reps = (marks.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("bands", "sig", "bins"), "doc_id").alias("x"))
            .select(F.col("rep").alias("doc_id"), *same, "x.bands", "x.sig", "x.bins"))
    reps = materialize(in_tasks(reps, n, DOCS), "bag")
    members = reps.select("doc_id", "size", F.posexplode("bands").alias("band_no", "band"))
    hubs = members.groupBy("band").agg(F.min(F.struct("doc_id", "size")).alias("hub"), F.count("*").alias("n")).where("n > 1")
    # from here on only the buckets of two members or more are read
    members = members.join(hubs.select("band", "hub.doc_id", "hub.size").toDF("band", "a", "size_a"), "band")
    members = materialize(in_tasks(members, n, DOCS), "bag")
    m = members.count()
    first = members.where((F.col("a") != F.col("doc_id")) & _could("size", "size_a", threshold)).select("a", F.col("doc_id").alias("b")).distinct()
    tried = materialize(in_tasks(first, m, MEMBERS), "bag")
    # texts that share a bucket are fetched once for all rounds
    texts = texts.join(members.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
    texts = materialize(in_tasks(texts, max(n, m), DOCS), "bag")
    t = texts.count()  # a check reads all of them, however few its pairs
    members = members.drop("a", "size_a")
    linked = materialize(in_tasks(verified(tried, texts, threshold), max(t, tried.count()), PAIRS), "bag")
    comp = components(linked)
    for best in (FIRST, None):
        more, live = _apart(members, reps, comp, threshold, best)
        if more is None:
            break
        members = live.select("doc_id", "size", "band", "band_no")
        more = materialize(in_tasks(more.join(tried, ["a", "b"], "left_anti"), members.count() + tried.count(), MEMBERS), "bag")
        found = more.count()
        if not found:
            continue
        links = materialize(in_tasks(verified(more, texts, threshold), max(t, found), PAIRS), "bag")
        tried, linked = tried.union(more), linked.union(links)
        if links.limit(1).count():
            comp = components(linked)
    final = reps.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(*same, F.coalesce("component", "doc_id").alias("class_id"))
    found = marks.select("doc_id", *same).join(final, same).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    out = docs.select(F.col(doc_id).cast("long").alias("doc_id")).join(found, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.8) -> DataFrame:
    """``docs`` with one text of each group of near-duplicates: that with the smallest id (then text fingerprint).

    Texts are told apart by id and fingerprint, so an id that comes with several texts does not tie their groups together.  Rows without an
    id all stay.  Of rows that repeat an id and a text, that with the smallest hash over all columns stays.
    """
    rows = docs.select(F.struct("*").alias("doc"), F.col(doc_id).cast("long").alias("id"), row_key(text).alias("key"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("turn"))
    ids = rows.select("id", "key").where("id IS NOT NULL").distinct()
    if ids.groupBy("id").count().where("count > 1").limit(1).count():
        nodes = materialize(ids.withColumn("node", F.monotonically_increasing_id()), "bag")
        texts = docs.select(F.col(doc_id).cast("long").alias("id"), row_key(text).alias("key"), F.col(text).alias("text")).join(nodes, ["id", "key"]).select("node", "text").dropDuplicates(["node"])
        found = near_duplicates(texts, doc_id="node", threshold=threshold).select(F.col("doc_id").alias("node"), "class_id").join(nodes, "node")
        stays = found.groupBy("class_id").agg(F.min(F.struct("id", "key")).alias("stays")).select("stays.*")
        rows = rows.where("id IS NULL").unionByName(rows.join(stays, ["id", "key"], "left_semi"))
    else:
        gone = near_duplicates(docs, doc_id=doc_id, text=text, threshold=threshold).where("NOT kept").select(F.col("doc_id").alias("id")).distinct()
        rows = rows.join(gone, "id", "left_anti")
    first = Window.partitionBy("id", "key").orderBy("turn")
    return rows.withColumn("nr", F.row_number().over(first)).where("nr = 1 OR id IS NULL").select("doc.*")
