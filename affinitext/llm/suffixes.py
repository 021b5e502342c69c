"""Removal of repeated byte strings by a distributed sort of sampled suffixes.

A window of `length` bytes has an anchor: the place of the smallest fingerprint near its
start. Equal windows have equal anchors, so suffixes at anchors stand for all windows.

1. Anchors whose next bytes (those every one of their windows has) occur once are dropped.
2. The suffixes left, `length` bytes each, are sorted per task into runs, equal ones once.
   Runs are front-coded: how much each shares with the one before, and the rest. They are
   exchanged by ranges of suffixes.
3. Each range merges its runs with a loser tree that compares candidates by what they share
   with the last suffix put out, and bytes only beyond that. Neighbours in that order tell
   how much of a suffix occurs elsewhere: an anchor with all `length` bytes is repeated.
4. Between anchors that are repeated everything is covered. Where coverage begins or ends,
   the exact window is found by comparing the fingerprints of the windows of those anchors.
"""

from __future__ import annotations

import bisect
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinitext.llm.common import KEY, drop_stored, stored, text_of, with_key
from affinitext.llm.hashing import Prints, chunks, mixed

LENGTH = 400
#: Bytes whose smallest fingerprint is a window's anchor, as a share of the window.
REACH = 0.64
GRAM = 16
RUN_SUFFIXES = 50_000
#: Text slices whose windows one group compares; anchors with more than HOT_SLICES slices have
#: their windows counted by a distributed aggregate instead.
BUCKET_SLICES = 4_000
HOT_SLICES = 4_000
#: Bytes from one compared left context of a hot anchor to the next longer one.
STEP = 16
#: Suffixes per range, and the bounded sample that the ranges' bounds are taken from.
RANGE_SUFFIXES = 50_000
SAMPLED_TEXTS = 4_000
SAMPLED_SUFFIXES = 8_000


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, reach: int):
    """anchor, last window of each run of windows of one anchor, and the text they are in."""
    n = len(data) - GRAM + 1
    if n < reach:
        return (np.zeros(0, np.int64),) * 3
    high = np.uint64(0xFFFFFFFF00000000)
    ranked = (Prints(data).all_of(GRAM) & high) | np.arange(n, dtype=np.uint64)
    padded = np.full(-(-n // reach) * reach, np.uint64(2**64 - 1))
    padded[:n] = ranked
    blocks = padded.reshape(-1, reach)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[: n - reach + 1], ahead[reach - 1 : n])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    at = np.flatnonzero(np.arange(len(least)) + length <= ends[: len(least)])
    anchor = (least[at] & ~high).astype(np.int64)
    last = np.flatnonzero(np.append((anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1), True)) \
        if len(at) else at
    anchor, window = anchor[last], at[last]
    return anchor, window, np.searchsorted(offsets, window, side="right") - 1


def _anchor_rows(keyed: DataFrame, length: int, reach: int) -> DataFrame:
    """Per text: its anchors, last windows, and fingerprints of what their windows share."""
    core = length - reach + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in chunks(batch.column(2)):
                anchor, window, text = anchors(data, offsets, length, reach)
                if not len(anchor):
                    continue
                prints = Prints(data).of(anchor, anchor + core).view(np.int64)
                base = offsets[text]
                found, ends = np.unique(text, return_index=True)
                ends = pa.array(np.append(ends, len(text)).astype(np.int32))
                rows = pa.array(row + found)
                lists = [
                    pa.ListArray.from_arrays(ends, pa.array(x))
                    for x in ((anchor - base).astype(np.int32), (window - base).astype(np.int32), prints)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(1).take(rows), *lists],
                    [*KEY, "at", "hi", "core"],
                )

    return keyed.select(*KEY, text_of().alias("text")).mapInArrow(
        run, "_k1 bigint, _k2 bigint, at array<int>, hi array<int>, core array<bigint>"
    )


def shared_prefixes(suffixes: list[bytes], length: int) -> np.ndarray:
    """How many bytes each of the sorted suffixes shares with the one before."""
    shared = np.zeros(len(suffixes), np.uint16)
    sizes = np.array([len(s) for s in suffixes])
    for a in range(0, len(suffixes) - 1, 4096):
        part = suffixes[a : a + 4097]
        bytes_ = np.frombuffer(b"".join(s.ljust(length, b"\0") for s in part), np.uint8)
        differ = np.diff(bytes_.reshape(-1, length).view(np.uint8), axis=0) != 0
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        own = sizes[a : a + len(part)]
        shared[a + 1 : a + len(part)] = np.minimum(first, np.minimum(own[1:], own[:-1]))
    return shared


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """How many first bytes a and b share, given that they share `known`."""
    lo, hi = known, min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while hi - lo > 1:
        middle = (lo + hi) // 2
        if a[lo:middle] == b[lo:middle]:
            lo = middle
        else:
            hi = middle
    return lo


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(1).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


RUNS = (
    "run string, range int, first int, shared binary, sizes binary, twice binary, tails binary,"
    " below int, above int, _k1 bigint, _k2 bigint, at array<int>, lo array<int>, hi array<int>,"
    " core array<bigint>, rank array<int>"
)


def _runs(texts: DataFrame, bounds: list[bytes], length: int) -> DataFrame:
    """Per run and range its front-coded suffixes, and per text (range null) its suffixes'
    ranks in the run. below and above: what the suffixes around the range's lower bound
    share with that bound."""
    names = [f.split()[0] for f in RUNS.split(", ")]
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.int32(), pa.int32(),
             pa.int64(), pa.int64(), ints, ints, ints, longs, ints]

    def closed(rows: list[tuple], suffixes: list[bytes]) -> pa.RecordBatch:
        run, ranks, twice, ordered = uuid.uuid4().hex, [0] * len(suffixes), bytearray(), []
        for i in sorted(range(len(suffixes)), key=suffixes.__getitem__):
            if ordered and suffixes[i] == ordered[-1]:
                twice[-1] = 1
            else:
                ordered.append(suffixes[i])
                twice.append(0)
            ranks[i] = len(ordered) - 1
        overlap, out, done = shared_prefixes(ordered, length), [], 0
        cuts = [0, *[bisect.bisect_left(ordered, b) for b in bounds], len(ordered)]
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
            below = shared(ordered[lo - 1], bounds[k - 1]) if k and lo else 0
            above = shared(ordered[lo], bounds[k - 1]) if k and lo < len(ordered) else 0
            part = overlap[lo:hi].copy()
            part[:1] = 0
            tails = b"".join(s[n:] for s, n in zip(ordered[lo:hi], part.tolist(), strict=True))
            sizes = np.array([len(s) for s in ordered[lo:hi]], np.uint16)
            out.append((run, k, lo, _zip(part.tobytes()), _zip(sizes.tobytes()),
                        _zip(bytes(twice[lo:hi])), _zip(tails), below, above, *[None] * 7))
        done = 0
        for key, lists in rows:
            n = len(lists[0])
            out.append((run, *[None] * 8, *key, *lists, ranks[done : done + n]))
            done += n
        columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, suffixes = [], []
        for batch in batches:
            texts, lists = batch.column(2), [batch.column(i) for i in range(3, 7)]
            for i, key in enumerate(zip(*[batch.column(j).to_pylist() for j in (0, 1)], strict=True)):
                data = texts[i].as_buffer().to_pybytes()
                own = [x[i].as_py() for x in lists]
                rows.append((key, own))
                suffixes.extend([data[a : a + length] for a in own[0]])
                if len(suffixes) >= RUN_SUFFIXES:
                    yield closed(rows, suffixes)
                    rows, suffixes = [], []
        if rows:
            yield closed(rows, suffixes)

    return texts.select(*KEY, "text", "at", "lo", "hi", "core").mapInArrow(run, RUNS)


class Run:
    """A front-coded run read suffix by suffix; `known`: what the current one shares with the
    suffix that the merge put out last."""

    def __init__(self, first, overlap, sizes, twice, tails):
        self.rank = first - 1
        self.overlap = np.frombuffer(_unzip(overlap), np.uint16).tolist()
        self.sizes = np.frombuffer(_unzip(sizes), np.uint16).tolist()
        self.twice, self.tails = _unzip(twice), _unzip(tails)
        self.next, self.at, self.value, self.known = 0, 0, b"", 0

    def step(self) -> bool:
        """Go to the next suffix; what it shares with the last one is known from the code."""
        if self.next == len(self.sizes):
            self.value = None
            return False
        self.known = self.overlap[self.next]
        end = self.at + self.sizes[self.next] - self.known
        self.value = self.value[: self.known] + self.tails[self.at : end]
        self.at, self.next, self.rank = end, self.next + 1, self.rank + 1
        return True


def merged(runs: list[Run]) -> Iterator[tuple[int, int]]:
    """Index of the run of the next suffix in order, and what it shares with the one before.

    A loser tree: of two suffixes, that which shares more with the last one put out comes
    first; only if both share the same are bytes compared, from there on, and the loser then
    knows what it shares with the winner.
    """
    k = len(runs)
    losers = [-1] * max(k, 1)

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        x, y = runs[a], runs[b]
        if x.value is None or y.value is None:
            return (b, a) if x.value is None else (a, b)
        if x.known != y.known:
            return (a, b) if x.known > y.known else (b, a)
        n = shared(x.value, y.value, x.known)
        if x.value[n : n + 1] <= y.value[n : n + 1]:
            y.known = n
            return a, b
        x.known = n
        return b, a

    for r in runs:
        r.step()
    # Leaves k..2k-1, inner nodes 1..k-1.
    winners = [-1] * (2 * k)
    winners[k:] = range(k)
    for node in range(k - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1] if k > 1 else 0
    while runs[top].value is not None:
        yield top, runs[top].known
        runs[top].step()
        node = (top + k) // 2
        while node:
            top, losers[node] = play(top, losers[node])
            node //= 2


def _merge_ranges(runs: DataFrame, edges: dict[int, tuple[int, int]], bounds: list[bytes], least: int) -> DataFrame:
    """run, rank, most: how much of the suffixes occurs elsewhere, if at least `least` bytes."""

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        number = key[0].as_py()
        names = group.column("run").to_pylist()
        columns = [group.column(c).to_pylist() for c in ("first", "shared", "sizes", "twice", "tails")]
        heads = [Run(*x) for x in zip(*columns, strict=True)]
        owner, rank, most = [], [], []
        ends: list[bytes] = []
        for r, n in merged(heads):
            x = heads[r]
            if most and n > most[-1]:
                most[-1] = n
            owner.append(r)
            rank.append(x.rank)
            most.append(max(n, len(x.value)) if x.twice[x.next - 1] else n)
            if not ends:
                ends = [x.value, x.value]
            ends[1] = x.value
        # Neighbours in the ranges below and above share with these what both share with the bound.
        for end, bound, side in ((0, number - 1, 0), (-1, number, 1)):
            if ends and bound in edges:
                most[end] = max(most[end], min(shared(ends[end], bounds[bound]), edges[bound][side]))
        owner, rank, most = np.array(owner, int), np.array(rank, int), np.array(most, int)
        out = []
        for r in np.unique(owner[most >= least]) if len(most) else []:
            own = (owner == r) & (most >= least)
            out.append((names[r], rank[own].tolist(), most[own].tolist()))
        runs_, ranks, mosts = zip(*out, strict=True) if out else ((), (), ())
        ints = pa.list_(pa.int32())
        return pa.table({"run": pa.array(runs_, pa.string()), "rank": pa.array(ranks, ints), "most": pa.array(mosts, ints)})

    return runs.filter("range is not null").select(
        "run", "range", "first", "shared", "sizes", "twice", "tails"
    ).groupBy("range").applyInArrow(merge, "run string, rank array<int>, most array<int>")


FOUND = (
    "_k1 bigint, _k2 bigint, start array<int>, stop array<int>, at array<int>, lo array<int>,"
    " hi array<int>, core array<bigint>, open array<boolean>"
)


def union(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges joined where they touch or overlap, in order."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]


def _coverage(origins: DataFrame, results: DataFrame, length: int) -> DataFrame:
    """Per text: ranges covered by repeated anchors, and the anchors with windows in doubt
    (`open` if the text itself needs them)."""
    names = [f.split()[0] for f in FOUND.split(", ")]

    def judge(key: tuple, own: pa.Table, found: pa.Table) -> pa.Table:
        own_rows = own.to_pylist()
        size = 1 + max((max(r["rank"]) for r in own_rows if r["rank"]), default=0)
        most = np.zeros(size, np.int64)
        for r in found.to_pylist():
            most[r["rank"]] = r["most"]
        out = []
        for r in own_rows:
            at, lo, hi = (np.array(r[c], np.int64) for c in ("at", "lo", "hi"))
            m = most[np.array(r["rank"], int)]
            start, stop = union(at[m >= length], at[m >= length] + length)
            hi = np.minimum(hi, at + m - length)
            left = lo <= hi
            at, lo, hi, core = at[left], lo[left], hi[left], np.array(r["core"], np.int64)[left]
            if not len(at):
                continue
            i = np.searchsorted(start, lo, side="right") - 1
            inside = (i >= 0) & (stop[np.maximum(i, 0)] >= hi + length) if len(start) else np.zeros(len(at), bool)
            out.append((r["_k1"], r["_k2"], start.tolist(), stop.tolist(), at.tolist(), lo.tolist(),
                        hi.tolist(), core.tolist(), (~inside).tolist()))
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int64(), *[ints] * 5, longs, pa.list_(pa.bool_())]
        columns = zip(*out, strict=True) if out else [()] * 9
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return origins.groupBy("run").cogroup(results.groupBy("run")).applyInArrow(judge, FOUND)


def _windows(slices: DataFrame, length: int, back: bool) -> DataFrame:
    """Fingerprints of all windows of different text slices, which occur `n` times each:
    counted per batch, or with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            core, slice_, times = (batch.column(i).to_numpy() for i in range(3))
            asked = batch.column(3).to_numpy(zero_copy_only=False)
            for row, data, offsets in chunks(batch.column(4)):
                prints = Prints(data, 1).all_of(length).view(np.int64)
                counts = np.diff(offsets) - length + 1
                own = np.repeat(np.arange(len(counts)), counts)
                step = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
                prints, own = prints[offsets[own] + step], own + row
                if back:
                    arrays = [core[own], slice_[own], prints, step.astype(np.int32)]
                    names = ["core", "slice", "print", "window"]
                else:
                    pairs = np.stack([core[own], prints])
                    order = np.lexsort(pairs)
                    pairs = pairs[:, order]
                    new = np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(axis=0))
                    at = np.flatnonzero(new)
                    arrays = [pairs[0][at], pairs[1][at], np.add.reduceat(times[own][order], at),
                              np.logical_or.reduceat(asked[own][order], at)]
                    names = ["core", "print", "n", "asked"]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names)

    chosen = slices.select("core", "slice", "n", "open", "bytes")
    if back:
        return chosen.filter("open").mapInArrow(run, "core bigint, slice bigint, print bigint, window int")
    return chosen.mapInArrow(run, "core bigint, print bigint, n bigint, asked boolean")


def _reachable(different: DataFrame, length: int) -> DataFrame:
    """Slices without the first windows that no other slice of their anchor can have, and how
    many were left out (`skip`).

    Equal windows have equal anchors, so the bytes left of the anchor in them are equal too. How
    many of those bytes occur again with the anchor is told by fingerprints, STEP bytes apart.
    """
    steps = different.filter(F.col("left") >= STEP).select("core", "slice", "n", F.explode(F.expr(
        f"transform(sequence({STEP}, left, {STEP}), d -> struct(d AS depth,"
        " xxhash64(substring(bytes, left - d + 1, d)) AS print))"
    )).alias("x")).select("core", "slice", "n", "x.*")
    agreed = steps.groupBy("core", "depth", "print").agg(F.sum("n").alias("_n")).filter("_n > 1").drop("_n")
    depths = steps.join(agreed, ["core", "depth", "print"]).groupBy("core", "slice").agg(
        F.max("depth").alias("_depth")
    )
    skip = F.greatest(F.col("left") - F.coalesce("_depth", F.lit(0)) - (STEP - 1), F.lit(0))
    return different.join(depths, ["core", "slice"], "left").withColumn("skip", skip).filter(
        F.octet_length("bytes") - F.col("skip") >= length
    ).withColumn("bytes", F.expr("substring(bytes, skip + 1, octet_length(bytes) - skip)")).drop("_depth")


def _hot_ends(slices: DataFrame, length: int) -> DataFrame:
    """As `_ends`, for anchors of many slices: each different slice is looked at once, however
    many copies it has, and those of its windows that can occur again are counted by an
    aggregate."""
    placed = slices.withColumn("left", F.col("at") - F.col("lo"))
    hot = stored(placed.withColumn("slice", F.xxhash64("left", "bytes")))
    different = stored(hot.groupBy("core", "slice", "left", "bytes").agg(
        F.count("*").alias("n"), F.max("open").alias("open")
    ))
    reachable = stored(_reachable(different, length))
    again = _windows(reachable, length, back=False).groupBy("core", "print").agg(
        F.sum("n").alias("_n"), F.max("asked").alias("_asked")
    ).filter("_n > 1 and _asked").select("core", "print")
    found = _windows(reachable, length, back=True).join(again, ["core", "print"]).groupBy("core", "slice").agg(
        F.min("window").alias("_first"), F.max("window").alias("_last")
    ).join(reachable.select("core", "slice", "skip"), ["core", "slice"])
    first = F.col("lo") + F.col("skip")
    return hot.filter("open").join(found, ["core", "slice"]).select(
        *KEY, (first + F.col("_first")).alias("start"), (first + F.col("_last") + length).alias("stop")
    )


def _ends(slices: DataFrame, buckets: int, length: int) -> DataFrame:
    """First window and end of the last one that occur again, per open anchor. All slices of
    an anchor's core are in one bucket, so nothing needs to leave it."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        names = [*KEY, "core", "lo", "open"]
        k1, k2, core, lo, asked = (group.column(c).to_numpy() for c in names)
        prints, owners, places = [], [], []
        for row, data, offsets in chunks(group.column("bytes").combine_chunks()):
            counts = np.diff(offsets) - length + 1
            own = np.repeat(np.arange(len(counts)), counts)
            step = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
            window = Prints(data, 1).all_of(length)[offsets[own] + step]
            prints.append(mixed(window ^ core[own + row].view(np.uint64)))
            owners.append((own + row).astype(np.int32))
            places.append(step.astype(np.int32))
        prints, own, place = (np.concatenate(x) for x in (prints, owners, places))
        order = np.argsort(prints)
        equal = np.diff(prints[order]) == 0
        again = np.zeros(len(prints), bool)
        again[order[1:][equal]] = True
        again[order[:-1][equal]] = True
        at = np.flatnonzero(again & asked[own])
        first = at[np.append(True, own[at][1:] != own[at][:-1])] if len(at) else at
        last = at[np.append(own[at][1:] != own[at][:-1], True)] if len(at) else at
        row = own[first]
        return pa.table({
            "_k1": pa.array(k1[row]), "_k2": pa.array(k2[row]),
            "start": pa.array((lo[row] + place[first]).astype(np.int32)),
            "stop": pa.array((lo[row] + place[last] + length).astype(np.int32)),
        })

    return slices.withColumn("bucket", F.pmod(F.hash("core"), F.lit(buckets))).groupBy("bucket").applyInArrow(
        run, "_k1 bigint, _k2 bigint, start int, stop int"
    )


def repeated_ranges(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """Texts that may repeat something (key, text), and per key the byte ranges that do.

    The ranges are the union of all windows of `length` bytes that also start elsewhere, in
    the same or another row of `docs`.
    """
    spark = docs.sparkSession
    reach = int(length * REACH)
    core = length - reach + 1
    keyed = with_key(docs.select("doc_id", "text")).select(*KEY, text_of().alias("text"))
    listed = stored(_anchor_rows(keyed, length, reach))
    twice = listed.select(F.explode("core").alias("core")).groupBy("core").agg(
        F.count("*").alias("_n")
    ).filter("_n > 1").select("core")
    # The windows of a text are dealt to its anchors in order, so a run begins after the last.
    each = listed.select(*KEY, F.explode(F.arrays_zip(
        "at", F.concat(F.array(F.lit(-1)), "hi").alias("lo"), "hi", "core"
    )).alias("x")).filter("x.core is not null").select(
        *KEY, "x.at", (F.col("x.lo") + 1).alias("lo"), "x.hi", "x.core"
    )
    # Written before the texts are read again: what was shuffled for it and `listed` are deleted.
    kept = stored(each.join(twice, "core").groupBy(*KEY).agg(
        F.sort_array(F.collect_set(F.struct("at", "lo", "hi", "core"))).alias("x")
    ))
    drop_stored(listed)
    texts = stored(keyed.join(kept, KEY).select(
        *KEY, "text", F.col("x.at").alias("at"), F.col("x.lo").alias("lo"), F.col("x.hi").alias("hi"),
        F.col("x.core").alias("core"),
    ))
    drop_stored(kept)

    bounds = _bounds(texts, length)
    runs = stored(_runs(texts, bounds, length))
    edges = {
        r[0] - 1: (r[1], r[2])
        for r in runs.filter("range > 0").groupBy("range").agg(F.max("below"), F.max("above")).collect()
    }
    results = _merge_ranges(runs, edges, bounds, core)
    origins = runs.filter("range is null").select("run", *KEY, "at", "lo", "hi", "core", "rank")
    found = stored(_coverage(origins, results, length))
    drop_stored(runs)

    doubts = found.select(
        *KEY, F.explode(F.arrays_zip("at", "lo", "hi", "core", "open")).alias("x")
    ).select(*KEY, "x.*")
    asked = stored(doubts.groupBy("core").agg(
        F.max("open").alias("_asked"), (F.count("*") > HOT_SLICES).alias("hot")
    ).filter("_asked").select("core", "hot"))
    wanted = stored(doubts.join(asked, "core").groupBy(*KEY).agg(
        F.collect_set(F.struct("at", "lo", "hi", "core", "open", "hot")).alias("x"), F.count("*").alias("_n")
    ))
    slices = texts.select(*KEY, "text").join(wanted, KEY).select(
        *KEY, F.encode("text", "UTF-8").alias("_data"), F.explode("x").alias("x")
    ).select(
        *KEY, "x.*", F.expr(f"substring(_data, x.lo + 1, x.hi - x.lo + {length})").alias("bytes")
    )
    buckets = 1 + (wanted.agg(F.sum("_n")).first()[0] or 0) // BUCKET_SLICES
    ends = _ends(slices.filter("not hot"), buckets, length)
    if asked.filter("hot").limit(1).count():
        ends = ends.unionByName(_hot_ends(slices.filter("hot"), length))
    whole = found.select(*KEY, F.explode(F.arrays_zip("start", "stop")).alias("x")).select(*KEY, "x.*")
    ranges = stored(
        whole.unionByName(ends.select(*KEY, "start", "stop")).groupBy(*KEY)
        .agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    )
    drop_stored(found, asked, wanted)
    return texts.select(*KEY, "text"), ranges


def _bounds(texts: DataFrame, length: int) -> list[bytes]:
    """Suffixes that share the sorted suffixes out evenly, from a bounded sample."""
    texts_n, suffixes_n = texts.agg(F.count("*"), F.sum(F.size("at"))).first()
    ranges = -(-(suffixes_n or 0) // RANGE_SUFFIXES)
    if ranges < 2:
        return []
    share = max(1, texts_n // SAMPLED_TEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, at in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                data = text.as_buffer().to_pybytes()
                step = max(1, len(at) // 8)
                out += [data[a : a + length] for a in at[::step]]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["suffix"])

    sample = texts.filter(F.pmod("_k1", F.lit(share)) == 0).select("text", "at").mapInArrow(run, "suffix binary")
    found = sorted({bytes(r[0]) for r in sample.limit(SAMPLED_SUFFIXES).collect()})
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)} if found else [])


CUT = "_k1 bigint, _k2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept string"


def _cut(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                data = text.as_buffer().to_pybytes()
                start, stop = union(*(np.array([r[c] for r in ranges]) for c in ("start", "stop")))
                kept = b"".join(data[a:b] for a, b in zip([0, *stop], [*start, len(data)], strict=True))
                out.append((int((stop - start).sum()), len(start), hashlib.sha256(kept).hexdigest(),
                            kept.decode(errors="ignore")))
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                [f.split()[0] for f in CUT.split(", ")],
            )

    return texts.select(*KEY, "text", "ranges").mapInArrow(run, CUT)


def removed_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty. Repeated rows repeat all of each other's windows. Texts shorter than
    `length` bytes lose nothing. An empty table gives no rows. Only doc_id and text are
    looked at.
    """
    texts, ranges = repeated_ranges(docs, length)
    cut = _cut(texts.join(ranges, KEY)).drop("kept").dropDuplicates(KEY)
    own = with_key(docs.select("doc_id", "text")).select(
        "doc_id", *KEY, F.octet_length(text_of()).cast("long").alias("n_bytes"),
        F.sha2(text_of(), 256).alias("_sha256"),
    )
    zero = F.lit(0).cast("long")
    return own.join(cut, KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "_sha256").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """`docs` with repeated strings cut out of their texts; other columns stay as they are.

    Characters of which only a part is left are dropped. Texts without repeats, null ones
    too, are unchanged.
    """
    texts, ranges = repeated_ranges(docs, length)
    cut = _cut(texts.join(ranges, KEY)).select(*KEY, F.col("kept").alias("_kept")).dropDuplicates(KEY)
    return with_key(docs).join(cut, KEY, "left").select(
        *[F.coalesce("_kept", "text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    )
