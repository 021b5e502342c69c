"""Best-fit packing by linear grouping.

Large lengths are rounded up within groups of equal cardinality, a linear programme over
configurations of the few rounded sizes says how many sequences of each configuration to
fill, actual documents take the rounded slots, and what is left, small documents above all,
goes best-fit into the gaps. All of that happens on counts per length (at most `capacity`
numbers, whatever the corpus), on the driver; documents are ranked within their length by
Spark and look their place up by rank.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinitext.llm.common import stored, text_of

CAPACITY = 1024
END_ID = 2
#: Lengths up to this share of a sequence are small.
SMALL_SHARE = 1 / 16
#: Rounded sizes of the linear programme.
GROUPS = 128
#: The programme ends when its value is within this share of the optimum, or after so many
#: pivots; any of its bases is a valid packing.
CLOSE = 0.002
PIVOTS = 2500
#: Rows of one length that one task ranks.
RANKED_ROWS = 200_000
#: Distinct words whose ids a worker remembers.
REMEMBERED = 300_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", sequence_id bigint, offset bigint"


def encoder(path: str | None = None):
    """text -> ids as little-endian unsigned 32-bit bytes, for the vocabulary of byte_bpe_50k.json.

    The rank file holds the same vocabulary and merges. A single space between two other
    characters always begins a new pre-token, so words are encoded once and remembered.
    """
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    special = "<|endoftext|>"
    coder = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
        special_tokens={special: 50256},
    )

    def encode(text: str) -> bytes:
        return np.asarray(coder.encode(text, allowed_special="all"), dtype="<u4").tobytes()

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            found = np.asarray(coder.encode_ordinary(" " + word), dtype="<u4").tobytes()
            if len(self) < REMEMBERED and len(word) < 64:
                self[word] = found
            return found

    words, unclear = Words(), re.compile(r" \s|\s ")

    def ids(text: str) -> bytes:
        if unclear.search(text) or special in text:
            return encode(text)
        first, *rest = text.split(" ")
        return encode(first) + b"".join([words[w] for w in rest])

    return ids


def cut(length: int, capacity: int) -> list[int]:
    """Bounds of the pieces of a document: whole sequences, a shorter one first."""
    if length <= capacity:
        return [0, length]
    return [0, *range(length % capacity or capacity, length + 1, capacity)]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece of every document; a null text is empty and has the end id only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end = encoder(path), np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            out = []
            for doc_id, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                data = ids(text.as_py()) + end
                at = cut(len(data) // 4, capacity)
                for k, (a, b) in enumerate(zip(at, at[1:], strict=False)):
                    out.append((doc_id, k, a, b - a, zlib.crc32(data[4 * a : 4 * b])))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return chosen.mapInArrow(run, PIECES)


def configurations(sizes: list[int], wanted: list[int], capacity: int, pivots: int = PIVOTS):
    """Whole numbers of sequences for configurations of few sizes.

    The linear programme min sum(x), A x >= wanted is solved by the revised simplex method;
    a knapsack over the capacities prices new configurations. Fractions are rounded down.
    """
    k = len(sizes)
    size, need = np.array(sizes), np.array(wanted, float)
    basis = np.diag((capacity // size).astype(float))
    inverse = np.diag(1 / (capacity // size))
    x = need / (capacity // size)
    for _ in range(pivots):
        dual = inverse.sum(axis=0)
        value, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(size.min()), capacity + 1):
            n = np.searchsorted(size, c, side="right")
            gains = dual[:n] + value[c - size[:n]]
            best = int(gains.argmax())
            if gains[best] > value[c - 1] + 1e-12:
                value[c], took[c] = gains[best], best
            else:
                value[c] = value[c - 1]
        if value[capacity] <= 1 + CLOSE:  # Farley's bound
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if took[c] < 0:
                c -= 1
            else:
                column[took[c]] += 1
                c -= size[took[c]]
        direction = inverse @ column
        steps = np.where(direction > 1e-9, x / np.where(direction > 1e-9, direction, 1), np.inf)
        leaves = int(steps.argmin())
        step = steps[leaves]
        x = x - step * direction
        x[leaves] = step
        row = inverse[leaves] / direction[leaves]
        inverse = inverse - np.outer(direction, row)
        inverse[leaves] = row
        basis[:, leaves] = column
    whole = np.floor(np.maximum(x, 0) + 1e-6).astype(np.int64)
    return [(basis[:, j].astype(int), int(whole[j])) for j in range(k) if whole[j] > 0]


class Plan:
    """Which ranks of each length go to which sequences, as ranges of equal layout."""

    def __init__(self, counts: dict[int, int], capacity: int, groups: int, small_share: float):
        self.capacity = capacity
        self.left = {s: n for s, n in sorted(counts.items()) if n > 0}
        self.rank = dict.fromkeys(self.left, 0)
        self.ranges: list[tuple[int, int, int, int, int]] = []  # length, lo, hi, sequence, offset
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # free -> (first sequence, how many)
        self._large(groups, int(capacity * small_share))
        for s in sorted(self.left, reverse=True):
            self._best_fit(s)

    def _put(self, s: int, n: int, sequence: int, offset: int) -> None:
        lo = self.rank[s]
        self.ranges.append((s, lo, lo + n, sequence, offset))
        self.rank[s] += n
        self.left[s] -= n

    def _large(self, groups: int, small: int) -> None:
        lengths = [s for s in self.left if s > small]
        total = sum(self.left[s] for s in lengths)
        if not total:
            return
        members: list[list[int]] = [[]]
        seen = 0
        for s in lengths:  # a length stays in one group, so groups are equal to within one length
            if members[-1] and seen >= total * len(members) / groups:
                members.append([])
            members[-1].append(s)
            seen += self.left[s]
        tops = [m[-1] for m in members]
        wanted = [sum(self.left[s] for s in m) for m in members]
        for column, x in configurations(tops, wanted, self.capacity):
            slots = [g for g in np.flatnonzero(column)[::-1] for _ in range(column[g])]
            while x > 0:
                # The largest members of each group go first; a group that ran out leaves a gap.
                held: dict[int, int] = {}
                picks = []
                for g in slots:
                    s = next((s for s in reversed(members[g]) if self.left[s] > held.get(s, 0)), 0)
                    if s:
                        held[s] = held.get(s, 0) + 1
                        picks.append(s)
                if not picks:
                    break
                n = min(x, *(self.left[s] // held[s] for s in held))
                offset = 0
                for s in picks:
                    self._put(s, n, self.sequences, offset)
                    offset += s
                self._open(self.capacity - offset, self.sequences, n)
                self.sequences += n
                x -= n

    def _open(self, free: int, first: int, n: int) -> None:
        if free and n:
            self.gaps.setdefault(free, []).append((first, n))

    def _best_fit(self, s: int) -> None:
        while self.left[s]:
            free = min((f for f in self.gaps if f >= s), default=0)
            if not free:
                n = -(-self.left[s] // (self.capacity // s))
                self._open(self.capacity, self.sequences, n)
                self.sequences += n
                continue
            first, n = self.gaps[free].pop()
            if not self.gaps[free]:
                del self.gaps[free]
            each = min(free // s, self.left[s])
            full = min(n, self.left[s] // each)
            for j in range(each):
                self._put(s, full, first, self.capacity - free + j * s)
            self._open(free - each * s, first, full)
            self._open(free, first + full, n - full)


def pack(
    docs: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS,
    small_share: float = SMALL_SHARE, path: str | None = None,
) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    Null and empty texts are a piece of one id; repeated rows are packed each on its own; a
    null doc_id is kept; an empty table gives no rows. Columns of `docs` other than doc_id
    and text are not looked at. Reads the texts once and writes the pieces (a few numbers
    each) to the shared folder.
    """
    cut_up = stored(pieces(docs, capacity, path))
    counts = {r[0]: r[1] for r in cut_up.groupBy("length").count().collect()}  # <= capacity rows
    shares = max(1, sum(counts.values()) // RANKED_ROWS)
    plan = Plan(counts, capacity, groups, small_share)

    # Rank within a length: shares are numbered on their own, then moved behind one another.
    share = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares)).alias("_share")
    rows = cut_up.select("*", share)
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(
        Window.unboundedPreceding, -1
    )
    firsts = rows.groupBy("length", "_share").agg(F.count("*").alias("_n")).select(
        "length", "_share", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
    )
    inside = Window.partitionBy("length", "_share").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.join(firsts, ["length", "_share"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("_first") + F.row_number().over(inside) - 1).alias("_rank"),
    )

    by_length: dict[int, np.ndarray] = {}
    for s, lo, _, sequence, offset in sorted(plan.ranges):
        by_length.setdefault(s, []).append((lo, sequence, offset))
    by_length = {s: np.array(r, dtype=np.int64) for s, r in by_length.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(length):
                own = np.flatnonzero(length == s)
                ranges = by_length[int(s)]
                at = np.searchsorted(ranges[:, 0], rank[own], side="right") - 1
                sequence[own] = ranges[at, 1] + rank[own] - ranges[at, 0]
                offset[own] = ranges[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, PLACED)
