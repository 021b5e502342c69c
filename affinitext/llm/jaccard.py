"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Two sets that share o tokens share the first l of them within the first |x| - o + l tokens of
each, in any order common to all sets. So a set may pick a longer prefix (a larger l) when
its tokens are so common that one match would bring too many candidates, and in return only
pairs with l matches are verified.

1. Sieve. In fingerprint order, with l a sixteenth of the set, a set stays only if enough of
   its prefix occurs in other prefixes. Prefixes travel as compressed runs.
2. Order. Tokens of the sets left are counted and ordered from rare to common.
3. Hubs. For each prefix token the set with the fewest tokens of its own is paired with the
   others; links that verify already join most groups of near copies.
4. Rest. Sets of different components that still meet are paired, given l matches and sizes
   and places that allow the similarity, and verified.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinitext.llm.common import KEY, drop_stored, stored, text_of, with_key
from affinitext.llm.components import components
from affinitext.llm.hashing import shingle_sets

#: Documents whose prefix tokens one reducing task compares.
DOCS_PER_TASK = 4096
BLOCK_DOCS = 8192
BLOCK_TOKENS = 2_000_000
SIEVE = 16
MOST = 4
#: Cost of verifying a pair, in units of reading one entry of a token's list.
VERIFY_COST = 20
MANY = 0xFFFF


def needed(n: int, percent: int) -> int:
    """Least overlap of a set of n tokens with any partner."""
    return -(-n * percent // 100)


def packed(values: np.ndarray) -> bytes:
    """Rising 64-bit numbers, as differences in byte planes, compressed."""
    steps = np.diff(values, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(1).compress(
        np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()
    )


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


RUNS = (
    "block string, part int, doc_id bigint, _k1 bigint, _k2 bigint, n bigint, a bigint, b bigint,"
    " tokens binary, places binary"
)


def _runs(docs: DataFrame, percent: int, width: int, bits: int) -> DataFrame:
    """Two kinds of rows: per document its set (part = place in the block), per block and
    range of fingerprints (n null) a run of prefix tokens with their documents' places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in RUNS.split(",")]
        kinds = [pa.string(), pa.int32(), *[pa.int64()] * 6, pa.binary(), pa.binary()]

        def emitted(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

        def closed(block: str, rows: list[tuple], held: list[np.ndarray]):
            place = np.repeat(np.arange(len(held)), [len(h) for h in held])
            token = np.concatenate(held) if held else np.zeros(0, np.uint64)
            order = np.argsort(token, kind="stable")
            token, place = token[order], place[order]
            new = np.ones(len(token), bool)
            new[1:] = token[1:] != token[:-1]
            single = new & np.append(new[1:], True)
            # A token that several documents of the block have is counted here, and sent once.
            here = np.bincount(place[~single], minlength=len(held))
            own = np.where(single, place, MANY)[new].astype(np.uint16)
            token = token[new]
            at = np.searchsorted(token, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
            at = [0, *at, len(token)]
            out = [(block, k, *row, here[k].astype("<u4").tobytes(), None) for k, row in enumerate(rows)]
            for part, (lo, hi) in enumerate(zip(at, at[1:], strict=False)):
                if hi > lo:
                    places = zstandard.ZstdCompressor(1).compress(own[lo:hi].tobytes())
                    out.append((block, part, *[None] * 6, packed(token[lo:hi]), places))
            return emitted(out)

        rows, held, total = [], [], 0
        for batch in batches:
            ids = zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)
            for own, tokens in zip(ids, shingle_sets(batch.column(3), width), strict=True):
                n = len(tokens)
                node = np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), np.int64)
                rows.append((*own, n, int(node[0]), int(node[1])))
                held.append(tokens[: n - needed(n, percent) + max(1, n // SIEVE)])
                total += len(held[-1])
                if len(rows) >= BLOCK_DOCS or total >= BLOCK_TOKENS:
                    yield closed(uuid.uuid4().hex, rows, held)
                    rows, held, total = [], [], 0
        if rows:
            yield closed(uuid.uuid4().hex, rows, held)

    return docs.select(F.col("doc_id").cast("bigint"), *KEY, text_of().alias("text")).mapInArrow(run, RUNS)


def _shared_counts(runs: DataFrame) -> DataFrame:
    """block, counts: how many prefix tokens of each document other blocks have too."""

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        tokens = [unpacked(x.as_py()) for x in group.column("tokens")]
        sizes = [len(t) for t in tokens]
        token = np.concatenate(tokens)
        order = np.argsort(token, kind="stable")
        ranked = token[order]
        same = np.zeros(len(token), bool)
        equal = ranked[1:] == ranked[:-1]
        same[1:] |= equal
        same[:-1] |= equal
        shared = np.zeros(len(token), bool)
        shared[order] = same
        out, at = [], 0
        for places, n in zip(group.column("places"), sizes, strict=True):
            place = np.frombuffer(zstandard.ZstdDecompressor().decompress(places.as_py()), np.uint16)
            hit = place[shared[at : at + n] & (place != MANY)]
            out.append(np.bincount(hit, minlength=1).astype("<u4").tobytes())
            at += n
        return pa.table({"block": group.column("block"), "counts": pa.array(out, pa.binary())})

    def summed(key: tuple, group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x.as_py(), "<u4") for x in group.column("counts")]
        total = np.zeros(max(map(len, parts)), np.int64)
        for p in parts:
            total[: len(p)] += p
        found = np.flatnonzero(total)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()] * len(found), pa.string()),
                "part": pa.array(found, pa.int32()), "_elsewhere": pa.array(total[found], pa.int64()),
            }
        )

    lists = runs.filter("n is null").select("block", "part", "tokens", "places")
    counts = lists.groupBy("part").applyInArrow(compare, "block string, counts binary")
    return counts.groupBy("block").applyInArrow(summed, "block string, part int, _elsewhere bigint")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1), width)]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                ["node", "tokens"],
            )

    return docs.select("node", text_of().alias("text")).mapInArrow(
        run, "node struct<a:bigint,b:bigint>, tokens array<bigint>"
    )


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """token, node, n, own (tokens no other set has), place, l of every set's prefix."""
    spread = sets.select("node", F.size("tokens").cast("long").alias("n"), F.explode("tokens").alias("token"))
    counts = spread.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    listed = spread.join(counts, "token").groupBy("node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("common")
    )
    n, own = F.col("n"), F.col("own")
    spare = n - F.ceil(n * percent / 100)
    listed = listed.withColumn("own", n - F.size("common")).withColumn("spare", spare - own)
    # Reading the lists of the l-prefix, and verifying what has l matches there at most.
    costs = F.array(
        *[
            F.struct(
                (F.expr(f"aggregate(slice(common, 1, greatest(0, cast(spare as int) + {k})), 0L, (s, x) -> s + x.df)")
                 * (1 + VERIFY_COST / k)).alias("cost"),
                F.lit(k).alias("l"),
            )
            for k in range(1, MOST + 1)
        ]
    )
    # No pair can be asked for more matches than it is sure to have.
    costs = F.slice(costs, 1, F.greatest(F.lit(1), F.least(F.lit(MOST), F.ceil(n * percent / 100).cast("int"))))
    chosen = listed.filter(F.col("spare") + 1 > 0).withColumn("l", F.array_min(costs)["l"])
    taken = F.slice("common", 1, (F.col("spare") + F.col("l")).cast("int"))
    return chosen.select("node", "n", "own", "l", F.posexplode(taken).alias("i", "x")).select(
        F.col("x.token").alias("token"), "node", "n", "own", "l", (own + F.col("i")).alias("place")
    )


def _possible(percent: int):
    """Sizes n, m and places i, j of the first shared token allow the similarity."""
    least = f"ceil({percent} * (n + m) / {100 + percent})"
    return F.expr(f"least(n - i, m - j) >= {least} and least(n, m) * 100 >= greatest(n, m) * {percent}")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("_y"))
    both = F.size(F.array_intersect("_x", "_y"))
    union = F.size("_x") + F.size("_y") - both
    return pairs.join(left, "a").join(right, "b").filter(both * 100 >= union * percent).select("a", "b")


def links(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the distinct `sets`: enough to join every pair that is similar.

    Pairs that earlier links already put into one component are not looked at.
    """
    prefixes = stored(_prefixes(sets, percent))
    hubs = prefixes.groupBy("token").agg(
        F.min(F.struct((F.col("own") * 1000 / F.col("n")).cast("int").alias("share"),
                       F.col("node").alias("b"), F.col("n").alias("m"), F.col("place").alias("j"))).alias("hub")
    ).select("token", "hub.b", "hub.m", "hub.j")
    near = prefixes.select("token", F.col("node").alias("a"), "n", F.col("place").alias("i")).join(
        hubs, "token"
    ).filter(F.col("a") != F.col("b")).filter(_possible(percent)).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()
    first = stored(_verified(near, sets, percent))
    roots = components(first)

    labelled = prefixes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_tokens = labelled.groupBy("token").agg(
        F.min("root").alias("_lo"), F.max("root").alias("_hi")
    ).filter("_lo <> _hi").select("token")
    rest = stored(labelled.join(open_tokens, "token").withColumn(
        "band", F.floor(F.log(F.col("n")) / np.log(100 / percent)).cast("int")
    ))
    smaller = rest.select(
        "token", "band", F.col("node").alias("a"), "n", F.col("place").alias("i"),
        F.col("root").alias("_ra"), F.col("l").alias("_la"),
    ).filter(f"{percent} * 2 * n <= {100 + percent} * (n - i)")
    larger = rest.select(
        "token", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"),
        F.col("node").alias("b"), F.col("n").alias("m"), F.col("place").alias("j"),
        F.col("root").alias("_rb"), F.col("l").alias("_lb"),
    )
    pairs = smaller.join(larger, ["token", "band"]).filter("_ra <> _rb").filter(
        "n < m or (n = m and a < b)"
    ).filter(_possible(percent))
    # Only the first match is sure to lie that early; all are counted over the whole l-prefixes.
    pairs = stored(pairs.groupBy("a", "b").agg(F.first(F.least("_la", "_lb")).alias("_l")))
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    heads = stored(rest.join(nodes, "node", "left_semi").groupBy("node").agg(F.collect_list("token").alias("head")))
    met = F.size(F.array_intersect("_x", "_y"))
    pairs = pairs.join(heads.select(F.col("node").alias("a"), F.col("head").alias("_x")), "a").join(
        heads.select(F.col("node").alias("b"), F.col("head").alias("_y")), "b"
    ).filter(met >= F.col("_l")).select("a", "b")
    return first.unionByName(_verified(pairs, sets, percent))


def near_duplicates(docs: DataFrame, percent: int = 75, width: int = 5) -> DataFrame:
    """One row per document: doc_id, its key, n_shingles, component_id.

    A null text is empty; documents without words are linked with nothing, not even with each
    other; equal sets are linked, so repeated rows and copies share a component; a null
    doc_id is never a component's name unless there is no other; an empty table gives no
    rows. Only doc_id and text are looked at.
    """
    spark = docs.sparkSession
    keyed = with_key(docs.select("doc_id", "text"))
    bits = max(0, (docs.count() // DOCS_PER_TASK).bit_length())
    runs = stored(_runs(keyed, percent, width, bits))
    counts = stored(_shared_counts(runs))
    rows = stored(runs.filter("n is not null").drop("places").withColumn("node", F.struct("a", "b")))
    drop_stored(runs)
    here = F.conv(F.hex(F.reverse("tokens")), 16, 10).cast("long")
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * percent / 100) / SIEVE))
    kept = rows.filter("n > 0").join(counts, ["block", "part"], "left").filter(
        here + F.coalesce("_elsewhere", F.lit(0)) >= least
    )
    chosen = kept.groupBy("node").agg(F.min(F.struct(*KEY)).alias("_one")).select("node", "_one.*")
    texts = keyed.select(*KEY, "text").join(chosen, KEY).dropDuplicates(KEY)
    # The numbers are settled by the writing; they are shorter than nodes.
    sets = stored(_sets(texts, width).withColumn("id", F.monotonically_increasing_id()))
    nodes = sets.select("id", "node")
    found = stored(links(sets.select(F.col("id").alias("node"), "tokens"), percent))
    roots = (
        components(found)
        .join(nodes.select(F.col("id").alias("node"), F.col("node").alias("_node")), "node")
        .join(nodes.select(F.col("id").alias("root"), F.col("node").alias("_root")), "root")
        .select(F.col("_node").alias("node"), F.col("_root").alias("root"))
    )
    named = rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("_id")).join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("_id").alias("component_id"))
    classes = named.select("node", "root").join(names, "root").select("node", "root", "component_id")
    return rows.select("doc_id", *KEY, F.col("n").alias("n_shingles"), "node").join(
        classes, "node", "left"
    ).select(
        "doc_id", *KEY, "n_shingles", "root",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """One document of each component, with all its columns: that of the smallest doc_id.

    Documents without words are all kept.
    """
    found = stored(near_duplicates(docs, **settings))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *KEY)).alias("_one")
    ones = found.filter("n_shingles > 0").groupBy("root").agg(first).select("_one._k1", "_one._k2")
    empty = found.filter("n_shingles = 0").select(*KEY).distinct()
    keyed = with_key(docs)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return keyed.join(ones, KEY, "left_semi").dropDuplicates(KEY).select(*columns).unionByName(
        keyed.filter(F.trim(F.translate(text_of(), "\t\n\x0b\x0c\r", "     ")) == "")
        .join(empty, KEY, "left_semi").select(*columns)
    )
