"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is put into a leaf. A query visits leaves
best-bin-first: a priority queue holds the branches not taken, nearest centre first. How many
leaves it visits is widened, on sampled queries against brute force over the sample, until
the recall asked for is reached.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinitext.llm.common import stored

FIT_VECTORS = 20_000
BRANCHES = 8
#: Sampled vectors per leaf, about.
LEAF_VECTORS = 64
CALIBRATED_QUERIES = 400
RECALL = 0.98
#: Vectors of a leaf, and queries that visit it, that one task compares.
BLOCK_VECTORS = 20_000
BLOCK_QUERIES = 20_000
SLACK = 1e-9


class Tree:
    """Nested k-means centres: node 0 is the root; leaves are numbered."""

    def __init__(self, vectors: np.ndarray, branches: int, leaf_vectors: int, seed: int = 7):
        self.centres: list[np.ndarray] = []
        self.children: list[list[int]] = []  # a node; or, below zero, -1 - leaf
        self.leaves = 0
        self.random = np.random.default_rng(seed)
        self.root = self._grow(vectors, branches, leaf_vectors)

    def _grow(self, vectors: np.ndarray, branches: int, leaf_vectors: int) -> int:
        if len(vectors) <= leaf_vectors:
            self.leaves += 1
            return -self.leaves
        centres = vectors[self.random.choice(len(vectors), branches, replace=False)]
        for _ in range(8):
            own = (vectors @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
            centres = np.stack([
                vectors[own == k].mean(axis=0) if (own == k).any() else centres[k] for k in range(branches)
            ])
        own = (vectors @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        used = np.unique(own)
        if len(used) < 2:
            self.leaves += 1
            return -self.leaves
        node = len(self.centres)
        self.centres.append(centres[used])
        self.children.append([])
        self.children[node] = [self._grow(vectors[own == k], branches, leaf_vectors) for k in used]
        return node

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector descends to."""
        found = np.zeros(len(vectors), np.int32)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                found[rows] = -1 - node
            elif len(rows):
                centres = self.centres[node]
                own = (vectors[rows] @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
                todo += [(child, rows[own == k]) for k, child in enumerate(self.children[node])]
        return found

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """Leaves in best-bin-first order."""
        queue, found = [(0.0, self.root)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                continue
            away = ((self.centres[node] - query) ** 2).sum(axis=1)
            for d, child in zip(away.tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (d, child))
        return found


def calibrate(tree: Tree, vectors: np.ndarray, n: int, recall: float, queries: int) -> int:
    """Leaves to visit so that sampled queries find that share of their n nearest in the sample."""
    leaf = tree.leaf_of(vectors)
    asked = vectors[:: max(1, len(vectors) // queries)][:queries]
    at = np.arange(0, len(vectors), max(1, len(vectors) // queries))[:queries]
    scores = asked @ vectors.T
    scores[np.arange(len(at)), at] = -2
    near = np.argsort(-scores, axis=1)[:, :n]
    rank = np.full((len(at), tree.leaves), tree.leaves)
    for i, q in enumerate(asked):
        for k, x in enumerate(tree.visits(q, tree.leaves)):
            rank[i, x] = k
    needed = np.sort(np.take_along_axis(rank, leaf[near], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1 if len(needed) else 1


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (doubles) of the vectors that take part: the commonest length, finite, not zero."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sizes = rows.filter("v is not null").groupBy(F.size("v").alias("d")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    good = "vec_id is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('Infinity')) and exists(v, x -> x <> 0)"
    return rows.filter(F.size("v") == (top[0] if top else -1)).filter(good)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest(
    vectors: DataFrame, every: int = 50, n: int = 5, fit_vectors: int = FIT_VECTORS,
    recall: float = RECALL,
) -> DataFrame:
    """query_id, rank, vec_id, score: the n nearest found of each row whose vec_id `every` divides.

    Vectors that are null, zero, of another length, or hold nulls or non-finite numbers take no
    part, nor do rows with a null id. Equal scores go by vec_id; a row is never its own
    neighbour, rows that repeat its id neither. Rows repeated whole count once; an id with
    several vectors asks once, by the least of them, and each of its vectors is a candidate. An empty table gives no rows. Every vector is
    indexed; leaves with many vectors or many queries are dealt to several tasks.
    """
    spark = vectors.sparkSession
    # A row repeated whole is one candidate; an id that asks is one query, by its least vector.
    rows = stored(usable(vectors).dropDuplicates(["vec_id", "v"]))
    total = rows.count()
    share = max(1, total // fit_vectors)
    sample = rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(share)) == 0).select("v").limit(2 * fit_vectors)
    held = sample.toPandas()["v"].tolist()
    result = "query_id bigint, vec_id bigint, score double"
    if not held:
        return spark.createDataFrame([], result).select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    fitted = _unit(np.unique(np.array(held, dtype=float), axis=0))
    fitted = fitted[np.random.default_rng(1).permutation(len(fitted))]
    tree = Tree(fitted, BRANCHES, LEAF_VECTORS)
    most = calibrate(tree, fitted, n, recall, CALIBRATED_QUERIES)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaf_of(_unit(_matrix(batch.column(1)))) if len(batch) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), *batch.columns], ["leaf", "vec_id", "v"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            found = [tree.visits(q, most) for q in _unit(_matrix(batch.column(1)))]
            own = np.repeat(np.arange(len(found)), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).astype(np.int32)), *[c.take(pa.array(own)) for c in batch.columns]],
                ["leaf", "query_id", "q"],
            )

    indexed = stored(rows.mapInArrow(index, "leaf int, vec_id bigint, v array<double>"))
    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy(F.col("vec_id").alias("query_id")).agg(
        F.min("v").alias("q"))
    visiting = stored(asked.mapInArrow(route, "leaf int, query_id bigint, q array<double>"))
    # One row per leaf, and the sample bounds the leaves.
    parts = F.broadcast(
        indexed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("_of")).join(
            visiting.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("_asked")), "leaf"
        )
    )
    each_part, each_ask = (F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("_of", "_asked"))
    blocks = indexed.join(parts, "leaf").withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("_of")).cast("int")
    ).withColumn("ask", each_ask)
    routed = visiting.join(parts, "leaf").withColumn("part", each_part).withColumn(
        "ask", F.pmod(F.xxhash64("query_id"), F.col("_asked")).cast("int")
    )

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if len(left) and len(right):
            ids = right.column("vec_id").to_numpy()
            x = _matrix(right.column("v").combine_chunks())
            sizes, units = np.sqrt((x * x).sum(axis=1)), _unit(x)
            queries = _matrix(left.column("q").combine_chunks())
            names = left.column("query_id").to_numpy()
            for a in range(0, len(names), 256):
                coarse = _unit(queries[a : a + 256]) @ units.T
                for i, row in enumerate(coarse):
                    name, q = names[a + i], queries[a + i]
                    row[ids == name] = -2
                    least = np.partition(row, -n)[-n] if len(row) > n else -1.5
                    at = np.flatnonzero(row >= max(least - SLACK, -1.5))
                    # The same sum in the same order for equal vectors, so that ties are ties.
                    score = (x[at] * q).sum(axis=1) / (np.sqrt((q * q).sum()) * sizes[at])
                    best = np.lexsort([ids[at], -score])[:n]
                    out_q += [name] * len(best)
                    out_v += ids[at][best].tolist()
                    out_s += score[best].tolist()
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()),
                         "score": pa.array(out_s, pa.float64())})

    block = ["leaf", "part", "ask"]
    found = routed.select(*block, "query_id", "q").groupBy(*block).cogroup(
        blocks.select(*block, "vec_id", "v").groupBy(*block)
    ).applyInArrow(compare, result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select(
        "query_id", "rank", "vec_id", "score"
    )
