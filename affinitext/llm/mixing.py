"""Mixing sources to target weights on a low-discrepancy schedule.

Golden-ratio points, mapped through the cumulative target shares, name the source of every
slot of the mix. The slots of a source are ranked, and its k-th slot takes the k-th block of
equally many words of its shuffled documents, read over again where a target asks for more
than the source has.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinitext.llm.common import KEY, count_words, stored, text_of, with_key

WEIGHTS = (5.0, 2.0, 1.0)
#: Size of the mix, as a share of all sizes.
TOTAL = 1.5
#: No target is above so many times its source's size.
REPEATS = 2
#: Words of a block at most; a corpus of fewer than this many times `SLOTS` gets smaller ones.
BLOCK_WORDS = 8192
SLOTS = 100_000
#: Documents, or slots, that one task puts in order.
ORDERED_ROWS = 20_000
GOLDEN = 0.6180339887498949


class Target(NamedTuple):
    source: str | None
    size: int
    target: float


def source_targets(
    sizes: list[tuple[str | None, int]], weights=WEIGHTS, total=TOTAL, repeats=REPEATS
) -> list[Target]:
    """Targets by weight, each stopped at `repeats` times its source, the excess reshared.

    Weights repeat over the sources in code point order, null last.
    """
    sizes = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    weight = {source: weights[i % len(weights)] for i, (source, _) in enumerate(sizes)}
    rest, shared = total * sum(n for _, n in sizes), sum(weight.values())
    found = {}
    for source, n in sorted(sizes, key=lambda x: repeats * x[1] / weight[x[0]]):
        found[source] = min(repeats * n, rest * weight[source] / shared)
        rest -= found[source]
        shared -= weight[source]
    return [Target(source, n, float(found[source])) for source, n in sizes]


def _name(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def _running(*by: str):
    return Window.partitionBy(by[0]).orderBy(*by[1:]).rowsBetween(Window.unboundedPreceding, -1)


def schedule(spark: SparkSession, targets: list[Target], block: int) -> DataFrame:
    """_s, block, slot: the slot of the mix at which a block of a source is read.

    Every source gets the blocks its target needs: golden-ratio points beyond that are left
    unused, and blocks that the points did not reach follow at the end. Slots are ranked in
    two steps, per chunk of slots and over the chunks' counts, so no source meets in one task.
    """
    used = [t for t in targets if int(t.target) > 0]
    names = ["n" if t.source is None else "s" + t.source for t in used]
    needs = [-(-int(t.target) // block) for t in used]
    n = sum(needs)
    edges = np.cumsum([0, *needs])[:-1] / max(n, 1)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(0).to_numpy()
            own = np.searchsorted(edges, np.modf(slot * GOLDEN)[0], side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(own.astype(np.int64))], ["slot", "_i"]
            )

    drawn = spark.range(n if used else 0).mapInArrow(draw, "slot bigint, _i bigint").withColumn(
        "_chunk", F.floor(F.col("slot") / ORDERED_ROWS)
    )
    counts = drawn.groupBy("_i", "_chunk").count()
    firsts = counts.withColumn(
        "_first", F.coalesce(F.sum("count").over(_running("_i", "_chunk")), F.lit(0))
    ).drop("count")
    inside = Window.partitionBy("_i", "_chunk").orderBy("slot")
    facts = spark.createDataFrame(
        [(i, s, k) for i, (s, k) in enumerate(zip(names, needs, strict=True))],
        "_i bigint, _s string, _need bigint",
    )
    ranked = drawn.join(firsts, ["_i", "_chunk"]).select(
        "_i", "slot", (F.col("_first") + F.row_number().over(inside) - 1).alias("block")
    )
    reached = facts.join(counts.groupBy("_i").agg(F.sum("count").alias("_n")), "_i", "left")
    missing = reached.filter("coalesce(_n, 0) < _need").select(
        "_s", F.explode(F.sequence(F.coalesce("_n", F.lit(0)), F.col("_need") - 1)).alias("block"),
        F.lit(n).cast("bigint").alias("slot"),
    )
    return (
        ranked.join(facts, "_i").filter("block < _need").select("_s", "block", "slot")
        .unionByName(missing)
    )


class Mix(NamedTuple):
    #: doc_id, source, size, source_size, target and the row's key, one row per document
    documents: DataFrame
    #: slot, first_word, n_words of the document with that key: the mix itself
    reads: DataFrame


def mix(
    docs: DataFrame, weights=WEIGHTS, total: float = TOTAL, repeats: int = REPEATS,
    block_words: int = BLOCK_WORDS, slots: int = SLOTS,
) -> Mix:
    """Which words of which documents stand at which slot of the mix.

    A null text has size 0 and is never read; a null source is a source of its own; repeated
    rows each count, and rows that differ in source only are documents of their own sources; an empty table gives an empty mix. Sources are known to the driver (one
    number each); documents are ordered by a hash of doc_id and text, in buckets of about
    `ORDERED_ROWS`, with the buckets' sums added up over the buckets.
    """
    spark = docs.sparkSession
    rows = (
        with_key(docs.select("doc_id", "text", "source"), "source")
        .select("doc_id", F.col("source").cast("string").alias("source"), *KEY,
                count_words(text_of()).alias("size"))
        .groupBy("doc_id", "source", *KEY, "size").agg(F.count("*").alias("_m"))
        .withColumn("_s", _name(F.col("source")))
    )
    rows = stored(rows)
    sums = rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("_m")).alias("size"), F.count("*").alias("n")
    ).collect()
    targets = source_targets([(r[0], r[1]) for r in sums], weights, total, repeats)
    words = sum(int(t.target) for t in targets)
    block = max(1, min(block_words, words // slots))
    bits = max(0, (sum(r[2] for r in sums) // ORDERED_ROWS).bit_length())

    facts = F.broadcast(
        spark.createDataFrame(
            [("n" if t.source is None else "s" + t.source, t.size, t.target) for t in targets],
            "_s string, source_size bigint, target double",
        )
    )
    rows = rows.withColumn("_bucket", F.shiftright("_k1", 64 - bits) if bits else F.lit(0))
    weight = F.col("size") * F.col("_m")
    firsts = rows.groupBy("_s", "_bucket").agg(F.sum(weight).alias("_n")).select(
        "_s", "_bucket",
        F.coalesce(F.sum("_n").over(_running("_s", "_bucket")), F.lit(0)).alias("_first"),
    )
    inside = Window.partitionBy("_s", "_bucket").orderBy(*KEY, "doc_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = (
        rows.join(firsts, ["_s", "_bucket"])
        .withColumn("_start", F.col("_first") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m") - 1)))
        .withColumn("_start", F.col("_start") + F.col("_copy") * F.col("size"))
        .join(facts, "_s")
    )
    last = F.floor(F.col("target"))
    passes = placed.filter("size > 0").withColumn(
        "_pass", F.explode(F.array(*[F.lit(i) for i in range(repeats)]))
    ).withColumn("_at", F.col("_start") + F.col("_pass") * F.col("source_size")).withColumn(
        "_end", F.least(F.col("_at") + F.col("size"), last)
    ).filter("_at < _end")
    blocks = passes.withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("_at") / block), F.floor((F.col("_end") - 1) / block))),
    )
    lo = F.greatest("_at", F.col("block") * block)
    hi = F.least("_end", (F.col("block") + 1) * block)
    reads = blocks.join(schedule(spark, targets, block), ["_s", "block"]).select(
        "slot", "doc_id", "source", *KEY, "_copy", "block",
        (lo - F.col("_at")).alias("first_word"), (hi - lo).alias("n_words"),
    )
    documents = placed.select("doc_id", "source", "size", "source_size", "target", *KEY, "_copy")
    return Mix(documents, reads)


def taken_words(mixed: Mix) -> DataFrame:
    """One row per document with the words the mix reads of it, repeats counted."""
    own = [*KEY, "_copy"]
    taken = mixed.reads.groupBy(*own).agg(F.sum("n_words").alias("taken"))
    return mixed.documents.join(taken, own, "left").withColumn(
        "taken", F.coalesce("taken", F.lit(0).cast("bigint"))
    )


def repeat_documents(docs: DataFrame, **settings) -> DataFrame:
    """`docs` as often as the mix reads them, in whole documents, with all their columns.

    A document read in part once, or in part a second time, is there once, or twice; one that
    is not read is left out. Documents without words are kept once. Columns of `docs` keep
    their names and values, whatever they are called.
    """
    counts = taken_words(mix(docs, **settings)).groupBy(*KEY).agg(
        F.sum(F.when(F.col("size") == 0, 1).otherwise(F.ceil(F.col("taken") / F.col("size"))))
        .alias("__n"), F.count("*").alias("__rows"),
    )
    names = docs.columns
    held = docs.select(
        *[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)], "doc_id", "text", "source"
    )
    keyed = with_key(held, "source").join(counts, KEY)
    # Rows that share a key share its copies.
    each = F.ceil(F.col("__n") / F.col("__rows")).cast("int")
    return keyed.withColumn("__i", F.explode(F.array_repeat(F.lit(0), each))).select(
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(names)]
    )
