"""A Merkle manifest of a table: a hash per row, a tree per group, a root over the groups, and
the proof of every row.

Rows are ranked within their group, and the binary digits of the rank become columns. Within
blocks of `HEIGHT` levels the lowest digit column is grouped away, again and again, each group
nesting the structs of its (at most two) children, so that a block's root struct holds its
whole subtree and no more. A transform over that struct walks down again and explode gives
every bottom node its path through the block. The block roots are the next band's rows; the
paths of the bands are joined top-down, one row per block on one side, so every key holds at
most 2**HEIGHT rows. Root, group root and the check of a changed row are folds of the path, so
no row waits for a join with the root.

The plain join-free form (one nested struct per group, exploded once) would hold a whole group
in one task; bands bound that, at the cost of one join per band.

Hashes: H(x) is the lowercase hex SHA-256 of the UTF-8 bytes of x; nodes hash the hex digests
of their children, concatenated. At every level the nodes of a group are taken two by two in
order; a last lone node is hashed alone; a group left with one node stops there (a group of
one row has its leaf as root).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinitext.llm.common import stored

#: Levels of a block: a block root struct holds at most 2**HEIGHT bottom nodes.
HEIGHT = 8
#: A rank table of at most so many rows (partitions times groups) is broadcast.
BROADCAST_ROWS = 1_000_000
#: Fields of a leaf of `documents`, in this order (fixed).
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 byte count, `:` and the value (integers in decimal)."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    """H of the encoded fields, concatenated."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def group_key(value: Column) -> Column:
    """Binary that sorts null first, then by UTF-8 bytes (compared unsigned)."""
    return F.when(value.isNull(), F.lit(bytearray(b"\x00"))).otherwise(
        F.concat(F.lit(bytearray(b"\x01")), value.cast("string").cast("binary"))
    )


def fold(start: Column, path: Column) -> Column:
    """The hash reached from `start` by the steps of `path`, bottom up."""

    def step(acc: Column, s: Column) -> Column:
        paired = F.when(s["bit"] == 0, F.concat(acc, s["sib"])).otherwise(F.concat(s["sib"], acc))
        return (
            F.when(s["op"] == "pair", F.sha2(paired, 256))
            .when(s["op"] == "lone", F.sha2(acc, 256))
            .otherwise(acc)
        )

    return F.aggregate(path, start, step)


def proof_digest(path: Column) -> Column:
    """H of the siblings along the path, bottom up (empty when there are none)."""
    sibs = F.transform(F.filter(path, lambda s: s["op"] == "pair"), lambda s: s["sib"])
    return F.sha2(F.array_join(sibs, ""), 256)


def ranked(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """`nodes` (with `_g`) plus `_j`, the 0-based place in its group by `order`, and `_n`, the
    size of its group.

    Rows are range-partitioned and sorted, counted per task and group, and the counts are
    summed in order: no group meets in one task. Equal keys get consecutive places in any order.
    """
    spark = nodes.sparkSession
    keys = [F.col("_g"), *order]
    placed = stored(
        nodes.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_p", F.spark_partition_id())
        .withColumn("_i", F.monotonically_increasing_id())
    )
    counts = placed.groupBy("_p", "_g").agg(F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_c"))
    group = Window.partitionBy("_g")
    counts = stored(
        counts.withColumn("_before", F.sum("_c").over(group.orderBy("_p")) - F.col("_c"))
        .withColumn("_n", F.sum("_c").over(group))
        .drop("_c")
    )
    if counts.count() <= BROADCAST_ROWS:
        counts = F.broadcast(counts)
    out = placed.join(counts, ["_p", "_g"])
    return out.withColumn("_j", F.col("_before") + F.col("_i") - F.col("_first")).drop("_p", "_i", "_first", "_before")


def _band(nodes: DataFrame, level: int, height: int) -> tuple[DataFrame, DataFrame]:
    """One band of `height` levels over nodes (_g, _j, _n, _h, _x) at `level`.

    Returns the bottom nodes with their path through the band (`_g, _j, _blk, _h, _x, _path`)
    and the block roots as the next band's nodes.
    """
    size = 1 << height
    digits = [F.col("_t").bitwiseAND(1 << k).cast("boolean").cast("int").alias(f"_d{k}") for k in range(height)]
    cur = (
        nodes.withColumn("_blk", F.shiftright("_j", height))
        .withColumn("_t", F.col("_j").bitwiseAND(size - 1))
        .repartition("_g", "_blk")
        .select("_g", "_blk", "_n", *digits, F.struct(F.col("_h").alias("h"), F.col("_x").alias("x")).alias("_node"))
    )
    for k in range(height):
        keys = ["_g", "_blk", "_n", *[f"_d{i}" for i in range(k + 1, height)]]
        kids = F.array_sort(
            F.collect_list(F.struct(F.col(f"_d{k}").alias("bit"), F.col("_node").alias("kid"))),
            lambda a, b: a["bit"] - b["bit"],
        )
        grouped = cur.groupBy(*keys).agg(kids.alias("_kids"))
        below = F.shiftright(F.col("_n") + F.lit((1 << (level + k)) - 1), level + k)
        first = F.col("_kids")[0]["kid"]["h"]
        two = F.size("_kids") == 2
        h = (
            F.when(below <= 1, first)
            .when(two, F.sha2(F.concat(first, F.col("_kids")[1]["kid"]["h"]), 256))
            .otherwise(F.sha2(first, 256))
        )
        op = F.when(below <= 1, "top").when(two, "pair").otherwise("lone")
        cur = grouped.select(*keys, F.struct(h.alias("h"), op.alias("op"), F.col("_kids").alias("kids")).alias("_node"))
    cur = stored(cur)

    empty = F.array().cast("array<struct<op:string,bit:int,sib:string>>")
    walk = F.array(F.struct(F.col("_node").alias("nd"), empty.alias("path"), F.lit(0).alias("t")))
    for _ in range(height):

        def down(e: Column) -> Column:
            node = e["nd"]

            def child(k: Column) -> Column:
                sib = F.when(node["op"] == "pair", node["kids"][1 - k["bit"]]["kid"]["h"]).cast("string")
                step = F.struct(node["op"].alias("op"), k["bit"].alias("bit"), sib.alias("sib"))
                return F.struct(
                    k["kid"].alias("nd"), F.concat(F.array(step), e["path"]).alias("path"),
                    (e["t"] * 2 + k["bit"]).alias("t"),
                )

            return F.transform(node["kids"], child)

        walk = F.flatten(F.transform(walk, down))
    bottom = cur.select("_g", "_blk", F.explode(walk).alias("_w")).select(
        "_g", "_blk",
        (F.col("_blk") * size + F.col("_w.t")).alias("_j"),
        F.col("_w.nd.h").alias("_h"), F.col("_w.nd.x").alias("_x"), F.col("_w.path").alias("_path"),
    )
    none = F.lit(None).cast(nodes.schema["_x"].dataType)
    tops = cur.select("_g", F.col("_blk").alias("_j"), "_n", F.col("_node.h").alias("_h"), none.alias("_x"))
    return stored(bottom), tops


def paths(nodes: DataFrame, height: int = HEIGHT, above=None) -> tuple[DataFrame, DataFrame, int]:
    """Every node of `nodes` (`_g, _j, _n, _h, _x`: group, place, group size, hash, payload)
    with `_path`, its steps up to the root of its group (and on through `above`).

    `above(tops)` gets the group roots (`_g, _h`) and returns `_g, _path` to append. Also
    returns the group roots and the number of steps in a group's own tree.
    """
    most = nodes.agg(F.max("_n")).first()[0] or 1
    levels = math.ceil(math.log2(most)) if most > 1 else 0
    bands, level, cur = [], 0, nodes
    while True:
        bottom, cur = _band(cur, level, height)
        bands.append(bottom)
        level += height
        if level >= levels:
            break
    tops = stored(cur.select("_g", "_h"))
    tail = None
    if above is not None:
        tail = above(tops).select("_g", F.lit(0).cast("long").alias("_k"), F.col("_path").alias("_up"))
    for bottom in reversed(bands):
        if tail is None:
            full = bottom
        else:
            full = bottom.join(tail, (bottom["_g"] == tail["_g"]) & (bottom["_blk"] == tail["_k"])).select(
                bottom["_g"], bottom["_j"], bottom["_h"], bottom["_x"], F.concat(bottom["_path"], tail["_up"]).alias("_path")
            )
        full = stored(full.select("_g", "_j", "_h", "_x", "_path"))
        tail = full.select("_g", F.col("_j").alias("_k"), F.col("_path").alias("_up"))
    return full, tops, level


def manifest(docs: DataFrame, fields: list[str] = FIELDS, group: str = "lang", key: str = "doc_id",
             carry: list[str] = (), height: int = HEIGHT) -> DataFrame:
    """Per row of `docs`: `key`, `group`, the columns `carry`, `leaf` (H of `fields`),
    `subroot` (its group's root), `root`, `path` (array of steps `op` pair/lone/top, `bit` 0
    left 1 right, `sib` the sibling's hash; bottom up through the group's tree, then the root's
    tree) and `group_steps` (how many of the steps are the group's).

    Groups ascend null first, then by UTF-8 bytes; rows of a group ascend by `key` (null first),
    ties by leaf, so repeated rows take consecutive places in either order and get the proofs of
    those places. An empty table gives no rows. Other columns of `docs` are not carried, so
    their names do not matter.
    """
    payload = F.struct(F.col(key).alias("key"), F.col(group).alias("group"), F.col("_leaf").alias("leaf"),
                       *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    leaves = docs.select(
        group_key(F.col(group)).alias("_g"), F.col(key).alias("_key"),
        leaf_hash(*[F.col(f) for f in fields]).alias("_leaf"), *[F.col(c) for c in carry], F.col(group), F.col(key),
    )
    leaves = leaves.select("_g", "_key", "_leaf", payload.alias("_x"))
    leaves = ranked(leaves, [F.col("_key").asc_nulls_first(), F.col("_leaf")]).select(
        "_g", "_j", "_n", F.col("_leaf").alias("_h"), "_x"
    )
    steps = {}

    def over_groups(tops: DataFrame) -> DataFrame:
        roots = tops.select(F.lit(bytearray(b"\x00")).alias("_g"), F.col("_g").alias("_o"), "_h")
        roots = ranked(roots, [F.col("_o")]).select("_g", "_j", "_n", "_h", F.col("_o").alias("_x"))
        full, _, _ = paths(roots, height)
        return full.select(F.col("_x").alias("_g"), "_path")

    full, _, steps["group"] = paths(leaves, height, over_groups)
    out = full.select(
        F.col("_x.key").alias(key), F.col("_x.group").alias(group),
        *[F.col(f"_x.c{i}").alias(c) for i, c in enumerate(carry)],
        F.col("_h").alias("leaf"), F.col("_path").alias("path"),
    )
    own = F.slice("path", 1, steps["group"]) if steps["group"] else F.array().cast(out.schema["path"].dataType)
    return out.withColumn("subroot", fold(F.col("leaf"), own)).withColumn("root", fold(F.col("leaf"), F.col("path"))).withColumn(
        "group_steps", F.lit(steps["group"])
    )
