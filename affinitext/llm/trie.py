"""A prefix trie of conversations, with totals over each node's subtree.

Every node is the set of conversations that share a sequence of first turns; its key is a
running XOR of hashes of (turn, place), so a prefix is named without carrying it. Subtree totals
come from a depth-band rollup: a node explodes only to its ancestors within its band of `BAND`
depths (one join on conversation and band, at most BAND+1 rows a side), which sums each band
from below; then the totals of completed band roots, deepest band first, explode into the
band above. Rounds grow with depth / BAND, explosion with BAND, neither with the table.

Places in a conversation and the running XOR come from a range-partitioned sort counted per
task, so a long conversation is not one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinitext.llm.common import stored
from affinitext.session import shared_folder

#: Depths of a band.
BAND = 8
#: A table of counts per task and group of at most so many rows is broadcast.
BROADCAST_ROWS = 1_000_000


def running(rows: DataFrame, group: str, order: list[Column], values: list[str]) -> DataFrame:
    """`rows` plus `_pos` (0-based place in its `group` by `order`), `_len` (rows of the group)
    and `_x<i>`, the XOR of `values[i]` over the group's rows up to this one.

    No group meets in one task: rows are range-partitioned and sorted, summed per task and
    group, and the sums of earlier tasks are added. Equal keys take consecutive places in any
    order.
    """
    keys = [F.col(group), *order]
    placed = stored(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    )
    parts = placed.groupBy("_p", group).agg(
        F.min("_i").alias("_first"), F.count(F.lit(1)).alias("_cnt"),
        *[F.bit_xor(v).alias(f"_px{i}") for i, v in enumerate(values)],
    )
    before = Window.partitionBy(group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(
        parts.select(
            "_p", group, "_first",
            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_before"),
            F.sum("_cnt").over(Window.partitionBy(group)).alias("_len"),
            *[F.coalesce(F.bit_xor(f"_px{i}").over(before), F.lit(0)).alias(f"_bx{i}") for i in range(len(values))],
        )
    )
    if parts.count() <= BROADCAST_ROWS:
        parts = F.broadcast(parts)
    within = Window.partitionBy("_p", group).orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(parts, ["_p", group])
    out = out.select(
        *[c for c in placed.columns if c not in ("_p", "_i")],
        (F.col("_before") + F.col("_i") - F.col("_first")).alias("_pos"), "_len",
        *[F.col(f"_bx{i}").bitwiseXOR(F.bit_xor(v).over(within)).alias(f"_x{i}") for i, v in enumerate(values)],
    )
    return out


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (`_c, _pos, _role, _text`) and one row per
    conversation (`_c, _length`).

    Turns of a conversation go by turn (null first), then role and text; null role or text is
    empty. Conversation c takes the first h = crc32(decimal c) % 6 turns of c - c % 100 (all if
    fewer, none if it is absent), then its own turns after its first h. Rows without conv_id
    belong to no conversation.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("_c"), F.col("turn").alias("_turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("_role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"),
    ).where(F.col("_c").isNotNull())
    turns = stored(running(turns, "_c", [F.col("_turn").asc_nulls_first(), F.col("_role"), F.col("_text")], []))
    convs = turns.groupBy("_c").agg(F.max("_len").alias("_n")).select(
        "_c", "_n", (F.crc32(F.col("_c").cast("string")) % 6).alias("_h"), (F.col("_c") - F.col("_c") % 100).alias("_b"),
    )
    base = convs.select(F.col("_c").alias("_b"), F.col("_n").alias("_nb"))
    convs = stored(convs.join(base, "_b", "left").withColumn("_keep", F.least("_h", F.coalesce("_nb", F.lit(0)))))
    heads = turns.where(F.col("_pos") < 5).select(F.col("_c").alias("_b"), "_pos", "_role", "_text")
    head = convs.select("_c", "_b", "_h").join(heads, "_b").where(F.col("_pos") < F.col("_h"))
    own = turns.join(convs.select("_c", "_h", "_keep"), "_c").where(F.col("_pos") >= F.col("_h"))
    own = own.select("_c", (F.col("_keep") + F.col("_pos") - F.col("_h")).alias("_pos"), "_role", "_text")
    lengths = convs.select("_c", (F.col("_keep") + F.greatest(F.col("_n") - F.col("_h"), F.lit(0))).alias("_length"))
    return head.select("_c", "_pos", "_role", "_text").unionByName(own), lengths


def _by_band(df: DataFrame) -> DataFrame:
    """Written to the shared folder by `_band`, so that a round reads its band only."""
    path = f"{shared_folder(df.sparkSession)}/affinitext-{uuid.uuid4().hex}"
    df.write.partitionBy("_band").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def trie(conversations: DataFrame, band: int = BAND) -> DataFrame:
    """One row per node of the trie of rebuilt conversations (see `rebuilt`).

    Columns (long unless said): `conv_id` smallest member; `depth`; `parent_conv_id` (root:
    null); `n_convs` members (conversations that start with the node, turnless ones too for the
    root); `n_children`; `n_leaves` childless nodes in the subtree (itself included);
    `saved_tokens` the subtree's sum of (n_convs - 1) times the code points of each node's last
    text (root: none); `ends_sha256` string, SHA-256 of the comma-joined ascending ids of members
    with exactly `depth` turns (none: of the empty string). Repeated rows are turns of their own;
    an empty table gives no nodes.

    The ids that end at one node meet in one task, as one hash covers them in order.
    """
    turns, lengths = rebuilt(conversations)
    h1 = F.xxhash64(F.col("_pos"), F.col("_role"), F.col("_text"))
    h2 = F.xxhash64(F.col("_text"), F.lit(7), F.col("_role"), F.col("_pos"))
    keyed = running(turns.select("*", h1.alias("_h1"), h2.alias("_h2")).withColumnRenamed("_pos", "_at"), "_c",
                    [F.col("_at")], ["_h1", "_h2"])
    # One row per conversation and depth: the node it is in there.
    prefixes = keyed.select(
        "_c", (F.col("_pos") + 1).alias("_d"), F.col("_x0").alias("_k1"), F.col("_x1").alias("_k2"),
        F.length("_text").cast("long").alias("_last"),
    ).unionByName(lengths.select("_c", F.lit(0).cast("long").alias("_d"), F.lit(0).cast("long").alias("_k1"),
                                 F.lit(0).cast("long").alias("_k2"), F.lit(0).cast("long").alias("_last")))
    prefixes = stored(prefixes.join(lengths, "_c"))
    parents = prefixes.select("_c", (F.col("_d") + 1).alias("_d"), F.col("_k1").alias("_p1"), F.col("_k2").alias("_p2"))
    ends = F.filter(F.collect_list(F.when(F.col("_length") == F.col("_d"), F.col("_c"))), lambda c: c.isNotNull())
    nodes = prefixes.join(parents, ["_c", "_d"], "left").groupBy("_k1", "_k2", "_d").agg(
        F.min("_c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("_last").alias("_last"),
        F.first("_p1", ignorenulls=True).alias("_p1"), F.first("_p2", ignorenulls=True).alias("_p2"),
        F.sha2(F.array_join(F.array_sort(ends).cast("array<string>"), ","), 256).alias("ends_sha256"),
    )
    nodes = stored(nodes)
    children = nodes.groupBy(F.col("_p1").alias("_k1"), F.col("_p2").alias("_k2")).agg(F.count(F.lit(1)).alias("n_children"))
    up = nodes.select(F.col("_k1").alias("_p1"), F.col("_k2").alias("_p2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = stored(
        nodes.join(children, ["_k1", "_k2"], "left").join(up, ["_p1", "_p2"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("_leaf", (F.col("n_children") == 0).cast("long"))
        .withColumn("_saved", F.when(F.col("_d") > 0, (F.col("n_convs") - 1) * F.col("_last")).otherwise(F.lit(0)))
    )

    # Each node explodes to its ancestors within its band through its smallest member; a band
    # root (depth a positive multiple of `band`) also to those of the band above.
    top = (F.col("_d") % band == 0) & (F.col("_d") > 0)
    group = F.when(top, F.col("_d") / band - 1).otherwise(F.floor(F.col("_d") / band)).cast("long")
    rows = prefixes.select("_c", "_d", "_k1", "_k2", F.floor(F.col("_d") / band).cast("long").alias("_grp"))
    rows = rows.unionByName(rows.where((F.col("_d") % band == 0) & (F.col("_d") > 0)).withColumn("_grp", F.col("_grp") - 1))
    rows = rows.select(F.col("_c").alias("conv_id"), F.col("_d").alias("_ad"), F.col("_k1").alias("_a1"),
                       F.col("_k2").alias("_a2"), "_grp")
    exploded = nodes.select("conv_id", "_d", "_k1", "_k2", "_leaf", "_saved", group.alias("_grp")).join(
        rows, ["conv_id", "_grp"]
    ).where(F.col("_ad") <= F.col("_d"))
    same = F.floor(F.col("_ad") / band) == F.floor(F.col("_d") / band)
    sums = exploded.where(same).groupBy("_a1", "_a2").agg(F.sum("_leaf").alias("_sl"), F.sum("_saved").alias("_ss"))
    totals = _by_band(
        nodes.join(sums.withColumnRenamed("_a1", "_k1").withColumnRenamed("_a2", "_k2"), ["_k1", "_k2"])
        .withColumn("_band", F.floor(F.col("_d") / band).cast("long"))
    )
    ups = _by_band(exploded.where(top & (F.col("_ad") < F.col("_d"))).select(
        "_k1", "_k2", "_a1", "_a2", (F.col("_d") / band - 1).cast("long").alias("_band")
    ))
    deepest = nodes.agg(F.max("_d")).first()[0]
    out, carry = [], None
    for b in range((deepest or 0) // band, -1, -1):
        here = totals.where(F.col("_band") == b)
        if carry is not None:
            gained = ups.where(F.col("_band") == b).join(carry, ["_k1", "_k2"]).groupBy("_a1", "_a2").agg(
                F.sum("_tl").alias("_gl"), F.sum("_ts").alias("_gs"))
            here = here.join(gained.withColumnRenamed("_a1", "_k1").withColumnRenamed("_a2", "_k2"), ["_k1", "_k2"], "left")
            here = here.withColumn("_sl", F.col("_sl") + F.coalesce("_gl", F.lit(0))).withColumn(
                "_ss", F.col("_ss") + F.coalesce("_gs", F.lit(0)))
        here = stored(here.select(
            "_k1", "_k2", "conv_id", F.col("_d").alias("depth"), "parent_conv_id", "n_convs", "n_children",
            F.col("_sl").alias("n_leaves"), F.col("_ss").alias("saved_tokens"), "ends_sha256",
        ))
        out.append(here.drop("_k1", "_k2"))
        carry = here.where(F.col("depth") == b * band).select("_k1", "_k2", F.col("n_leaves").alias("_tl"),
                                                                F.col("saved_tokens").alias("_ts"))
    if not out:
        return nodes.select(
            "conv_id", F.col("_d").alias("depth"), "parent_conv_id", "n_convs", "n_children",
            F.col("_leaf").alias("n_leaves"), F.col("_saved").alias("saved_tokens"), "ends_sha256",
        )
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result
