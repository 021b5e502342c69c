"""Conversations out of reply trees.

Self-joins that double the distance in each round lead every message to its root; branches
are ranked by score, and the best path of each tree becomes one formatted conversation with
the spans that a loss counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinitext.llm.common import stored

OPEN, TEXT, CLOSE = "<s>", "[TEXT]", "</s>"
#: Strings that a text must not contain bare, and the mark that takes their meaning away.
CONTROLS = re.compile(r"\\|</?s>|\[/?INST\]|\[TEXT\]")
PARTS = re.compile(r"\\(\\|</?s>|\[/?INST\]|\[TEXT\])|(<s>|\[TEXT\]|</s>)")
COUNTED = "assistant"


def escape(text: str) -> str:
    return CONTROLS.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return PARTS.sub(lambda m: m[1] if m[1] is not None else m[0], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one string, and where the texts that the loss counts stand in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = OPEN + escape(role) + TEXT, escape(text)
        if role == COUNTED:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns back from the string."""
    turns, at, role = [], 0, ""
    for m in PARTS.finditer(formatted):
        if m[2] == OPEN:
            at = m.end()
        elif m[2] == TEXT:
            role, at = unescape(formatted[at : m.start()]), m.end()
        elif m[2] == CLOSE:
            turns.append((role, unescape(formatted[at : m.start()])))
    return turns


def best_paths(messages: DataFrame) -> DataFrame:
    """Messages (tree, node, parent, role, text, score) on the best root-to-leaf path of each
    tree, with their `depth`.

    A path's score is the sum of its messages'; ties go to the longer path, then the smaller
    leaf. Messages whose ancestors lead to no root (a missing parent, a cycle) are left out, and
    so are rows without tree or node. Of rows that share both, the first by parent, score, role
    and text counts, nulls first. A null score is 0. An empty table gives no rows. Columns other
    than these six are not looked at.
    """
    nodes = stored(_first_of(messages, "parent", "score").withColumn("score", F.coalesce("score", F.lit(0.0))))
    up = stored(nodes.select("tree", "node", F.col("parent").alias("above"), F.lit(1).cast("long").alias("steps"), "score"))
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    # After k rounds a message has jumped 2**k messages up, or beyond its root (above null). One
    # that is beyond its root rests; no path is longer than its tree, so a cycle ends the rounds.
    jumps, complete, jumped = [], up.filter("above is null"), up.filter("above is not null")
    while jumped.limit(1).count() and 2 ** len(jumps) < largest:
        jumps.append(jumped)
        higher = complete.unionByName(jumped).select(
            "tree", F.col("node").alias("above"), F.col("above").alias("_above"),
            F.col("steps").alias("_steps"), F.col("score").alias("_score"),
        )
        up = stored(jumped.join(higher, ["tree", "above"]).select(
            "tree", "node", F.col("_above").alias("above"), (F.col("steps") + F.col("_steps")).alias("steps"),
            (F.col("score") + F.col("_score")).alias("score"),
        ))
        complete, jumped = complete.unionByName(up.filter("above is null")), up.filter("above is not null")
    inner = nodes.filter("parent is not null").select("tree", F.col("parent").alias("node")).distinct()
    leaves = complete.join(inner, ["tree", "node"], "left_anti").groupBy("tree").agg(
        F.min_by("node", F.struct(-F.col("score"), -F.col("steps"), F.col("node"))).alias("node")
    )
    path = leaves
    for step in reversed(jumps):
        higher = path.join(step, ["tree", "node"]).select("tree", F.col("above").alias("node"))
        path = stored(path.unionByName(higher).distinct())
    depth = complete.select("tree", "node", F.col("steps").alias("depth"))
    said = _first_of(messages, "parent", "score", "role", "text")
    return said.join(path, ["tree", "node"]).join(depth, ["tree", "node"])


def _first_of(messages: DataFrame, *columns: str) -> DataFrame:
    """One row per tree and node: the least of `columns`, taken as one value."""
    return messages.filter("tree is not null and node is not null").groupBy("tree", "node").agg(
        F.min(F.struct(*columns)).alias("_least")
    ).select("tree", "node", "_least.*")


def format_paths(paths: DataFrame) -> DataFrame:
    """tree, formatted, loss (start, end) per tree; a conversation is one value, held by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [render([(t["role"], t["text"]) for t in turns]) for turns in batch.column(1).to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f for f, _ in done], pa.string()), pa.array(spans, kind)],
                ["tree", "formatted", "loss"],
            )

    turns = paths.groupBy("tree").agg(F.sort_array(F.collect_list(F.struct(
        "depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ))).alias("turns"))
    return turns.mapInArrow(run, "tree bigint, formatted string, loss array<struct<start:bigint,end:bigint>>")


def from_turns(conversations: DataFrame) -> DataFrame:
    """Messages of conversations whose rows answer one another by turn; ties by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.coalesce(F.col("conv_id").cast("bigint"), F.lit(-(2**62))).alias("tree"),
        F.row_number().over(order).cast("bigint").alias("node"), "role", "text",
    ).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted strings say when they are read back."""
    import hashlib

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tree, text, spans in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                turns = parse(text)
                said = "".join(f"{r}\n{t}\n" for r, t in turns)
                loss = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
                out.append((None if tree == -(2**62) else tree, len(turns), hashlib.sha256(said.encode()).hexdigest(),
                            len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return formatted.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
