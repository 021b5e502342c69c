"""The conversation prefix trie against a plain trie built in Python."""

import hashlib
import zlib

import pandas as pd
import pytest

from affinitext.llm import trie
from affinitext.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, _k1 int, _pos int, n_convs string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))]
           for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        b = c - int(abs(c) % 100) * (1 if c >= 0 else -1)
        built[c] = own.get(b, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for key in nodes:
        if key:
            kids.setdefault(key[:-1], []).append(key)
    def total(key):
        leaves = 0 if kids.get(key) else 1
        saved = (len(nodes[key]) - 1) * len(key[-1][1]) if key else 0
        for k in kids.get(key, []):
            a, b = total(k)
            leaves, saved = leaves + a, saved + b
        return leaves, saved
    out = []
    for key, members in nodes.items():
        ends = sorted(c for c in members if len(built[c]) == len(key))
        leaves, saved = total(key)
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members),
                    len(kids.get(key, [])), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, band):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    got = trie.trie(df, band=band).collect()
    return sorted((tuple(r) for r in got), key=str)


ROWS = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "hello there"), (0, 2, "user", "more"), (0, 3, "assistant", "yes"),
    (0, 4, "user", "x"), (0, 5, "assistant", "y"), (0, 6, "user", "z"),
    (1, 0, "user", "hi"), (1, 1, "assistant", "other"), (1, 2, None, None),
    (2, None, "user", "a"), (2, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "é" * 3000),
    (3, 0, "user", "q"), (5, 0, "user", "solo"), (7, 0, "user", "hi"), (7, 1, "assistant", "hello there"),
    (100, 0, "user", "hi"), (101, 0, "x", "y"), (-150, 0, "user", "neg"), (-101, 1, "user", "neg"),
    (None, 0, "user", "lost"), *[(200 + i, j, "user", f"t{j % 3}") for i in range(5) for j in range(19)],
]


@pytest.mark.parametrize("band", [1, 2, 8])
def test_against_brute_force(spark, band):
    assert run(spark, ROWS, band) == brute(ROWS)


def test_empty(spark):
    assert run(spark, [], 2) == []


def test_query_on_table(spark):
    got = QUERIES["op12_prefix_trie"](spark, SF_DIR).toPandas()
    conv = pd.read_parquet(f"{SF_DIR}/conversations.parquet")
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in
            conv[["conv_id", "turn", "role", "text"]].astype(object).itertuples(index=False)]
    have = sorted(((r.conv_id, r.depth, None if pd.isna(r.parent_conv_id) else int(r.parent_conv_id), r.n_convs,
                    r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got.itertuples()), key=str)
    assert have == brute(rows)
