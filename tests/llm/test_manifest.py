"""The Merkle manifest against a plain tree built in Python."""

import hashlib
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from affinitext.llm import manifest
from affinitext.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, root int, _g string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def enc(v):
    if v is None or (isinstance(v, float) and pd.isna(v)):
        return "-"
    s = str(int(v)) if isinstance(v, (int, float)) else str(v)
    return f"{len(s.encode())}:{s}"


def leaf(row, n_chars=None):
    d, s, l, n, t = row[:5]
    return h("".join(enc(x) for x in (d, s, l, n if n_chars is None else n_chars, t)))


def tree(nodes):
    """Levels of a tree over `nodes`; the steps of each place bottom up."""
    steps = [[] for _ in nodes]
    owners = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, own = [], []
        for a in range(0, len(nodes), 2):
            run = nodes[a : a + 2]
            up.append(h("".join(run)))
            own.append(owners[a] + (owners[a + 1] if len(run) == 2 else []))
            for side, members in enumerate(owners[a : a + 2]):
                for m in members:
                    steps[m].append(("pair", side, run[1 - side]) if len(run) == 2 else ("lone", 0, None))
        nodes, owners = up, own
    return nodes[0], steps


def fold(start, steps):
    for op, bit, sib in steps:
        start = h(start + sib if bit == 0 else sib + start) if op == "pair" else h(start)
    return start


def brute(rows):
    def gkey(l):
        return (0, b"") if l is None else (1, l.encode())

    groups = {}
    for r in rows:
        groups.setdefault(gkey(r[2]), []).append(r)
    subroots, per = [], {}
    for g in sorted(groups):
        members = sorted(groups[g], key=lambda r: ((r[0] is not None), r[0] or 0, leaf(r)))
        top, steps = tree([leaf(r) for r in members])
        subroots.append(top)
        per[g] = (members, steps, top)
    root, upper = tree(subroots)
    out = []
    for gi, g in enumerate(sorted(groups)):
        members, steps, top = per[g]
        for r, s in zip(members, steps):
            full = s + upper[gi]
            changed = r[3] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            t = leaf(r, r[3] + 1) if changed else leaf(r)
            sibs = "".join(x[2] for x in full if x[0] == "pair")
            out.append((r[0], leaf(r), top, root, h(sibs), fold(t, full)))
    return sorted(out, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[4]))


ROWS = [
    (5, "a", "en", 10, "x"), (5, "a", "en", 10, "x"), (3, None, "en", None, None), (None, "b", "en", 2, ""),
    (7, "b", None, 4, "é"), (8, "c", "", 1, "y"), (9, "c", "fr", 3, "z" * 50000), (1, "a", "fr", 5, "w"),
    *[(100 + i, "s", "de", i, f"t{i}") for i in range(37)], (2, "a", "zz", 7, "q"),
]


def run(spark, rows, height):
    docs = spark.createDataFrame(rows, SCHEMA.rsplit(", leaf", 1)[0]).withColumn("leaf", F.lit("clash")).withColumn(
        "root", F.lit(1)).withColumn("_g", F.lit("x")).withColumn("_j", F.lit(3))
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    docs = docs.withColumn("_tampered", manifest.leaf_hash(*[tampered if f == "n_chars" else F.col(f) for f in manifest.FIELDS]))
    out = manifest.manifest(docs, carry=["_tampered"], height=height)
    got = out.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("p"),
                     manifest.fold(F.col("_tampered"), F.col("path")).alias("f")).collect()
    return sorted((tuple(r) for r in got), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[4]))


@pytest.mark.parametrize("height", [1, 2, 8])
def test_against_brute_force(spark, height):
    assert run(spark, ROWS, height) == brute(ROWS)


def test_one_row_and_empty(spark):
    one = [(1, "a", "en", 3, "t")]
    got = run(spark, one, 2)
    assert got == brute(one) and got[0][1] == got[0][2] == got[0][3]
    assert run(spark, [], 2) == []


def test_query_on_table(spark):
    got = QUERIES["op11_merkle_manifest"](spark, SF_DIR).toPandas()
    docs = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in
            docs[["doc_id", "source", "lang", "n_chars", "text"]].astype(object).itertuples(index=False)]
    want = brute(rows)
    have = sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got.itertuples()),
                  key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[4]))
    assert have == want
    assert (got.verified == (got.folded_root == got.root)).all() and 0 < (~got.verified).sum() < len(got)
