"""Secrets in texts: fixed patterns, then strings whose characters are too evenly spread.

The patterns find assignments to secret-like names, access key ids and long hex runs. The
method adds strings of token characters in which some window of `WINDOW` characters has a
Shannon entropy above the bound of its character class (hex digits or the wider token set).
The entropy of each window comes from the counts of the one before: one character enters, one
leaves, and the sum of c*log2(c) changes by two table lookups. Strings that match the allow
list (placeholders, counting runs, examples) are passed over, as are strings inside a pattern
span. Texts are scanned in Arrow batches on the executors; nothing is grouped or shuffled.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

# The patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ["assign", "access", "hex", "entropy"]

#: Characters of a candidate string, the least length of one, and the window.
CANDIDATE = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
WINDOW = 20
#: Entropy in bits a window must reach, by class: only hex digits, else the token set.
BITS = {"hex": 3.3, "token": 4.0}
#: Strings that are passed over: placeholders, examples, counting and repeated runs.
ALLOW = re.compile(
    r"(?i)example|sample|dummy|placeholder|changeme|redacted|your_?(?:api_?)?(?:key|token|secret)|x{6,}|"
    r"0123456|123456789|abcdefgh|(.)\1{5,}"
)

SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                              StructField("end", IntegerType())]))

_TABLE: list[float] = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each pattern that reach its least length."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return out


def window_entropies(s: str, width: int = WINDOW) -> list[float]:
    """Shannon entropy in bits of every window of `width` characters of `s`, by counts kept up
    to date as the window slides."""
    if len(s) < width:
        return []
    counts: dict[str, int] = {}
    total = 0.0
    for ch in s[:width]:
        c = counts.get(ch, 0)
        total += _TABLE[c + 1] - _TABLE[c]
        counts[ch] = c + 1
    out = [math.log2(width) - total / width]
    for i in range(width, len(s)):
        new, old = s[i], s[i - width]
        if new != old:
            c = counts[old]
            total += _TABLE[c - 1] - _TABLE[c]
            counts[old] = c - 1
            c = counts.get(new, 0)
            total += _TABLE[c + 1] - _TABLE[c]
            counts[new] = c + 1
        out.append(math.log2(width) - total / width)
    return out


def entropy_spans(text: str, taken: list[tuple[str, int, int]], width: int = WINDOW) -> list[tuple[str, int, int]]:
    """Runs of windows above their class's bound in candidate strings outside `taken` spans and
    the allow list; each run of overlapping windows is one span."""
    out = []
    for m in CANDIDATE.finditer(text):
        s, at = m[0], m.start()
        if ALLOW.search(s) or any(a < m.end() and at < b for _, a, b in taken):
            continue
        bound = BITS["hex"] if all(ch in "0123456789abcdefABCDEF" for ch in s) else BITS["token"]
        run = None
        for i, e in enumerate(window_entropies(s, width)):
            if e >= bound:
                run = (run[0] if run else i, i + width)
            elif run:
                out.append(("entropy", at + run[0], at + run[1]))
                run = None
        if run:
            out.append(("entropy", at + run[0], at + run[1]))
    return out


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of one text (null: none), by start, then kind in the order of KINDS."""
    text = text or ""
    base = base_spans(text)
    spans = base + entropy_spans(text, base)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


@F.pandas_udf(SPANS)
def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)] for t in texts])


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` plus `spans`: array of (kind, start, end) in code points, end exclusive, by start
    then kind (assign, access, hex, entropy). Base kinds keep every match of their pattern that
    reaches its length; `entropy` spans never overlap them. Null and empty texts have none; a
    column `spans` of `docs` is replaced."""
    return docs.withColumn("spans", _spans(F.col(text).cast("string")))


def joined(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] != "entropy")
