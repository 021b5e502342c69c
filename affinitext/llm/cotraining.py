"""Quality classifier by co-training.

Two views of a document, the words of its text and its metadata, each train a logistic
classifier on a bounded sample of labelled documents. Over some rounds, each view labels the
sampled unlabelled documents it is surest of for the other. Both are then calibrated on
labelled documents kept aside, and their weighted log odds score every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinitext.llm.common import text_of

#: Documents with labels, and without, that the classifiers are fitted on; beyond that,
#: a hash of doc_id chooses them. Every document is scored.
FIT_LABELLED = 4000
FIT_UNLABELLED = 2000
ROUNDS = 4
#: Unlabelled documents that a view labels per round and class, of those beyond SURE.
PSEUDO = 50
SURE = 0.95
#: Least share of right answers, among at least so many rows kept aside, for a view to teach.
RIGHT, TRIED = 0.9, 5
BUCKETS = 1 << 18
#: A word counts where its shares of the two classes differ by so many standard errors.
TELLING = 2.5
#: Words and runs of other signs.
WORD = re.compile(r"\w+|[^\w\s]+")


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words and the shape of the text: buckets and values."""
    words = WORD.findall(text.lower())
    counts: dict[int, int] = {}
    for w in words:
        k = 32 + hash_of(w)
        counts[k] = counts.get(k, 0) + 1
    n, letters = max(len(words), 1), max(sum(map(str.isalpha, text)), 1)
    shape = [
        1.0, np.log1p(len(words)) / 5, sum(map(str.isupper, text)) / letters * 4,
        len(set(words)) / n * 4, sum(not c.isalnum() and not c.isspace() for c in text) / max(len(text), 1) * 8,
        np.log1p(text.count("\n")) / 3, len(text) / n / 6, max(counts.values(), default=0) / n * 4,
    ]
    keys = np.array([*range(len(shape)), *counts], dtype=np.int64)
    return keys, np.array([*shape, *(1 + np.log(c) for c in counts.values())])


def hash_of(word: str) -> int:
    """A bucket that is the same in every process."""
    import zlib

    return zlib.crc32(word.encode()) % (BUCKETS - 32)


def meta_features(lang, source, n_chars) -> tuple[np.ndarray, np.ndarray]:
    size = np.log1p(max(n_chars or 0, 0))
    keys = [0, 1, 2, 32 + hash_of(f"lang {lang}"), 32 + hash_of(f"source {source}"), 3 + min(int(size * 2), 28)]
    return np.array(keys, dtype=np.int64), np.array([1.0, size / 5, (size / 5) ** 2, 1.0, 1.0, 1.0])


class Rows(NamedTuple):
    keys: np.ndarray
    values: np.ndarray
    row: np.ndarray
    n: int

    @staticmethod
    def of(features: list[tuple[np.ndarray, np.ndarray]]) -> "Rows":
        sizes = [len(k) for k, _ in features]
        joined = [np.concatenate(x) if features else np.zeros(0) for x in zip(*features, strict=True)] or [np.zeros(0, int), np.zeros(0)]
        return Rows(joined[0], joined[1], np.repeat(np.arange(len(features)), sizes), len(features))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * weights[self.keys], self.n)


def chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def telling(rows: Rows, label: np.ndarray) -> np.ndarray:
    """How much each feature says: 1 for those that are no words, for words the log ratio of
    their shares of documents in the two classes, 0 where chance explains it.

    A rare word that decides, one of many in a long text, would drown among the others else.
    """
    word = rows.keys >= 32
    seen = [np.bincount(rows.keys[word & (label[rows.row] == v)], minlength=BUCKETS) + 0.5 for v in (1, 0)]
    of = [(label == v).sum() + 1.0 for v in (1, 0)]
    ratio = np.log(seen[0] / of[0]) - np.log(seen[1] / of[1])
    error = np.sqrt(sum(1 / s - 1 / n for s, n in zip(seen, of, strict=True)).clip(1e-6))
    says = np.where(np.abs(ratio) >= TELLING * error, np.abs(ratio), 0.0)
    # Fewer than three documents tell nothing.
    says[(seen[0] + seen[1]) < 4] = 0
    says[:32] = 1.0
    return says


def logistic(
    rows: Rows, label: np.ndarray, says: np.ndarray, steps: int = 300, decay: float = 1e-3
) -> np.ndarray:
    """Weights by adaptive gradient steps over the labelled rows, classes weighted evenly."""
    held = (says[rows.keys] > 0) & (label[rows.row] >= 0)
    kept, keys = np.unique(rows.keys[held], return_inverse=True)
    row, values = rows.row[held], rows.values[held] * says[rows.keys[held]]
    weights, past = np.zeros(len(kept)), np.full(len(kept), 1e-8)
    share = sum(np.where(label == v, 0.5 / max((label == v).sum(), 1), 0.0) for v in (0, 1))
    y = np.maximum(label, 0)
    for _ in range(steps):
        error = (chance(np.bincount(row, values * weights[keys], rows.n)) - y) * share
        slope = np.bincount(keys, values * error[row], len(kept)) + decay * weights
        past += slope**2
        weights -= 0.3 * slope / np.sqrt(past)
    out = np.zeros(BUCKETS)
    out[kept] = weights * says[kept]
    return out


class Classifier(NamedTuple):
    text: np.ndarray
    meta: np.ndarray
    #: Calibration: log odds = base + a * text view + b * metadata view
    blend: np.ndarray

    def odds(self, text: Rows, meta: Rows) -> np.ndarray:
        return self.blend[0] + self.blend[1] * text.dot(self.text) + self.blend[2] * meta.dot(self.meta)


def cotrain(text: Rows, meta: Rows, label: np.ndarray, rounds: int = ROUNDS) -> Classifier:
    """label: 1, 0, or -1 for unlabelled. A quarter of the labelled rows only calibrates."""
    known = np.flatnonzero(label >= 0)
    aside = np.zeros(len(label), bool)
    aside[known[::4]] = True
    own = [np.where(aside, -1, label) for _ in (text, meta)]
    for i in range(rounds + 1):
        says = telling(text, own[0]), np.ones(BUCKETS)
        weights = [logistic(*x) for x in zip((text, meta), own, says, strict=True)]
        if i == rounds:
            break
        for me, other, view in ((0, 1, text), (1, 0, meta)):
            sure = chance(view.dot(weights[me]))
            free = (label < 0) & (own[other] < 0)
            for value, surety in ((1, sure), (0, 1 - sure)):
                # A view teaches a class only where it is right about the rows kept aside.
                tried = label[aside & (surety >= SURE)] == value
                if len(tried) < TRIED or tried.mean() < RIGHT:
                    continue
                most = min(PSEUDO, int((label == value).sum()))
                at = np.flatnonzero(free & (surety >= SURE))
                own[other][at[np.argsort(-surety[at], kind="stable")[:most]]] = value
    x = np.stack([np.ones(len(label)), text.dot(weights[0]), meta.dot(weights[1])])[:, aside]
    y, blend = label[aside], np.array([0.0, 1.0, 0.0])
    prior, hold = blend, np.array([0.01, 1.0, 1.0])

    def loss(b: np.ndarray) -> float:
        odds = np.where(y == 1, b @ x, -(b @ x))
        return float(np.logaddexp(0, -odds).sum() + 0.5 * (hold * (b - prior) ** 2).sum())

    for _ in range(30):  # Newton steps, halved until they help; held near the text view alone
        p = chance(blend @ x)
        slope = x @ (p - y) + hold * (blend - prior)
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + np.diag(hold), slope)
        while loss(blend - step) > loss(blend) and np.abs(step).max() > 1e-6:
            step = step / 2
        blend = blend - step
    return Classifier(weights[0], weights[1], blend)


TARGETS = ("quality", "toxic")


def fit(docs: DataFrame, labels: DataFrame, labelled: int = FIT_LABELLED, unlabelled: int = FIT_UNLABELLED) -> dict[str, Classifier | None]:
    """A classifier per target; None where the labels do not hold both classes."""
    marks = labels.filter("doc_id is not null").groupBy("doc_id").agg(*[F.max(t).cast("int").alias(f"_{t}") for t in TARGETS])
    columns = _columns(docs).filter("doc_id is not null")
    order = F.xxhash64("doc_id")

    def some(rows: DataFrame, ids: DataFrame, n: int) -> list:
        share = max(1, ids.count() // n)
        chosen = ids.filter(F.pmod(order, F.lit(share)) == 0)
        return rows.join(chosen, "doc_id").dropDuplicates(["doc_id"]).limit(2 * n).collect()

    found = some(columns, marks, labelled)
    found += some(columns, columns.select("doc_id").join(marks, "doc_id", "left_anti").select(
        "doc_id", *[F.lit(None).cast("int").alias(f"_{t}") for t in TARGETS]).distinct(), unlabelled)
    found.sort(key=lambda r: (r["doc_id"] * 2654435761) % 2**32)
    text = Rows.of([text_features(r["_text"]) for r in found])
    meta = Rows.of([meta_features(r["_lang"], r["_source"], r["_n_chars"]) for r in found])
    out = {}
    for t in TARGETS:
        label = np.array([-1 if r[f"_{t}"] is None else min(max(r[f"_{t}"], 0), 1) for r in found], dtype=int)
        enough = (label == 1).sum() > 3 and (label == 0).sum() > 3
        out[t] = cotrain(text, meta, label) if enough else None
    return out


def _columns(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("_text"),
        F.col("lang").cast("string").alias("_lang"), F.col("source").cast("string").alias("_source"),
        F.col("n_chars").cast("bigint").alias("_n_chars"),
    )


def score(docs: DataFrame, labels: DataFrame, models: dict[str, Classifier | None] | None = None, **settings) -> DataFrame:
    """One row per document: doc_id, score (that it is good), toxic_score, kept.

    A document is kept if it is more likely good than not and not likely toxic. Null texts and
    metadata count as empty; without labels of both classes a target's score is 0.5 and
    rejects nothing; repeated rows score alike; labels of one doc_id count once, the larger
    one; an empty table gives no rows.
    """
    models = models or fit(docs, labels, **settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[], []]
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                texts, langs, sources, sizes = [part.column(i).to_pylist() for i in range(1, 5)]
                text = Rows.of([text_features(t) for t in texts])
                meta = Rows.of([meta_features(*x) for x in zip(langs, sources, sizes, strict=True)])
                for k, t in enumerate(TARGETS):
                    m = models[t]
                    out[k] += (chance(m.odds(text, meta)) if m else np.full(len(part), 0.5)).tolist()
            good, toxic = np.array(out[0]), np.array(out[1])
            kept = (good >= 0.5) & (toxic <= 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(good, pa.float64()), pa.array(toxic, pa.float64()), pa.array(kept, pa.bool_())],
                ["doc_id", "score", "toxic_score", "kept"],
            )

    return _columns(docs).mapInArrow(run, "doc_id bigint, score double, toxic_score double, kept boolean")
