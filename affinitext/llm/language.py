"""Language identification by unigram piece models, summed over all segmentations.

The pieces are a fixed public vocabulary; every language has a probability for each of them.
A word's probability is the sum over all ways to cut it into pieces (forward algorithm), a
text's the product over its words. Probabilities are learnt by expectation maximisation on
word counts of a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinitext.llm.common import stored, text_of

#: Labelled documents per language that the piece probabilities are learnt from.
FIT_DOCS = 1000
ROUNDS = 3
#: Pieces get this many counts before any is seen.
SMOOTH = 0.1
#: A character that is no piece.
UNKNOWN = 1e-7
LONGEST = 12
REMEMBERED = 400_000
LETTERS = re.compile(r"[^\W\d_]+")


def vocabulary(path: str | None = None) -> list[str]:
    """The pieces, lower-cased, with the mark of a word's beginning."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(
        model_file=path or public_tokenizers.path("piece_bpe_32k.model")
    )
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size()) if not model.is_byte(i)}
    return sorted(p for p in pieces if len(p) <= LONGEST)


class Lattice:
    """The pieces that occur at each place of a word."""

    def __init__(self, pieces: list[str]):
        #: By the next character; the piece that ends here is under "".
        self.tree: dict = {}
        for i, piece in enumerate(pieces):
            node = self.tree
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = i

    def of(self, word: str) -> list[list[tuple[int, int]]]:
        """Per end j: (begin, piece) of the pieces that end there; piece -1 is unknown."""
        tree = self.tree
        ends: list[list[tuple[int, int]]] = [[] for _ in range(len(word) + 1)]
        for i, first in enumerate(word):
            node = tree.get(first)
            if node is None or "" not in node:
                ends[i + 1].append((i, -1))
                if node is None:
                    continue
            if "" in node:
                ends[i + 1].append((i, node[""]))
            j = i + 1
            for c in word[j:]:
                if c not in node:
                    break
                node = node[c]
                j += 1
                if "" in node:
                    ends[j].append((i, node[""]))
        return ends


def forward(ends: list[list[tuple[int, int]]], chance: list[float]) -> list[float]:
    """Summed probability of all segmentations of each beginning of a word."""
    alpha = [1.0] + [0.0] * (len(ends) - 1)
    for j in range(1, len(ends)):
        total = 0.0
        for i, piece in ends[j]:
            total += alpha[i] * (chance[piece] if piece >= 0 else UNKNOWN)
        alpha[j] = total
    return alpha


def expected(ends: list[list[tuple[int, int]]], chance: list[float]) -> list[tuple[int, float]]:
    """Expected number of times each piece is used in a word."""
    alpha = forward(ends, chance)
    n = len(ends) - 1
    beta = [0.0] * n + [1.0]
    for j in range(n, 0, -1):
        for i, piece in ends[j]:
            beta[i] += beta[j] * (chance[piece] if piece >= 0 else UNKNOWN)
    if not alpha[n]:
        return []
    return [
        (piece, alpha[i] * chance[piece] * beta[j] / alpha[n])
        for j in range(1, n + 1) for i, piece in ends[j] if piece >= 0
    ]


#: Longer words are read in parts, so that products of probabilities stay above zero.
PART = 40


def words_of(text: str | None) -> list[str]:
    found = ["\u2581" + w for w in LETTERS.findall((text or "").lower())]
    if any(len(w) > PART for w in found):
        found = [w[i : i + PART] for w in found for i in range(0, len(w), PART)]
    return found


class Model:
    def __init__(self, languages: list[str], prior: list[float], pieces: list[str], chances: np.ndarray):
        self.languages, self.prior = languages, np.log(prior)
        self.pieces, self.chances = pieces, chances


def _held_out():
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, rounds: int = ROUNDS, path: str | None = None) -> Model:
    """Piece probabilities per language, from labelled documents that are not held out.

    About `fit_docs` documents per language, chosen by a hash, are counted; their word counts
    stay in Spark, and a number per language and piece comes to the driver in each round.
    """
    labelled = docs.select(
        F.col("doc_id"), F.col("lang").cast("string").alias("lang"), text_of().alias("text")
    ).filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~_held_out())
    totals = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(totals)
    pieces = vocabulary(path)
    if not languages:
        return Model([], [], pieces, np.zeros((0, len(pieces))))
    share = F.create_map(*[F.lit(x) for l in languages for x in (l, max(1, totals[l] // fit_docs))])
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id"), share[F.col("lang")]) == 0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((lang, w) for w in words_of(text))
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array(list(counts.values()), pa.int64())], ["lang", "word", "n"],
            )

    counted = stored(
        sample.select("lang", "text").mapInArrow(count, "lang string, word string, n bigint")
        .groupBy("lang", "word").agg(F.sum("n").alias("n"))
    )
    chances = np.full((len(languages), len(pieces)), 1 / len(pieces))
    for _ in range(rounds):
        rows = [c.tolist() for c in chances]

        def use(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lattice, sums = Lattice(pieces), np.zeros((len(languages), len(pieces)))
            row = {l: i for i, l in enumerate(languages)}
            for batch in batches:
                for lang, word, n in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                    own = row[lang]
                    for piece, times in expected(lattice.of(word), rows[own]):
                        sums[own, piece] += n * times
            at = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[0].astype(np.int32)), pa.array(at[1].astype(np.int32)), pa.array(sums[at])],
                ["lang", "piece", "n"],
            )

        used = counted.mapInArrow(use, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n"))
        chances = np.full(chances.shape, SMOOTH)
        for lang, piece, n in used.collect():  # at most languages x pieces
            chances[lang, piece] += n
        chances /= chances.sum(axis=1, keepdims=True)
    everything = sum(totals.values())
    return Model(languages, [totals[l] / everything for l in languages], pieces, chances)


def identify(docs: DataFrame, model: Model | None = None, **settings) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    A text without letters, null ones too, is `und` with score 0, as is any text where no
    language was learnt. The score is the posterior of the predicted language. Repeated rows
    are predicted alike; a null doc_id is not held out and not learnt from; an empty table
    gives no rows. Predictions look at the text alone.
    """
    model = model or fit(docs, **settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, chances = Lattice(model.pieces), [c.tolist() for c in model.chances]
        places: dict[str, int] = {}
        scores = np.zeros((1024, len(chances)))
        for batch in batches:
            named, best = [], []
            for text in batch.column(2):
                words = words_of(text.as_py())
                # Signs such as one half count as word characters, but are no letters.
                if not words or not chances or not any(map(str.isalpha, text.as_py())):
                    named.append("und")
                    best.append(0.0)
                    continue
                if len(places) > REMEMBERED:
                    places.clear()
                for w in words:
                    if w not in places:
                        at = places[w] = len(places)
                        if at >= len(scores):
                            scores = np.concatenate([scores, np.zeros_like(scores)])
                        ends = lattice.of(w)
                        scores[at] = [math.log(max(forward(ends, c)[-1], 1e-300)) for c in chances]
                total = model.prior + scores[[places[w] for w in words]].sum(axis=0)
                weight = np.exp(total - total.max())
                named.append(model.languages[int(total.argmax())])
                best.append(float(1 / weight.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(named, pa.string()), pa.array(best, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), _held_out().alias("held_out"), text_of().alias("text")).mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double"
    )
