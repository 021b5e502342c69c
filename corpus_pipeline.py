"""From raw documents to packed sequences: five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from affinitext.llm import jaccard, mixing, packing, quality, suffixes
from affinitext.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return jaccard.keep_one(docs)


#: Bytes of the repeated strings this stage cuts out. A passage of over 50 words has at least
#: 101 bytes (51 words of one byte and 50 separators), so every repeated one is covered; op2
#: on its own keeps its 400 bytes.
PASSAGE_BYTES = 100


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of `PASSAGE_BYTES` that occur more than once, in one text or across texts,
    are cut out of the texts; other columns, and texts without such strings (null ones too),
    stay as they are."""
    return suffixes.without_repeats(docs, length=PASSAGE_BYTES)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix reads them."""
    return mixing.repeat_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_dedup", suffix_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot say what the stages do; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; what a stage returns is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
