"""What several operators of this folder share: row keys, word columns, written tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinitext.session import cut_lineage, drop_stored  # noqa: F401

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
KEY = ["_k1", "_k2"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def with_key(docs: DataFrame, *more: str) -> DataFrame:
    """`docs` plus 128 bits that tell its rows apart by doc_id, text and the columns `more`.

    Rows that agree in all of them share a key; every operator treats them alike.
    """
    text, rest = text_of(), [F.struct(F.col(c)) for c in more]
    return docs.withColumn("_k1", F.xxhash64(F.col("doc_id"), text, *rest)).withColumn(
        "_k2", F.xxhash64(text, F.lit(1), F.col("doc_id"), *rest)
    )


def count_words(text: Column) -> Column:
    """Number of `WORD` matches: starts of words, counted without making strings of them."""
    marked = F.concat(F.lit(" "), F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.size(F.split(F.rtrim(marked), " +")).cast("long") - 1


def stored(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and go on from the written table."""
    return cut_lineage(df)
