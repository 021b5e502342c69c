"""Side-by-side results of several vectorisations, and the tally of judged winners."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_results(results: Mapping[str, DataFrame]) -> DataFrame:
    """Results of several models one below the other, marked by `model`."""
    marked = [df.withColumn("model", F.lit(name)) for name, df in results.items()]
    return reduce(DataFrame.unionByName, marked)


def compare_models(
    results: Mapping[str, DataFrame], value: str = "shown", keys: tuple[str, ...] = ("id", "rank")
) -> DataFrame:
    """One row per (id, rank) with one `value` column per model."""
    long = stack_results({name: df.select(*keys, value) for name, df in results.items()})
    return long.groupBy(*keys).pivot("model", list(results)).agg(F.first(value))


def self_hits(results: Mapping[str, DataFrame]) -> DataFrame:
    """Share of the queries of each model whose best hit is the query itself."""
    best = stack_results({name: df.select("rank", "is_self") for name, df in results.items()})
    return (
        best.filter(F.col("rank") == 1)
        .groupBy("model")
        .agg(
            F.count(F.lit(1)).alias("n_queries"),
            F.avg(F.col("is_self").cast("double")).alias("self_hit_rate"),
        )
    )


def tally(df: DataFrame, label: str) -> DataFrame:
    """Count and share of every label; the total is the row without a label.

    A label that is itself NULL counts as `(empty)`.
    """
    named = F.coalesce(F.col(label).cast("string"), F.lit("(empty)")).alias(label)
    counted = df.groupBy(named).agg(F.count(F.lit(1)).alias("n"))
    totals = counted.rollup(label).agg(F.sum("n").alias("n"))
    return totals.withColumn("share", F.col("n") / counted.agg(F.sum("n")).scalar())
