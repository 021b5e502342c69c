"""Result files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_results(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    per_query: str | None = "query_id",
    mode: str = "error",
) -> None:
    """CSV with a header, one folder per query, as a rule with one file.

    `columns` fixes the column order; arrays are joined with spaces, as CSV has none.
    """
    names = list(columns or df.columns)
    if per_query and per_query not in names:
        names.append(per_query)
    flat = df.select([_csv_value(df, name) for name in names])
    if per_query:
        # One file per query; a result too large for a task is split over several.
        flat = flat.hint("rebalance", per_query)
    writer = (
        flat.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    if per_query:
        writer = writer.partitionBy(per_query)
    writer.csv(path)


def _csv_value(df: DataFrame, name: str):
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return F.array_join(F.col(name).cast("array<string>"), " ").alias(name)
    return F.col(name)


def read_results(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read result files back; quoted texts may span lines."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )
