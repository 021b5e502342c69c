"""Corpus files: raw and prepared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RAW_CORPUS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("pub_date", T.StringType()),
        T.StructField("feed", T.StringType()),
        T.StructField("text_cleaned", T.StringType()),
        T.StructField("text_html", T.StringType()),
        T.StructField("test_preprocessed", T.StringType()),
    ]
)


def with_metadata(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    """`schema` plus further metadata columns, which every operator carries through."""
    return T.StructType(
        schema.fields + [T.StructField(name, kind) for name, kind in columns.items()]
    )


def read_corpus(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_CORPUS,
    fmt: str = "json",
) -> DataFrame:
    """Lazy scan with a declared schema: no inference pass over the data.

    A malformed JSON line stops the job instead of turning into a row of nulls.
    """
    reader = spark.read.schema(schema)
    if fmt == "json":
        reader = reader.option("mode", "FAILFAST")
    return reader.format(fmt).load(path)


def spread_out(df: DataFrame) -> DataFrame:
    """Share out the rows of a few input files over all cores.

    A file that is one row group is one task however large; text work on it would use one
    core. Input of at least as many files as there are cores is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    # The JVM's array has a length; `df.inputFiles()` would fetch every name of a large table.
    files = len(df._jdf.inputFiles())
    return df.repartition(cores) if files < cores else df


def write_corpus(
    df: DataFrame, path: str, fmt: str = "parquet", by_year: bool = False, mode: str = "error"
) -> None:
    """Write a prepared corpus or an evaluation sample.

    With `by_year`, files are laid out by `year`, which the year filters then prune by.
    """
    writer = df.write.format(fmt).mode(mode)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    if by_year:
        writer = writer.partitionBy("year")
    writer.save(path)
