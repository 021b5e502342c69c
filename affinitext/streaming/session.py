"""A search session as a stream: queries come in as files, results go out as files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from affinitext.operators.queries import ALLOWED_YEARS, COLUMNS, validate_queries
from affinitext.plans.search import batch_search, resolve_queries
from affinitext.session import cut_lineage
from affinitext.sources.results import write_results

QUERY_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())


def read_queries(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of queries from the JSON-lines files that appear in `folder`."""
    return spark.readStream.schema(QUERY_SCHEMA).json(folder)


def answer_stream(
    queries: DataFrame,
    index: DataFrame,
    corpus: DataFrame,
    words: DataFrame,
    lexicon: DataFrame,
    out: str,
    checkpoint: str,
    years: Iterable[int] = ALLOWED_YEARS,
) -> DataStreamWriter:
    """Answer every micro-batch of queries with one batch search.

    Results go to `out/answers/batch=N`, one folder per query, and refused queries with
    their reason to `out/rejected/batch=N`; one bad query does not stop the others. A
    batch that is run again after a failure overwrites its own folders. Start the returned
    writer with a trigger of your choice.
    """
    years = list(years)

    def answer(batch: DataFrame, number: int) -> None:
        valid, rejected = validate_queries(batch, years)
        resolved = cut_lineage(
            resolve_queries(valid, index, corpus, words, lexicon, unknown="drop")
        )
        lost = valid.join(resolved.select("query_id"), "query_id", "left_anti").withColumn(
            "reason", F.lit("no document has this id")
        )
        refused = rejected.unionByName(lost).select("query_id", "reason")
        refused.write.mode("overwrite").json(f"{out}/rejected/batch={number}")
        found = batch_search(resolved, index, corpus)
        write_results(found, f"{out}/answers/batch={number}", mode="overwrite")

    return queries.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
