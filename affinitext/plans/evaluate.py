"""Comparing vectorisations on an evaluation set."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinitext.functions.text import display_text, join_tokens
from affinitext.operators.compare import compare_models, stack_results
from affinitext.operators.lookup import rows_by_id
from affinitext.plans.search import batch_search
from affinitext.session import cut_lineage

EVAL_TOP = 3  # fixed value: ranks looked at per evaluation document


def rank_by_model(
    eval_set: DataFrame,
    corpus: DataFrame,
    models: Mapping[str, tuple[DataFrame, DataFrame]],
    n: int = EVAL_TOP,
) -> dict[str, DataFrame]:
    """Per model, the `n` best documents of every evaluation document.

    A model is a pair of (id, vector) tables: evaluation documents and corpus. Nothing is
    left out as the query itself; `is_self` tells where it was found. An evaluation document
    without a vector in a model has one row there, of rank 1 and without a hit.

    The evaluation set and each model's few hits are written, since each is read several times.
    """
    eval_set = cut_lineage(eval_set)
    ranked = {}
    for name, (query_vectors, corpus_vectors) in models.items():
        asked = eval_set.select("id", F.col("text_cleaned").alias("query"))
        queries = rows_by_id(query_vectors.select("id", "vector"), asked).select(
            F.col("id").alias("query_id"), "query", "vector", F.lit(n).alias("n")
        )
        hits = batch_search(
            queries, corpus_vectors, corpus.select("id", "text_cleaned"), "none", clamp=False
        )
        hits = eval_set.select(F.col("id").alias("query_id")).distinct().join(hits, "query_id", "left")
        ranked[name] = cut_lineage(hits.select(
            F.col("query_id").alias("id"),
            F.coalesce("rank", F.lit(1)).alias("rank"),
            F.col("id").alias("hit_id"),
            "cosine_sim_score",
            display_text(F.col("text_cleaned"), F.col("cosine_sim_score")).alias("shown"),
            F.coalesce(F.col("text_cleaned") == F.col("query"), F.lit(False)).alias("is_self"),
        ))
    return ranked


def evaluate(
    eval_set: DataFrame,
    corpus: DataFrame,
    models: Mapping[str, tuple[DataFrame, DataFrame]],
    n: int = EVAL_TOP,
    sheet: bool = False,
) -> DataFrame:
    """One row per evaluation document and rank, one column of shown text per model.

    With `sheet`, the judging sheet: `BEST` follows, empty, for the judge's choice of model
    (`operators.compare.tally` counts it), and `is_self`, true where a model's hit at that
    rank is the evaluation document's own text.
    """
    eval_set = cut_lineage(eval_set)
    ranked = rank_by_model(eval_set, corpus, models, n)
    wide = compare_models(ranked)
    asked = eval_set.select(
        "id",
        join_tokens(F.col("preprocessed_text")).alias("query_tokens"),
        F.col("text_cleaned").alias("query_doc"),
    )
    found = asked.join(wide, "id").select("id", "query_tokens", "query_doc", "rank", *models)
    if not sheet:
        return found
    selfs = stack_results({name: df.select("id", "rank", "is_self") for name, df in ranked.items()})
    selfs = selfs.groupBy("id", "rank").agg(F.max(F.col("is_self").cast("int")).cast("boolean").alias("is_self"))
    return found.join(selfs, ["id", "rank"]).select(
        "id", "query_tokens", "query_doc", "rank", *models, F.lit(None).cast("string").alias("BEST"), "is_self"
    )
