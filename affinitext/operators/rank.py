"""Top-n, ranks per query, and what happens to the best hit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from affinitext.functions.vectors import tie_score

RANK_SALTS = 64
EXCLUDE_MODES = ("drop_if_best_is_self", "none")


def _best_first(score: str, id_col: str) -> list[Column]:
    return [F.desc_nulls_last(tie_score(F.col(score))), F.asc(id_col)]


def top_n(scored: DataFrame, n: int, score: str = "score", id_col: str = "id") -> DataFrame:
    """The `n` best-scored rows, ties by id; rows without a score, NaN included, never rank.

    Each partition keeps its own `n` best and only those meet. Rows without a score sort
    last and are dropped from the `n` kept, so that the score is worked out once per row.
    """
    known = scored.withColumn(score, F.nanvl(F.col(score), F.lit(None).cast("double")))
    best = known.orderBy(*_best_first(score, id_col)).limit(n)
    return best.filter(F.col(score).isNotNull())


def rank_per_query(
    scored: DataFrame,
    k: int,
    query: str = "query_id",
    score: str = "score",
    id_col: str = "id",
    salts: int = RANK_SALTS,
) -> DataFrame:
    """The `k` best rows of each query with their rank, rows without a score last.

    The rows of one query are first ranked in `salts` shares, so no task ever sees more of
    a query than its share and then `salts * k` rows.
    """
    order = _best_first(score, id_col)
    share = F.pmod(F.xxhash64(id_col), F.lit(salts))
    in_share = Window.partitionBy(query, "_share").orderBy(*order)
    best = (
        scored.withColumn("_share", share)
        .withColumn("_rank", F.row_number().over(in_share))
        .filter(F.col("_rank") <= k)
        .drop("_share", "_rank")
    )
    whole = Window.partitionBy(query).orderBy(*order)
    return best.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= k)


def clamp_n(n: Column, rows: Column) -> Column:
    """How many hits to show: one only, when there are fewer candidates than asked for."""
    return F.when((rows > 0) & (rows < n), F.lit(1)).otherwise(n)


def exclude_self(
    ranked: DataFrame,
    mode: str = "drop_if_best_is_self",
    query: str = "query_id",
    query_text: str = "query",
    text_col: str = "text_cleaned",
    rank: str = "rank",
) -> DataFrame:
    """Drop the best hit when its text is the query text, and move the others up.

    Only the best hit is looked at: further copies of the query text stay. `ranked` holds
    the few best hits of each query, one more than will be shown.
    """
    if mode not in EXCLUDE_MODES:
        raise ValueError(f"mode must be one of {EXCLUDE_MODES}")
    if mode == "none":
        return ranked
    is_self = (F.col(rank) == 1) & F.col(text_col).eqNullSafe(F.col(query_text))
    found = F.max(F.when(is_self, 1).otherwise(0)).over(Window.partitionBy(query))
    return (
        ranked.withColumn(rank, F.col(rank) - found).filter(F.col(rank) >= 1)
    )
