"""From raw corpus files to a prepared corpus and an evaluation sample."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from affinitext.operators import corpus as ops
from affinitext.operators.tokens import preprocess


def select_articles(
    raw: DataFrame,
    years: Iterable[int] | None = ops.SEEN_YEARS,
    before: int | None = None,
    feed: str | None = ops.FEED,
) -> DataFrame:
    """Distinct articles of a feed, in given years or before one, with date and year.

    Rows are made distinct over all raw columns and only then lose the raw-only ones, so
    articles that differ just there all stay.
    """
    rows = raw if feed is None else ops.filter_feed(raw, feed)
    rows = ops.with_year(ops.with_pub_date(rows))
    if years is not None:
        rows = ops.filter_years(rows, years)
    if before is not None:
        rows = ops.filter_before(rows, before)
    return ops.drop_columns(ops.dedup_rows(rows))


def prepare_corpus(articles: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Articles with their lexical tokens, party names merged."""
    return ops.fix_party_names(preprocess(articles, lexicon))


def prepare_eval_set(
    raw: DataFrame, lexicon: DataFrame, n: int = ops.SAMPLE_SIZE, seed: str = "0",
    feed: str | None = ops.FEED,
) -> DataFrame:
    """`n` articles of the corpus years and `n` older ones, prepared like the corpus."""
    seen = select_articles(raw, feed=feed)
    unseen = select_articles(raw, None, min(ops.SEEN_YEARS), feed)
    return prepare_corpus(ops.build_eval_set(seen, unseen, n, seed), lexicon)
