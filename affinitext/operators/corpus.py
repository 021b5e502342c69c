"""Corpus preparation: dates, filters, distinct rows, exact samples."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinitext.functions import dates, text
from affinitext.operators.lookup import rows_by_id
from affinitext.session import cut_lineage

# --- fixed values ----------------------------------------------------------------------
SEEN_YEARS = (2020, 2021)
FEED = "RTBFINFO"
RAW_ONLY_COLUMNS = ("text_html", "test_preprocessed")
SAMPLE_SIZE = 25
# ---------------------------------------------------------------------------------------

#: The column that names a row of a stored corpus, as a position does.
ROW_KEY = "row_key"


def with_pub_date(df: DataFrame, column: str = "pub_date") -> DataFrame:
    """Parse the stored date text; a date that is already a timestamp is left as it is."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return df
    return df.withColumn(column, dates.parse_pub_date(F.col(column)))


def with_year(df: DataFrame, column: str = "pub_date") -> DataFrame:
    return df.withColumn("year", F.year(column))


def filter_years(df: DataFrame, years: Iterable[int] = SEEN_YEARS, column: str = "pub_date"):
    """Rows of the given years.

    Tested on the date, as a range the scan can use. A `year` column adds its own test,
    which prunes folders when the files are laid out by year.
    """
    years = list(years)
    kept = df.filter(dates.in_years(F.col(column), years))
    return kept.filter(F.col("year").isin(years)) if "year" in df.columns else kept


def filter_before(df: DataFrame, year: int = min(SEEN_YEARS), column: str = "pub_date"):
    kept = df.filter(dates.before_year(F.col(column), year))
    return kept.filter(F.col("year") < year) if "year" in df.columns else kept


def filter_feed(df: DataFrame, feed: str = FEED, column: str = "feed") -> DataFrame:
    return df.filter(F.col(column) == feed)


def drop_columns(df: DataFrame, columns: Iterable[str] = RAW_ONLY_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def filter_date_parts(
    df: DataFrame,
    day: int | None = None,
    month: int | None = None,
    year: int | None = None,
    compat: bool = False,
    column: str = "pub_date",
) -> DataFrame:
    return df.filter(dates.has_parts(F.col(column), day, month, year, compat))


def filter_date_range(
    df: DataFrame,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    column: str = "pub_date",
) -> DataFrame:
    return df.filter(dates.in_range(F.col(column), start, end))


def get_document(df: DataFrame, doc_id: int, id_col: str = "id") -> DataFrame:
    """The rows of one id; an unknown id is an error."""
    found = df.filter(F.col(id_col) == doc_id)
    if found.select(id_col).isEmpty():
        raise ValueError(f"no document has the id {doc_id}")
    return found


def get_documents(
    df: DataFrame, wanted: DataFrame, id_col: str = "id", required: bool = False
) -> DataFrame:
    """The documents of a table of ids: one row per wanted id, NULLs where there is none.

    With `required`, an unknown id stops the job when the rows are read. The documents
    are fetched like search hits, without moving the whole table for a few ids.
    """
    wanted = wanted.select(id_col)
    documents = rows_by_id(df.withColumn("_found", F.lit(True)), wanted.distinct(), id_col)
    found = wanted.join(documents, id_col, "left")
    if required:
        missing = F.concat(F.lit("no document has the id "), F.col(id_col).cast("string"))
        checked = F.when(F.col("_found"), F.col(id_col)).otherwise(
            F.raise_error(missing).cast("bigint")
        )
        found = found.withColumn(id_col, checked)
    return found.drop("_found")


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct rows over all columns, the ones dropped later included.

    Copies collapse within each partition before anything is shuffled, so a large group
    of identical rows sends one row per partition.
    """
    return df.dropDuplicates()


def with_row_key(corpus: DataFrame, id_col: str = "id", key: str = ROW_KEY) -> DataFrame:
    """`corpus` plus `key`, a bigint that tells its rows apart, ids repeated or not.

    Rows are range-partitioned by id and sorted, so keys ascend with the id (rows of one id by
    all their other columns) and a stored corpus is laid out by id. The keys are made where
    the corpus is written and read from there on: vectors, index and hits carry them, so that
    two rows of one id are two candidates, like two positions.
    """
    others = [F.to_json(F.struct(*[c for c in corpus.columns if c not in (id_col, key)]))]
    placed = corpus.drop(key).repartitionByRange(id_col).sortWithinPartitions(id_col, *others)
    return placed.withColumn(key, F.monotonically_increasing_id())


def sample_exact(
    df: DataFrame, n: int = SAMPLE_SIZE, seed: str = "0", id_col: str = "id"
) -> DataFrame:
    """Exactly `n` rows without replacement, the same ones for the same seed.

    Each partition keeps its own `n` best keys, so nothing is sorted as a whole. The
    sample is written once: whatever uses it sees the same rows without drawing again.
    Fewer than `n` rows are an error.
    """
    key = F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string")))
    keyed = df.withColumn("_key", key)
    picked = cut_lineage(keyed.orderBy("_key", id_col).limit(n).drop("_key"))
    if picked.count() < n:
        raise ValueError(f"fewer than {n} rows to sample from")
    return picked


def build_eval_set(
    seen: DataFrame, unseen: DataFrame, n: int = SAMPLE_SIZE, seed: str = "0", id_col: str = "id"
) -> DataFrame:
    """`n` rows of each set, one below the other, marked by where they came from."""
    return (
        sample_exact(seen, n, seed, id_col)
        .withColumn("is_seen", F.lit(True))
        .unionByName(
            sample_exact(unseen, n, seed, id_col).withColumn("is_seen", F.lit(False))
        )
    )


def fix_party_names(
    df: DataFrame, text_col: str = "text_cleaned", tokens_col: str = "preprocessed_text"
) -> DataFrame:
    """Merge party names in the tokens of texts that mention one."""
    mentions = F.coalesce(F.col(text_col).rlike(text.PARTY_TEXT), F.lit(False))
    tokens = F.col(tokens_col)
    return df.withColumn(
        tokens_col, F.when(mentions, text.merge_party_name(tokens)).otherwise(tokens)
    )


def profile(df: DataFrame) -> DataFrame:
    """Row count and column names, as one row; the plan is `df.explain()`."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "columns", F.lit(", ".join(df.columns))
    )


def select_columns(df: DataFrame, columns: Iterable[str] | Mapping[str, str]) -> DataFrame:
    """Column selection, with new names where a mapping is given; nothing is collected."""
    if isinstance(columns, Mapping):
        return df.select([F.col(old).alias(new) for old, new in columns.items()])
    return df.select(*columns)


def one_per_id(corpus: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """Rows with one row per id, and the rows left out for another of their id.

    Of several rows the first by all other columns is taken, so the choice does not depend on
    the layout.
    """
    others = [F.to_json(F.struct(*[c for c in corpus.columns if c != id_col]))]
    place = F.row_number().over(Window.partitionBy(id_col).orderBy(*others))
    numbered = corpus.withColumn("_place", place)
    return (
        numbered.filter(F.col("_place") == 1).drop("_place"),
        numbered.filter(F.col("_place") > 1).drop("_place"),
    )
