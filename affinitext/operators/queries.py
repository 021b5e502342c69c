"""The table of queries: its defaults and its validation."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------------------
TOP_N = 3
ALLOWED_YEARS = (2020, 2021)
# ---------------------------------------------------------------------------------------

COLUMNS = {
    "query_id": "bigint",
    "text": "string",
    "doc_id": "bigint",
    "day": "int",
    "month": "int",
    "year": "int",
    "start_date": "timestamp_ntz",
    "end_date": "timestamp_ntz",
    "n": "int",
}


DATES = ("start_date", "end_date")
#: How a date may be typed besides Spark's own forms: day, month, year (fixed).
TYPED_DATE = "dd-MM-yyyy"
BAD_DATE = f"dates are {TYPED_DATE} or yyyy-MM-dd[ HH:mm:ss]"


def _typed_date(text: Column) -> Column:
    """A date typed as text, NULL where it is none."""
    as_is = text.try_cast("timestamp_ntz")
    typed = F.try_to_timestamp(text, F.lit(TYPED_DATE)).cast("timestamp_ntz")
    return F.coalesce(as_is, typed)


def _unreadable_dates(queries: DataFrame) -> Column:
    """True where a date given as text cannot be read."""
    bad = F.lit(False)
    for name in DATES:
        if name in queries.columns and queries.schema[name].dataType.simpleString() == "string":
            bad = bad | (F.col(name).isNotNull() & _typed_date(F.col(name)).isNull())
    return bad


def with_query_columns(queries: DataFrame, unreadable: str = "raise") -> DataFrame:
    """Queries with every column of the model, missing ones NULL, `n` defaulted.

    Dates given as text may be typed `dd-MM-yyyy` too. One that cannot be read stops the
    job, or with `unreadable="null"` becomes NULL (`validate_queries` rejects such rows).
    """
    for name, kind in COLUMNS.items():
        have = F.col(name) if name in queries.columns else F.lit(None)
        if name in DATES and name in queries.columns and queries.schema[name].dataType.simpleString() == "string":
            read = _typed_date(have)
            if unreadable == "raise":
                message = F.concat(F.lit(f"{name} cannot be read: "), have)
                read = F.when(have.isNull() | read.isNotNull(), read).otherwise(F.raise_error(message))
            queries = queries.withColumn(name, read.cast(kind))
        else:
            queries = queries.withColumn(name, have.cast(kind))
    return queries.withColumn("n", F.coalesce("n", F.lit(TOP_N)))


def reject_reason(years: Iterable[int] = ALLOWED_YEARS) -> Column:
    """Why a query is refused, NULL if it is not; the first failing rule names it."""
    years = list(years)
    col = F.col
    has_part = reduce(lambda a, b: a | b, [col(p).isNotNull() for p in ("day", "month", "year")])
    has_range = col("start_date").isNotNull() | col("end_date").isNotNull()
    both = col("start_date").isNotNull() & col("end_date").isNotNull()
    rules = [
        (col("text").isNull() == col("doc_id").isNull(), "give either a text or an id"),
        (has_part & has_range, "date parts and a date range exclude each other"),
        (~col("month").between(1, 12), "month must be 1 to 12"),
        (~col("day").between(1, 31), "day must be 1 to 31"),
        (~col("year").isin(years), "year outside the corpus"),
        (both & (col("start_date") >= col("end_date")), "start must be before end"),
        (
            both & ~(F.year("start_date").isin(years) & F.year("end_date").isin(years)),
            "range outside the years of the corpus",
        ),
    ]
    reason = F.lit(None).cast("string")
    for broken, message in reversed(rules):
        reason = F.when(broken, message).otherwise(reason)
    return reason


def validate_queries(
    queries: DataFrame, years: Iterable[int] = ALLOWED_YEARS
) -> tuple[DataFrame, DataFrame]:
    """(valid queries, rejected queries with their `reason`); a date typed as text that cannot
    be read is a reason too."""
    unreadable = _unreadable_dates(queries)
    checked = with_query_columns(queries.withColumn("_unreadable", unreadable), "null").withColumn(
        "reason", F.when(F.col("_unreadable"), F.lit(BAD_DATE)).otherwise(reject_reason(years))
    ).drop("_unreadable")
    valid = checked.filter(F.col("reason").isNull()).drop("reason")
    return valid, checked.filter(F.col("reason").isNotNull())
