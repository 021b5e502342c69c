"""Publication dates: parsing and predicates that reach the scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

PUB_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"  # fixed value: the stored date format


def parse_pub_date(text: Column) -> Column:
    """Strict parse to a zone-less timestamp; bad text raises under ANSI mode."""
    return F.to_timestamp_ntz(text, F.lit(PUB_DATE_FORMAT))


def timestamp(value: datetime | str) -> Column:
    """A zone-less timestamp literal."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def in_years(date: Column, years: Iterable[int]) -> Column:
    """Date in one of `years`, as ranges of the date itself so that the scan can use them."""
    runs: list[list[int]] = []
    for year in sorted(set(years)):
        if runs and runs[-1][1] == year - 1:
            runs[-1][1] = year
        else:
            runs.append([year, year])
    ranges = [
        (date >= timestamp(f"{first:04d}-01-01 00:00:00"))
        & (date < timestamp(f"{last + 1:04d}-01-01 00:00:00"))
        for first, last in runs
    ]
    return reduce(or_, ranges) if ranges else F.lit(False)


def before_year(date: Column, year: int) -> Column:
    return date < timestamp(f"{year:04d}-01-01 00:00:00")


def has_parts(
    date: Column,
    day: int | None = None,
    month: int | None = None,
    year: int | None = None,
    compat: bool = False,
) -> Column:
    """Date with all the given parts.

    With `compat`, a month together with a day makes the year be ignored.
    """
    if compat and month is not None and day is not None:
        year = None
    tests = []
    if year is not None:
        tests.append(in_years(date, [year]))
    if month is not None:
        tests.append(F.month(date) == month)
    if day is not None:
        tests.append(F.dayofmonth(date) == day)
    return reduce(and_, tests) if tests else F.lit(True)


def in_range(
    date: Column, start: datetime | str | None = None, end: datetime | str | None = None
) -> Column:
    """Closed interval; either end may be open."""
    tests = []
    if start is not None:
        tests.append(date >= timestamp(start))
    if end is not None:
        tests.append(date <= timestamp(end))
    return reduce(and_, tests) if tests else F.lit(True)
