"""Month arithmetic on month-end keyed tables."""

from __future__ import annotations

import calendar
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_begin(as_of: date, lag: int = 0) -> date:
    """First day of the month ``lag`` months before ``as_of``'s month."""
    year, month0 = divmod(as_of.year * 12 + as_of.month - 1 - lag, 12)
    return date(year, month0 + 1, 1)


def month_end(as_of: date, lag: int = 0) -> date:
    """Last day of the month ``lag`` months before ``as_of``'s month."""
    first = month_begin(as_of, lag)
    return first.replace(day=calendar.monthrange(first.year, first.month)[1])


def month_slice(
    df: DataFrame,
    as_of: date,
    lag: int,
    months: int = 1,
    column: str = "ddate",
    snapshot: bool = False,
) -> DataFrame:
    """Rows of ``months`` whole months, the last of which lies ``lag`` months back.

    ``snapshot=True`` keeps the single month-end day, for tables that hold one
    row per month. The bounds are literals, so a table partitioned or sorted
    by ``column`` is pruned at the scan.
    """
    last = month_end(as_of, lag)
    if snapshot:
        if months != 1:
            raise ValueError("a snapshot is one month")
        return df.filter(F.col(column) == F.lit(last))
    return df.filter(F.col(column).between(F.lit(month_begin(as_of, lag + months - 1)), F.lit(last)))


def shifted_month_end(day: Column, months_back: int) -> Column:
    """Month end ``months_back`` months before ``day``.

    ``add_months`` alone keeps the day of month (30 June - 3 = 30 March), which
    would match no month-end key; ``last_day`` restores it.
    """
    return F.last_day(F.add_months(day, -months_back))


def add_shifted_month(df: DataFrame, months_back: int, source: str = "ddate", target: str = "prof_month") -> DataFrame:
    return df.withColumn(target, shifted_month_end(F.col(source), months_back))
