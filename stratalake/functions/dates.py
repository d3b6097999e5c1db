"""Calendar columns and relative time windows. ``as_of`` always replaces the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_date(as_of: dt.date | dt.datetime | str) -> Column:
    return F.to_date(F.lit(str(as_of)))


def as_timestamp(as_of: dt.date | dt.datetime | str) -> Column:
    return F.to_timestamp(F.lit(str(as_of)))


def calendar_parts(df: DataFrame, ts: str) -> DataFrame:
    """Day, month start, year, Monday of the week and hour start of a timestamp column."""
    col = F.col(ts)
    return df.withColumns(
        {
            f"{ts}_day": F.to_date(col),
            f"{ts}_month": F.trunc(col, "month"),
            f"{ts}_year": F.year(col),
            f"{ts}_week": F.to_date(F.date_trunc("week", col)),
            f"{ts}_hour": F.date_trunc("hour", col),
        }
    )


def days_between(start: Column, end: Column) -> Column:
    """Number of midnights between two moments."""
    return F.datediff(F.to_date(end), F.to_date(start))


def shift_date(col: Column, n: Column | int, unit: str = "day") -> Column:
    """Move a date by a number of days or months; ``n`` may be a column and may be negative."""
    amount = F.lit(n) if isinstance(n, int) else n
    if unit == "day":
        return F.date_add(col, amount.cast("int"))
    if unit == "month":
        return F.add_months(col, amount.cast("int"))
    raise ValueError(f"unit {unit!r}: day or month")


def shift_timestamp(col: Column, days: Column) -> Column:
    """Move a timestamp by a number of days held in a column."""
    return col + F.make_dt_interval(days.cast("int"))


def in_last(col: Column, n: int, unit: str, as_of) -> Column:
    """Whether a date lies in the last ``n`` days, in the last ``n`` whole months or in the current month.

    The bound is a constant, so it is folded and reaches the Parquet scan.
    """
    if unit == "day":
        return col >= F.date_sub(as_date(as_of), n)
    if unit == "month":
        return col >= F.trunc(F.add_months(as_date(as_of), -n), "month")
    if unit == "this_month":
        return F.trunc(col, "month") == F.trunc(as_date(as_of), "month")
    raise ValueError(f"unit {unit!r}: day, month or this_month")
