"""Epoch repair and calendar parts, all as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .predicates import _c


def epoch_ms_to_ts(col: Column | str, precision: str = "millisecond") -> Column:
    """Epoch milliseconds to a timestamp, kept to the millisecond or the second."""
    c = _c(col).cast("long")
    if precision == "millisecond":
        return F.timestamp_millis(c)
    if precision == "second":
        return F.timestamp_seconds(F.floor(c / F.lit(1000)))
    raise ValueError(f"precision must be 'millisecond' or 'second', got {precision!r}")


def epoch_days_to_date(
    col: Column | str, epoch: str = "1960-01-01", default: str = "1900-01-01"
) -> Column:
    """Day number since ``epoch`` to a date; null, zero and negatives give ``default``."""
    days = _c(col).cast("int")
    return F.when(days > 0, F.date_add(F.lit(epoch).cast("date"), days)).otherwise(
        F.lit(default).cast("date")
    )


def parse_date(col: Column | str, fmt: str = "yyyyMMdd") -> Column:
    """Text to date by pattern; text that does not fit gives null."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("date")


def day_number(col: Column | str, base: str = "sunday1") -> Column:
    """Weekday number: Sunday=1 (default), Sunday=0 or Monday=0."""
    c = _c(col)
    if base == "sunday1":
        return F.dayofweek(c)
    if base == "sunday0":
        return F.dayofweek(c) - F.lit(1)
    if base == "monday0":
        return F.weekday(c)
    raise ValueError(f"unknown weekday base {base!r}")


def period_label(col: Column | str, part: str) -> Column:
    """``2016/1`` for a quarter, ``2016/01`` for a month."""
    c = _c(col)
    if part == "quarter":
        return F.concat_ws("/", F.year(c).cast("string"), F.quarter(c).cast("string"))
    if part == "month":
        return F.date_format(c, "yyyy/MM")
    raise ValueError(f"unknown period {part!r}")


def time_parts(col: Column | str, weekday_base: str = "sunday1") -> dict[str, Column]:
    """The calendar columns of a time dimension."""
    c = _c(col)
    return {
        "hour": F.hour(c),
        "day": F.dayofmonth(c),
        "week": F.weekofyear(c),
        "month": F.month(c),
        "year": F.year(c),
        "weekday": day_number(c, weekday_base),
        "day_of_week": F.date_format(c, "EEEE"),
    }


def date_parts(col: Column | str) -> dict[str, Column]:
    """The calendar columns of a date dimension."""
    c = _c(col)
    return {
        "id": c,
        "year": F.year(c),
        "year_quarter": period_label(c, "quarter"),
        "year_month": period_label(c, "month"),
        "quarter": F.quarter(c),
        "month": F.month(c),
        "week": F.weekofyear(c),
        "weekday": F.date_format(c, "EEEE"),
        "weekday_short": F.date_format(c, "EEE"),
        "dayofweek": F.dayofweek(c),
        "day": F.dayofmonth(c),
    }
